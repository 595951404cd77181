"""Tables and folders that are replaced without a moment in which there is none.

Every replacement writes a version of its own, which nobody reads yet, and then becomes
current in one step:

- A folder holds its versions below ``_runs`` and one small file for each committed version
  below ``_commits``. Readers take the version of the last such file. It is made
  under another name and renamed, so it is there as a whole or not at all, also on an object store,
  and no folder is ever renamed.
- A table of the session catalog is a view over the current version's table; one call to the
  catalog alters the view. (``CREATE OR REPLACE VIEW`` drops the view first, so it is
  used for none.)

The current and the previous version stay, and any that was replaced less than
``KEPT_SECONDS`` ago, so a reader that began before a replacement can end. Older versions, and
what a run has left that died before its commit, go with the next replacement. Versions
are numbered. A target has one writer at a time; of two, the later number would be current.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Committed versions that stay: the current one and those before it.
KEPT = 2
#: How long a version stays after it was replaced, at least.
KEPT_SECONDS = 3600

_RUNS, _COMMITS = "_runs", "_commits"


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and a function that makes its paths."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return files, hadoop.Path


def remove_folder(spark: SparkSession, path: str) -> None:
    files, at = _hadoop(spark, path)
    files.delete(at(path), True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, in order; none if there is no folder."""
    files, at = _hadoop(spark, path)
    if not files.exists(at(path)):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(at(path)))


def put_file(spark: SparkSession, path: str, content: str) -> None:
    """Make a small file that is never seen half written."""
    files, at = _hadoop(spark, path)
    folder, _, name = path.rpartition("/")
    own = f"{folder}/.{name}.{uuid.uuid4().hex}"
    out = files.create(at(own), False)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    if not files.rename(at(own), at(path)):
        files.delete(at(own), False)
        raise OSError(f"cannot make {path}")


def get_file(spark: SparkSession, path: str) -> str | None:
    """What ``put_file`` has put there."""
    files, at = _hadoop(spark, path)
    if not files.exists(at(path)):
        return None
    stream = files.open(at(path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _modified(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, by its file system's clock; 0 if it is gone."""
    files, at = _hadoop(spark, path)
    return files.getFileStatus(at(path)).getModificationTime() / 1000 if files.exists(at(path)) else 0


def _outdated(versions: list[str], made: dict[str, float]) -> list[str]:
    """Of versions in order, those that nobody should be reading any more.

    ``made`` says when each was made, which is when the one before it was replaced.
    """
    old = []
    for version, after in zip(versions[:-KEPT], versions[1:], strict=False):
        if made[versions[-1]] - made[after] >= KEPT_SECONDS:
            old.append(version)
    return old


def _next(versions: list[str]) -> str:
    """A version name that sorts behind all others."""
    return f"{max((_number(v) for v in versions), default=0) + 1:09d}-{uuid.uuid4().hex[:12]}"


def _number(version: str) -> int:
    return int(re.match(r"\d+", version)[0])


# Folders


def _committed(spark: SparkSession, path: str) -> list[str]:
    return [v for v in names_in(spark, f"{path}/{_COMMITS}") if v[0].isdigit()]


def current_folder(spark: SparkSession, path: str) -> str | None:
    """The current version of a folder; none before the first commit."""
    return (_committed(spark, path.rstrip("/")) or [None])[-1]


def version_path(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/{_RUNS}/{version}"


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a folder's current version.

    A folder without versions, or a glob, is read as plain Parquet.
    """
    path = path.rstrip("/")
    version = None if re.search(r"[*?\[{]", path) else current_folder(spark, path)
    return spark.read.parquet(version_path(path, version) if version else path)


def _sweep_folder(spark: SparkSession, path: str) -> None:
    """Remove outdated versions, and what died before its commit."""
    committed = _committed(spark, path)
    made = {v: _modified(spark, f"{path}/{_COMMITS}/{v}") for v in committed}
    for version in _outdated(committed, made):
        # Without its commit a version is found by nobody.
        remove_folder(spark, f"{path}/{_COMMITS}/{version}")
        committed.remove(version)
    for run in names_in(spark, f"{path}/{_RUNS}"):
        if run not in committed and run < committed[-1]:
            remove_folder(spark, version_path(path, run))
    if len(committed) >= KEPT:
        # Plain files from before the folder had versions.
        for name in names_in(spark, path):
            if name[0] not in "_.":
                remove_folder(spark, f"{path}/{name}")


def write_parquet(
    df: DataFrame,
    path: str,
    before_commit: Callable[[str], None] | None = None,
    **options: str,
) -> str:
    """Replace the rows of folder ``path`` and return the new version.

    Until the commit, and if anything fails, readers get the rows from before. ``before_commit``
    is called with the new version's folder once its rows are written; ``options``
    are those of Spark's Parquet writer.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    version = _next(_committed(spark, path) + names_in(spark, f"{path}/{_RUNS}"))
    run = version_path(path, version)
    try:
        df.write.options(**options).parquet(run)
        if before_commit is not None:
            before_commit(run)
        files, at = _hadoop(spark, path)
        files.mkdirs(at(f"{path}/{_COMMITS}"))
        put_file(spark, f"{path}/{_COMMITS}/{version}", json.dumps({"files": names_in(spark, run)}))
    except Exception:
        remove_folder(spark, run)
        raise
    _sweep_folder(spark, path)
    return version


# Tables of the session catalog


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _parts(spark: SparkSession, name: str) -> tuple[str, str]:
    schema, _, base = name.rpartition(".")
    return schema or spark.catalog.currentDatabase(), base


def _of(base: str) -> re.Pattern:
    """The names of version tables of ``base``."""
    return re.compile(rf"v\d+_[0-9a-f]+__{re.escape(base.lower())}")


def _version_table(base: str, version: str) -> str:
    return f"v{version.replace('-', '_')}__{base}".lower()


def _version_tables(spark: SparkSession, schema: str, base: str) -> list[str]:
    rows = spark.sql(f"SHOW TABLES IN {quoted(schema)} LIKE 'v*__{base}'").collect()
    return sorted(r["tableName"] for r in rows if _of(base).fullmatch(r["tableName"].lower()))


def _table_folders(spark: SparkSession, schema: str, base: str) -> list[str]:
    """Folders of versions below the schema's own, with and without a table."""
    folder = spark.catalog.getDatabase(schema).locationUri
    return [x for x in names_in(spark, folder) if _of(base).fullmatch(x)]


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _is_view(spark: SparkSession, name: str) -> bool | None:
    """Whether ``name`` is a view of the catalog; none if there is no such thing."""
    if not spark.catalog.tableExists(name):
        return None
    return "View Text" in _described(spark, name)


def current_table(spark: SparkSession, name: str) -> str | None:
    """The table of the current version behind ``name``; none if it has no versions."""
    if not _is_view(spark, name):
        return None
    found = re.search(r"`(v\d+_[0-9a-f]+__[^`]+)`$", _described(spark, name)["View Text"].strip())
    return found and found[1]


def set_view(spark: SparkSession, name: str, text: str) -> None:
    """Make or alter a catalog view; an existing one is never gone in between."""
    verb = "ALTER" if _is_view(spark, name) else "CREATE"
    spark.sql(f"{verb} VIEW {quoted(name)} AS {text}")


def _sweep_tables(spark: SparkSession, schema: str, base: str, current: str) -> None:
    """Drop outdated versions, and what died before its commit."""
    folder = spark.catalog.getDatabase(schema).locationUri
    tables = [t for t in _version_tables(spark, schema, base) if t <= current]
    made = {t: _modified(spark, f"{folder}/{t}") for t in tables}
    for table in _outdated(tables, made):
        spark.sql(f"DROP TABLE IF EXISTS {quoted(f'{schema}.{table}')}")
    there = {t.lower() for t in _version_tables(spark, schema, base)}
    for name in _table_folders(spark, schema, base):
        # A run that died while it wrote leaves a folder without a table.
        if name not in there and name < current.lower():
            remove_folder(spark, f"{folder}/{name}")


def replace_table(df: DataFrame, name: str) -> str | None:
    """Replace the rows of ``name`` and return the table of the new version.

    A catalog of its own (a name of three parts) replaces its tables itself. In the session
    catalog ``name`` is a view over versions. A plain table of that name is
    taken over once as the version before: only then ``name`` is absent for a moment.
    """
    spark = df.sparkSession
    if name.count(".") == 2:
        df.writeTo(name).createOrReplace()
        return None
    schema, base = _parts(spark, name)
    whole = f"{schema}.{base}"
    # Also what died before its commit counts, so that numbers are never used again.
    known = _version_tables(spark, schema, base) + _table_folders(spark, schema, base)
    version = _version_table(base, _next([t[1:] for t in known]))
    fresh = f"{schema}.{version}"
    try:
        df.write.saveAsTable(quoted(fresh))
        if _is_view(spark, whole) is False:
            before = _version_table(base, f"{0:09d}-{uuid.uuid4().hex[:12]}")
            spark.sql(f"ALTER TABLE {quoted(whole)} RENAME TO {quoted(f'{schema}.{before}')}")
        set_view(spark, whole, f"SELECT * FROM {quoted(fresh)}")
    except Exception:
        if current_table(spark, whole) != version:
            spark.sql(f"DROP TABLE IF EXISTS {quoted(fresh)}")
        raise
    _sweep_tables(spark, schema, base, version)
    return version


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a replaced table with all its versions, or a plain one."""
    schema, base = _parts(spark, name)
    kind = _is_view(spark, f"{schema}.{base}")
    if kind is not None:
        spark.sql(f"DROP {'VIEW' if kind else 'TABLE'} {quoted(f'{schema}.{base}')}")
    for table in _version_tables(spark, schema, base):
        spark.sql(f"DROP TABLE IF EXISTS {quoted(f'{schema}.{table}')}")
