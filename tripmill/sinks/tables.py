"""Where results go: catalog tables, connectors, and the publishing of several targets."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tripmill.functions.calendar import is_zoned
from tripmill.plans.staging import staging_sql
from tripmill.scenario import DEFAULT_SIZE, sized_name
from tripmill.sinks.versions import quoted, remove_folder, replace_table, set_view, write_parquet

#: Writes a frame to the target of a name; may return the version it has made.
Sink = Callable[[DataFrame, str], str | None]


class PublishError(RuntimeError):
    """Some targets could not be written; ``failures`` maps each to its error."""

    def __init__(self, failures: Mapping[str, Exception]):
        self.failures = dict(failures)
        lines = [f"{name}: {error}" for name, error in self.failures.items()]
        super().__init__(f"{len(lines)} target(s) failed\n" + "\n".join(lines))


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the schema if it is absent, below ``location`` when given."""
    where = " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)}{where}")


def format_sink(fmt: str, name_option: str = "table", **options: str) -> Sink:
    """A sink that goes through a connector on the classpath.

    The target name is handed over as ``name_option``; ``options`` pass through,
    e.g. ``format_sink("bigquery", temporaryGcsBucket="...")``.
    """

    def write(df: DataFrame, name: str) -> None:
        df.write.format(fmt).options(**options).option(name_option, name).mode("overwrite").save()

    return write


def replace_staging_view(
    spark: SparkSession, raw_table: str, view: str, null_tip: str = "zero", survivor: str = "first"
) -> None:
    """A catalog view over ``raw_table``; its rows are worked out on each read."""
    zoned = is_zoned(spark.table(raw_table), "trip_start_timestamp")
    text = staging_sql(raw_table, zoned, null_tip, survivor)
    set_view(spark, view, text)


def side_by_side(
    spark: SparkSession, jobs: Mapping[str, Callable[[], object]], threads: int
) -> dict[str, object]:
    """Run jobs, up to ``threads`` at a time, and return each one's result or its error.

    Each job is in a scheduler pool of its own name, so that with
    ``spark.scheduler.mode=FAIR`` a long one does not hold up the others. Only an
    ``Exception`` is an answer; anything else (an interrupt) ends the call.
    """

    def run(name: str) -> object:
        if threads > 1:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return jobs[name]()
        except Exception as error:
            return error

    if threads <= 1:
        return {name: run(name) for name in jobs}
    with ThreadPoolExecutor(threads) as pool:
        started = {
            name: pool.submit(inheritable_thread_target(spark)(run), name) for name in jobs
        }
        return {name: job.result() for name, job in started.items()}


def publish(
    frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
    schema: str | None = None,
    size: str = DEFAULT_SIZE,
    sink: Sink = replace_table,
    spark: SparkSession | None = None,
    threads: int = 1,
) -> dict[str, str]:
    """Write each frame to ``schema.name_size`` and return the target names.

    A frame may be given as a function, so that an unreadable source fails only
    its own target. One failure does not stop the others, but it is raised in
    the end: a partial publish never looks like a whole one. With ``threads``, so many
    targets are written at a time.
    """
    targets = {name: sized_name(name, size, schema) for name in frames}

    def job(name: str) -> Callable[[], object]:
        def write() -> object:
            frame = frames[name]
            return sink(frame() if callable(frame) else frame, targets[name])

        return write

    spark = spark or SparkSession.active()
    done = side_by_side(spark, {name: job(name) for name in frames}, threads)
    raise_failures({targets[name]: result for name, result in done.items()})
    return targets


def raise_failures(results: Mapping[str, object]) -> None:
    """Raise one error for all results that are errors."""
    failures = {name: x for name, x in results.items() if isinstance(x, Exception)}
    if failures:
        raise PublishError(failures) from next(iter(failures.values()))


__all__ = [
    "PublishError", "Sink", "ensure_schema", "format_sink", "publish", "raise_failures",
    "remove_folder", "replace_staging_view", "replace_table", "side_by_side", "write_parquet",
]
