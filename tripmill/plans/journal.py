"""What a run has done, so that it can go on where it was interrupted.

A run is named by its id. Each step leaves a file in the run's folder once its output is
committed; the file's name holds a fingerprint of all that the step depends on, and
its content names the version it has made. The same step of the same run is
left out while its fingerprint is the same and its version still stands. Steps name the
versions they read, so redoing one redoes what depends on it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmill.sinks.versions import _hadoop, get_file, put_file, remove_folder


def source_mark(df: DataFrame) -> dict:
    """What a journal can tell of a source: its columns and the names of its files.

    Files that keep their names and change their content are not seen; name another
    run then.
    """
    names = "\n".join(sorted(df.inputFiles()))
    return {"schema": df.schema.json(), "files": hashlib.sha256(names.encode()).hexdigest()}


def fingerprint(inputs: dict) -> str:
    text = json.dumps(inputs, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:32]


class Journal:
    """The steps of one run, below ``folder``. Without a folder every step is done again."""

    def __init__(self, spark: SparkSession, folder: str | None):
        self.spark, self.folder = spark, folder

    def _path(self, step: str, inputs: dict) -> str:
        return f"{self.folder}/{step}.{fingerprint(inputs)}"

    def version(self, step: str, inputs: dict) -> str | None:
        """The version that the step has made, if it was done with these inputs."""
        text = self.folder and get_file(self.spark, self._path(step, inputs))
        return json.loads(text)["version"] if text else None

    def once(
        self,
        step: str,
        inputs: Callable[[], dict],
        do: Callable[[], str | None],
        stands: Callable[[str], bool] = lambda version: True,
    ) -> str | None:
        """The step's version: made by ``do`` unless it is on record and ``stands``."""
        if not self.folder:
            return do()
        given = inputs()
        made = self.version(step, given)
        if made is not None and stands(made):
            return made
        made = do() or ""
        path = self._path(step, given)
        files, at = _hadoop(self.spark, path)
        files.mkdirs(at(self.folder))
        remove_folder(self.spark, path)
        put_file(self.spark, path, json.dumps({"version": made, "inputs": given}, default=str))
        return made
