"""Runs whose outputs appear together, at the end, or not at all.

Every attempt at a run writes into folders of its own, ``run=<name>/attempt=<number>``, so
nothing that readers see is touched. What an attempt wrote counts from the moment its
manifest is in place, which is the last thing it does: one small file, put under its name in
one step. Readers take of each run the latest attempt that has a manifest. An attempt that
stops halfway leaves the former one whole.

Numbers of attempts are claimed by creating a file that must not exist yet, so two drivers
that repeat a run at the same time do not share one.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicecheck.settings import remove

RUN_COLUMNS = ["run", "attempt"]
_MANIFEST = "run string, attempt int, outputs array<string>"


@dataclass(frozen=True)
class Attempt:
    run: str
    number: int

    def folder(self, path: str, **parts: int) -> str:
        own = [f"run={self.run}", f"attempt={self.number}", *[f"{k}={v}" for k, v in parts.items()]]
        return "/".join([path.rstrip("/"), *own])


class Runs:
    """The manifests of runs, in a folder of any store that Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def begin(self, run: str) -> Attempt:
        """A new attempt at a run, with a number that no other attempt has."""
        if not re.fullmatch(r"[A-Za-z][A-Za-z0-9._-]*", run):
            raise ValueError(f"the name of a run is a folder name that begins with a letter: {run!r}")
        fs, claims = self._open(f"{self.path}/_claims/{run}")
        number = 1 + max(map(int, self._names(fs, claims)), default=0)
        while True:
            try:
                fs.create(self._at(f"{self.path}/_claims/{run}/{number}"), False).close()
                return Attempt(run, number)
            except Py4JJavaError as error:
                if not fs.exists(self._at(f"{self.path}/_claims/{run}/{number}")):
                    raise error
                number += 1

    def write(self, df: DataFrame, path: str, attempt: Attempt, **parts: int) -> None:
        """The rows of one output of an attempt. ``parts`` are columns with one value in all
        rows, which become folders like the run. A task that is run again writes the same."""
        df.drop(*RUN_COLUMNS, *parts).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(attempt.folder(path, **parts))

    def commit(self, attempt: Attempt, outputs: list[str]) -> None:
        """From here on readers see this attempt. The file is written under a hidden name and
        then renamed, so it is never seen in part."""
        text = json.dumps({"run": attempt.run, "attempt": attempt.number, "outputs": outputs})
        fs, hidden = self._open(f"{self.path}/_new/{attempt.run}-{attempt.number}")
        stream = fs.create(hidden, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        final = self._at(f"{self.path}/{attempt.run}-{attempt.number}.json")
        fs.mkdirs(final.getParent())
        if not fs.rename(hidden, final) and not fs.exists(final):
            raise OSError(f"the manifest of {attempt} could not be put in place")

    def committed(self) -> DataFrame:
        """``run, attempt``: the attempt of each run that counts."""
        fs, folder = self._open(self.path)
        names = [n for n in self._names(fs, folder) if n.endswith(".json")]
        if not names:
            return self.spark.createDataFrame([], "run string, attempt int")
        found = self.spark.read.schema(_MANIFEST).json(self.path)
        return found.groupBy("run").agg(F.max("attempt").alias("attempt"))

    def read(self, path: str) -> DataFrame:
        """The rows of an output, of the attempts that count. Their folders are picked by the
        join before files are opened."""
        return self._rows(path).join(self.committed(), RUN_COLUMNS, "left_semi")

    def read_ledger(self, path: str) -> DataFrame:
        """All rows of tasks that were begun, and outcomes of attempts that count."""
        rows = self._rows(path)
        begun = rows.where("seq = 0")
        return begun.unionByName(rows.where("seq <> 0").join(self.committed(), RUN_COLUMNS, "left_semi"))

    def remove_superseded(self, run: str, path: str) -> int:
        """Deletes what earlier attempts of a run than the one that counts left under ``path``,
        once nobody reads them any more. Returns how many there were."""
        last = self.committed().where(F.col("run") == run).first()
        fs, folder = self._open(f"{path.rstrip('/')}/run={run}")
        numbers = [int(n.removeprefix("attempt=")) for n in self._names(fs, folder) if n.startswith("attempt=")]
        old = [n for n in numbers if last is not None and n < last.attempt]
        for number in old:
            remove(self.spark, Attempt(run, number).folder(path))
        return len(old)

    def _rows(self, path: str) -> DataFrame:
        # Names like 007 stay what they are.
        with_types = self.spark.read.option("mergeSchema", "true").parquet(path)
        return with_types.withColumns({"run": F.col("run").cast("string"), "attempt": F.col("attempt").cast("int")})

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _open(self, path: str):
        at = self._at(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    @staticmethod
    def _names(fs, folder) -> list[str]:
        if not fs.exists(folder):
            return []
        return [status.getPath().getName() for status in fs.listStatus(folder) if not status.getPath().getName().endswith(".crc")]
