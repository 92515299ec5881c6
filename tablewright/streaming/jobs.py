"""Change logs as streams: each batch goes through the batch operators.

A subscriber keeps its table as versions, one folder per batch. A batch that runs again
after a failure reads the version before its own and writes the same folder anew, so
replays change nothing. A change that conflicts stops the stream before its version is
written; once the table or the log is repaired the job goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators.rules import RuleViolation
from tablewright.session import hadoop_path
from tablewright.streaming import changes as logs


class Subscriber:
    """A table that follows a folder of change files."""

    def __init__(self, spark: SparkSession, folder: str, key: str | Sequence[str], schema: StructType, stop_at_conflicts: bool = False):
        self.spark, self.folder, self.key, self.schema, self.stop = spark, folder.rstrip("/"), key, schema, stop_at_conflicts

    def _path(self, version: int) -> str:
        return f"{self.folder}/table/version={version}"

    def versions(self) -> list[int]:
        fs, path = hadoop_path(self.spark, f"{self.folder}/table")
        if not fs.exists(path):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        done = [n for n in names if fs.exists(hadoop_path(self.spark, f"{self.folder}/table/{n}/_SUCCESS")[1])]
        return sorted(int(n.partition("=")[2]) for n in done)

    def start_from(self, rows: DataFrame) -> None:
        """The initial copy, or a new one after the subscriber was out of step."""
        rows.write.mode("overwrite").parquet(self._path(max(self.versions(), default=-1)))

    def read(self, before: int | None = None) -> DataFrame:
        known = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.schema(self.schema).parquet(self._path(known[-1]))

    def _apply(self, batch: DataFrame, number: int) -> None:
        logs.check_drift(batch, self.schema)
        present = self.read(before=number)
        if self.stop:
            found = logs.conflicts(present, batch, self.key).where(F.col("conflict").isin(*logs.STOPPING))
            if not found.isEmpty():
                raise RuleViolation(f"batch {number} conflicts with the table")
        logs.apply_changes(present, batch, self.key).write.mode("overwrite").parquet(self._path(number))

    def follow(self, source: str, schema: StructType, files_per_batch: int = 1) -> None:
        """Apply what the folder has and the subscriber has not, then end; a later call catches up."""
        stream = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
        job = stream.writeStream.foreachBatch(self._apply).option("checkpointLocation", f"{self.folder}/progress")
        job.trigger(availableNow=True).start().awaitTermination()
