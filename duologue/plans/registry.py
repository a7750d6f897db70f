"""Keyed tables that grow by small batches: a log of deltas, merged level by level.

Batch ``n`` writes only its own rows.  When ``fanout`` runs of a level are full they are
merged into one run of the next level, so a row is written once per level and a reader
opens a few runs per level, however many batches there were.  Which runs are in force
follows from the number of batches alone; a batch that is run again writes the same runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class DeltaLog:
    """A table with one row per key in ``folder`` on shared storage.

    ``schema`` names all columns, ``key`` among them.  Columns in ``sums`` are added up over
    batches; of the others the newest batch's values count, nulls included.  Batches are
    numbered from 0 without gaps.
    """

    folder: str
    schema: str
    key: tuple[str, ...]
    sums: tuple[str, ...] = ()
    fanout: int = 4

    def path(self, level: int, run: int) -> str:
        return f"{self.folder}/level={level}/run={run}"

    def live(self, batches: int) -> list[tuple[int, int]]:
        """Level and number of the runs that hold the first ``batches`` batches, oldest first."""
        level = 0
        while self.fanout ** (level + 1) <= batches:
            level += 1
        out, start = [], 0
        for at in range(level, -1, -1):
            size = self.fanout**at
            while start + size <= batches:
                out.append((at, start // size))
                start += size
        return out

    def merged_by(self, number: int) -> list[tuple[int, int]]:
        """Runs that batch ``number`` fills up: level and number, lowest first."""
        out, level = [], 1
        while (number + 1) % self.fanout**level == 0:
            out.append((level, (number + 1) // self.fanout**level - 1))
            level += 1
        return out

    def superseded(self, batches: int) -> list[str]:
        """Runs that no reader of ``batches`` batches or more opens; a storage tool may remove them."""
        live = set(self.live(batches))
        return [self.path(level, run) for level in range(len(f"{batches:b}")) for run in range(batches // self.fanout**level) if (level, run) not in live]

    def _combined(self, rows: DataFrame) -> DataFrame:
        fields = {f.name: f.dataType for f in T.StructType.fromDDL(self.schema).fields}
        rest = [c for c in fields if c not in (*self.key, *self.sums)]
        newest = [F.max_by(F.struct(*rest), "_at").alias("_newest")] if rest else []
        added = [F.sum(c).cast(fields[c]).alias(c) for c in self.sums]
        found = rows.groupBy(*self.key).agg(*added, *newest, F.max("_at").alias("_at"))
        return found.select(*[F.col(f"_newest.{c}" if c in rest else c).cast(fields[c]).alias(c) for c in fields], "_at")

    def _runs(self, spark: SparkSession, runs: list[tuple[int, int]]) -> DataFrame:
        return spark.read.schema(f"{self.schema}, _at bigint").parquet(*[self.path(*r) for r in runs])

    def write(self, delta: DataFrame, number: int) -> None:
        """Store the rows of batch ``number``, merge what it fills up, then announce it."""
        spark = delta.sparkSession
        columns = T.StructType.fromDDL(self.schema).names
        rows = self._combined(delta.select(*columns).withColumn("_at", F.lit(number).cast("bigint")))
        rows.write.mode("overwrite").parquet(self.path(0, number))
        for level, run in self.merged_by(number):
            below = [(level - 1, run * self.fanout + i) for i in range(self.fanout)]
            self._combined(self._runs(spark, below)).write.mode("overwrite").parquet(self.path(level, run))
        done = spark.createDataFrame([(number,)], "number bigint")
        done.coalesce(1).write.mode("append").json(f"{self.folder}/done")

    def batches(self, spark: SparkSession) -> int:
        """How many batches are announced."""
        try:
            done = spark.read.schema("number bigint").json(f"{self.folder}/done")
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return 0
            raise
        return (done.agg(F.max("number")).first()[0] or 0) + 1

    def read(self, spark: SparkSession, batches: int | None = None) -> DataFrame:
        """The table after the first ``batches`` batches, or after all that are announced; empty before the first."""
        count = self.batches(spark) if batches is None else batches
        if count == 0:
            return spark.createDataFrame([], self.schema)
        return self._combined(self._runs(spark, self.live(count))).drop("_at")
