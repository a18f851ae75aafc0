"""Rows that a stream adds up or looks into, in a number of folders that stays small.

Each micro-batch writes one *run*. When a level has ``fan`` runs, they are merged into one run of the
next level, so after n micro-batches there are fewer than ``fan`` runs on each of log(n) levels, and a
row has been rewritten once a level. Which runs there are follows from n alone: run j of level k holds
the micro-batches from j * fan^k up to (j + 1) * fan^k. A repeated micro-batch writes the same folders
anew. What it has merged is deleted by the next one, when it cannot be repeated any more.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..runtime import children, delete, exists

FAN = 8


class Runs:
    """``merge`` makes the rows of one run out of the rows of several. ``by`` are partition columns,
    ``order`` sorts the rows of a file."""

    def __init__(
        self, spark: SparkSession, root: str, schema: StructType, merge: Callable[[DataFrame], DataFrame],
        by: Sequence[str] = (), order: Sequence[str] = (), fan: int = FAN,
    ):
        self.spark, self.root, self.schema, self.merge = spark, root, schema, merge
        self.by, self.order, self.fan = by, order, fan

    def _folder(self, level: int, run: int) -> str:
        return f"{self.root}/level={level}/run={run}"

    def _read(self, runs: list[tuple[int, int]]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", self.root)
        rows = reader.parquet(*[self._folder(*run) for run in runs])
        return rows.select(*self.schema.fieldNames())

    def _write(self, rows: DataFrame, level: int, run: int):
        rows = rows.select(*self.schema.fieldNames()).hint("rebalance", *self.by)
        rows = rows.sortWithinPartitions(*self.by, *self.order) if self.order else rows
        rows.write.mode("overwrite").partitionBy(*self.by).parquet(self._folder(level, run))

    def live(self, number: int) -> list[tuple[int, int]]:
        """The runs (level, run) that hold the micro-batches before ``number``, each of them once."""
        runs, level, rest = [], 0, number
        while rest:
            runs += [(level, run) for run in range(rest - rest % self.fan, rest)]
            level, rest = level + 1, rest // self.fan
        return runs

    def before(self, number: int) -> DataFrame:
        """All rows of the micro-batches before ``number``."""
        return self._read(self.live(number))

    def _merged(self, number: int) -> list[list[tuple[int, int]]]:
        """For each level that fills up when micro-batches before ``number`` are done, its runs."""
        groups, level, rest = [], 0, number
        while rest and rest % self.fan == 0:
            groups.append([(level, run) for run in range(rest - self.fan, rest)])
            level, rest = level + 1, rest // self.fan
        return groups

    def add(self, number: int, rows: DataFrame):
        """Store the rows of micro-batch ``number``."""
        for runs in self._merged(number):
            for run in runs:
                delete(self.spark, self._folder(*run))
        self._write(rows, 0, number)
        for runs in self._merged(number + 1):
            level, last = runs[-1]
            self._write(self.merge(self._read(runs)), level + 1, last // self.fan)

    def stored(self) -> DataFrame:
        """All rows, for a reader that does not know the number of micro-batches.

        It has the time of one micro-batch to read them, then merged runs may go.
        """
        found = [
            (int(level.partition("=")[2]), int(run.partition("=")[2]))
            for level in children(self.spark, self.root) if level.startswith("level=")
            for run in children(self.spark, f"{self.root}/{level}")
        ]
        done = {run for run in found if exists(self.spark, f"{self._folder(*run)}/_SUCCESS")}

        def covered(level: int, run: int) -> bool:
            """Is the run part of one of a higher level?"""
            above = ((upper, run // self.fan ** (upper - level)) for upper in range(level + 1, len(done) + level + 1))
            return any(one in done for one in above)

        return self._read(sorted(run for run in done if not covered(*run)))
