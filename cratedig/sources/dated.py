"""Tables stored by day, so that what expires goes as whole partitions and nothing that stays is rewritten."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cratedig.functions.times import ago

DAY = "day"


@dataclass(frozen=True)
class DatedTable:
    """A managed table of the session's catalog, partitioned by the day of ``column``. Rows need a time."""

    spark: SparkSession
    name: str
    column: str

    def append(self, rows: DataFrame) -> None:
        """Adds rows; a day's rows are spread over tasks by all their columns, so a busy day is no single task's work."""
        plain = [c for c, kind in rows.dtypes if "map<" not in kind]
        dealt = rows.withColumn(DAY, F.to_date(self.column)).repartition(DAY, F.pmod(F.xxhash64(*plain), F.lit(8)))
        dealt.write.mode("append").format("parquet").partitionBy(DAY).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(DAY)

    def expire(self, as_of, days: int) -> DataFrame:
        """Drops the days that ended ``days`` days before ``as_of``: their files go, no other file is touched.

        Returns (day, dropped), the rows of each, counted before from those partitions alone. The day that the limit lies in
        stays as a whole until it has passed.
        """
        edge = self.spark.range(1).select(F.to_date(ago(as_of, days=days)).alias("edge")).first()[0]
        old = self.spark.table(self.name).filter(F.col(DAY) < F.lit(edge))
        counts = [tuple(r) for r in old.groupBy(DAY).agg(F.count(F.lit(1)).alias("dropped")).collect()]  # one row per day
        for day, _ in counts:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({DAY} = DATE '{day}')")
        return self.spark.createDataFrame(counts, f"{DAY} date, dropped bigint")
