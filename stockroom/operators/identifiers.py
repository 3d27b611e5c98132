"""Dense numbers for ids of any kind, so that their distinct counts can be kept as small bitmaps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.session import work_dir
from stockroom.sinks.tables import create_table
from stockroom.streaming.loading import BATCH_COLUMNS, batch_table_columns, overwrite_batch


@dataclass(frozen=True)
class IdDictionary:
    """A table of (id as text, number). Numbers start at 1, have no gaps, and never change.

    Ids are added by batch. A batch owns a partition of the table, so the last one may be run again: it then gets the
    numbers that are free without it. One writer may add at a time. Of a batch only ids that are not in the table yet are
    numbered, by their task's place and their place in the task; nothing but one count for each task reaches the driver.
    """

    table: str

    def create(self, spark: SparkSession) -> IdDictionary:
        columns = batch_table_columns("id STRING, number BIGINT")
        create_table(spark, self.table, columns, ["id"], partition_by=BATCH_COLUMNS, if_not_exists=True)
        return self

    def add(self, rows: DataFrame, ids: Sequence[str], run_id: str, batch_id: int) -> int:
        """Number the new ids of these columns; return how many there were. NULL is no id."""
        spark = rows.sparkSession
        work_dir(spark)
        own = (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)
        known = spark.table(self.table).where(~own)
        texts = [rows.select(F.col(name).cast("string").alias("id")) for name in ids]
        met = texts[0]
        for more in texts[1:]:
            met = met.unionByName(more)
        new = met.where(F.col("id").isNotNull()).distinct().join(known.select("id"), "id", "left_anti")
        # Cut from its inputs, so that every later step sees the same rows in the same tasks.
        new = new.checkpoint()
        placed = new.withColumn("task", F.spark_partition_id())
        counts = sorted((row["task"], row["count"]) for row in placed.groupBy("task").count().collect())
        largest = known.agg(F.max("number")).first()[0]
        base, firsts = (largest or 0) + 1, {}
        for task, count in counts:
            firsts[task] = base
            base += count
        offsets = F.create_map(*[F.lit(x) for pair in firsts.items() for x in pair]) if firsts else F.lit(None)
        in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        first = offsets[F.spark_partition_id()] if firsts else F.lit(0)
        overwrite_batch(new.select("id", (first + in_task).cast("bigint").alias("number")), self.table, run_id, batch_id)
        return sum(count for _, count in counts)

    def numbered(self, rows: DataFrame, keys: Sequence[str], ids: str, name: str = "number") -> DataFrame:
        """Each combination of ``keys`` and id once, with the id's number as ``name``.

        Combinations are made distinct before they meet the dictionary, so an id is looked up once for each key.
        """
        spark = rows.sparkSession
        texts = rows.select(*keys, F.col(ids).cast("string").alias("id")).where(F.col("id").isNotNull()).distinct()
        spark.catalog.refreshTable(self.table)
        dictionary = spark.table(self.table).select("id", F.col("number").alias(name))
        return texts.join(dictionary, "id").select(*keys, name)
