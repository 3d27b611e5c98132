"""Tables that grow by batches and whose name always gives all rows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.sinks.partitions import drop_partitions, partition_values
from stockroom.sinks.tables import create_table, sorted_for
from stockroom.streaming.loading import BATCH_COLUMNS, batch_table_columns, overwrite_batch

COMBINE = {
    "sum": F.sum,
    "max": F.max,
    "bitmap_or": F.bitmap_or_agg,
    "hll_union": F.hll_union_agg,
}

SHOWN = "stockroom.shown"


@dataclass(frozen=True)
class Shown:
    """What a view takes from the tables below it: the merged row sets with their sizes, and the last batch of each run
    that these cover. ``replaced`` sets have been merged into others and can go."""

    sets: Mapping[str, int] = field(default_factory=dict)
    covered: Mapping[str, int] = field(default_factory=dict)
    replaced: tuple[str, ...] = ()


@dataclass(frozen=True)
class MergeableState:
    """State rows per key whose measures combine in any order and grouping; without measures, a set of keys.

    Batches add partial rows to ``<table>_parts``, each in its own partition, so a replayed batch replaces itself.
    :meth:`compact` writes combined rows to ``<table>_merged``. ``<table>`` is a view over the batches that no merged
    rows cover and over the merged rows in use; a compaction replaces it in one statement, so a reader sees the rows
    either before or after it, and one that is lost on the way changes nothing. Many streams may add; one compaction
    runs at a time.
    """

    table: str
    keys: Mapping[str, str]
    measures: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def beside(self, suffix: str) -> str:
        """The name of a table next to this one; the name may be quoted."""
        return f"{self.table[:-1]}{suffix}`" if self.table.endswith("`") else f"{self.table}{suffix}"

    @property
    def parts(self) -> str:
        return self.beside("_parts")

    @property
    def merged(self) -> str:
        return self.beside("_merged")

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.measures]

    @property
    def column_list(self) -> str:
        types = {**self.keys, **{name: kind for name, (kind, _) in self.measures.items()}}
        return ", ".join(f"`{name}` {kind}" for name, kind in types.items())

    def create(self, spark: SparkSession) -> MergeableState:
        """Create the table of parts and the view if they are missing."""
        columns = batch_table_columns(self.column_list)
        create_table(spark, self.parts, columns, partition_by=BATCH_COLUMNS, if_not_exists=True)
        if not spark.catalog.tableExists(self.table):
            self._show(spark, Shown())
        return self

    def _create_merged(self, spark: SparkSession) -> None:
        columns = f"{self.column_list}, set_id STRING"
        create_table(spark, self.merged, columns, partition_by=["set_id"], if_not_exists=True)

    def combine(self, rows: DataFrame) -> DataFrame:
        """Partial rows combined to one row per key."""
        if not self.measures:
            return rows.select(*self.keys).distinct()
        measures = [COMBINE[how](F.col(name)).alias(name) for name, (_, how) in self.measures.items()]
        return rows.groupBy(*self.keys).agg(*measures)

    def layout(self, rows: DataFrame) -> DataFrame:
        """Combined rows as a compaction writes them."""
        return rows

    def add(self, partials: DataFrame, run_id: str, batch_id: int) -> None:
        """Store a batch's partial rows, of which there is one per key."""
        overwrite_batch(partials, self.parts, run_id, batch_id)

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows stored so far, not yet combined: what the view shows."""
        spark.catalog.refreshTable(self.parts)
        if spark.catalog.tableExists(self.merged):
            spark.catalog.refreshTable(self.merged)
        return spark.table(self.table)

    def current(self, spark: SparkSession) -> DataFrame:
        """The combined state of all batches stored so far."""
        return self.combine(self.rows(spark))

    def _shown(self, spark: SparkSession) -> Shown:
        found = spark.sql(f"SHOW TBLPROPERTIES {self.table}").where(F.col("key") == SHOWN).collect()
        if not found:
            raise ValueError(f"{self.table} is not a view over stored batches")
        kept = json.loads(found[0]["value"])
        return Shown(kept["sets"], kept["covered"], tuple(kept["replaced"]))

    def _show(self, spark: SparkSession, shown: Shown) -> None:
        """Replace the view by one over the given sets and the batches they do not cover."""
        names = ", ".join(f"`{name}`" for name in self.columns)
        covered = " OR ".join(f"(run_id = '{run}' AND batch_id <= {last})" for run, last in shown.covered.items())
        query = f"SELECT {names} FROM {self.parts}" + (f" WHERE NOT ({covered})" if covered else "")
        if shown.sets:
            sets = ", ".join(f"'{name}'" for name in shown.sets)
            query += f" UNION ALL SELECT {names} FROM {self.merged} WHERE set_id IN ({sets})"
        properties = json.dumps(asdict(shown)).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE OR REPLACE VIEW {self.table} TBLPROPERTIES ('{SHOWN}' = '{properties}') AS {query}")

    def _uncovered(self, spark: SparkSession, shown: Shown, upto: Mapping[str, int]) -> DataFrame:
        """Parts that no merged rows cover, up to the given batches. Prunes partitions."""
        spark.catalog.refreshTable(self.parts)
        parts = spark.table(self.parts)
        wanted = F.lit(False)
        for run_id, last in upto.items():
            first = shown.covered.get(run_id, -1)
            own = (F.col("run_id") == run_id) & (F.col("batch_id") > first) & (F.col("batch_id") <= last)
            wanted = wanted | own
        return parts.where(wanted).select(*self.columns)

    def compact(self, spark: SparkSession, full: bool = False) -> int:
        """Combine all batches but each run's newest, which may still be replayed; return how many became covered.

        Earlier row sets no larger than what is combined anyway are combined with it, so that their number grows with
        the logarithm of the rows only, and every row is written that often. ``full`` combines all of them.
        """
        shown = self._shown(spark)
        batches: dict[str, list[int]] = {}
        for part in partition_values(spark, self.parts):
            batches.setdefault(part["run_id"], []).append(int(part["batch_id"]))
        covered = shown.covered
        closed = {run_id: max(ids) - 1 for run_id, ids in batches.items()}
        upto = {run_id: max(closed.get(run_id, -1), covered.get(run_id, -1)) for run_id in {*closed, *covered}}
        fresh = sum(covered.get(run, -1) < i <= upto[run] for run, ids in batches.items() for i in ids)
        if not fresh and not (full and len(shown.sets) > 1):
            return 0
        self._create_merged(spark)
        rows = self._uncovered(spark, shown, upto)
        size, joined = rows.count() if fresh else 0, []
        for name, held in sorted(shown.sets.items(), key=lambda item: item[1]):
            if full or held <= size:
                joined.append(name)
                size += held
        if joined:
            spark.catalog.refreshTable(self.merged)
            earlier = spark.table(self.merged).where(F.col("set_id").isin(*joined)).select(*self.columns)
            rows = rows.unionByName(earlier)
        set_id = uuid.uuid4().hex
        self.layout(self.combine(rows)).select(*self.columns, F.lit(set_id)).write.insertInto(self.merged)
        spark.catalog.refreshTable(self.merged)
        written = spark.table(self.merged).where(F.col("set_id") == set_id).count()
        if self._shown(spark) != shown:
            raise RuntimeError(f"{self.table} was compacted by another job; this result was not used")
        sets = {name: held for name, held in shown.sets.items() if name not in joined} | {set_id: written}
        self._show(spark, Shown(sets, upto, (*shown.replaced, *joined)))
        return fresh

    def discard_covered(self, spark: SparkSession) -> int:
        """Delete batches and merged rows that the view shows no more. Run while nobody reads an earlier view.

        Rows that no view has shown yet, such as those of a compaction under way, stay.
        """
        shown = self._shown(spark)
        dropped = drop_partitions(
            spark, self.parts, lambda p: int(p["batch_id"]) <= shown.covered.get(p["run_id"], -1)
        )
        if shown.replaced:
            dropped += drop_partitions(spark, self.merged, lambda p: p["set_id"] in shown.replaced)
            self._show(spark, Shown(shown.sets, shown.covered))
        return dropped


@dataclass(frozen=True)
class BatchedRows(MergeableState):
    """Rows loaded in batches, all of them kept; ``keys`` are the columns.

    Streams load into :attr:`parts`. Compaction gathers closed batches into sorted row sets, so that partitions and files
    do not grow with the number of batches, and a filter on the sort key opens few of them.
    """

    sort_key: tuple[str, ...] = ()

    def combine(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.columns)

    def layout(self, rows: DataFrame) -> DataFrame:
        return sorted_for(rows, self.sort_key, clustered=True)


def compact_now_and_then(*states: MergeableState, every: int | None) -> Callable[[SparkSession, int], None]:
    """To be called after each batch: compacts the states after every so many, or never.

    What a compaction replaced is deleted by the next one, so that a reader has that long to finish.
    """

    def after_batch(spark: SparkSession, batch_id: int) -> None:
        if every and batch_id % every == every - 1:
            for state in states:
                state.discard_covered(spark)
                state.compact(spark)

    return after_batch
