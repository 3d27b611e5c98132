"""The daily quality report, kept up to date by a stream."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockroom.operators.daily_report import CONDITIONS, condition_counts, with_day
from stockroom.operators.distinct import bitmap_state
from stockroom.streaming.admission import EVERY_SECOND
from stockroom.streaming.loading import for_each_batch
from stockroom.streaming.state import MergeableState, compact_now_and_then

# The item fields the report uses.
REPORT_FIELDS = ["shk_id", "dt", *dict.fromkeys(field for field, _ in CONDITIONS.values())]

DAY = {"dt_day": "TIMESTAMP_NTZ"}
COUNTS = {name: ("BIGINT", "sum") for name in CONDITIONS}
KINDS = ("shk", "tare")
SKETCHES = {name: ("BINARY", "hll_union") for name in KINDS}
LG_K = 14
LOST = "lost_ids"


@dataclass(frozen=True)
class DailyReportState:
    """The report's stored state.

    Conditional counts add up; numbers of different ids do not, so their state is one of

    * ``set``: the ids seen per day. Exact for any ids; as large as the data has different (day, id) pairs.
    * ``bitmap``: a bit per id, in blocks of 32,768 ids and 4 KB. Exact for integer ids; small if they are dense. Ids that
      are no integers are left out and counted (:meth:`lost_ids`).
    * ``sketch``: two sketches per day. Approximate; a few kilobytes per day, however many items there are.
    """

    table: str
    ids: str = "set"

    def __post_init__(self):
        if self.ids not in ("set", "bitmap", "sketch"):
            raise ValueError(f"unknown kind of id state {self.ids!r}")

    @property
    def days(self) -> MergeableState:
        more = {"sketch": SKETCHES, "bitmap": {LOST: ("BIGINT", "sum")}}.get(self.ids, {})
        return MergeableState(f"{self.table}_days", DAY, COUNTS | more)

    @property
    def seen(self) -> MergeableState:
        if self.ids == "bitmap":
            keys = {**DAY, "kind": "STRING", "block": "BIGINT"}
            return MergeableState(f"{self.table}_seen", keys, {"bits": ("BINARY", "bitmap_or")})
        return MergeableState(f"{self.table}_seen", {**DAY, "kind": "STRING", "id": "STRING"})

    @property
    def states(self) -> list[MergeableState]:
        return [self.days] if self.ids == "sketch" else [self.days, self.seen]

    def create(self, spark: SparkSession) -> DailyReportState:
        for state in self.states:
            state.create(spark)
        return self

    def compact(self, spark: SparkSession, full: bool = False) -> None:
        for state in self.states:
            state.compact(spark, full)

    def discard_covered(self, spark: SparkSession) -> None:
        for state in self.states:
            state.discard_covered(spark)

    def add(self, items: DataFrame, run_id: str, batch_id: int) -> None:
        """Add a batch of items."""
        placed = with_day(items.select(*REPORT_FIELDS))
        if self.ids == "sketch":
            sketches = [F.hll_sketch_agg(f"{name}_id", LG_K).alias(name) for name in KINDS]
            self.days.add(placed.groupBy("dt_day").agg(*condition_counts(), *sketches), run_id, batch_id)
            return
        # Both states read the batch; kept, it is fetched and parsed once.
        placed = placed.persist()
        try:
            counts = [*condition_counts(), *([_lost_ids().alias(LOST)] if self.ids == "bitmap" else [])]
            self.days.add(placed.groupBy("dt_day").agg(*counts), run_id, batch_id)
            self.seen.add(self._ids_seen(placed), run_id, batch_id)
        finally:
            placed.unpersist()

    def _ids_seen(self, placed: DataFrame) -> DataFrame:
        id_type = "bigint" if self.ids == "bitmap" else "string"
        pairs = [
            F.struct(F.lit(name).alias("kind"), F.col(f"{name}_id").try_cast(id_type).alias("id")) for name in KINDS
        ]
        ids = placed.select("dt_day", F.inline(F.array(*pairs)))
        if self.ids == "bitmap":
            return bitmap_state(ids, ["dt_day", "kind"], "id")
        return ids.where(F.col("id").isNotNull()).distinct()

    def lost_ids(self, spark: SparkSession) -> int:
        """How many ids the bitmaps could not take."""
        return self.days.current(spark).agg(F.sum(LOST)).first()[0] or 0 if self.ids == "bitmap" else 0

    def current(self, spark: SparkSession) -> DataFrame:
        """The report so far: the columns of the batch report, and its values unless sketched."""
        days = self.days.current(spark)
        if self.ids == "sketch":
            estimates = [F.hll_sketch_estimate(name).alias(f"qty_{name}") for name in KINDS]
            return days.select("dt_day", *estimates, *CONDITIONS)
        size = F.bitmap_count("bits") if self.ids == "bitmap" else F.lit(1).cast("bigint")
        sizes = [F.sum(F.when(F.col("kind") == name, size)).alias(f"qty_{name}") for name in KINDS]
        seen = self.seen.current(spark).groupBy(F.col("dt_day").alias("day")).agg(*sizes)
        # The NULL day is a group like any other, so it has to match itself. Both sides hold one row per day.
        quantities = [F.coalesce(f"qty_{name}", F.lit(0)).alias(f"qty_{name}") for name in KINDS]
        return days.join(seen, F.col("day").eqNullSafe(F.col("dt_day")), "left").select(
            "dt_day", *quantities, *CONDITIONS
        )


def _lost_ids() -> Column:
    """Rows' ids that are there but are no integers."""
    lost = [
        F.count_if(F.col(f"{name}_id").isNotNull() & F.col(f"{name}_id").try_cast("bigint").isNull()) for name in KINDS
    ]
    return lost[0] + lost[1]


def keep_daily_report(
    items: DataFrame,
    report: DailyReportState,
    checkpoint: str,
    trigger: Mapping[str, object] = EVERY_SECOND,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Add each batch of items to the report's state, and compact it after every so many batches."""
    after_batch = compact_now_and_then(*report.states, every=compact_every)

    def handle(rows: DataFrame, run_id: str, batch_id: int) -> None:
        report.add(rows, run_id, batch_id)
        after_batch(rows.sparkSession, batch_id)

    return for_each_batch(items, handle, checkpoint, trigger)
