"""Check queries: every operator on whole test tables, each next to SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.functions import (
    approx_unique,
    best_effort_timestamp,
    count_if,
    count_if_value,
    datetime_text,
    iso_record,
    since_days,
    start_of_day,
    text_is,
    unique,
    year_month,
)
from stockroom.operators import (
    IdDictionary,
    RollupRule,
    StoredRollup,
    age_rollup,
    bitmap_state,
    bitmap_totals,
    blank_missing_tare_type,
    daily_report,
    expand_records,
    guarded_upsert,
    loose_records,
    lost_values,
    observed_fields,
    office_totals,
    parse_items,
    parse_with_quarantine,
    record_arrays,
    sketch_state,
    sketch_totals,
    state_counts,
    typed_items,
    typed_records,
)
from stockroom.operators.daily_report import CONDITIONS
from stockroom.plans import jobs
from stockroom.plans.registry import check, fresh_database
from stockroom.plans.standin import (
    ITEMS_SQL,
    files_per_batch,
    items,
    raw_items,
    spread_over_files,
    staging,
    table,
)
from stockroom.schemas import ITEM_COLUMNS, ITEM_DELIMITED, REPORTS, STAGING
from stockroom.session import fresh_dir
from stockroom.sinks import (
    append_rows,
    create_layers,
    create_table,
    create_table_as,
    expire_months,
    insert_literals,
    publish,
    write_by_month,
)
from stockroom.sinks.publish import as_messages
from stockroom.sources import folder_topic, read_back, scan_delimited, scan_delimited_inferred, scan_table
from stockroom.streaming import (
    accounts,
    create_accounts,
    Admission,
    DailyReportState,
    batch_table_columns,
    keep_daily_report,
    keep_office_totals,
    latest_totals,
    load_into,
    office_state,
    running_office_totals,
)
from stockroom.streaming.admission import EVERY_SECOND, UNTIL_DRAINED
from stockroom.streaming.loading import BATCH_COLUMNS

AS_OF = dt.datetime(2024, 8, 6, 8, 18, 4)
LAST_EVENT_DAY = dt.date(2024, 1, 30)

OFFICE_TOTALS_SQL = """
select user_id as office_id, cast(count_if(event_type = 'purchase') as bigint) as is_stock_count, count(*) as total
from events group by 1
"""

DAILY_REPORT_SQL = f"""
select date_trunc('day', cast(dt as timestamp)) as dt_day,
       count(distinct shk_id) as qty_shk,
       count(distinct tare_id) as qty_tare,
       count(shk_id) filter (where tare_id = 0) as qty_shk_without_tare,
       count(shk_id) filter (where isstock = 1) as qty_shk_stock,
       count(shk_id) filter (where state_id = 'WWE') as qty_shk_wwe,
       count(shk_id) filter (where place_cod = 0) as qty_shk_without_pc
from ({ITEMS_SQL})
"""


# Reports and aggregates


@check("FN6 FN7 FLT1 AGG3 AGG4 AGG8 AGG9 JOB6", f"{DAILY_REPORT_SQL} group by 1")
def daily_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_report(items(spark, sf_dir))


@check(
    "FLT4 FN11 JOB6",
    f"{DAILY_REPORT_SQL} where cast(dt as timestamp) >= timestamp '2024-01-30' - interval 7 day group by 1",
)
def daily_report_last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_report(items(spark, sf_dir), last_days=7, as_of=LAST_EVENT_DAY)


@check(
    "FLT4 FN11 PRJ2 SRT1 JOB6",
    f"{DAILY_REPORT_SQL} where cast(dt as timestamp) >= timestamp '2024-01-30' - interval 7 day group by 1",
)
def typed_report_last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw items typed into day partitions, of which the report reads the last ones."""
    database = fresh_database(spark)
    create_table_as(spark, f"{database}.raw", raw_items(spark, sf_dir))
    jobs.create_typed_items(spark, f"{database}.typed")
    jobs.type_items(spark, f"{database}.raw", f"{database}.typed")
    return jobs.quality_report(spark, f"{database}.typed", 7, LAST_EVENT_DAY)


@check("FLT4 FN11", "select event_id, ts from events where ts >= timestamp '2024-01-30' - interval 7 day")
def relative_day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(since_days("ts", 7, LAST_EVENT_DAY)).select("event_id", "ts")


@check("AGG5 SRT2 PRJ1", f"select state_id, count(*) as qty from ({ITEMS_SQL}) where state_id is not null group by 1")
def state_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_counts(items(spark, sf_dir))


@check("AGG1 AGG2 FLT2", OFFICE_TOTALS_SQL)
def office_stock_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return office_totals(staging(spark, sf_dir))


@check(
    "AGG2 AGG3",
    """select event_type, count(nullif(user_id, 5)) filter (where value > 10) as with_user,
              cast(count_if(value > 10) as bigint) as rows_over
       from events group by 1""",
)
def count_if_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = F.col("value") > 10
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(
            count_if_value(F.nullif("user_id", F.lit(5)), over).alias("with_user"),
            count_if(over).alias("rows_over"),
        )
    )


@check(
    "FLT1 FLT2",
    f"""select shk_id, tare_id = 0 as is_loose, isstock = 1 as is_in_stock, state_id = 'WWE' as is_wwe,
               place_cod = 0 as is_unplaced
        from ({ITEMS_SQL})""",
)
def text_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_items(spark, sf_dir).select(
        F.col("shk_id").cast("bigint").alias("shk_id"),
        text_is("tare_id", "0").alias("is_loose"),
        text_is("isstock", "1").alias("is_in_stock"),
        text_is("state_id", "WWE").alias("is_wwe"),
        text_is("place_cod", "0").alias("is_unplaced"),
    )


@check(
    "AGG4",
    "select date_trunc('day', ts) as dt_day, true as shk_close, true as tare_close from events group by 1",
)
def approx_distinct_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates next to exact counts: true where they differ by at most 5 percent."""
    days = table(spark, sf_dir, "events").groupBy(start_of_day("ts").alias("dt_day"))
    estimates = days.agg(
        approx_unique("event_id").alias("shk_estimate"), approx_unique("user_id").alias("tare_estimate")
    )
    exact = days.agg(unique("event_id").alias("shk"), unique("user_id").alias("tare"))
    return estimates.join(exact, "dt_day").select("dt_day", _close("shk"), _close("tare"))


def _close(name: str):
    return (F.abs(F.col(f"{name}_estimate") - F.col(name)) <= F.col(name) * 0.05).alias(f"{name}_close")


DISTINCT_DAILY_SQL = """
select date_trunc('day', ts) as dt_day, count(distinct event_id) as qty_shk, count(distinct user_id) as qty_tare
from events group by 1
"""


@check("AGG10", DISTINCT_DAILY_SQL)
def bitmap_distinct_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(start_of_day("ts").alias("dt_day"), "event_id", "user_id")
    shk = bitmap_totals(bitmap_state(events, ["dt_day"], "event_id"), ["dt_day"], "qty_shk")
    tare = bitmap_totals(bitmap_state(events, ["dt_day"], "user_id"), ["dt_day"], "qty_tare")
    return shk.join(tare, "dt_day").select("dt_day", "qty_shk", "qty_tare")


@check(
    "AGG10",
    """select date_trunc('day', ts) as dt_day, count(distinct props) as qty_props,
              count(distinct event_id * 1000003) as qty_sparse
       from events group by 1""",
)
def numbered_distinct_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps of text ids and of ids that are far apart, which are numbered in two batches first."""
    events = table(spark, sf_dir, "events").select(
        start_of_day("ts").alias("dt_day"), "event_type", "props", (F.col("event_id") * 1000003).alias("sparse")
    )
    ids = IdDictionary(f"{fresh_database(spark)}.ids").create(spark)
    is_view = F.coalesce(F.col("event_type") == "view", F.lit(False))
    for number, batch in enumerate((events.where(is_view), events.where(~is_view))):
        ids.add(batch, ["props", "sparse"], "run", number)

    def totals(column: str) -> DataFrame:
        state = bitmap_state(ids.numbered(events, ["dt_day"], column), ["dt_day"], "number")
        return bitmap_totals(state, ["dt_day"], f"qty_{column}")

    return totals("props").join(totals("sparse"), "dt_day")


@check("AGG10", "select date_trunc('day', ts) as dt_day, true as shk_close from events group by 1")
def sketch_distinct_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches per day and type, united per day, next to exact counts."""
    events = table(spark, sf_dir, "events").withColumn("dt_day", start_of_day("ts"))
    by_type = sketch_state(events, ["dt_day", "event_type"], "event_id")
    estimates = sketch_totals(by_type, ["dt_day"], "shk_estimate")
    exact = events.groupBy("dt_day").agg(unique("event_id").alias("shk"))
    return estimates.join(exact, "dt_day").select("dt_day", _close("shk"))


@check(
    "AGG11",
    """with x as (select event_type as metric, value, event_id as id, cast(floor(epoch(ts)) as bigint) as e,
                         cast(epoch(timestamp '2024-01-31') as bigint) as n from events),
            y as (select *, case when metric = 'click' then case when n - e >= 86400 then 60 else 3600 end
                                 when n - e >= 86400 then 3600 when n - e >= 3600 then 300 else 60 end as p from x)
       select metric, e - e % p as bucket,
              case when metric = 'click' then arg_min(value, id) else max(value) end as value
       from y group by metric, e - e % p""",
)
def age_rollup_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = (
        RollupRule("click", "any", ((0, 3600), (86400, 60))),
        RollupRule("", "max", ((0, 60), (3600, 300), (86400, 3600))),
    )
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return age_rollup(table(spark, sf_dir, "events"), rules, as_of, metric="event_type", order="event_id")


@check(
    "AGG11 SNK12 SNK13",
    """with x as (select event_type as metric, value, event_id as id, cast(floor(epoch(ts)) as bigint) as e,
                         cast(epoch(timestamp '2024-01-30 23:59:59') as bigint) as n from events),
            y as (select *, case when metric = 'click' then case when n - e >= 86400 then 60 else 3600 end
                                 when n - e >= 864000 then 7200 when n - e >= 86400 then 3600
                                 when n - e >= 3600 then 300 else 60 end as p from x)
       select metric, e - e % p as bucket,
              case when metric = 'click' then arg_min(value, id) else max(value) end as value
       from y group by metric, e - e % p""",
)
def stored_rollup_thinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events come in three lots, and are thinned in the table after each; those of odd users come one lot late."""
    rules = (
        RollupRule("click", "any", ((0, 3600), (86400, 60))),
        RollupRule("", "max", ((0, 60), (3600, 300), (86400, 3600), (864000, 7200))),
    )
    series = StoredRollup(f"{fresh_database(spark)}.series", rules).create(spark)
    ends = [dt.datetime(2024, 1, day, 23, 59, 59) for day in (10, 20, 30)]
    lot = F.when(F.col("ts") <= F.lit(ends[0]), 0).when(F.col("ts") <= F.lit(ends[1]), 1).otherwise(2)
    late = F.least(lot + F.pmod("user_id", F.lit(2)), F.lit(2))
    events = table(spark, sf_dir, "events").withColumn("lot", F.coalesce(late, lot))
    for number, end in enumerate(ends):
        series.add(events.where(F.col("lot") == number), end, metric="event_type", order="event_id")
        series.thin(spark, end)
    return series.read(spark, ends[-1])


# Parsing and cleaning


@check("SNK1 FN1 FN2 FN4 FN5 PRJ2", "select event_id, ts, event_type, value from events")
def json_envelope_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = as_messages(table(spark, sf_dir, "events"))
    return read_back(messages, "event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING, value DOUBLE")


@check("FN5", "select event_id, cast(ts as varchar) as ts_text from events")
def datetime_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", datetime_text("ts").alias("ts_text"))


@check("FN1 FN2 FN3 PRJ2", f"select cast(shk_id as varchar) as shk_id, tare_type from ({ITEMS_SQL})")
def sentinel_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that spell an empty container type as a bare NaN."""
    text = F.col("value").cast("string")
    bare_nan = F.replace(text, F.lit('"tare_type":""'), F.lit('"tare_type":NaN')).cast("binary")
    messages = as_messages(items(spark, sf_dir)).select(bare_nan.alias("value"))
    return blank_missing_tare_type(parse_items(messages)).select("shk_id", "tare_type")


@check(
    "FLT5 FN2 PRJ2",
    f"""select case when state_id = 'WWE' then null else cast(shk_id as varchar) end as shk_id,
               case when state_id = 'WWE' then null else state_id end as state_id,
               state_id = 'WWE' as is_broken
        from ({ITEMS_SQL})""",
)
def quarantine_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of one state lose their closing brace."""
    parsed = parse_with_quarantine(_cut_messages(items(spark, sf_dir)))
    return parsed.select("shk_id", "state_id", F.col("broken_message").isNotNull().alias("is_broken"))


@check(
    "PRJ2 FN6 FLT2",
    f"""select shk_id, date_trunc('second', cast(dt as timestamp)) as dt, employee_id, place_cod, tare_id, tare_type,
               isdeleted = 1 as isdeleted, isstock = 1 as isstock, chrt_id, state_id, transfer_box_id,
               cast(correction_dt as timestamp) as correction_dt, wbsticker_id
        from ({ITEMS_SQL})""",
)
def typed_item_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_items(raw_items(spark, sf_dir))


@check(
    "PRJ2",
    f"""select count(*) filter (where state_id = 'WWE') as dt_lost, cast(0 as bigint) as employee_id_lost,
               count(*) filter (where tare_type = 'BOX') as chrt_id_lost
        from ({ITEMS_SQL})""",
)
def conversion_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of one state and ids of one container type are replaced by text that is neither."""
    spoiled = raw_items(spark, sf_dir).withColumns(
        {
            "dt": F.when(F.col("state_id") == "WWE", "n/a").otherwise(F.col("dt")),
            "chrt_id": F.when(F.col("tare_type") == "BOX", "x1").otherwise(F.col("chrt_id")),
        }
    )
    return spoiled.agg(*lost_values(spoiled, ["dt", "employee_id", "chrt_id"]))


@check(
    "FN6",
    """select event_id, case when event_type = 'view' then null else date_trunc('second', ts) end as dt from events""",
)
def best_effort_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each type writes its times in a spelling of its own; one type writes no times."""
    spelled = {
        "error": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.0"),
        "purchase": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        "click": F.date_format("ts", "dd/MM/yyyy HH:mm:ss"),
        "signup": F.unix_timestamp("ts").cast("string"),
        "view": F.lit("junk"),
    }
    text = F.coalesce(*[F.when(F.col("event_type") == name, time) for name, time in spelled.items()])
    return table(spark, sf_dir, "events").select("event_id", best_effort_timestamp(text).alias("dt"))


@check(
    "FN7 FN12",
    """select event_id, date_trunc('day', ts) as dt_day, cast(strftime(ts, '%Y%m') as integer) as yyyymm from events""",
)
def calendar_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", start_of_day("ts").alias("dt_day"), year_month("ts").alias("yyyymm"))


# Files, tables and messages


@check("SRC3", "select event_id, event_type, ts, value from events")
def csv_delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "delimited")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", datetime_text("ts").alias("ts"), "value")
    events.write.option("sep", ";").option("header", True).csv(path)
    return scan_delimited(spark, path, "event_id BIGINT, event_type STRING, ts TIMESTAMP_NTZ, value DOUBLE")


@check("SRC3", "select doc_id, text, lang, n_chars from documents")
def quoted_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes, separators and line breaks, as other programs write them: quotes are doubled."""
    path = fresh_dir(spark, "quoted")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    written = documents.write.option("sep", ";").option("header", True).option("escape", '"').option("quoteAll", True)
    written.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return scan_delimited(spark, path, "doc_id BIGINT, text STRING, lang STRING, n_chars BIGINT", multi_line=True)


@check("SRC4", f"select shk_id, cast(dt as timestamp) as dt, tare_type, isstock, wbsticker_id from ({ITEMS_SQL})")
def inferred_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "inferred")
    items(spark, sf_dir).write.option("header", True).csv(path)
    return scan_delimited_inferred(spark, path).select("shk_id", "dt", "tare_type", "isstock", "wbsticker_id")


@check("SRC5 SRC7 SNK5 SNK6 SRT1 PRJ1 PRJ4", ITEMS_SQL)
def item_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_database(spark)}.items"
    create_table_as(spark, name, items(spark, sf_dir), sort_key=["shk_id"])
    return scan_table(spark, name, ITEM_COLUMNS)


@check("SRT1 SNK6", "select l_orderkey, l_linenumber, l_quantity, l_shipdate from lineitem")
def sorted_layout_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_database(spark)}.lines"
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    columns = "l_quantity DOUBLE, l_orderkey BIGINT, l_linenumber INT, l_shipdate TIMESTAMP_NTZ"
    create_table(spark, name, columns, sort_key=["l_orderkey"])
    append_rows(spark, name, lines, clustered=True)
    return scan_table(spark, name)


@check(
    "SRT1 SNK6 SRC5",
    """select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem
       where l_partkey = (select min(l_partkey) from lineitem)""",
)
def lookup_beside_sort_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one part in a table that is sorted by order; files without the part are skipped by their filters."""
    name = f"{fresh_database(spark)}.lines"
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    create_table_as(spark, name, lines, sort_key=["l_orderkey"], lookup={"l_partkey": 1_000_000})
    part = lines.agg(F.min("l_partkey")).first()[0]
    return scan_table(spark, name).where(F.col("l_partkey") == part)


@check(
    "SNK7 SNK11 SNK6 SNK3 SRC7",
    """select event_id as shk_id, user_id as office_id, event_type = 'purchase' as is_stock, ts as dt_load from events
       union all values (cast(-1 as bigint), cast(7 as bigint), true, timestamp '2024-06-28 12:05:12'),
                        (-1, 7, true, timestamp '2024-06-28 12:05:12'), (-2, 8, false, null)""",
)
def named_column_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, and literals, whose columns come in another order than the table's."""
    prefix = f"{fresh_database(spark)}_"
    create_layers(spark, fresh_dir(spark, "layers"), prefix)
    name = f"{prefix}staging.items"
    create_table(spark, name, STAGING, sort_key=["shk_id"])
    append_rows(spark, name, staging(spark, sf_dir).select("dt_load", "is_stock", "office_id", "shk_id"))
    twice = ("2024-06-28 12:05:12", True, -1, 7)
    insert_literals(spark, name, ["dt_load", "is_stock", "shk_id", "office_id"], [twice, twice, (None, False, -2, 8)])
    return scan_table(spark, name)


@check(
    "SNK9 FN8",
    """select event_id, '{"state_id":"' || event_type || '","qty":' || user_id || ',"dt_load":"'
              || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(cast(cast(floor(microsecond(ts) % 1000000 / 1000)
              as bigint) as varchar), 3, '0') || '"}' as record
       from events""",
)
def iso_record_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col("event_type").alias("state_id"), F.col("user_id").alias("qty"), F.col("ts").alias("dt_load")]
    return table(spark, sf_dir, "events").select("event_id", iso_record(fields).alias("record"))


@check(
    "SNK9 FN8 FN9",
    """select user_id, event_type, event_id as qty, date_trunc('millisecond', ts) as dt_load, cast(null as varchar)
       as note from events""",
)
def recordset_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumnsRenamed({"event_id": "qty", "ts": "dt_load"})
    arrays = record_arrays(rows, ["user_id", "event_type", "qty", "dt_load", "value"], max_records=500)
    return expand_records(
        arrays, "user_id bigint, event_type string, qty bigint, dt_load timestamp_ntz, note string"
    )


def _loose_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages whose fields differ by type: purchases carry a price, errors a user that is no number."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    record = F.to_json(
        F.struct(
            F.col("event_id").alias("shk_id"),
            datetime_text("ts").alias("dt"),
            F.when(kind != "error", user.cast("bigint")).alias("office_id"),
            kind.alias("state"),
            F.when(kind == "purchase", F.col("event_id").cast("decimal(38,3)") + F.lit("1e30").cast("decimal(38,3)")).alias(
                "price"
            ),
        )
    )
    strange = F.when(kind == "error", F.concat(F.expr("left(record, length(record) - 1)"), F.lit(',"office_id":"none"}')))
    rows = table(spark, sf_dir, "events").withColumn("record", record)
    return rows.select(F.coalesce(strange, F.col("record")).cast("binary").alias("value"))


@check(
    "FN9 SRC2 FN2",
    """select event_id as shk_id, ts as dt, case when event_type <> 'error' then user_id end as office_id,
              '"' || event_type || '"' as state, case when event_type = 'error' then 'office_id' else '' end as lost,
              case when event_type = 'purchase' then cast(cast(event_id as hugeint) + cast('1' || repeat('0', 30) as hugeint)
                   as varchar) end as price
       from events""",
)
def loose_messages_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read back without a schema: three fields are typed, the others stay, and no number loses a digit."""
    topic = folder_topic(fresh_dir(spark, "topic"))
    topic.append(_loose_messages(spark, sf_dir))
    typed = typed_records(
        loose_records(topic.read(spark), "value"), "shk_id bigint, dt timestamp_ntz, office_id bigint"
    )
    price = F.col("unknown")["price"].cast("decimal(38,0)").cast("string").alias("price")
    lost = F.array_join("lost", ",").alias("lost")
    return typed.select("shk_id", "dt", "office_id", F.col("unknown")["state"].alias("state"), lost, price)


@check(
    "FN9 SRC2",
    """with f as (select unnest(['shk_id', 'dt', 'state']) as name, 1 as n from events
                  union all select 'office_id', 1 from events
                  union all select 'price', 1 from events where event_type = 'purchase')
       select name, count(*) as records from f group by name""",
)
def loose_message_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many messages have each field, whatever its type."""
    met = observed_fields(loose_records(_loose_messages(spark, sf_dir), "value"))
    return met.groupBy("name").agg(F.sum("records").alias("records"))


@check("SNK1 SNK2 SRC2 JOB1 JOB7", "select event_id, user_id, event_type, ts from events")
def publish_then_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = folder_topic(fresh_dir(spark, "topic"))
    publish(table(spark, sf_dir, "events"), topic)
    return jobs.read_topic(spark, topic, "event_id BIGINT, user_id BIGINT, event_type STRING, ts TIMESTAMP_NTZ")


@check("SNK2", "select count(*) as messages from events")
def publish_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = folder_topic(fresh_dir(spark, "topic"))
    messages = publish(table(spark, sf_dir, "events"), topic)
    written = topic.read(spark).agg(F.count("*").alias("messages"))
    # The job's own count has to agree with what the topic holds.
    return written.where(F.col("messages") == messages)


@check(
    "SRC2 JOB7 FN1 FN2",
    """select cast(extract(hour from ts) as integer) as topic_partition, event_id as topic_offset,
              event_type as state_id, user_id as qty
       from events""",
)
def topic_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a topic that is partitioned by hour, with their positions."""
    path = fresh_dir(spark, "topic")
    fields = [F.col("event_type").alias("state_id"), F.col("user_id").alias("qty")]
    table(spark, sf_dir, "events").select(
        F.hour("ts").alias("partition"),
        F.col("event_id").alias("offset"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
    ).write.parquet(path)
    topic = folder_topic(path, "partition INT, offset BIGINT, value BINARY")
    decoded = jobs.read_topic(spark, topic, "state_id STRING, qty BIGINT")
    return decoded.withColumnsRenamed({"partition": "topic_partition", "offset": "topic_offset"})


@check("SRC3 SRC2 JOB1 JOB7", ITEMS_SQL)
def published_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, topic = fresh_dir(spark, "delimited"), folder_topic(fresh_dir(spark, "topic"))
    items(spark, sf_dir).write.option("sep", ";").option("header", True).csv(path)
    jobs.publish_file(spark, path, topic)
    return jobs.read_topic(spark, topic, ITEM_DELIMITED)


# Reports by state, and the guarded upsert

STATE_COUNTS_SQL = f"select state_id, count(*) as qty from ({ITEMS_SQL}) group by 1"


@check(
    "SRC5 SRC6 AGG5 PRJ3 PRJ4 FN10 SNK3 JOB4",
    f"select state_id, qty, timestamp '2024-08-06 08:18:04' as dt from ({STATE_COUNTS_SQL})",
)
def state_counts_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_table(spark, _reports(spark, sf_dir), ["state_id", "qty", "dt"])


def _reports(spark: SparkSession, sf_dir: str) -> str:
    database = fresh_database(spark)
    create_table_as(spark, f"{database}.items", items(spark, sf_dir), sort_key=["shk_id"])
    create_table(spark, f"{database}.reports", REPORTS, sort_key=["dt"], if_not_exists=True)
    jobs.report_state_counts(spark, f"{database}.items", f"{database}.reports", AS_OF)
    return f"{database}.reports"


@check(
    "SRC6 SNK1 FN5 JOB1",
    f"select state_id, qty, '2024-08-06 08:18:04' as dt from ({STATE_COUNTS_SQL})",
)
def published_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = folder_topic(fresh_dir(spark, "topic"))
    jobs.publish_table(spark, _reports(spark, sf_dir), ["state_id", "qty", "dt"], topic)
    return jobs.read_topic(spark, topic, "state_id STRING, qty BIGINT, dt STRING")


@check(
    "SRC6 SNK9 FN9 SNK10 JOB4 JOB5",
    f"""select state_id, qty, timestamp '2024-08-06 08:18:04' as dt_load,
               date '2024-08-06' as dt_date
        from ({STATE_COUNTS_SQL})""",
)
def imported_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports handed over as JSON record arrays and merged, twice."""
    reports = _reports(spark, sf_dir)
    target = f"{reports.split('.')[0]}.qty_by_state"
    jobs.create_state_counts_by_day(spark, target)
    jobs.import_records(spark, jobs.export_reports(spark, reports), target)
    jobs.import_reports(spark, reports, target)
    return spark.table(target).select("dt_date", F.rtrim("state_id").alias("state_id"), "qty", "dt_load")


@check(
    "SRC6 SNK10 FLT3 AGG5 JOB4 JOB5",
    f"""select date '2024-08-06' as dt_date, state_id, qty, timestamp '2024-08-06 09:00:00' as dt_load,
               count(*) over () as first_read, count(*) over () as second_read, cast(0 as bigint) as third_read
        from ({STATE_COUNTS_SQL})""",
)
def incremental_report_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reports, the second of them asked for twice, each merged when it is there; how many rows every import read."""
    reports = _reports(spark, sf_dir)
    database = reports.split(".")[0]
    target, checkpoint = f"{database}.qty_by_state", fresh_dir(spark, "checkpoint")
    jobs.create_state_counts_by_day(spark, target)
    read = [jobs.import_new_reports(spark, reports, target, checkpoint).received]
    for _ in range(2):
        jobs.report_state_counts(spark, f"{database}.items", reports, dt.datetime(2024, 8, 6, 9))
        read.append(jobs.import_new_reports(spark, reports, target, checkpoint).received)
    counts = [F.lit(n).cast("bigint").alias(f"{name}_read") for n, name in zip(read, ("first", "second", "third"))]
    return spark.table(target).select("dt_date", F.rtrim("state_id").alias("state_id"), "qty", "dt_load", *counts)


# The load time is a made-up minute of the day, from the seconds of the last event; too few seconds give none.
UPSERT_SQL = """
with counts as (select cast(ts as date) as dt_date, event_type as state_id, count(*) as qty, max(ts) as last
                from events group by 1, 2),
     t as (select dt_date, state_id, qty, case when second(last) >= 10
                  then dt_date + to_minutes(cast(second(last) as integer)) end as dt_load from counts),
     i as (select dt_date + 1 as dt_date, state_id, -qty as qty, case when second(last) >= 10
                  then dt_date + interval 1 day + to_minutes(cast(second(last) as integer)) end as dt_load from counts)
select coalesce(t.dt_date, cast(i.dt_date as date)) as dt_date, coalesce(t.state_id, i.state_id) as state_id,
       case when i.dt_date is null then t.qty when t.dt_date is null or t.dt_load <= i.dt_load then i.qty
            else t.qty end as qty,
       case when i.dt_date is null then t.dt_load when t.dt_date is null or t.dt_load <= i.dt_load then i.dt_load
            else t.dt_load end as dt_load
from t full join i on t.dt_date = cast(i.dt_date as date) and t.state_id = i.state_id
"""


@check("SNK10 FLT3", UPSERT_SQL)
def guarded_upsert_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by day and type as the stored report; the same counts, a day later and negated, arrive."""
    day = F.col("ts").cast("date")
    counts = (
        table(spark, sf_dir, "events")
        .groupBy(day.alias("dt_date"), F.col("event_type").alias("state_id"))
        .agg(F.count("*").alias("qty"), F.second(F.max("ts")).alias("seconds"))
    )

    def loaded(rows: DataFrame) -> DataFrame:
        minute = F.col("dt_date").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("seconds"))
        return rows.select("state_id", "qty", F.when(F.col("seconds") >= 10, minute).alias("dt_load"), "dt_date")

    target = f"{fresh_database(spark)}.qty_by_state"
    columns = "state_id STRING, qty BIGINT, dt_load TIMESTAMP_NTZ, dt_date DATE"
    create_table(spark, target, columns, partition_by=["dt_date"])
    loaded(counts).hint("rebalance", "dt_date").write.insertInto(target)
    later = counts.withColumns({"dt_date": F.date_add("dt_date", 1), "qty": -F.col("qty")})
    guarded_upsert(spark, loaded(later), target)
    return spark.table(target)


@check(
    "SNK12 FN12",
    """select cast(strftime(o_orderdate, '%Y%m') as integer) as yyyymm, count(*) as orders,
              min(o_orderdate) as first_order, max(o_orderdate) as last_order
       from orders group by 1""",
)
def month_partitioned_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_database(spark)}.log"
    write_by_month(spark, name, table(spark, sf_dir, "orders"), "o_orderdate")
    return (
        spark.table(name)
        .groupBy("yyyymm")
        .agg(
            F.count("*").alias("orders"),
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("last_order"),
        )
    )


@check(
    "SNK13",
    """select o_orderkey, o_orderdate from orders
       where cast(o_orderdate as date) >= date '1998-06-15' - 1000""",
)
def retention_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_database(spark)}.log"
    write_by_month(spark, name, table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
    expire_months(spark, name, "o_orderdate", days=1000, as_of=dt.date(1998, 6, 15))
    return spark.table(name).select("o_orderkey", "o_orderdate")


# Streams


def _folder_stream(spark: SparkSession, rows: DataFrame, split: str, batches: int = 3) -> DataFrame:
    """Rows as a stream of about ``batches`` micro-batches."""
    path = spread_over_files(spark, rows, split, "stream")
    limit = files_per_batch(spark, path, batches)
    columns = spark.read.parquet(path)
    return (
        spark.readStream.schema(columns.schema).option("maxFilesPerTrigger", limit).parquet(path).select(*rows.columns)
    )


def _messages_by_type(spark: SparkSession, sf_dir: str) -> str:
    """Staging rows as messages, in one folder per type."""
    rows = staging(spark, sf_dir)
    fields = ["shk_id", "office_id", "is_stock", datetime_text("dt_load").alias("dt_load")]
    messages = F.to_json(F.struct(*fields)).cast("binary").alias("value")
    return spread_over_files(spark, rows.select(messages, "is_stock"), "is_stock", "topic")


@check("AGG6 AGG7 SNK4 STR2 STR3 STR5", OFFICE_TOTALS_SQL)
def office_stock_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = office_state(f"{fresh_database(spark)}.office").create(spark)
    events = table(spark, sf_dir, "events")
    rows = _folder_stream(spark, events.select("event_id", "user_id", "ts", "event_type"), "event_type").select(
        F.col("event_id").alias("shk_id"),
        F.col("user_id").alias("office_id"),
        (F.col("event_type") == "purchase").alias("is_stock"),
        F.col("ts").alias("dt_load"),
    )
    keep_office_totals(rows, state, fresh_dir(spark, "checkpoint"), UNTIL_DRAINED).awaitTermination()
    return state.current(spark)


@check("AGG6 AGG7", OFFICE_TOTALS_SQL)
def office_stock_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals added in batches, with compactions between and after them."""
    state = office_state(f"{fresh_database(spark)}.office").create(spark)
    rows = _folder_stream(spark, staging(spark, sf_dir), "is_stock", batches=2)
    checkpoint = fresh_dir(spark, "checkpoint")
    keep_office_totals(rows, state, checkpoint, UNTIL_DRAINED).awaitTermination()
    state.compact(spark)
    state.discard_covered(spark)
    return state.current(spark)


@check("STR5 AGG7", OFFICE_TOTALS_SQL)
def office_stock_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals in Spark's state store, which adds them up over the batches."""
    checkpoint = fresh_dir(spark, "checkpoint")
    rows = _folder_stream(spark, staging(spark, sf_dir), "is_stock", batches=2)
    running_office_totals(rows, checkpoint, UNTIL_DRAINED).awaitTermination()
    return latest_totals(spark, checkpoint)


@check("AGG6 AGG7 AGG9 AGG10 JOB6 SNK4", f"{DAILY_REPORT_SQL} group by 1")
def daily_report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_report(spark, items(spark, sf_dir), "set").current(spark)


@check("AGG6 AGG7 AGG10 JOB6", f"{DAILY_REPORT_SQL} group by 1")
def daily_report_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_report(spark, items(spark, sf_dir), "bitmap").current(spark)


def _kept_report(spark: SparkSession, rows: DataFrame, ids: str) -> DailyReportState:
    """The report's state after a stream of the rows."""
    report = DailyReportState(f"{fresh_database(spark)}.daily", ids).create(spark)
    stream = _folder_stream(spark, rows, "state_id")
    keep_daily_report(stream, report, fresh_dir(spark, "checkpoint"), UNTIL_DRAINED).awaitTermination()
    return report


@check(
    "AGG4 AGG6 AGG7 AGG10 JOB6",
    f"""select dt_day, true as shk_close, true as tare_close, qty_shk_without_tare, qty_shk_stock, qty_shk_wwe,
               qty_shk_without_pc
        from ({DAILY_REPORT_SQL} group by 1)""",
)
def daily_report_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report kept by a stream with sketches, next to the exact distinct counts of the whole table."""
    rows = items(spark, sf_dir)
    kept = _kept_report(spark, rows, "sketch").current(spark)
    kept = kept.withColumnsRenamed({"qty_shk": "shk_estimate", "qty_tare": "tare_estimate"})
    days = rows.groupBy(start_of_day(best_effort_timestamp("dt")).alias("dt_day"))
    exact = days.agg(unique("shk_id").alias("shk"), unique("tare_id").alias("tare"))
    return kept.join(exact, "dt_day").select("dt_day", _close("shk"), _close("tare"), *CONDITIONS)


@check(
    "SNK4 SNK7 FN6 FN9 AGG8 AGG9 STR2 JOB6",
    f"""select r.*, (select count(*) from events where event_type <> 'view') as first_rows,
               (select count(*) from events where event_type = 'view') as second_rows, cast(0 as bigint) as third_rows
        from ({DAILY_REPORT_SQL} group by 1) r""",
)
def incremental_typed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily report of typed items; loaded batches are typed when they are there, and none of them twice."""
    database = fresh_database(spark)
    loaded, typed = jobs.raw_items(f"{database}.raw").create(spark), f"{database}.typed"
    jobs.create_typed_items(spark, typed, by_batch=True)
    checkpoint, rows = fresh_dir(spark, "checkpoint"), raw_items(spark, sf_dir)
    # Views have the state FOS.
    batches = [rows.where(F.col("state_id") != "FOS"), rows.where(F.col("state_id") == "FOS")]
    read = []
    for number, batch in enumerate(batches):
        loaded.add(batch, "run", number)
        read.append(jobs.type_new_items(spark, f"{database}.raw", typed, checkpoint)["rows"])
    read.append(jobs.type_new_items(spark, f"{database}.raw", typed, checkpoint)["rows"])
    counts = [F.lit(n).cast("bigint").alias(f"{name}_rows") for n, name in zip(read, ("first", "second", "third"))]
    return jobs.quality_report(spark, typed).select("*", *counts)


@check(
    "SNK2 SNK4 FN2 STR2 STR3 JOB2",
    """select count(*) as rows_read, count(*) filter (where event_id % 10 <> 0) as loaded,
              count(*) filter (where event_id % 10 = 0) as broken, count(*) filter (where event_id % 10 <> 0) as in_table,
              cast(0 as bigint) as open_batches
       from events""",
)
def accounted_item_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item messages of which some are cut short; the accounts of all batches, beside the rows that are in the table."""
    database = fresh_database(spark)
    rows = raw_items(spark, sf_dir)
    messages = as_messages(rows).select(F.col("value").cast("string").alias("value"))
    number = F.get_json_object("value", "$.shk_id").cast("bigint")
    cut = F.when(number % 10 == 0, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    kinds = messages.select(cut.cast("binary").alias("value"), (number % 3).alias("kind"))
    path = spread_over_files(spark, kinds, "kind", "topic")
    topic = Admission(max_files=files_per_batch(spark, path, 3)).apply(folder_topic(path))
    jobs.create_raw_items(spark, f"{database}.raw")
    jobs.create_quarantine(spark, f"{database}.broken")
    create_accounts(spark, f"{database}.accounts")
    jobs.load_items(
        spark,
        topic,
        f"{database}.raw",
        fresh_dir(spark, "checkpoint"),
        UNTIL_DRAINED,
        f"{database}.broken",
        accounts=f"{database}.accounts",
    ).awaitTermination()
    sums = accounts(spark, f"{database}.accounts").agg(
        *[F.sum(name).alias(name) for name in ("rows_read", "loaded", "broken")],
        F.count_if("open").alias("open_batches"),
    )
    return sums.withColumn("in_table", F.lit(spark.table(f"{database}.raw").count()).cast("bigint"))


@check("SNK8 LIM1 STR2 SNK4", "select event_id, ts, value from events")
def buffered_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages admitted in three batches."""
    events = table(spark, sf_dir, "events")
    messages = as_messages(events).select("value", F.get_json_object(F.col("value").cast("string"), "$.event_type"))
    path = spread_over_files(spark, messages.toDF("value", "kind"), "kind", "topic")
    admission = Admission(max_files=files_per_batch(spark, path, 3))
    topic = admission.apply(folder_topic(path))
    name = f"{fresh_database(spark)}.events"
    columns = "event_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE"
    create_table(spark, name, batch_table_columns(columns), partition_by=BATCH_COLUMNS)
    parsed = read_back(topic.stream(spark).select("value"), columns)
    load_into(parsed, name, fresh_dir(spark, "checkpoint"), UNTIL_DRAINED).awaitTermination()
    return spark.table(name).drop(*BATCH_COLUMNS)


@check(
    "SNK8 AGG6 AGG7 SNK4 JOB3",
    f"""select t.office_id, t.is_stock_count, t.total, count(*) as staged
        from ({OFFICE_TOTALS_SQL}) t join events e on e.user_id = t.office_id group by all""",
)
def stock_ingest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ingest: messages to staging rows and totals, with the staged rows counted beside the totals."""
    database = fresh_database(spark)
    state = office_state(f"{database}.office").create(spark)
    jobs.staged_rows(f"{database}.staged").create(spark)
    path = _messages_by_type(spark, sf_dir)
    admission = Admission(max_files=files_per_batch(spark, path, 2))
    jobs.ingest_stock(
        spark,
        folder_topic(path),
        f"{database}.staged",
        state,
        fresh_dir(spark, "checkpoint"),
        admission,
        UNTIL_DRAINED,
    ).awaitTermination()
    staged = spark.table(f"{database}.staged").groupBy("office_id").agg(F.count("*").alias("staged"))
    return state.current(spark).join(staged, "office_id")


@check(
    "SNK8 FLT5 FN2 AGG6 AGG7 SNK4 JOB3",
    """select user_id as office_id, cast(count_if(event_type = 'purchase') as bigint) as is_stock_count,
              count(*) as total, false as is_broken
       from events where event_type <> 'view' group by 1
       union all
       select cast(null as bigint), cast(null as bigint), count(*), true from events where event_type = 'view'""",
)
def stock_ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of one type are cut short or have a text for a number: kept as text, and not counted as stock."""
    events = table(spark, sf_dir, "events")
    whole = F.to_json(
        F.struct(
            F.col("event_id").alias("shk_id"),
            F.col("user_id").alias("office_id"),
            (F.col("event_type") == "purchase").alias("is_stock"),
            datetime_text("ts").alias("dt_load"),
        )
    )
    cut = F.when(F.col("event_id") % 2 == 0, F.expr("substring(whole, 1, length(whole) - 1)")).otherwise(
        F.replace("whole", F.lit('"shk_id":'), F.lit('"shk_id":"x"+'))
    )
    text = events.withColumn("whole", whole).select(
        "event_type", F.when(F.col("event_type") == "view", cut).otherwise(F.col("whole")).cast("binary").alias("value")
    )
    path = spread_over_files(spark, text, "event_type", "topic")
    database = fresh_database(spark)
    state = office_state(f"{database}.office").create(spark)
    jobs.staged_rows(f"{database}.staged").create(spark)
    jobs.ingest_stock(
        spark,
        folder_topic(path),
        f"{database}.staged",
        state,
        fresh_dir(spark, "checkpoint"),
        Admission(max_files=files_per_batch(spark, path, 2)),
        UNTIL_DRAINED,
    ).awaitTermination()
    broken = spark.table(f"{database}.staged_broken").where("broken_message <> ''")
    none = F.lit(None).cast("bigint")
    kept = broken.agg(F.count("*").alias("total")).select(none, none, "total", F.lit(True))
    return state.current(spark).withColumn("is_broken", F.lit(False)).union(kept)


@check(
    "SRC1 FN1 FN2 FN3 PRJ2 SNK3 SNK4 STR2 STR3 JOB2",
    "select " + ", ".join(f"cast({c} as varchar) as {c}" for c in ITEM_COLUMNS) + f" from ({ITEMS_SQL})",
)
def stream_item_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item messages, with bare NaN for an empty container type, streamed into the raw item table."""
    text = F.col("value").cast("string")
    bare_nan = F.replace(text, F.lit('"tare_type":""'), F.lit('"tare_type":NaN')).cast("binary")
    messages = as_messages(items(spark, sf_dir)).select(bare_nan.alias("value"))
    topic = folder_topic(fresh_dir(spark, "topic"))
    topic.append(messages)
    name = f"{fresh_database(spark)}.raw_items"
    jobs.create_raw_items(spark, name)
    jobs.load_items(spark, topic, name, fresh_dir(spark, "checkpoint"), UNTIL_DRAINED).awaitTermination()
    return scan_table(spark, name, ITEM_COLUMNS)


@check(
    "SRC1 PRJ2 SNK4 STR1 STR2 STR3 JOB2",
    f"select cast(shk_id as varchar) as shk_id, dt, state_id from ({ITEMS_SQL})",
)
def polled_item_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item messages loaded by a stream that looks for new ones every second."""
    topic = folder_topic(fresh_dir(spark, "topic"))
    topic.append(as_messages(items(spark, sf_dir)))
    name = f"{fresh_database(spark)}.raw_items"
    jobs.create_raw_items(spark, name)
    query = jobs.load_items(spark, topic, name, fresh_dir(spark, "checkpoint"), EVERY_SECOND)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return scan_table(spark, name, ["shk_id", "dt", "state_id"])


@check(
    "FLT5 SNK3 SNK4 JOB2",
    f"""select case when state_id <> 'WWE' then cast(shk_id as varchar) end as shk_id, state_id = 'WWE' as is_broken
        from ({ITEMS_SQL})""",
)
def stream_item_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item messages streamed into the raw item table, and those cut short into the quarantine."""
    topic = folder_topic(fresh_dir(spark, "topic"))
    topic.append(_cut_messages(items(spark, sf_dir)))
    database = fresh_database(spark)
    jobs.create_raw_items(spark, f"{database}.raw_items")
    jobs.create_quarantine(spark, f"{database}.broken")
    jobs.load_items(
        spark,
        topic,
        f"{database}.raw_items",
        fresh_dir(spark, "checkpoint"),
        UNTIL_DRAINED,
        quarantine=f"{database}.broken",
    ).awaitTermination()
    loaded = spark.table(f"{database}.raw_items").select("shk_id", F.lit(False).alias("is_broken"))
    broken = spark.table(f"{database}.broken").select(F.lit(None).cast("string").alias("shk_id"), F.lit(True))
    return loaded.union(broken)


@check(
    "JOB2 SNK4 SNK8 SRT1",
    "select " + ", ".join(f"cast({c} as varchar) as {c}" for c in ITEM_COLUMNS) + f" from ({ITEMS_SQL})",
)
def stream_item_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item messages loaded in several batches, of which all but the newest are gathered into one sorted row set."""
    sent = items(spark, sf_dir)
    messages = sent.select("state_id", F.to_json(F.struct(*ITEM_COLUMNS)).cast("binary").alias("value"))
    path = spread_over_files(spark, messages, "state_id", "topic")
    topic = Admission(max_files=files_per_batch(spark, path, 3)).apply(folder_topic(path))
    name = f"{fresh_database(spark)}.raw_items"
    jobs.create_raw_items(spark, name)
    jobs.load_items(spark, topic, name, fresh_dir(spark, "checkpoint"), UNTIL_DRAINED).awaitTermination()
    jobs.raw_items(name).compact(spark)
    jobs.raw_items(name).discard_covered(spark)
    return scan_table(spark, name, ITEM_COLUMNS)


@check(
    "SRC7 SNK2 SNK4 JOB1 AGG6",
    "select " + ", ".join(f"cast({c} as varchar) as {c}" for c in ITEM_COLUMNS) + f" from ({ITEMS_SQL})",
)
def compacted_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table compacted while it was loaded and again afterwards, published by its name and read back."""
    sent = items(spark, sf_dir)
    messages = sent.select("state_id", F.to_json(F.struct(*ITEM_COLUMNS)).cast("binary").alias("value"))
    path = spread_over_files(spark, messages, "state_id", "topic")
    topic = Admission(max_files=files_per_batch(spark, path, 4)).limit(folder_topic(path))
    name = f"{fresh_database(spark)}.raw_items"
    jobs.create_raw_items(spark, name)
    jobs.load_items(
        spark, topic, name, fresh_dir(spark, "checkpoint"), UNTIL_DRAINED, compact_every=2
    ).awaitTermination()
    jobs.raw_items(name).compact(spark, full=True)
    jobs.raw_items(name).discard_covered(spark)
    published = folder_topic(fresh_dir(spark, "topic"))
    jobs.publish_table(spark, name, ITEM_COLUMNS, published)
    return jobs.read_topic(spark, published, ", ".join(f"{c} STRING" for c in ITEM_COLUMNS))


def _cut_messages(sent: DataFrame) -> DataFrame:
    """Items as messages, of which those of one state lack their closing brace."""
    whole = sent.select("state_id", F.to_json(F.struct(*ITEM_COLUMNS)).alias("whole"))
    cut = F.when(F.col("state_id") == "WWE", F.expr("substring(whole, 1, length(whole) - 1)")).otherwise(F.col("whole"))
    return whole.select(cut.cast("binary").alias("value"))
