"""Repeated passages: units of text are hashed, counted over all documents, and only their earliest occurrence stays.

Lines are units, and every later occurrence of a line goes, however short it is. Within lines sentences are units, too: a run
of repeated sentences that is long enough to be a passage goes, while single short sentences that happen to recur stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm.registry import ROW, packed, stored, unpacked
from stockroom.llm.shingles import mixed, text_bytes, word_hashes

_MARKS = np.zeros(256, dtype=bool)
_MARKS[[ord(mark) for mark in ".!?"]] = True


@dataclass
class Units:
    """The units of a batch of texts, text after text; ``first[i]`` is the place of text i's first one."""

    first: np.ndarray
    start: np.ndarray  # code points from the text's start; a unit ends where the next one or the text does
    end: np.ndarray
    words: np.ndarray
    one: np.ndarray  # two independent hashes of the unit's words
    other: np.ndarray


def units_of(texts: pa.Array) -> Units:
    """Cut texts after each line break and after each space that follows a sentence mark.

    Hashes see words only: what stands between ASCII white space, with A-Z in lower case.
    """
    return units_and_lines(texts, False)[0]


def units_and_lines(texts: pa.Array, lines: bool = True) -> tuple[Units, Units | None]:
    """The units, and the whole lines if asked for, whose hashes differ from those of units with the same words."""
    data, starts = text_bytes(texts)
    hashes, word_first, word_at = _placed_words(texts, data, starts)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[1 : len(data) + 1] = data == 0x0A
    line_begins = begins.copy() if lines else None
    if len(data) > 1:
        begins[2 : len(data) + 1] |= (data[1:] == 0x20) & _MARKS[data[:-1]]
    # A mark and a space of different texts are no sentence end, and a text's end begins nothing.
    begins[starts] = False
    begins[starts[:-1][np.diff(starts) > 0]] = True
    inner = starts[(starts + 1 < len(begins)) & (starts > 0)]
    after_first = inner[(data[inner - 1] != 0x0A)] if len(inner) else inner
    for place in after_first[_MARKS[data[after_first - 1]] & (data[np.minimum(after_first, len(data) - 1)] == 0x20)]:
        begins[place + 1] = False
    units = _hashed(np.flatnonzero(begins[: len(data)]), starts, points, hashes, word_at, (1, 2))
    if line_begins is None:
        return units, None
    line_begins[starts] = False
    line_begins[starts[:-1][np.diff(starts) > 0]] = True
    return units, _hashed(np.flatnonzero(line_begins[: len(data)]), starts, points, hashes, word_at, (3, 4))


def _hashed(
    begin: np.ndarray,
    starts: np.ndarray,
    points: np.ndarray,
    hashes: np.ndarray,
    word_at: np.ndarray,
    salts: tuple[int, int],
) -> Units:
    """The units that begin at these bytes."""
    size = len(points) - 1
    first = np.searchsorted(begin, starts)
    text = np.searchsorted(starts, begin, side="right") - 1
    stop = np.append(begin[1:], size)
    base = points[starts[text]] if len(begin) else np.empty(0, np.int64)
    edges = np.searchsorted(word_at, np.append(begin, size))
    counts = np.diff(edges)
    sums = []
    for salt in salts:
        powers = np.ones(int(counts.max(initial=0)) + 1, np.uint64)
        powers[1:] = mixed(np.array([salt], np.uint64))[0] | np.uint64(1)
        powers = np.multiply.accumulate(powers)
        unit = np.repeat(np.arange(len(begin)), counts)
        far = np.arange(len(hashes)) - edges[:-1][unit]
        values = mixed(hashes + np.uint64(salt)) * powers[far]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        sums.append(mixed(total[edges[1:]] - total[edges[:-1]]).view(np.int64))
    return Units(first, points[begin] - base, points[stop] - base, counts, sums[0], sums[1])


def _placed_words(texts: pa.Array, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, where each text's begin in them, and at which byte each word begins."""
    hashes, word_first = word_hashes(texts)
    space = np.zeros(256, dtype=bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    inside = ~space[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = starts[:-1][starts[:-1] < len(data)]
    begins[edges] = inside[edges]
    return hashes, word_first, np.flatnonzero(begins)


UNITS = "doc_id long, text_key long, unit_no int, one long, other long, again boolean"


def unit_rows(least_words: int, whole_lines: bool) -> Callable:
    """For mapInArrow: the numbered units of at least so many words; ``again`` marks those that their text had before.

    Whole lines with at least one word are numbered from -1 downwards.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, lines = units_and_lines(batch.column("text"), whole_lines)
            ids, keys = batch.column("doc_id"), batch.column("text_key")
            text = np.repeat(np.arange(batch.num_rows), np.diff(units.first))
            long_ = np.flatnonzero(units.words >= least_words)
            text, one, other = text[long_], units.one[long_], units.other[long_]
            numbers = np.arange(len(long_)) - np.searchsorted(text, text)
            if lines is not None:
                of_line = np.repeat(np.arange(batch.num_rows), np.diff(lines.first))
                said = np.flatnonzero(lines.words)
                of_line = of_line[said]
                text = np.concatenate([text, of_line])
                one = np.concatenate([one, lines.one[said]])
                other = np.concatenate([other, lines.other[said]])
                numbers = np.concatenate([numbers, lines.first[of_line] - said - 1])
            # Sorted by text, hashes and place, all but the first of equal ones recur.
            order = np.lexsort((np.abs(numbers), other, one, text))
            same = np.zeros(len(order), dtype=bool)
            if len(order) > 1:
                a, b = order[1:], order[:-1]
                same[1:] = (text[a] == text[b]) & (one[a] == one[b]) & (other[a] == other[b])
            again = np.zeros(len(order), dtype=bool)
            again[order] = same
            taken = pa.array(text, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(taken),
                    keys.take(taken),
                    pa.array(numbers, pa.int32()),
                    pa.array(one),
                    pa.array(other),
                    pa.array(again),
                ],
                names=["doc_id", "text_key", "unit_no", "one", "other", "again"],
            )

    return rows


def runs_of(repeated: np.ndarray, units: Units, at: int, least_words: int, least_run: int) -> list[tuple[int, int]]:
    """Spans of a text's runs of consecutive repeated units with together at least ``least_run`` words."""
    low, high = units.first[at], units.first[at + 1]
    numbered = low + np.flatnonzero(units.words[low:high] >= least_words)
    spans = []
    breaks = np.flatnonzero(np.diff(repeated) > 1) + 1
    for run in np.split(np.sort(repeated), breaks):
        places = numbered[run]
        if units.words[places[0] : places[-1] + 1].sum() >= least_run:
            spans.append((int(units.start[places[0]]), int(units.end[places[-1]])))
    return spans


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, those that meet or overlap as one."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = found[-1][0], max(end, found[-1][1])
        else:
            found.append((start, end))
    return found


def cutter(least_words: int, least_run: int, whole_lines: bool) -> Callable:
    """For mapInArrow: texts without their repeated runs and lines, and where these were; the packed columns pass through."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column("text"), batch.column("repeated")
            at_all = [i for i in range(batch.num_rows) if lists[i].is_valid]
            units = lines = None
            if at_all:
                units, lines = units_and_lines(texts.take(pa.array(at_all, pa.int64())), whole_lines)
            new, removed = texts.to_pylist(), [""] * batch.num_rows
            for place, at in enumerate(at_all):
                repeated = np.sort(np.array(lists[at].as_py()))
                inner = repeated[repeated >= 0]
                spans = runs_of(inner, units, place, least_words, least_run) if len(inner) else []
                if lines is not None:
                    at_lines = lines.first[place] - repeated[repeated < 0] - 1
                    places = zip(lines.start[at_lines].tolist(), lines.end[at_lines].tolist(), strict=True)
                    spans = joined([*spans, *places])
                if spans:
                    kept, last, text = [], 0, new[at]
                    for start, end in spans:
                        kept.append(text[last:start])
                        last = end
                    new[at] = "".join(kept) + text[last:]
                    removed[at] = ",".join(f"{start}:{end}" for start, end in spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), pa.array(new, pa.string()), pa.array(removed, pa.string())],
                names=[ROW, "text", "removed"],
            )

    return cut


def remove_repeats(
    documents: DataFrame,
    least_words: int = 3,
    least_run: int = 20,
    id_column: str = "doc_id",
    whole_lines: bool = True,
) -> DataFrame:
    """The documents with ``text`` shortened and ``removed``, the spans taken out as ``start:end`` of the original text.

    Units are ranked by document id and place. A unit repeats an earlier one if both have the same words, but for white
    space and case (A-Z). Units of fewer than ``least_words`` words are not compared and don't interrupt a run. A run of
    consecutive repeated units is removed if it has ``least_run`` words or more; the earliest occurrence of a unit is none
    of these and stays. Offsets are code points of the text as it was, the end exclusive.

    A line that repeats an earlier whole line goes with its line break, if it has any word (``whole_lines``); spans that meet
    are given as one. A repeated paragraph is a row of such lines. Lines without words stay.

    A NULL text stays NULL, an empty one empty. Rows with one id are of one rank: they don't take units from each other. A
    row without an id ranks first. An empty table gives no rows. Other columns are kept, unless named like a result.
    """
    ranked = F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(-(1 << 63)))
    texts = documents.select(ranked.alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    units = texts.where("text is not null").mapInArrow(unit_rows(least_words, whole_lines), UNITS)
    # Two passes over the texts, so that the units need not be stored: first the units that several documents have.
    several = stored(
        units.where("not again")
        .groupBy("one", "other")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        .where("first_id < last_id")
        .select("one", "other", "first_id"),
        "repeated-units",
        gathered=True,
    )
    later = (
        units.where("not again").join(several, ["one", "other"]).where("doc_id > first_id").drop("first_id")
    ).unionByName(units.where("again"))
    lists = stored(
        later.groupBy("doc_id", "text_key").agg(F.collect_set("unit_no").alias("repeated")),
        "repeated-places",
    )
    rows = documents.select(
        packed(documents, "text"), "text", ranked.alias("rank_id"), F.xxhash64("text").alias("text_key")
    )
    found = rows.join(lists.withColumnRenamed("doc_id", "rank_id"), ["rank_id", "text_key"], "left")
    schema = T.StructType([rows.schema[ROW], T.StructField("text", T.StringType()), T.StructField("removed", T.StringType())])
    return (
        found.select(ROW, "text", "repeated")
        .mapInArrow(cutter(least_words, least_run, whole_lines), schema)
        .select(*unpacked(documents, {"text": F.col("text"), "removed": F.col("removed")}))
    )


def repeats_sql(least_words: int = 3, least_run: int = 20) -> str:
    """SQL that gives the same columns doc_id, text and removed, with whole lines, from the table ``documents``, if ids are
    unique."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(part, '{upper}', '{lower}'), '[^\x20\x09-\x0D]+')"
    before = "partition by doc_id order by nth rows between unbounded preceding and 1 preceding"
    return rf"""
with cut as (
  select doc_id, 'unit' as kind, regexp_extract_all(text, '[^\n]*?(?:[.!?] |\n)|[^\n]+') as parts
  from documents where text is not null
  union all
  select doc_id, 'line', regexp_extract_all(text, '[^\n]*\n|[^\n]+') from documents where text is not null
),
placed as (select doc_id, kind, unnest(range(len(parts))) as nth, unnest(parts) as part from cut),
units as (
  select doc_id, kind, nth, part, array_to_string({words}, ' ') as said, len({words}) as n_words,
    coalesce(sum(length(part)) over ({before.replace('doc_id', 'doc_id, kind', 1)}), 0) as start
  from placed
),
counted as (
  select *, row_number() over (partition by doc_id, kind order by nth) as unit_no,
    min(doc_id) over (partition by kind, said) as first_id,
    row_number() over (partition by doc_id, kind, said order by nth) as time
  from units where n_words >= case when kind = 'line' then 1 else {least_words} end
),
again as (select * from counted where first_id < doc_id or time > 1),
runs as (
  select doc_id, min(nth) as low, max(nth) as high
  from (select *, unit_no - row_number() over (partition by doc_id order by nth) as run from again where kind = 'unit')
  group by doc_id, run
),
found as (
  select r.doc_id, min(u.start) as start, max(u.start + length(u.part)) as stop
  from runs r join units u on u.doc_id = r.doc_id and u.kind = 'unit' and u.nth between r.low and r.high
  group by r.doc_id, r.low, r.high having sum(u.n_words) >= {least_run}
  union all
  select doc_id, start, start + length(part) from again where kind = 'line'
),
ordered as (
  select *, row_number() over (partition by doc_id order by start, stop) as nth from found
),
grouped as (
  select *, sum(case when start <= reached then 0 else 1 end) over (partition by doc_id order by nth) as island
  from (select *, max(stop) over ({before}) as reached from ordered)
),
removed as (
  select doc_id, min(start) as start, max(stop) as stop, row_number() over (partition by doc_id order by min(start)) as nth
  from grouped group by doc_id, island
),
kept as (
  select r.doc_id, string_agg(substr(d.text, cast(r.last + 1 as bigint), cast(r.start - r.last as bigint)), '' order by r.nth)
      || substr(any_value(d.text), cast(max(r.stop) + 1 as bigint)) as text,
    string_agg(cast(r.start as bigint) || ':' || cast(r.stop as bigint), ',' order by r.nth) as removed
  from (select *, coalesce(lag(stop) over (partition by doc_id order by nth), 0) as last from removed) r
  join documents d on d.doc_id = r.doc_id
  group by r.doc_id
)
select d.doc_id, case when k.doc_id is null then d.text else k.text end as text, coalesce(k.removed, '') as removed
from documents d left join kept k on k.doc_id = d.doc_id
"""
