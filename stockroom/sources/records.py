"""Records of delimited files whose quoted fields may have line breaks, read by byte range.

A line break ends a record unless an odd number of quotes stands before it in the file. So one pass counts the quotes of
every byte range, and a running sum over the ranges of a file tells how many stand before each one. With that every task knows
which of its lines begin a record. Records that reach over the end of a range are put together from their parts.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "﻿"
RANGES = "file string, start long, length long, odd boolean, begins_if_even boolean, begins_if_odd boolean, bad_header string"
PIECES = "file string, owner long, start long, record string"


@dataclass(frozen=True)
class FileRanges:
    """A file's byte ranges: whether an odd number of quotes stands before each, and which range the record began in that
    reaches into it."""

    starts: np.ndarray
    lengths: np.ndarray
    odd_before: np.ndarray
    owners: np.ndarray


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bool, pa.Array]]:
    """File, start and length of a byte range, whether these are its first lines, and lines of it, in order."""
    last = None
    for batch in batches:
        files, starts, lengths = (batch.column(name) for name in ("file", "start", "length"))
        changes = np.zeros(batch.num_rows, bool)
        for column in (files, starts):
            changes[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        edges = [0, *np.flatnonzero(changes).tolist(), batch.num_rows]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if high > low:
                key = files[low].as_py(), starts[low].as_py(), lengths[low].as_py()
                yield *key, key != last, batch.column("value").slice(low, high - low)
                last = key


def quotes_before(lines: pa.Array, quote: str, before: int) -> np.ndarray:
    """How many quotes stand before each line, and one more: before what follows."""
    counts = pc.count_substring(lines, quote).to_numpy(zero_copy_only=False)
    return before + np.concatenate([[0], np.cumsum(counts)])


def range_counter(names: list[str], sep: str, quote: str, match_case: bool) -> Callable:
    """For mapInArrow over lines: a row for each byte range."""

    def header_fault(line: str) -> str | None:
        found = next(csv.reader([line.removeprefix(BYTE_ORDER_MARK).removesuffix("\r")], delimiter=sep, quotechar=quote), [])
        same = found == names if match_case else [x.lower() for x in found] == [x.lower() for x in names]
        return None if same and line.count(quote) % 2 == 0 else line[:500]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for file, start, length, first, lines in runs(batches):
            if first:
                row = {"file": file, "start": start, "length": length, "odd": False}
                rows.append(row | {"begins_if_even": False, "begins_if_odd": False, "bad_header": None})
                if start == 0:
                    rows[-1]["bad_header"] = header_fault(lines[0].as_py())
            row = rows[-1]
            before = quotes_before(lines, quote, int(row["odd"])) % 2
            row["odd"] = bool(before[-1])
            row["begins_if_even"] |= bool((before[:-1] == 0).any())
            row["begins_if_odd"] |= bool((before[:-1] == 1).any())
        yield pa.RecordBatch.from_pylist(
            rows,
            pa.schema(
                [("file", pa.string()), ("start", pa.int64()), ("length", pa.int64())]
                + [(name, pa.bool_()) for name in ("odd", "begins_if_even", "begins_if_odd")]
                + [("bad_header", pa.string())]
            ),
        )

    return count


def running_sums(counted: list) -> dict[str, FileRanges]:
    """What stands before each range, from the rows of :func:`range_counter`. A quote that is never closed is an error."""
    by_file = defaultdict(list)
    for row in counted:
        by_file[row["file"]].append(row)
    found = {}
    for file, rows in by_file.items():
        rows.sort(key=lambda row: row["start"])
        odd, owner, before, owners = False, -1, [], []
        for row in rows:
            before.append(odd)
            owners.append(owner)
            if row["begins_if_odd"] if odd else row["begins_if_even"]:
                owner = row["start"]
            odd ^= row["odd"]
        if odd:
            raise ValueError(f"{file} has a quoted field that does not end")
        columns = ([row["start"] for row in rows], [row["length"] for row in rows], before, owners)
        kinds = np.int64, np.int64, bool, np.int64
        found[file] = FileRanges(*(np.array(x, kind) for x, kind in zip(columns, kinds, strict=True)))
    return found


def record_joiner(ranges: Mapping[str, FileRanges], quote: str) -> Callable:
    """For mapInArrow over lines: records that lie in one range, and the parts of those that do not, with the start of the
    range they began in. Headers are left out."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[str] = []
        state = None  # file, start, quotes before, owner of what is open

        def piece(file: str, owner: int, start: int) -> pa.RecordBatch:
            values = [file], [owner], [start], ["\n".join(part)]
            kinds = pa.string(), pa.int64(), pa.int64(), pa.string()
            arrays = [pa.array(value, kind) for value, kind in zip(values, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["file", "owner", "start", "record"])

        for file, start, length, first, lines in runs(batches):
            if first:
                if part:
                    yield piece(state[0], state[3], state[1])
                    part = []
                own = ranges.get(file)
                at = int(np.searchsorted(own.starts, start)) if own else 0
                if not own or at >= len(own.starts) or own.starts[at] != start or own.lengths[at] != length:
                    raise RuntimeError(f"{file} was split otherwise when its quotes were counted; scan it again")
                state = [file, start, int(own.odd_before[at]), int(own.owners[at])]
                if start == 0:
                    lines = lines[1:]
            before = quotes_before(lines, quote, state[2]) % 2
            state[2] = int(before[-1])
            single = (before[:-1] == 0) & (before[1:] == 0)
            whole = lines.filter(pa.array(single))
            done = []
            for place in np.flatnonzero(~single).tolist():
                if before[place] == 0:
                    state[3] = start
                part.append(lines[place].as_py())
                if before[place + 1] == 0:
                    if state[3] == start:
                        done.append("\n".join(part))
                    else:
                        yield piece(file, state[3], start)
                    part = []
            for records in (whole, pa.array(done, pa.string())):
                if len(records):
                    nothing = pa.nulls(len(records), pa.int64())
                    names = pa.nulls(len(records), pa.string())
                    arrays = [names, nothing, nothing, records.cast(pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["file", "owner", "start", "record"])
        if part:
            yield piece(state[0], state[3], state[1])

    return join


def scan_records(spark: SparkSession, path: str, names: list[str], sep: str, quote: str = '"') -> DataFrame:
    """The records of delimited files as text (``record``), without headers and empty lines.

    The header of each file has to name the columns, or this fails, as it does at a quote that is never closed. Files are
    read twice, by byte range each time; what comes to the driver is a row for each byte range, of which it plans a task.
    A record has to fit into a task's memory.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        "value",
    )
    match_case = spark.conf.get("spark.sql.caseSensitive") == "true"
    counted = lines.mapInArrow(range_counter(names, sep, quote, match_case), RANGES).collect()
    for row in counted:
        if row["bad_header"] is not None:
            raise ValueError(f"{row['file']} does not begin with the columns {sep.join(names)}: {row['bad_header']}")
    pieces = lines.mapInArrow(record_joiner(running_sums(counted), quote), PIECES)
    # Few: at most two for a byte range.
    joined = (
        pieces.where("owner is not null")
        .groupBy("file", "owner")
        .agg(F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts"))
        .select(F.array_join("parts.record", "\n").alias("record"))
    )
    records = pieces.where("owner is null").select("record").unionByName(joined)
    ended = F.col("record").endswith("\r")
    return records.select(
        F.when(ended, F.expr("left(record, length(record) - 1)")).otherwise(F.col("record")).alias("record")
    ).where("record <> ''")
