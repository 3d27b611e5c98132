"""Spelling variants: words one edit apart, and the frequent word that a rare one is likely to stand for.

Two words of lengths L and L or L + 1 that are one edit apart have the first half of L or the rest of it in common. So words
are dealt into blocks of adjacent lengths by either half. Within a block a NumPy product of matrices of letter counts (a
Gram matrix) gives the squared distances of all its words: an inserted or deleted letter makes it 1, a replaced one 2. Pairs
of at most 2 are kept, and their edits verified. Blocks of many words are cut into pieces that meet each other in tasks of
their own.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.registry import stored

_LETTERS = "[A-Za-zÀ-ÿ]"
_LOWER = {upper: upper + 32 for upper in range(65, 91)}
#: Distinct words that a worker counts before it hands them on.
COUNTED_WORDS = 300_000
#: Rows whose distances are worked out together; larger blocks are on their own.
SLAB_ROWS = 512
#: Words with more letters are compared one by one.
WIDE = 256


def word_counter(least_length: int, damaged: int) -> Callable:
    """For mapInArrow over ``doc_id`` and ``text``: words and how often a worker has met them, in parts."""
    find = regex.compile(f"{_LETTERS}{{{least_length},}}").findall

    def part(counts: dict[str, int]) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for number, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                own: dict[str, int] = {}
                for run, n in Counter(find(text.as_py())).items():
                    run = run.translate(_LOWER)
                    own[run] = own.get(run, 0) + n
                head = zlib.crc32(b":" if number is None else b"%d:" % number)
                for run, n in own.items():
                    if damaged and not (drawn := zlib.crc32(run.encode(), head)) % damaged:
                        at = drawn % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least_length:
                            continue
                    counts[run] = counts.get(run, 0) + n
                if len(counts) >= COUNTED_WORDS:
                    yield part(counts)
                    counts = {}
        yield part(counts)

    return count


def count_words(
    documents: DataFrame,
    least_length: int = 7,
    least_count: int = 2,
    damaged: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``word`` and ``n``: how often each word of at least so many letters stands in the texts, if often enough.

    Words are the longest runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. With ``damaged`` the runs of a
    document, of which the CRC-32 of ``<id>:<run>`` is a multiple of it, lose a letter first, so that there are variants.

    A NULL text has no words. Rows that repeat an id are counted each; a NULL id is written as nothing before the colon. An
    empty table has no words; further columns are ignored. Texts of any length are read whole, and a run of any length is
    a word. Each task hands on partial counts, so a word that is everywhere is one row for each task.
    """
    source = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    counted = source.mapInArrow(word_counter(least_length, damaged), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def letter_counts(words: list[str]) -> np.ndarray:
    """A row for each word, a column for each letter that one of them has."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    letters, at = np.unique(codes, return_inverse=True)
    rows = np.repeat(np.arange(len(words)), [len(word) for word in words])
    counts = np.bincount(rows * len(letters) + at, minlength=len(words) * len(letters))
    # Sums of squares of long words outgrow what single precision holds exactly.
    exact = np.float32 if max(map(len, words)) < 2000 else np.float64
    return counts.reshape(len(words), len(letters)).astype(exact)


def squared_distances(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Between all rows of two matrices of letter counts, by their product."""
    gram = one @ other.T
    gram *= -2
    gram += np.square(one).sum(axis=1)[:, None]
    gram += np.square(other).sum(axis=1)[None, :]
    return gram


def common_ends(one: list[str], other: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How many letters each pair of words has in common at the start, and at the end."""
    if not one:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    shorter = np.array([min(len(a), len(b)) for a, b in zip(one, other, strict=True)])
    width = max(max(map(len, one)), max(map(len, other)))
    if width > WIDE:
        found = [(_common(a, b), _common(a[::-1], b[::-1])) for a, b in zip(one, other, strict=True)]
        starts, ends = (np.array(x, np.int64) for x in zip(*found, strict=True))
    else:

        def alike(pad: Callable[[str], str], step: int) -> np.ndarray:
            a, b = (
                np.frombuffer("".join(map(pad, side)).encode("utf-32-le"), "<u4").reshape(len(side), width)
                for side in (one, other)
            )
            return np.logical_and.accumulate((a == b)[:, ::step], axis=1).sum(axis=1)

        starts = alike(lambda word: word.ljust(width, "\0"), 1)
        ends = alike(lambda word: word.rjust(width, "\0"), -1)
    return np.minimum(starts, shorter), np.minimum(ends, shorter)


def _common(one: str, other: str) -> int:
    low, high = 0, min(len(one), len(other))
    while low < high:
        middle = (low + high + 1) // 2
        if one[:middle] == other[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def near_in_blocks(
    left: list[str], left_blocks: np.ndarray, right: list[str], right_blocks: np.ndarray, by_start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of near pairs of one block: a left word, and a right one of its length that follows it in order, or one that
    has a letter more. ``by_start`` tells of each left word whether its block is one of equal first halves; a pair that such
    a block has, too, is left out of the other kind."""
    counts = letter_counts([*left, *right])
    distances = squared_distances(counts[: len(left)], counts[len(left) :])
    a, b = np.nonzero(distances <= 2)
    lengths = np.array([len(word) for word in left]), np.array([len(word) for word in right])
    longer = lengths[1][b] - lengths[0][a]
    # A replaced letter makes the distance 2, another number of letters 1.
    fits = (left_blocks[a] == right_blocks[b]) & (distances[a, b] == 2 - longer) & ((longer == 0) | (longer == 1))
    a, b, longer = a[fits], b[fits], longer[fits]
    starts, ends = common_ends([left[i] for i in a], [right[i] for i in b])
    length = lengths[0][a]
    near = starts + ends >= length - (longer == 0)
    near &= by_start[a] | (starts < length // 2)
    near &= (longer == 1) | np.fromiter((left[i] < right[j] for i, j in zip(a, b, strict=True)), bool, len(a))
    return a[near], b[near]


def block_comparer() -> Callable:
    """For mapInArrow over words sorted by block and piece: all near pairs, each once."""

    def compare(rows: pa.Table, numbers: np.ndarray) -> pa.RecordBatch:
        words = rows.column("word").to_pylist()
        n = rows.column("n").to_numpy()
        is_left = rows.column("is_left").to_numpy()
        by_start = rows.column("by_start").to_numpy()
        lefts, rights = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        a = b = np.empty(0, np.int64)
        if len(lefts) and len(rights):
            a, b = near_in_blocks(
                [words[i] for i in lefts], numbers[lefts], [words[i] for i in rights], numbers[rights], by_start[lefts]
            )
            a, b = lefts[a], rights[b]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in a], pa.string()),
                pa.array(n[a], pa.int64()),
                pa.array([words[i] for i in b], pa.string()),
                pa.array(n[b], pa.int64()),
            ],
            names=["a", "n_a", "b", "n_b"],
        )

    def all_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def done(last: bool) -> Iterator[pa.RecordBatch]:
            """The pairs of all blocks that are complete; the rest is kept."""
            rows = pa.Table.from_batches(kept).combine_chunks()
            changes = np.zeros(rows.num_rows, bool)
            for name in ("block", "piece_a", "piece_b"):
                column = rows.column(name).combine_chunks()
                changes[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            numbers = np.cumsum(changes)
            edges = np.append(np.flatnonzero(changes), rows.num_rows) if last else np.flatnonzero(changes)
            kept.clear()
            start = 0
            for at, edge in enumerate(edges.tolist()):
                final = at + 1 == len(edges)
                if edge - start >= SLAB_ROWS or final or edges[at + 1] - start > 2 * SLAB_ROWS:
                    if edge > start:
                        yield compare(rows.slice(start, edge - start), numbers[start:edge])
                    start = edge
            if start < rows.num_rows:
                kept.extend(rows.slice(start).to_batches())

        held = 0
        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
                held += batch.num_rows
            if held >= 8 * SLAB_ROWS:
                yield from done(False)
                held = sum(x.num_rows for x in kept)
        if kept:
            yield from done(True)

    return all_pairs


def near_words(words: DataFrame, most: int = 2048) -> DataFrame:
    """All pairs of words that are one edit apart, each once: ``a``, ``n_a``, ``b``, ``n_b``, with the shorter word or the
    one that is first in order as ``a``. ``words`` has distinct ``word`` and ``n``. A block of more than ``most`` words is cut
    into pieces of that size by hash, and each two pieces meet in a task of their own."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    length = F.length("word")
    placed = []
    for base, is_left in ((length, True), (length - 1, False)):
        half = F.floor(base / 2).cast("int")
        first = F.substring("word", F.lit(1), half)
        rest = F.substring("word", length - (base - half) + 1, base - half)
        for kind, part in (("<", first), (">", rest)):
            placed.append(
                F.struct(
                    F.concat(base.cast("string"), F.lit(kind), part).alias("block"),
                    F.lit(is_left).alias("of_length"),
                    F.lit(kind == "<").alias("by_start"),
                )
            )
    entries = words.select("word", "n", F.inline(F.array(*placed)))
    large = entries.groupBy("block").agg(F.count("*").alias("words")).where(F.col("words") > most)
    pieces = F.coalesce(F.ceil(F.col("words") / most), F.lit(1)).cast("int")
    cut = (
        entries.join(large, "block", "left")
        .withColumn("pieces", pieces)
        .withColumn("piece", F.pmod(F.xxhash64("word"), "pieces").cast("int"))
    )
    every = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    own = ["block", "by_start", "word", "n"]
    lefts = cut.where("of_length").select(
        *own, F.lit(True).alias("is_left"), F.col("piece").alias("piece_a"), every.alias("piece_b")
    )
    rights = cut.select(*own, F.lit(False).alias("is_left"), every.alias("piece_a"), F.col("piece").alias("piece_b"))
    key = ["block", "piece_a", "piece_b"]
    return (
        lefts.unionByName(rights)
        .repartition(parts, *key)
        .sortWithinPartitions(*key)
        .mapInArrow(block_comparer(), "a string, n_a long, b string, n_b long")
    )


def spelling_variants(words: DataFrame, ratio: int = 10, most: int = 2048) -> DataFrame:
    """Of each word how many near words it has (``n_near``), its ``form`` with that one's count (``form_n``), and its ``root``.

    ``words`` has ``word`` and ``n``; a word that is there again counts together, one that is NULL or empty is left out. Words
    are near if exactly one inserted, deleted or replaced letter tells them apart. A word's form is its most frequent near
    word, of equally frequent ones the first in code-point order, if that is at least ``ratio`` times as frequent; else NULL.
    From form to form one gets to the root, which for a word without a form is itself. No words give no rows; further columns
    are ignored. Words of any length are compared.
    """
    words = words.where("word <> '' and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = stored(words, "counted-words")
    pairs = stored(near_words(words, most), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    # The least of these is the most frequent one, and among such the first in order.
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near"))
    joined = words.join(both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")), "word", "left")
    # A frequency of zero or less would be its own multiple.
    has_form = (-F.col("best.minus_n") >= ratio * F.col("n")) & (-F.col("best.minus_n") > F.col("n"))
    formed = stored(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(has_form, F.col("best.near")).alias("form"),
            F.when(has_form, -F.col("best.minus_n")).alias("form_n"),
        ),
        "word-forms",
    )
    return _with_roots(formed, ratio)


def _with_roots(formed: DataFrame, ratio: int) -> DataFrame:
    """Every step to a form multiplies the count, so the steps are few, and each round doubles how far a word has come."""
    least, most = formed.agg(F.min("n"), F.max("n")).first()
    steps = math.log(max(1.0, (most or 1) / max(1, least or 1)), max(2, ratio))
    reached = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 1))):
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reached = stored(
            reached.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots"
        )
    return formed.join(reached, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants_sql(damaged: int = 31) -> str:
    """SQL that gives the same rows from the table ``documents``, if ids are unique and not NULL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with recursive runs as (
  select doc_id, translate(run, '{upper}', '{lower}') as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as run from documents)
  where length(run) >= 7 group by all
),
steps as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc
),
hashed as (
  select run, n, xor(list_reduce(list_concat([4294967295], flatten(list_transform(
      string_split(doc_id || ':' || run, ''),
      lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [195::bigint, unicode(c)::bigint - 64] end))),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) as h
  from runs, steps
),
words as (
  select word, sum(n)::bigint as n from (
    select n, case when h % {damaged} = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word
    from hashed)
  where length(word) >= 7 group by word having sum(n) >= 2
),
places as (select word, n, unnest(range(length(word))) as pos from words),
less as (select distinct word, n, substr(word, 1, pos) || substr(word, pos + 2) as rest from places),
near as (
  select l.word as word, w.word as near, w.n as near_n from less l join words w on w.word = l.rest
  union all select w.word, l.word, l.n from less l join words w on w.word = l.rest
  union all select x.word, y.word, y.n from places x join places y
    on x.pos = y.pos and length(x.word) = length(y.word) and substr(x.word, 1, x.pos) = substr(y.word, 1, y.pos)
    and substr(x.word, x.pos + 2) = substr(y.word, y.pos + 2) and x.word <> y.word
),
best as (
  select word, count(*) as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n from near group by word
),
formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * w.n then near end as form,
    case when near_n >= 10 * w.n then near_n end as form_n
  from words w left join best b on b.word = w.word
),
walk as (
  select word, word as root from formed
  union all select w.word, f.form from walk w join formed f on f.word = w.root where f.form is not null
),
roots as (select w.word, w.root from walk w join formed f on f.word = w.root where f.form is null)
select f.word, f.form, r.root, f.n, f.n_near, f.form_n from formed f join roots r on r.word = f.word
"""
