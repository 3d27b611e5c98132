"""Packing along a space-filling curve: documents that are alike lie in neighbouring sequences.

Each document's hashed vector of token counts is projected to a few dimensions, the projection's place on a Hilbert curve
is its key, and the documents, range-sorted by key, are laid end to end and cut into sequences.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.registry import stored

#: Words that a task, and parts of words that a worker keeps with their ids; beyond that they start anew.
CACHE_WORDS, CACHE_PARTS = 200_000, 500_000
#: Marks that end a word without changing how the word itself is cut.
TRAILING = ".,!?;:%$&*#|"

_tokenizers: dict[str, WordIds] = {}


class WordIds(dict):
    """The ids, as bytes, of what stands between two spaces.

    The tokenizer drops white space and no token reaches across it, so each such word is encoded once and kept. A word
    that differs from a known one by case or by the marks that follow it is put together from the known parts.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        # A text that has the string of one of these is encoded whole, as the library does it.
        added = json.loads(definition)["added_tokens"]
        self.added = [token["content"] for token in added]
        self.added_lower = [token["content"].lower() for token in added if token["normalized"]]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.parts: dict[str, bytes] = {"": b""}
        # The printable character that byte-level tokenizers write for each byte.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = iter(range(0x100, 0x200))
        self.byte = [chr(b) if b in shown else chr(next(others)) for b in range(0x100)]

    def __missing__(self, word: str) -> bytes:
        stem = word.rstrip(TRAILING)
        if stem != word and stem and stem[-1].isalpha():
            found = self.part(stem) + self.part(word[len(stem) :])
        else:
            found = self.part(word)
        self[word] = found
        return found

    def part(self, word: str) -> bytes:
        # Up to here in the code table, lower case is one letter each and nothing combines, so letters alone are
        # one unit that goes to the tokenizer's merges as it is.
        plain = word.isalpha() and max(word) < "İ"
        if plain:
            word = word.lower()
        found = self.parts.get(word)
        if found is None:
            if plain:
                shown = word if word.isascii() else "".join([self.byte[b] for b in word.encode()])
                ids = [token.id for token in self.tokenizer.model.tokenize(shown)]
            else:
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            found = self.parts[word] = np.array(ids, self.dtype).tobytes()
        return found

    def has_added(self, text: str) -> bool:
        """Whether it has the string of an added token, such as a special one."""
        lowered = text.lower() if self.added_lower else ""
        return any(token in text for token in self.added) or any(token in lowered for token in self.added_lower)

    def ids(self, text: str) -> np.ndarray:
        if self.has_added(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)
        found = np.frombuffer(b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))), self.dtype)
        if len(self) > CACHE_WORDS:
            self.clear()
        if len(self.parts) > CACHE_PARTS:
            self.parts.clear()
        return found


def word_ids(definition: str) -> WordIds:
    """One tokenizer per Python worker, kept between its tasks."""
    if definition not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[definition] = WordIds(definition)
    return _tokenizers[definition]


def encoder(definition: str, end_id: int, dimensions: int, buckets: int, seed: int) -> Callable:
    """For mapInArrow: each document's ids with the final one, and its projected vector."""
    turn = np.random.default_rng(seed).standard_normal((buckets, dimensions))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(definition)
        size = np.iinfo(words.dtype).max + 1
        # Multiplicative hashing of ids to buckets.
        bucket = (np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)
        bucket = bucket.astype(np.int64)
        end = np.array([end_id], words.dtype)
        for batch in batches:
            ids = [words.ids(text) for text in batch.column("text").to_pylist()]
            vectors = np.array([np.bincount(bucket[x], minlength=buckets) for x in ids], dtype=float)
            vectors = vectors.reshape(len(ids), buckets)
            lengths = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
            places = (vectors / np.maximum(lengths, 1.0)) @ turn
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) + 1 for x in ids], pa.int64()),
                    pa.array([np.append(x, end).tobytes() for x in ids], pa.binary()),
                    *[pa.array(places[:, i]) for i in range(dimensions)],
                ],
                names=["doc_id", "doc_tokens", "ids", *[f"place_{i}" for i in range(dimensions)]],
            )
        # The worker stays for other work; it keeps the parts, which cost most.
        words.clear()

    return encode


def hilbert_key(coordinates: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of ``coordinates``, integers below ``2 ** bits``.

    The coordinates are turned, from the highest bit to the lowest, into the curve's own frame: where a bit is set, the
    lower bits of the first axis are inverted, elsewhere they are exchanged with those of the axis. Gray-coding the axes
    and reading their bits in turn gives the key.
    """
    axes = coordinates.astype(np.int64).copy()
    n = axes.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for axis in range(n):
            on = (axes[:, axis] & bit) != 0
            swap = np.where(on, 0, (axes[:, 0] ^ axes[:, axis]) & low)
            axes[:, 0] ^= np.where(on, low, swap)
            axes[:, axis] ^= swap
    for axis in range(1, n):
        axes[:, axis] ^= axes[:, axis - 1]
    flip = np.zeros(len(axes), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(axes[:, n - 1] & (1 << level), (1 << level) - 1, 0)
    axes ^= flip[:, None]
    key = np.zeros(len(axes), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            key = (key << 1) | ((axes[:, axis] >> level) & 1)
    return key


def curve_key(places: list[Column], bits: int) -> Column:
    """Coordinates between 0 and 1 to keys."""

    @F.pandas_udf("long")
    def key(*columns: pd.Series) -> pd.Series:
        grid = np.stack([column.to_numpy() for column in columns], axis=1)
        return pd.Series(hilbert_key(np.clip(grid * (1 << bits), 0, (1 << bits) - 1), bits))

    return key(*places)


class Sequences:
    """Lays documents end to end. A full sequence has ``length`` ids; what is left over goes into sequences whose lengths
    are powers of two, which need no padding."""

    def __init__(self, length: int, first: int):
        self.length, self.number, self.filled = length, first, 0
        self.open: list[tuple] = []

    def add(self, document: object, ids: np.ndarray) -> Iterator[tuple]:
        """The pieces that are final: (document, start, length, crc, document's ids, sequence, offset)."""
        start = 0
        while start < len(ids):
            taken = min(len(ids) - start, self.length - self.filled)
            self.open.append((document, start, ids[start : start + taken], len(ids)))
            self.filled += taken
            start += taken
            if self.filled == self.length:
                yield from self.close(self.length)

    def close(self, length: int) -> Iterator[tuple]:
        """End a sequence of the first ``length`` open ids."""
        offset = 0
        while offset < length:
            document, start, ids, total = self.open[0]
            taken = min(len(ids), length - offset)
            crc = zlib.crc32(ids[:taken].astype("<u4").tobytes())
            yield document, start, taken, crc, total, self.number, offset
            offset += taken
            if taken == len(ids):
                self.open.pop(0)
            else:
                self.open[0] = (document, start + taken, ids[taken:], total)
        self.number += 1
        self.filled -= length

    def finish(self) -> Iterator[tuple]:
        while self.filled:
            yield from self.close(1 << (self.filled.bit_length() - 1))


PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def packer(length: int, dtype: str) -> Callable:
    """For mapInArrow over range-sorted documents: each task packs its stretch of the curve."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = Sequences(length, TaskContext.get().partitionId() << 32)

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            columns = zip(*pieces, strict=True) if pieces else [[]] * len(PIECES)
            arrays = [pa.array(list(c), f.type) for c, f in zip(columns, PIECES, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=PIECES)

        for batch in batches:
            pieces: list[tuple] = []
            for document, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                pieces.extend(sequences.add(document, np.frombuffer(ids.as_buffer(), dtype)))
            yield rows(pieces)
        yield rows(list(sequences.finish()))

    return pack


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    length: int = 2048,
    end_id: int = 1,
    dimensions: int = 4,
    bits: int = 12,
    buckets: int = 64,
    seed: int = 5,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per piece of a document: where it lies in which sequence, and the checksum of its ids.

    ``tokenizer`` is the definition's text. A document is its ids followed by ``end_id``; documents are cut freely. Only
    the last sequences of a stretch of the curve are shorter than ``length``, and these are powers of two, so nothing is
    padded. The ids are stored once; documents then move once, to their place on the curve. Documents with one key, such
    as copies, are told apart by id, so they spread over stretches too. The pieces, small beside the documents, are
    rebalanced by sequence, so that Spark's advisory size and not the number of stretches says how many files hold them.

    A NULL or empty text is ``end_id`` alone. Rows with a repeated id are separate documents; a NULL id is kept. An empty
    table gives no rows; further columns are ignored.
    """
    spark = documents.sparkSession
    places = [f"place_{i}" for i in range(dimensions)]
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    schema = "doc_id long, doc_tokens long, ids binary, " + ", ".join(f"{place} double" for place in places)
    encoded = stored(
        rows.mapInArrow(encoder(tokenizer, end_id, dimensions, buckets, seed), schema), "token-ids"
    )
    # The spread of the projections over all documents sets the grid.
    spread = encoded.agg(
        *[F.avg(place).alias(f"{place}_mean") for place in places],
        *[F.stddev_pop(place).alias(f"{place}_spread") for place in places],
    ).first()

    def on_grid(place: str) -> Column:
        mean, width = spread[f"{place}_mean"] or 0.0, spread[f"{place}_spread"] or 0.0
        # Near a normal distribution's ranks, so that the cells hold similar numbers of documents.
        return 1 / (1 + F.exp(-1.7 * (F.col(place) - mean) / (width or 1.0)))

    keyed = encoded.select("doc_id", "ids", curve_key([on_grid(place) for place in places], bits).alias("curve"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    along = keyed.repartitionByRange(parts, "curve", "doc_id").sortWithinPartitions("curve", "doc_id")
    from tokenizers import Tokenizer

    small = Tokenizer.from_str(tokenizer).get_vocab_size() <= 1 << 16
    ddl = ", ".join(f"`{field.name}` long" for field in PIECES)
    pieces = along.select("doc_id", "ids").mapInArrow(packer(length, "<u2" if small else "<u4"), ddl)
    # Tasks number their sequences by their own place. A caller's coalesce would give several one place but for this.
    return pieces.hint("rebalance", "sequence_id")
