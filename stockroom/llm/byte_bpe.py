"""Byte-level BPE over a global shuffle of distinct words.

Texts are cut into blocks; a block lists its distinct pre-tokens and, for each of its documents, the places of their
occurrences in that list. The lists of all blocks are shuffled by word: a block's words of one hash bucket travel as one
packed row. Each distinct word is encoded once, and its ids go back to the blocks that hold it, where documents are put
together again by position. Decoding looks every id up in the table of token bytes, which has the size of the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.session import fresh_dir

#: White space as the tokenizer's own regular expressions understand it (Unicode's White_Space; fixed values).
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_SPACE = regex.compile(f"[{SPACES}]")
#: A single space between two other characters that are not white space: every pre-token ends before it.
_BETWEEN = regex.compile(f"(?<=[^{SPACES}]) (?=[^{SPACES}])")


def own_spaces(pattern: str) -> str:
    """A pre-token pattern with ``\\s`` and ``\\S`` spelt out, as engines differ in them."""
    inside = pattern.replace(r"[^\s", f"[^{SPACES}")
    return inside.replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]")


class _Irregular(Exception):
    """A part of a text that doesn't begin and end with something visible."""


class _Parts(dict):
    """What stands between two spaces, with the space before it, as places of its pre-tokens; filled as needed."""

    def __init__(self, block: Block, lead: str):
        self.block, self.lead = block, lead

    def __missing__(self, part: str) -> bytes:
        if not part or _SPACE.match(part[0]) or _SPACE.match(part[-1]):
            raise _Irregular
        found = self[part] = self.block.places(self.lead + part)
        return found


class Block:
    """Distinct words of some documents, and the documents as places in their list."""

    def __init__(self, pattern: regex.Pattern):
        self.cut = pattern.findall
        self.words: dict[str, int] = {}
        self.first, self.later = _Parts(self, ""), _Parts(self, " ")
        self.ids: list = []
        self.counts: list[int] = []
        self.documents: list[bytes] = []
        self.characters = 0

    def places(self, text: str) -> bytes:
        words = self.words
        return np.array([words.setdefault(word, len(words)) for word in self.cut(text)], "<u4").tobytes()

    def add(self, document: object, text: str) -> None:
        parts = text.split(" ")
        try:
            found = self.first[parts[0]] + b"".join(map(self.later.__getitem__, parts[1:]))
        except _Irregular:
            parts = _BETWEEN.split(text)
            found = self.places(parts[0])
            if len(parts) > 1:
                middle = b"".join(map(self.later.__getitem__, parts[1:-1]))
                found += middle + self.places(" " + parts[-1])
        self.ids.append(document)
        self.counts.append(len(found) // 4)
        self.documents.append(found)
        self.characters += len(text)

    def row(self, number: int, buckets: int) -> pa.RecordBatch:
        places = np.frombuffer(b"".join(self.documents), "<u4")
        # Frequent words first, so that the upper bytes of most places are zero.
        order = np.argsort(-np.bincount(places, minlength=len(self.words)), kind="stable")
        rank = np.empty(len(order), "<u4")
        rank[order] = np.arange(len(order), dtype="<u4")
        planes = np.ascontiguousarray(rank[places].view("u1").reshape(-1, 4).T).tobytes()
        words = [word.encode() for word in self.words]
        words = [words[i] for i in order]
        bucket = np.array([zlib.crc32(word) % buckets for word in words], "<u4")
        by_bucket = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
        lists = [
            {"bucket": at, "words": pack_words([words[i] for i in by_bucket[low:high].tolist()])}
            for at, (low, high) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
            if high > low
        ]
        kind = pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())]))
        columns = [
            pa.array([number], pa.int64()),
            pa.array([self.ids], pa.list_(pa.int64())),
            pa.array([self.counts], pa.list_(pa.int64())),
            pa.array([pa.compress(planes, "zstd", asbytes=True)], pa.binary()),
            pa.array([pa.compress(bucket.tobytes(), "zstd", asbytes=True)], pa.binary()),
            pa.array([len(words)], pa.int32()),
            pa.array([lists], kind),
        ]
        return pa.RecordBatch.from_arrays(
            columns, names=["block", "ids", "counts", "places", "buckets", "n_words", "lists"]
        )


BLOCKS = (
    "block long, ids array<long>, counts array<long>, places binary, buckets binary, n_words int, "
    "lists array<struct<bucket:int,words:binary>>"
)


def pack_words(words: list[bytes]) -> bytes:
    """Their number, lengths and bytes."""
    head = np.array([len(words), *map(len, words)], "<u4").tobytes()
    whole = head + b"".join(words)
    return len(whole).to_bytes(4, "little") + pa.compress(whole, "zstd", asbytes=True)


def unpack_words(packed: bytes) -> list[bytes]:
    whole = pa.decompress(packed[4:], int.from_bytes(packed[:4], "little"), "zstd", asbytes=True)
    count = int(np.frombuffer(whole, "<u4", 1)[0])
    ends = (4 + 4 * count + np.cumsum(np.frombuffer(whole, "<u4", count, 4))).tolist()
    return [whole[start:end] for start, end in zip([4 + 4 * count, *ends], ends, strict=False)]


def blocker(pattern: str, characters: int, buckets: int) -> Callable:
    """For mapInArrow: documents to blocks of about so many characters."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(own_spaces(pattern))
        block, number = Block(compiled), TaskContext.get().partitionId() << 32
        for batch in batches:
            for document, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                block.add(document, text.as_py())
                if block.characters >= characters:
                    yield block.row(number, buckets)
                    block, number = Block(compiled), number + 1
        if block.ids:
            yield block.row(number, buckets)

    return blocks


@lru_cache(maxsize=1)
def token_bytes(ranks: bytes) -> dict[int, bytes]:
    """The table that decoding joins: id to bytes."""
    return {int(number): base64.b64decode(token) for token, number in map(bytes.split, ranks.splitlines())}


@lru_cache(maxsize=1)
def word_encoder(ranks: bytes) -> Callable[[str], list[int]]:
    import tiktoken

    merges = {token: number for number, token in token_bytes(ranks).items()}
    # A word is one match already.
    return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=merges, special_tokens={}).encode_ordinary


#: Words whose ids a worker keeps while it goes through a bucket; beyond that it starts anew.
KEPT_WORDS = 500_000


def bucket_encoder(ranks: bytes) -> Callable:
    """For mapInArrow over lists sorted by bucket: encodes each distinct word of a bucket once, for all its blocks."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_encoder(ranks)
        known: dict[bytes, bytes] = {}
        last = None
        for batch in batches:
            packed = []
            for bucket, words in zip(batch.column("bucket").to_pylist(), batch.column("words"), strict=True):
                if bucket != last or len(known) > KEPT_WORDS:
                    last, known = bucket, {}
                found = []
                for word in unpack_words(words.as_py()):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = np.array(ids_of(word.decode()), "<u4").tobytes()
                    found.append(ids)
                packed.append(pack_words(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("bucket"), pa.array(packed, pa.binary())],
                names=["block", "bucket", "word_ids"],
            )

    return encode


def reassembler(ranks: bytes) -> Callable:
    """For mapInArrow: blocks with their words' ids to digests of documents."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(ranks)
        decimal = {number: b"%d" % number for number in table}
        for batch in batches:
            for at in range(batch.num_rows):
                size = batch.column("n_words")[at].as_py()
                encoded, decoded, lengths = [b""] * size, [b""] * size, np.zeros(size, np.int64)
                buckets = pa.decompress(batch.column("buckets")[at].as_py(), 4 * size, "zstd", asbytes=True)
                by_bucket = np.argsort(np.frombuffer(buckets, "<u4"), kind="stable")
                ordered = np.frombuffer(buckets, "<u4")[by_bucket]
                for entry in batch.column("entries")[at].as_py() or []:
                    first = np.searchsorted(ordered, entry["bucket"])
                    found = unpack_words(entry["word_ids"])
                    for place, packed_ids in zip(by_bucket[first : first + len(found)].tolist(), found, strict=True):
                        ids = np.frombuffer(packed_ids, "<u4").tolist()
                        encoded[place] = b",".join([decimal[i] for i in ids])
                        decoded[place] = b"".join([table[i] for i in ids])
                        lengths[place] = len(ids)
                counts = batch.column("counts")[at].as_py()
                packed = batch.column("places")[at].as_py()
                total = sum(counts)
                planes = np.frombuffer(pa.decompress(packed, total * 4, "zstd", asbytes=True), "u1").reshape(4, total)
                words = np.ascontiguousarray(planes.T).view("<u4").reshape(total)
                sizes, id_digests, byte_digests, start = [], [], [], 0
                for count in counts:
                    own = words[start : start + count]
                    listed_places = own.tolist()
                    start += count
                    sizes.append(int(lengths[own].sum()))
                    id_digests.append(hashlib.sha256(b",".join(map(encoded.__getitem__, listed_places))).hexdigest())
                    byte_digests.append(hashlib.sha256(b"".join(map(decoded.__getitem__, listed_places))).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[at].values,
                        pa.array(sizes, pa.int64()),
                        pa.array(id_digests),
                        pa.array(byte_digests),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return assemble


def encode_and_decode(
    documents: DataFrame,
    ranks: bytes,
    pattern: str,
    block_characters: int = 8_000_000,
    id_column: str = "doc_id",
) -> DataFrame:
    """Per document: how many ids its whole text has, and digests of the ids and of the bytes they decode to.

    ``ranks`` is the content of a rank file, ``pattern`` cuts texts into pre-tokens. Blocks are written once, bucketed by
    block, so what moves is each distinct word of a block once, and its ids back. A word that stands in every text travels once
    per block. A block's word list is no longer than its text.

    A NULL or empty text has no ids. Rows with a repeated id are separate documents; a NULL id is kept. An empty table
    gives no rows; further columns are ignored.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    name = f"token_blocks_{uuid.uuid4().hex[:12]}"
    path = fresh_dir(spark, "token-blocks")
    buckets = 4 * parts
    blocked = rows.mapInArrow(blocker(pattern, block_characters, buckets), BLOCKS)
    blocked.write.bucketBy(parts, "block").option("path", path).saveAsTable(name)
    blocks = spark.table(name)
    words = blocks.select("block", F.inline("lists"))
    encoded = (
        words.repartition(parts, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(bucket_encoder(ranks), "block long, bucket int, word_ids binary")
    )
    entries = encoded.groupBy("block").agg(F.collect_list(F.struct("bucket", "word_ids")).alias("entries"))
    # Never broadcast: the entries grow with the texts.
    whole = blocks.drop("lists").join(entries.hint("merge"), "block", "left")
    return whole.select("ids", "counts", "places", "buckets", "n_words", "entries").mapInArrow(
        reassembler(ranks), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
