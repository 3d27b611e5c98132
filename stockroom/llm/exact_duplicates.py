"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Rows are cut into blocks. A block sends the sorted, distinct fingerprints of its texts to their owners, which each hold a
range of all fingerprints, as Golomb codes of the gaps; an owner answers every block with a bitmap of the fingerprints that
other blocks have sent, too. Only rows whose fingerprint is marked, or repeats within its block, are suspects. Their texts
are shuffled, one for each block and digest, and compared byte by byte.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.golomb import decode_sorted, encode_sorted
from stockroom.llm.registry import discard, stored
from stockroom.session import fresh_dir

#: The characters that do not count when texts are compared.
IGNORED = b"\x20\x09\x0a\x0b\x0c\x0d"
ROWS = "block long, place int, doc_id long, n_chars long, digest binary, fingerprint long, bare binary"
MESSAGES = "block long, owner int, n int, coded binary"
ANSWERS = "block long, owner int, n int, marks binary"
FLAGS = "block long, flags binary"


def row_maker(bits: int, block_rows: int) -> Callable:
    """For mapInArrow: numbers the rows by block and place, and adds digest, fingerprint and bare text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, place = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            if place >= block_rows:
                block, place = block + 1, 0
            bare = [text.translate(None, IGNORED) for text in batch.column("text").cast(pa.binary()).to_pylist()]
            digests = [hashlib.sha256(text).digest() for text in bare]
            whole = np.frombuffer(b"".join([digest[:8] for digest in digests]), ">u8")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(batch.num_rows, block, np.int64)),
                    pa.array(np.arange(place, place + batch.num_rows, dtype=np.int32)),
                    batch.column("doc_id"),
                    batch.column("n_chars"),
                    pa.array(digests, pa.binary()),
                    pa.array((whole >> np.uint64(64 - bits)).astype(np.int64)),
                    pa.array(bare, pa.binary()),
                ],
                names=["block", "place", "doc_id", "n_chars", "digest", "fingerprint", "bare"],
            )
            place += batch.num_rows

    return make


def range_starts(bits: int, owners: int) -> np.ndarray:
    """Where each owner's range of fingerprints begins; one more: the end of the last."""
    return np.array([-((-at << bits) // owners) for at in range(owners + 1)], np.uint64)


def message_writer(bits: int, owners: int) -> Callable:
    """For a group of a block's rows: its distinct fingerprints, sorted, a coded message to each owner."""

    def write(rows: pa.Table) -> pa.Table:
        own = np.unique(rows.column("fingerprint").to_numpy()).astype(np.uint64)
        starts = range_starts(bits, owners)
        edges = np.searchsorted(own, starts)
        to = np.flatnonzero(np.diff(edges))
        coded = [
            encode_sorted(own[edges[at] : edges[at + 1]] - starts[at], int(starts[at + 1] - starts[at])) for at in to
        ]
        block = rows.column("block")[0].as_py()
        return pa.table(
            {
                "block": pa.array(np.full(len(to), block, np.int64)),
                "owner": pa.array(to.astype(np.int32)),
                "n": pa.array(np.diff(edges)[to].astype(np.int32)),
                "coded": pa.array(coded, pa.binary()),
            }
        )

    return write


def owner(bits: int, owners: int) -> Callable:
    """For a group of the messages to one owner: a bitmap for each, of the fingerprints that several blocks have."""

    def answer(messages: pa.Table) -> pa.Table:
        at = messages.column("owner")[0].as_py()
        starts = range_starts(bits, owners)
        span = int(starts[at + 1] - starts[at])
        counts = messages.column("n").to_numpy()
        values = np.concatenate(
            [
                decode_sorted(coded.as_py(), count, span)
                for coded, count in zip(messages.column("coded"), counts.tolist(), strict=True)
            ]
        )
        order = np.argsort(values, kind="stable")
        again = values[order][1:] == values[order][:-1]
        shared = np.zeros(len(values), bool)
        shared[order[1:]] |= again
        shared[order[:-1]] |= again
        ends = np.cumsum(counts)
        marks = [np.packbits(shared[end - n : end]).tobytes() for end, n in zip(ends.tolist(), counts.tolist())]
        return messages.select(["block", "owner", "n"]).append_column("marks", pa.array(marks, pa.binary()))

    return answer


def flag_setter() -> Callable:
    """For a cogroup of a block's rows and the answers it got: one bit for each place, set for suspects."""

    def flag(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "flags": pa.array([], pa.binary())})
        _, inverse, times = np.unique(rows.column("fingerprint").to_numpy(), return_inverse=True, return_counts=True)
        answers = answers.sort_by("owner")
        marks = [
            np.unpackbits(np.frombuffer(bits.as_py(), np.uint8), count=n)
            for bits, n in zip(answers.column("marks"), answers.column("n").to_pylist(), strict=True)
        ]
        suspect = np.concatenate(marks).astype(bool) | (times > 1)
        flags = np.zeros(rows.num_rows, np.uint8)
        flags[rows.column("place").to_numpy()] = suspect[inverse]
        return pa.table(
            {
                "block": pa.array(rows.column("block")[:1].to_pylist(), pa.int64()),
                "flags": pa.array([np.packbits(flags).tobytes()], pa.binary()),
            }
        )

    return flag


def bit_at(flags: Column, place: Column) -> Column:
    """Whether the bit of a place is set."""
    byte = F.conv(F.hex(F.substring(flags, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), 7 - place % 8).cast("int")) != 0


def exact_duplicates(
    documents: DataFrame,
    bits: int = 44,
    owners: int | None = None,
    block_rows: int = 65_536,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``; documents are equal if their texts are the
    same but for ASCII white space. Of equal ones the text with the most code points stays, then the smallest id.

    Fingerprints have ``bits`` bits; ``owners`` share them out, as many as there are shuffle partitions unless given. A block
    has about ``block_rows`` rows. A block sends a fingerprint once however often it has it, and a text once, so a text that
    a third of all rows have is one fingerprint, one text and one answer for each block.

    A NULL text counts as empty; empty texts and those of white space alone equal each other. A row without an id stays only
    if no equal row of its length has one. Of rows that repeat id and length, too, exactly one stays. An empty table gives no
    rows; further columns are ignored. A text of any length is hashed and compared whole, and has to fit into a task's memory.
    Should two texts ever share a SHA-256, the job fails.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    owners = owners or parts
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    source = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.length(text).cast("long").alias("n_chars"), text.alias("text")
    )
    # Bucketed by block, so that no text moves before it is a suspect.
    name, path = f"equal_texts_{uuid.uuid4().hex[:12]}", fresh_dir(spark, "equal-texts")
    made = source.mapInArrow(row_maker(bits, block_rows), ROWS)
    made.write.bucketBy(parts, "block").option("path", path).saveAsTable(name)
    rows = spark.table(name)
    prints = rows.select("block", "place", "fingerprint")
    messages = prints.groupBy("block").applyInArrow(message_writer(bits, owners), MESSAGES)
    answers = messages.groupBy("owner").applyInArrow(owner(bits, owners), ANSWERS)
    flags = prints.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(flag_setter(), FLAGS)
    suspects = rows.join(flags.hint("shuffle_hash"), "block").where(bit_at(F.col("flags"), F.col("place")))
    # The greatest one stays; the complement turns the order of ids, and NULL comes last.
    turned = [F.bitwise_not(name).alias(name) for name in ("doc_id", "block", "place")]
    best = F.struct("n_chars", *turned)
    in_block = stored(
        suspects.groupBy("block", "digest").agg(
            F.count("*").alias("n"),
            F.max(best).alias("best"),
            F.min("bare").alias("least"),
            F.max("bare").alias("most"),
        ),
        "suspects",
    )
    groups = in_block.groupBy("digest").agg(
        F.sum("n").alias("n"),
        F.max("best").alias("best"),
        (F.min("least") == F.max("most")).alias("same"),
    )
    checked = F.when(F.col("same"), F.col("n")).otherwise(F.raise_error(F.lit("two texts share a digest")))
    found = stored(
        in_block.select("block", "digest").join(groups.select("digest", checked.alias("n"), "best"), "digest"),
        "equal-groups",
    )
    numbered = stored(rows.drop("bare", "fingerprint"), "numbered-rows")
    spark.sql(f"DROP TABLE {name}")
    discard(spark, path)
    stays = (F.col("best.block") == F.bitwise_not("block")) & (F.col("best.place") == F.bitwise_not("place"))
    return numbered.join(found, ["block", "digest"], "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.bitwise_not("best.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(stays, F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_duplicates_sql() -> str:
    """SQL that gives the same rows from the table ``documents``, if ids are unique."""
    return r"""
with bare as (
  select doc_id, length(coalesce(text, '')) as n_chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents
)
select doc_id,
  first_value(doc_id) over (partition by text_sha256 order by n_chars desc, doc_id) as keep_id,
  count(*) over (partition by text_sha256) as group_size,
  doc_id = first_value(doc_id) over (partition by text_sha256 order by n_chars desc, doc_id) as kept,
  text_sha256
from bare
"""
