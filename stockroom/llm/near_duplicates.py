"""Near-duplicates: MinHash bands propose, signatures sift, full shingle sets decide, components group.

Documents with the same shingle set are one from the start. Within a band's bucket every member is compared with one member,
the hub, which connects most of a group: pairs whose signatures agree in far fewer minima than linked ones would (five
standard deviations, about one linked pair in a million) go before whole sets are compared. Buckets of three and more that
then still hold several components are compared in blocks by whole sets, each member outside the largest component with all
others, whatever their signatures say.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.components import connected_components
from stockroom.llm.registry import in_fewer_files, stored
from stockroom.llm.shingles import mixed, shingle_sets

SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"


def minima(values: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The minimum over ``values`` of each universal hash ``(factor * value + term) >> 32``."""
    lowest = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(values), 2048):
        part = values[start : start + 2048] >> np.uint64(32)
        np.minimum(lowest, (part[:, None] * factors + terms).min(axis=0), out=lowest)
    return (lowest >> np.uint64(32)).astype(np.uint32)


def signer(shingle: int, bands: int, rows: int, seed: int) -> Callable:
    """For mapInArrow: set size, digest of the set, band keys and signature of each text."""
    draw = np.random.default_rng(seed)
    factors = draw.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    terms = draw.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = mixed(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            sets = shingle_sets(batch.column("text"), shingle)
            keys, signatures, digests = [], [], []
            for found in sets:
                if not len(found):
                    keys.append(None), signatures.append(None), digests.append(None)
                    continue
                lowest = minima(found, factors, terms)
                key = salts.copy()
                for column in lowest.reshape(bands, rows).T:
                    key = mixed(key + column.astype(np.uint64))
                keys.append(key.view(np.int64))
                signatures.append(lowest.astype(np.uint16).tobytes())
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(found) for found in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest", "bands", "signature"],
            )

    return sign


def set_maker(shingle: int) -> Callable:
    """For mapInArrow: the digest and the whole set of each text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text"), shingle)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets], pa.binary()),
                    pa.array([x.tobytes() for x in sets], pa.binary()),
                ],
                names=["doc_id", "digest", "shingles"],
            )

    return make


def sifter(least_equal: int) -> Callable:
    """For mapInArrow over pairs with signatures: those that agree in at least so many minima."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, other = (
                np.array([np.frombuffer(x.as_buffer(), np.uint16) for x in batch.column(name)])
                for name in ("signature_a", "signature_b")
            )
            keep = pa.array((one == other).sum(axis=1) >= least_equal)
            yield batch.select(["a", "b"]).filter(keep)

    return sift


def is_near(shared: np.ndarray, one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (one + other - shared)


def confirmer(percent: int) -> Callable:
    """For mapInArrow over pairs with whole sets: the linked ones."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True):
                one, other = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                shared = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(bool(is_near(shared, len(one), len(other), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


class Joined(dict):
    """Which components of a block are one by the links found so far."""

    def root(self, component: int) -> int:
        while (above := self.get(component, component)) != component:
            self[component] = component = self.get(above, above)
        return component

    def join(self, one: int, other: int) -> bool:
        """Whether they were not one before."""
        one, other = self.root(one), self.root(other)
        if one != other:
            self[max(one, other)] = min(one, other)
        return one != other


def block_linker(percent: int) -> Callable:
    """For a cogroup of two blocks of one bucket: links between members of different components, by a product of their
    membership matrices. Of the links found only those are returned that join components not yet joined by the others, so
    they are fewer than the members."""

    def link(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return none
        one = [np.frombuffer(x.as_buffer(), np.uint64) for x in left.column("shingles")]
        known = np.unique(np.concatenate(one))
        sizes = np.array([len(x) for x in one])
        nodes, groups = (left.column(name).to_numpy() for name in ("node", "component"))
        # A slice of the known shingles at a time bounds the matrices.
        members = [np.searchsorted(known, x) for x in one]
        us, vs = [], []
        joined = Joined()
        for start in range(0, right.num_rows, 512):
            part = right.slice(start, 512)
            others, other_groups = (part.column(name).to_numpy() for name in ("node", "component"))
            other_sizes, shared = [], np.zeros((len(one), part.num_rows), np.float32)
            found = []
            for x in part.column("shingles"):
                values = np.frombuffer(x.as_buffer(), np.uint64)
                other_sizes.append(len(values))
                at = np.searchsorted(known, values)
                at[at == len(known)] = 0
                found.append(at[known[at] == values])
            for low in range(0, len(known), 8192):
                width = min(8192, len(known) - low)
                a, b = np.zeros((len(one), width), np.float32), np.zeros((part.num_rows, width), np.float32)
                for row, places in enumerate(members):
                    a[row, places[np.searchsorted(places, low) : np.searchsorted(places, low + width)] - low] = 1
                for row, places in enumerate(found):
                    b[row, places[np.searchsorted(places, low) : np.searchsorted(places, low + width)] - low] = 1
                shared += a @ b.T
            near = is_near(shared, sizes[:, None], np.array(other_sizes)[None, :], percent)
            near &= groups[:, None] != other_groups[None, :]
            at, to = np.nonzero(near)
            # Members of one component are linked already, so one link between two components says as much as many.
            pairs = np.stack([groups[at], other_groups[to]])
            _, first = np.unique(pairs, axis=1, return_index=True) if len(at) else (None, [])
            for i, j in zip(at[first].tolist(), to[first].tolist(), strict=True):
                if joined.join(groups[i], other_groups[j]):
                    us.append(nodes[i]), vs.append(others[j])
        if not us:
            return none
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return link


def near_duplicates(
    documents: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = 30,
    rows: int = 4,
    seed: int = 3,
    block: int = 1 << 18,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document ``n_shingles``, ``component_id`` and ``kept``: the smallest id of a group of linked documents.

    Documents are linked if their sets of ``shingle`` consecutive words (of fewer words, all of them as one) have a Jaccard
    similarity of at least ``percent`` / 100. Words are runs of anything but ASCII white space, with A-Z in lower case.
    ``bands * rows`` universal hashes are used: bands of 4 miss a pair at exactly 80 percent with a chance of 1e-7.

    A NULL or empty text, or one of white space, has an empty set and is linked with nothing. Rows that repeat an id are
    one node. A row without an id is linked with nothing and kept. An empty table gives no rows; further columns are
    ignored. Ids must be integers.
    """
    source = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    signed = stored(source.mapInArrow(signer(shingle, bands, rows, seed), SIGNED), "signatures")
    # One representative of each set, with its bands and signature, which all its copies share.
    alike = signed.where("digest is not null and doc_id is not null")
    chosen = alike.groupBy("digest").agg(
        F.min("doc_id").alias("node"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"),
        F.first("signature").alias("signature"),
    )
    chosen = stored(in_fewer_files(chosen, 8), "representatives")
    members = stored(_bucket_members(chosen), "bucket-members", gathered=True)
    links, sets = _star_links(members, chosen, source, shingle, percent, bands * rows)
    components = connected_components(links)
    more = _block_links(members, components, chosen.select("node", "n_shingles"), sets, percent, block)
    components = connected_components(links.unionByName(more))
    groups = (
        chosen.select("digest", "node")
        .join(components, "node", "left")
        .select("digest", F.coalesce("component", "node").alias("component"))
    )
    return (
        signed.select("doc_id", "n_shingles", "digest")
        .join(groups, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _bucket_members(chosen: DataFrame) -> DataFrame:
    """Bucket, node and hub, of buckets with several nodes that differ from other buckets in their members."""
    entries = chosen.select("node", F.explode("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.min_by("node", F.xxhash64("node", "bucket")).alias("hub"),
        F.bit_xor(F.xxhash64("node")).alias("same"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("members"),
    )
    several = buckets.where("n > 1")
    # Bands often bring the same nodes together; large groups keep a few of such buckets, and their different hubs.
    one = several.groupBy("n", "same", "members").agg(F.min(F.struct("bucket", "hub")).alias("bucket"))
    return entries.join(one.select("bucket.bucket", "bucket.hub", "n"), "bucket").select("bucket", "node", "hub", "n")


def _star_links(
    members: DataFrame, chosen: DataFrame, source: DataFrame, shingle: int, percent: int, hashes: int
) -> tuple[DataFrame, DataFrame]:
    """Links between hubs and members, and the whole sets of all members of buckets."""
    pairs = (
        members.where("node <> hub")
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        .distinct()
    )
    known = chosen.select("node", "n_shingles", "signature")
    sized = (
        pairs.join(known.toDF("a", "n_a", "signature_a"), "a")
        .join(known.toDF("b", "n_b", "signature_b"), "b")
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    )
    share = percent / 100
    # Five standard deviations below what a linked pair agrees in.
    least_equal = int(hashes * (share - 5 * (share * (1 - share) / hashes) ** 0.5))
    likely = stored(
        sized.select("a", "b", "signature_a", "signature_b").mapInArrow(sifter(least_equal), "a long, b long"),
        "likely",
        few=True,
    )
    wanted = members.select("node").distinct().join(chosen.select("node", "digest"), "node")
    texts = source.join(wanted.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = (
        texts.mapInArrow(set_maker(shingle), "doc_id long, digest binary, shingles binary")
        .join(wanted, "digest")
        .where("doc_id = node")
        .dropDuplicates(["node", "digest"])
        .select("node", "shingles")
    )
    sets = stored(in_fewer_files(sets, 4), "shingle-sets")
    linked = (
        likely.join(sets.toDF("a", "shingles_a"), "a")
        .join(sets.toDF("b", "shingles_b"), "b")
        .select("a", "b", "shingles_a", "shingles_b")
        .mapInArrow(confirmer(percent), "a long, b long")
    )
    return stored(linked.select(F.col("a").alias("u"), F.col("b").alias("v")), "star-links", gathered=True), sets


def _block_links(
    members: DataFrame, components: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int, block: int
) -> DataFrame:
    """Links that hubs did not find: in buckets of three or more, of every member outside the largest component.

    Blocks are cut by what they hold, about ``block`` shingles on the left and four times as many on the right, and a member
    counts for 2,048 at least, as the matrices have a row for it. So tasks need the same memory for long texts and short ones.
    """
    placed = stored(
        members.where("n > 2")
        .select("bucket", "node")
        .join(components, "node", "left")
        .join(sizes, "node")
        .select(
            "bucket",
            "node",
            F.coalesce("component", "node").alias("component"),
            F.greatest("n_shingles", F.lit(2048)).alias("weight"),
        ),
        "placed-members",
        few=True,
    )
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"), F.sum("weight").alias("weight"))
    open_ = (
        parts.groupBy("bucket")
        .agg(
            F.count("*").alias("components"),
            F.sum("weight").alias("weight"),
            F.max(F.struct("size", "component", "weight")).alias("largest"),
        )
        .where("components > 1")
        .select(
            "bucket",
            F.col("largest.component").alias("largest"),
            F.ceil((F.col("weight") - F.col("largest.weight")) / block).cast("int").alias("left_blocks"),
            F.ceil(F.col("weight") / (4 * block)).cast("int").alias("right_blocks"),
        )
    )
    rows = stored(
        placed.join(stored(open_, "open-buckets", few=True), "bucket")
        .join(sets, "node")
        .withColumn("outside", F.col("component") != F.col("largest"))
        .select("bucket", "node", "component", "outside", "left_blocks", "right_blocks", "shingles"),
        "open-members",
    )
    own = F.xxhash64("node", "bucket")
    left = rows.where("outside").select(
        "bucket",
        "node",
        "component",
        "shingles",
        F.pmod(own, F.col("left_blocks")).cast("int").alias("left_block"),
        F.explode(F.sequence(F.lit(0), F.col("right_blocks") - 1)).alias("right_block"),
    )
    right = rows.select(
        "bucket",
        "node",
        "component",
        "shingles",
        F.explode(F.sequence(F.lit(0), F.col("left_blocks") - 1)).alias("left_block"),
        F.pmod(own, F.col("right_blocks")).cast("int").alias("right_block"),
    )
    key = ["bucket", "left_block", "right_block"]
    # Not stored: the components write their links themselves.
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(block_linker(percent), "u long, v long")


def near_duplicates_sql(shingle: int, percent: int) -> str:
    """SQL that gives the same rows from the table ``documents``, if ids are unique. It lists all pairs that share a
    shingle, so it is for small tables."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') as w
  from documents
),
shingles as (
  select distinct doc_id, said from (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < {shingle} then [array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - {shingle} + 2), lambda i: array_to_string(w[i:i + {shingle - 1}], ' ')) end)
      as said
    from words)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as one, b.doc_id as other, count(*) as shared
  from shingles a join shingles b on a.said = b.said and a.doc_id < b.doc_id group by all
),
links as (
  select one, other from pairs join sizes x on x.doc_id = one join sizes y on y.doc_id = other
  where 100 * shared >= {percent} * (x.n + y.n - shared)
),
both_ways as (select one, other from links union all select other, one from links),
reached as (
  select doc_id, doc_id as reach from documents
  union
  select r.doc_id, b.other from reached r join both_ways b on b.one = r.reach
),
components as (select doc_id, min(reach) as component_id from reached group by doc_id)
select d.doc_id, coalesce(s.n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d join components c using (doc_id) left join sizes s using (doc_id)
"""
