"""Nearest neighbours by a hash-prefix forest (LSH forest).

Every tree gives each vector a long string of hash bits; sorted, the strings are the tree. A query descends in all trees to
its longest matching prefix and ascends in all of them together, one bit at a time, until it has met enough vectors. Only
these are compared exactly. Trees are dealt out by their upper branches, and large branches in blocks, so no task holds
more than a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.registry import stored

#: Bits of a string.
BITS = 32


def hash_bits(vectors: np.ndarray, planes: np.ndarray, trees: int) -> np.ndarray:
    """One number per vector and tree, whose binary digits say on which side of the tree's planes the vector lies."""
    signs = (vectors @ planes > 0).reshape(len(vectors), trees, BITS)
    return signs.astype(np.int64) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """With one more component all vectors get the same length, so the largest inner product has the smallest angle."""
    short = vectors / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (short**2).sum(axis=1)))
    return np.concatenate([short, rest[:, None]], axis=1)


def common_prefix(codes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many leading bits two strings share."""
    differ = (codes ^ others).astype(np.uint64)
    return np.where(differ == 0, BITS, BITS - 1 - np.floor(np.log2(np.maximum(differ, 1))).astype(np.int64))


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_buffer(), kind) for x in column]).astype(float)


def hasher(planes: np.ndarray, trees: int, longest: float, kind: str) -> Callable:
    """For mapInArrow: the strings of each vector as a row, and as a query, which has no further component."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"), kind)
            as_query = np.concatenate([vectors, np.zeros((len(vectors), 1))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("vector"),
                    batch.column("asked"),
                    pa.array(list(hash_bits(lifted(vectors, longest), planes, trees)), pa.list_(pa.int64())),
                    pa.array(list(hash_bits(as_query, planes, trees)), pa.list_(pa.int64())),
                ],
                names=["vec_id", "vector", "asked", "codes", "query_codes"],
            )

    return hashed


def best(ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and inner products of the ``count`` nearest; ties go to the smaller id."""
    rough = vectors @ query
    if len(rough) > count:
        limit = np.partition(rough, len(rough) - count)[len(rough) - count]
        chosen = np.flatnonzero(rough >= limit - 1e-9 * (1 + abs(limit)))
    else:
        chosen = np.arange(len(rough))
    # Summed in one order whatever stands beside a row, so that equal vectors have equal products.
    exact = (vectors[chosen] * query).sum(axis=1)
    order = np.lexsort((ids[chosen], -exact))[:count]
    return ids[chosen][order], exact[order]


def observer(sample: list[tuple[int, bytes, list[int]]], trees: int, count: int, kind: str) -> Callable:
    """For mapInArrow over all rows: for each sampled query, how many rows share prefixes of each length in each tree, and
    its nearest rows with the prefixes that they share with it."""
    own = [(i, np.frombuffer(vector, kind).astype(float), np.array(codes)) for i, vector, codes in sample]

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros((len(own), trees, BITS + 1), np.int64)
        nearest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
            (np.empty(0, np.int64), np.empty(0), np.empty((0, trees), np.int64)) for _ in own
        ]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("vec_id").to_numpy()
            vectors = _matrix(batch.column("vector"), kind)
            codes = batch.column("codes").flatten().to_numpy().reshape(len(ids), trees)
            for at, (query, vector, query_codes) in enumerate(own):
                shared = common_prefix(codes, query_codes)
                for tree in range(trees):
                    met[at, tree] += np.bincount(shared[:, tree], minlength=BITS + 1)
                other = ids != query
                scores = np.concatenate([nearest[at][1], (vectors[other] * vector).sum(axis=1)])
                all_ids = np.concatenate([nearest[at][0], ids[other]])
                all_shared = np.concatenate([nearest[at][2], shared[other]])
                order = np.lexsort((all_ids, -scores))[:count]
                nearest[at] = all_ids[order], scores[order], all_shared[order]
        rows = [
            (at, met[at].ravel().tolist(), near[0].tolist(), near[1].tolist(), near[2].ravel().tolist())
            for at, near in enumerate(nearest)
        ]
        names = ["query", "met", "ids", "scores", "shared"]
        kinds = [pa.int64(), *[pa.list_(x) for x in (pa.int64(), pa.int64(), pa.float64(), pa.int64())]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
        )

    return observe


def stop_depths(counts: np.ndarray, wanted: int) -> tuple[np.ndarray, bool]:
    """Per tree the prefix length at which the ascent ends, given how many rows share at least each length.

    All trees go up together, one bit at a time and tree after tree, until ``wanted`` rows have been met, repeated ones
    counted again. Returns whether as many were met within the lengths that ``counts`` has.
    """
    total = counts.sum(axis=0)
    enough = np.flatnonzero(total >= wanted)
    if not len(enough):
        return np.zeros(len(counts), np.int64), False
    depth = enough[-1]
    depths = np.full(len(counts), depth, np.int64)
    if depth + 1 < counts.shape[1]:
        short = wanted - total[depth + 1]
        gained = np.cumsum(counts[:, depth] - counts[:, depth + 1])
        depths[np.arange(len(counts)) > np.searchsorted(gained, short)] = depth + 1
    return depths, True


def needed_rows(met: np.ndarray, shared: list[np.ndarray], recall: float) -> int:
    """The fewest rows that queries must meet for the sampled ones to find ``recall`` of their nearest ones on average."""
    at_least = met[:, :, ::-1].cumsum(axis=2)[:, :, ::-1]
    low, high = 1, int(at_least[:, :, 0].sum(axis=1).max())
    while low < high:
        middle = (low + high) // 2
        found = []
        for counts, near in zip(at_least, shared, strict=True):
            depths, _ = stop_depths(counts, middle)
            if len(near):
                found.append((near >= depths).any(axis=1).mean())
        low, high = (low, middle) if not found or np.mean(found) >= recall else (middle + 1, high)
    return low


def meeter(top: int) -> Callable:
    """For a cogroup of a branch's block and its queries: how many rows share at least each prefix length."""

    def meet(rows: pa.Table, queries: pa.Table) -> pa.Table:
        codes = np.sort(rows.column("code").to_numpy())
        asked = queries.column("code").to_numpy()
        lengths = BITS - np.arange(top, BITS + 1)
        low = (asked[:, None] >> lengths) << lengths
        counts = np.searchsorted(codes, low + (1 << lengths)) - np.searchsorted(codes, low)
        return pa.table(
            {
                "query_id": queries.column("query_id"),
                "tree": queries.column("tree"),
                "counts": pa.array(list(counts), pa.list_(pa.int64())),
            }
        )

    return meet


def ascender(trees: int, top: int, wanted: int) -> Callable:
    """For mapInArrow over queries with their counts: where the ascent ends in each tree."""

    def ascend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, reached = [], []
            for entries in batch.column("met"):
                counts = np.zeros((trees, BITS + 1 - top), np.int64)
                for entry in entries.as_py():
                    counts[entry["tree"]] += entry["counts"]
                depths, enough = stop_depths(counts, wanted)
                ends.append(depths + top), reached.append(enough)
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id"), pa.array(ends, pa.list_(pa.int32())), pa.array(reached, pa.bool_())],
                names=["query_id", "depths", "reached"],
            )

    return ascend


def comparer(count: int, kind: str) -> Callable:
    """For a cogroup of a branch's block and its queries: the nearest of the rows that each query meets there."""

    def compare(rows: pa.Table, queries: pa.Table) -> pa.Table:
        asked, ids_of, scores_of = [], [], []
        if rows.num_rows and queries.num_rows:
            codes = rows.column("code").to_numpy()
            order = np.argsort(codes, kind="stable")
            codes, ids = codes[order], rows.column("vec_id").to_numpy()[order]
            vectors = _matrix(rows.column("vector").combine_chunks(), kind)[order]
            for query, vector, code, depth in zip(
                queries.column("query_id").to_pylist(),
                queries.column("query_vector").to_pylist(),
                queries.column("code").to_pylist(),
                queries.column("depth").to_pylist(),
                strict=True,
            ):
                low = (code >> (BITS - depth)) << (BITS - depth)
                first, last = np.searchsorted(codes, [low, low + (1 << (BITS - depth))])
                other = ids[first:last] != query
                found, scores = best(
                    ids[first:last][other], vectors[first:last][other], np.frombuffer(vector, kind).astype(float), count
                )
                asked.append(query), ids_of.append(found), scores_of.append(scores)
        return pa.table(
            {
                "query_id": pa.array(asked, pa.int64()),
                "ids": pa.array(ids_of, pa.list_(pa.int64())),
                "scores": pa.array(scores_of, pa.list_(pa.float64())),
            }
        )

    return compare


def ranker(count: int) -> Callable:
    """For a query's nearest rows of each branch's block, of which there are few: the nearest of all."""

    def rank(found: pa.Table) -> pa.Table:
        ids = found.column("ids").combine_chunks().flatten().to_numpy()
        scores = found.column("scores").combine_chunks().flatten().to_numpy()
        # Trees meet the same rows again.
        ids, first = np.unique(ids, return_index=True)
        scores = scores[first]
        order = np.lexsort((ids, -scores))[:count]
        return pa.table(
            {
                "query_id": pa.array([found.column("query_id")[0].as_py()] * len(order), pa.int64()),
                "rank": pa.array(range(1, len(order) + 1), pa.int32()),
                "vec_id": pa.array(ids[order], pa.int64()),
                "score": pa.array(scores[order], pa.float64()),
            }
        )

    return rank


def nearest_neighbours(
    vectors: DataFrame,
    is_query: F.Column,
    count: int = 20,
    trees: int = 24,
    recall: float = 0.96,
    sampled_queries: int = 128,
    block: int = 8192,
    seed: int = 9,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``count`` nearest rows found of each query.

    Nearness is the inner product in double precision, ties go to the smaller id. How many rows a query has to meet is set
    by ``sampled_queries`` of the queries (those with the smallest hash of their id): these are compared with all rows, and
    the number is the smallest with which they find ``recall`` of their true neighbours. All rows are indexed.

    Rows with a NULL id, and vectors that are NULL, zero, of another length than most, or hold NULL or non-finite
    components take no part. Rows that repeat an id and vector count once. With fewer rows than ``count`` all others are
    returned; an empty table gives no rows; further columns are ignored.
    """
    spark = vectors.sparkSession
    given = F.col(f"`{vector_column}`")
    number = given.cast("array<double>")
    kind = "<f4" if dict(vectors.dtypes)[vector_column] == "array<float>" else "<f8"
    whole = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (
        vectors.where(F.col(id_column).isNotNull() & given.isNotNull())
        .where(F.coalesce(whole & F.exists(number, lambda x: x != 0), F.lit(False)))
        .select(F.col(id_column).cast("long").alias("vec_id"), given.alias("given"), is_query.alias("asked"))
        .withColumn("square", F.aggregate(F.col("given").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x))
    )
    result = "query_id long, rank int, vec_id long, score double"
    sizes = usable.groupBy(F.size("given").alias("size")).agg(F.count("*").alias("n"), F.max("square").alias("square"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    if common is None:
        return spark.createDataFrame([], result)
    longest = float(common["square"]) ** 0.5
    planes = np.random.default_rng(seed).standard_normal((common["size"] + 1, trees * BITS))

    def to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.asarray(x.values).astype(kind).tobytes() for x in batch.column("given")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(raw, pa.binary()), batch.column("asked")],
                names=["vec_id", "vector", "asked"],
            )

    packed = (
        usable.where(F.size("given") == common["size"])
        .select("vec_id", "given", "asked")
        .mapInArrow(to_bytes, "vec_id long, vector binary, asked boolean")
        .groupBy("vec_id", "vector")
        .agg(F.max("asked").alias("asked"))
    )
    hashed = packed.mapInArrow(
        hasher(planes, trees, longest, kind),
        "vec_id long, vector binary, asked boolean, codes array<long>, query_codes array<long>",
    )
    index = stored(hashed, "forest")
    queries = (
        index.where("asked")
        .select(
            F.col("vec_id").alias("query_id"),
            F.col("vector").alias("query_vector"),
            F.col("query_codes").alias("codes"),
        )
        .dropDuplicates(["query_id"])
    )
    sample = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(sampled_queries).collect()
    if not sample:
        return spark.createDataFrame([], result)
    wanted, depth = _calibrate(index, sample, trees, count, kind, recall)
    # A row can be met once per tree, so this many are ``count`` others at least, or all there are.
    wanted = max(wanted, trees * (count + 1))

    found = None
    pending = queries
    # Branches begin a little above where the sampled ascents end; queries that need more start further up.
    top = max(0, depth - 2)
    while True:
        part, pending = _search(index, pending, trees, top, wanted, count, block, kind)
        found = part if found is None else found.unionByName(part)
        if pending is None:
            break
        top = max(0, top - 3)
    return found.groupBy("query_id").applyInArrow(ranker(count), result)


def _calibrate(index: DataFrame, sample: list, trees: int, count: int, kind: str, recall: float) -> tuple[int, int]:
    """How many rows a query has to meet, and about how long the prefixes are at which sampled ascents end."""
    asked = [(row["query_id"], bytes(row["query_vector"]), list(row["codes"])) for row in sample]
    observed = index.select("vec_id", "vector", "codes").mapInArrow(
        observer(asked, trees, count, kind),
        "query long, met array<long>, ids array<long>, scores array<double>, shared array<long>",
    )
    # One row per sampled query and task, of fixed size; counts are added up by query before they get here.
    merged = observed.groupBy("query").applyInArrow(
        _merged_observations(trees, count), "query long, met array<long>, shared array<long>"
    )
    rows = sorted(merged.collect())
    met = np.array([row["met"] for row in rows]).reshape(len(rows), trees, BITS + 1)
    shared = [np.array(row["shared"]).reshape(-1, trees) for row in rows]
    wanted = needed_rows(met, shared, recall)
    at_least = met[:, :, ::-1].cumsum(axis=2)[:, :, ::-1]
    ends = [stop_depths(counts, wanted)[0].min() for counts in at_least]
    return wanted, int(np.median(ends))


def _merged_observations(trees: int, count: int) -> Callable:
    def merge(rows: pa.Table) -> pa.Table:
        met = np.sum([np.array(x) for x in rows.column("met").to_pylist()], axis=0)
        ids = np.concatenate([np.array(x, np.int64) for x in rows.column("ids").to_pylist()])
        scores = np.concatenate([np.array(x, float) for x in rows.column("scores").to_pylist()])
        shared = np.concatenate([np.array(x, np.int64).reshape(-1, trees) for x in rows.column("shared").to_pylist()])
        order = np.lexsort((ids, -scores))[:count]
        return pa.table(
            {
                "query": rows.column("query").slice(0, 1),
                "met": pa.array([met.tolist()], pa.list_(pa.int64())),
                "shared": pa.array([shared[order].ravel().tolist()], pa.list_(pa.int64())),
            }
        )

    return merge


def _search(
    index: DataFrame,
    queries: DataFrame,
    trees: int,
    top: int,
    wanted: int,
    count: int,
    block: int,
    kind: str,
) -> tuple[DataFrame, DataFrame | None]:
    """The nearest rows of the queries that meet enough below the branches at length ``top``, and the other queries."""
    branch = F.shiftright("code", BITS - top) if top else F.lit(0).cast("long")
    rows = index.select("vec_id", "vector", F.posexplode("codes").alias("tree", "code")).withColumn("branch", branch)
    sizes = rows.groupBy("tree", "branch").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    # A row for each branch, which is little beside the rows.
    sizes = stored(sizes.coalesce(8), "branches")
    dealt = rows.join(sizes, ["tree", "branch"]).withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "tree"), F.col("blocks")).cast("int")
    )
    asked = (
        queries.select("query_id", "query_vector", F.posexplode("codes").alias("tree", "code"))
        .withColumn("branch", branch)
        .join(sizes, ["tree", "branch"])
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    key = ["tree", "branch", "block"]
    met = (
        dealt.select(*key, "code")
        .groupBy(*key)
        .cogroup(asked.select(*key, "query_id", "code").groupBy(*key))
        .applyInArrow(meeter(top), "query_id long, tree int, counts array<long>")
        .groupBy("query_id")
        .agg(F.collect_list(F.struct("tree", "counts")).alias("met"))
    )
    ends = stored(
        met.mapInArrow(ascender(trees, top, wanted), "query_id long, depths array<int>, reached boolean"), "ascents"
    )
    if top == 0:
        # At the root everything has been met, so all queries end here.
        ends = ends.withColumn("reached", F.lit(True))
    going = asked.join(ends.where("reached"), "query_id").withColumn("depth", F.get("depths", F.col("tree")))
    found = (
        dealt.select(*key, "code", "vec_id", "vector")
        .groupBy(*key)
        .cogroup(going.select(*key, "query_id", "query_vector", "code", "depth").groupBy(*key))
        .applyInArrow(comparer(count, kind), "query_id long, ids array<long>, scores array<double>")
    )
    if top == 0:
        return found, None
    # A query whose branches are empty in all trees has no row in ``ends``; it has not met enough either.
    rest = queries.join(ends.where("reached"), "query_id", "left_anti")
    return found, None if rest.isEmpty() else rest
