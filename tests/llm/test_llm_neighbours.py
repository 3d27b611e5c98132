from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockroom.llm import neighbours
from stockroom.llm.neighbours import BITS, common_prefix, needed_rows, nearest_neighbours, stop_depths

def by_twenties():
    return F.col("vec_id") % 20 == 0



def exact(vectors, query, count=20):
    ids = np.array(sorted(vectors))
    scores = (np.stack([vectors[i] for i in ids]) * vectors[query]).sum(axis=1)
    order = [at for at in np.lexsort((ids, -scores)) if ids[at] != query][:count]
    return [(int(ids[at]), float(scores[at])) for at in order]


def check(rows, vectors, least_recall, count=20):
    found = {}
    for row in rows:
        found.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    assert set(found) == {i for i in vectors if i % 20 == 0}
    recalls = []
    for query, own in found.items():
        own.sort()
        wanted = exact(vectors, query, count)
        assert [rank for rank, *_ in own] == list(range(1, len(wanted) + 1))
        assert [(s, i) for _, i, s in own] == sorted(((s, i) for _, i, s in own), key=lambda x: (-x[0], x[1]))
        assert all(s == pytest.approx(float((vectors[i] * vectors[query]).sum()), abs=1e-12) for _, i, s in own)
        recalls.append(len({i for _, i, _ in own} & {i for i, _ in wanted}) / len(wanted))
    assert np.mean(recalls) >= least_recall


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def made(seed, count, dimensions=16):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (6, dimensions))
    return (centres[draw.integers(0, 6, count)] + draw.normal(0, 0.6, (count, dimensions))).astype(np.float32)


def test_recall_and_exact_scores(spark):
    vectors = made(1, 1500)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    found = nearest_neighbours(table(spark, rows), by_twenties()).collect()
    check(found, {i: v.astype(float) for i, v in enumerate(vectors)}, 0.9)


def test_largest_inner_product_not_smallest_angle(spark):
    vectors = made(2, 600) * np.linspace(0.1, 5, 600, dtype=np.float32)[:, None]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    found = nearest_neighbours(table(spark, rows, "double"), by_twenties()).collect()
    check(found, {i: v.astype(float) for i, v in enumerate(vectors)}, 0.9)


def test_many_copies_ties_and_blocks(spark):
    vectors = np.concatenate([made(3, 300), np.repeat(made(4, 1), 500, axis=0)])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    found = nearest_neighbours(table(spark, rows), by_twenties(), block=64).collect()
    check(found, {i: v.astype(float) for i, v in enumerate(vectors)}, 0.9)
    copies = [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 400]
    assert copies == list(range(300, 320))


def test_vectors_that_take_no_part(spark):
    odd = [
        (1000, None),
        (1020, [0.0] * 8),
        (1040, [float("nan")] * 8),
        (1060, [1.0, 2.0]),
        (1080, [None] + [1.0] * 7),
        (1100, [float("inf")] + [1.0] * 7),
        (1120, []),
        (None, [1.0] * 8),
    ]
    vectors = made(5, 30, 8)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    given = table(spark, rows + odd + rows[:3]).withColumns({"score": F.lit("x"), "codes": F.lit(1), "asked": F.lit(2)})
    found = nearest_neighbours(given, by_twenties(), recall=1.0).collect()
    check(found, {i: v.astype(float) for i, v in enumerate(vectors)}, 1.0)


@pytest.mark.parametrize("number", [5, 20, 21, 22, 60])
def test_as_many_rows_as_asked_for_or_all(spark, number):
    vectors = made(7, number)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    found = nearest_neighbours(table(spark, rows), by_twenties(), recall=0.1).collect()
    check(found, {i: v.astype(float) for i, v in enumerate(vectors)}, 0.1 if number > 21 else 1.0)


def test_few_rows_and_empty_tables(spark):
    assert nearest_neighbours(table(spark, []), by_twenties()).count() == 0
    assert nearest_neighbours(table(spark, [(1, [1.0, 0.0])]), by_twenties()).count() == 0
    assert nearest_neighbours(table(spark, [(20, [1.0, 0.0])]), by_twenties()).count() == 0
    pair = nearest_neighbours(table(spark, [(20, [1.0, 0.0]), (3, [-1.0, 0.5])]), by_twenties()).collect()
    assert [tuple(row) for row in pair] == [(20, 1, 3, -1.0)]


def test_ascent_from_low_branches_reaches_the_root(spark, monkeypatch):
    vectors = made(6, 400)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    calibrate = neighbours._calibrate
    monkeypatch.setattr(neighbours, "_calibrate", lambda *a: (calibrate(*a)[0], 9))
    found = nearest_neighbours(table(spark, rows), by_twenties()).collect()
    check(found, {i: v.astype(float) for i, v in enumerate(vectors)}, 0.9)


def test_query_without_rows_in_any_branch_is_found_further_up(spark):
    draw = np.random.default_rng(8)
    vectors = (np.ones((800, 8)) + draw.normal(0, 1e-7, (800, 8))).astype(np.float64)
    vectors[400] = -0.01
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    found = nearest_neighbours(table(spark, rows, "double"), by_twenties(), trees=4, recall=0.5).collect()
    per_query = {i: [r["rank"] for r in found if r["query_id"] == i] for i in range(0, 800, 20)}
    assert all(sorted(ranks) == list(range(1, 21)) for ranks in per_query.values())
    wanted = dict(exact(dict(enumerate(vectors)), 400))
    assert {r["vec_id"]: r["score"] for r in found if r["query_id"] == 400} == pytest.approx(wanted, abs=1e-12)


def test_prefixes_and_stops():
    codes = np.array([0, 1, 1 << 31, 5])
    assert common_prefix(codes, np.array([0, 0, 0, 4])).tolist() == [BITS, BITS - 1, 0, BITS - 1]
    counts = np.array([[10, 6, 2], [10, 4, 1]])
    assert [x.tolist() if hasattr(x, "tolist") else x for x in stop_depths(counts, 3)] == [[2, 2], True]
    assert stop_depths(counts, 7)[0].tolist() == [1, 2]
    assert stop_depths(counts, 10)[0].tolist() == [1, 1]
    assert stop_depths(counts, 21)[1] is False
    # One query, one tree: two of its three neighbours share two bits and are met with the third row.
    met = np.zeros((1, 1, BITS + 1), int)
    met[0, 0, [0, 1, 2]] = 5, 3, 3
    assert needed_rows(met, [np.array([[2], [2], [0]])], 0.6) <= 3
    assert needed_rows(met, [np.array([[2], [2], [0]])], 0.9) > 6
