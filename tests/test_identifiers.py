"""Ids of any kind get dense numbers, batch by batch."""

from __future__ import annotations

import pytest
from helpers import rows_of, with_lost_tasks
from pyspark.sql import functions as F

from stockroom.operators import IdDictionary, bitmap_state, bitmap_totals


@pytest.fixture
def dictionary(spark, database):
    return IdDictionary(f"{database}.ids").create(spark)


def numbers(spark, dictionary):
    return {row["id"]: row["number"] for row in spark.table(dictionary.table).collect()}


def id_rows(spark, ids):
    return spark.createDataFrame([(i % 3, x) for i, x in enumerate(ids)], "key int, id string")


def test_numbers_are_dense_and_never_change(spark, dictionary):
    first = [f"id-{i % 400}" for i in range(1200)] + ["hot"] * 600 + [None, "", "é", "a'b"]
    assert dictionary.add(with_lost_tasks(id_rows(spark, first)), ["id"], "run", 0) == 404
    before = numbers(spark, dictionary)
    assert sorted(before.values()) == list(range(1, 405))
    assert dictionary.add(id_rows(spark, first + [f"new-{i}" for i in range(50)]), ["id"], "run", 1) == 50
    after = numbers(spark, dictionary)
    assert sorted(after.values()) == list(range(1, 455))
    assert {name: after[name] for name in before} == before
    assert dictionary.add(id_rows(spark, first), ["id"], "run", 2) == 0
    assert numbers(spark, dictionary) == after


def test_a_batch_that_is_run_again(spark, dictionary):
    dictionary.add(id_rows(spark, ["a", "b"]), ["id"], "run", 0)
    for _ in range(2):
        assert dictionary.add(id_rows(spark, ["b", "c", "d"]), ["id"], "run", 1) == 2
        assert sorted(numbers(spark, dictionary)) == ["a", "b", "c", "d"]
        assert sorted(numbers(spark, dictionary).values()) == [1, 2, 3, 4]


def test_bitmaps_of_sparse_and_text_ids_are_exact(spark, dictionary):
    rows = spark.range(3000).select(
        (F.col("id") % 4).alias("key"),
        (F.col("id") % 700 * 10**15).alias("sparse"),
        F.concat(F.lit("box-"), F.col("id") % 900).alias("text"),
    )
    dictionary.add(rows, ["sparse", "text"], "run", 0)
    for name in ("sparse", "text"):
        state = bitmap_state(dictionary.numbered(rows, ["key"], name), ["key"], "number")
        assert state.count() == 4  # One block for each key, however far apart the ids are.
        exact = rows.groupBy("key").agg(F.count_distinct(name).alias("n"))
        assert rows_of(bitmap_totals(state, ["key"], "n")) == rows_of(exact)


def test_no_ids(spark, dictionary):
    assert dictionary.add(id_rows(spark, [None]), ["id"], "run", 0) == 0
    assert dictionary.add(id_rows(spark, []), ["id"], "run", 1) == 0
    assert dictionary.numbered(id_rows(spark, [None]), ["key"], "id").count() == 0
