"""Exact duplicates against a plain grouping, and the fingerprints' codes."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockroom.llm.exact_duplicates import ROWS, exact_duplicates, range_starts, row_maker
from stockroom.llm.golomb import decode_sorted, encode_sorted


@settings(deadline=None, max_examples=60)
@given(st.sets(st.integers(0, (1 << 44) - 1), min_size=0, max_size=300), st.integers(0, 3))
def test_codes_round_trip(values, gathered):
    span = 1 << 44
    kept = np.array(sorted({v >> (12 * gathered) for v in values}), np.uint64)
    coded = encode_sorted(kept, span)
    assert decode_sorted(coded, len(kept), span).tolist() == kept.tolist()


def test_evenly_spread_numbers_need_few_bits():
    span, count = 1 << 44, 20_000
    values = np.unique(np.random.default_rng(4).integers(0, span, count, dtype=np.uint64))
    # The gap's logarithm, and about a bit and a half.
    assert len(encode_sorted(values, span)) * 8 / count < np.log2(span / count) + 2


@pytest.mark.parametrize("owners", [1, 3, 12, 1000])
def test_ranges_hold_all_fingerprints(owners):
    starts = range_starts(10, owners)
    assert starts[0] == 0 and starts[-1] == 1 << 10 and (np.diff(starts.astype(int)) >= 0).all()


def expected(rows):
    """By plain grouping: of equal texts the longest, then the one with the smallest id."""
    groups = defaultdict(list)
    for number, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), number is None, number or 0))
    found = []
    for bare, members in groups.items():
        first = min(members)
        keep = None if first[1] else first[2]
        digest = hashlib.sha256(bare.encode()).hexdigest()
        for at, member in enumerate(sorted(members)):
            found.append((None if member[1] else member[2], keep, len(members), at == 0, digest))
    return sorted(found, key=str)


def found_in(spark, rows, **how):
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    result = exact_duplicates(documents, **how)
    assert result.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, result.collect()), key=str)


CASES = [
    (5, "a b"), (3, "ab"), (9, "a\tb"), (4, "a b"), (1, None), (2, ""), (7, " \n "), (8, "AB"),
    (6, "unique"), (None, "no id"), (None, "noid"), (10, "no  id"), (11, "x"), (11, "x"), (11, "x "), (None, "y"),
    (-5, "negative"), (-(1 << 63), "negative"), ((1 << 63) - 1, "negative"), (12, "é" * 3), (13, "é" * 3),
]


@pytest.mark.parametrize("bits", [4, 44, 60])
@pytest.mark.parametrize("block_rows", [2, 65_536])
def test_equals_plain_grouping(spark, bits, block_rows):
    rows = CASES + [(100 + at, f"text {at % 40}" + " " * (at % 3)) for at in range(200)]
    assert found_in(spark, rows, bits=bits, block_rows=block_rows, owners=3) == expected(rows)


def test_group_of_a_third_of_all_rows(spark, prose):
    rows = [(at, prose(0) if at % 3 == 0 else prose(at)) for at in range(600)]
    assert found_in(spark, rows, block_rows=32) == expected(rows)


def test_long_text(spark):
    long = "word " * 400_000
    rows = [(1, long), (2, long.replace(" ", "")), (3, long + "."), (4, long.replace(" ", "\n"))]
    assert found_in(spark, rows) == expected(rows)


def test_empty_table_and_clashing_columns(spark):
    assert found_in(spark, []) == []
    rows = spark.createDataFrame(
        [(1, "a", 7, "x", b"d", True), (2, "a ", 8, None, b"e", False)],
        "doc_id long, text string, block int, digest string, bare binary, kept boolean",
    )
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in exact_duplicates(rows).collect()) == [(1, 2, False), (2, 2, True)]


def test_only_suspects_are_marked(spark):
    rows = spark.createDataFrame([(at, f"{at}", 1) for at in range(50)], "doc_id long, text string, n_chars long")
    made = rows.mapInArrow(row_maker(44, 16), ROWS).collect()
    assert len({(r.block, r.place) for r in made}) == 50
    assert all(r.fingerprint < 1 << 44 for r in made)


def test_leaves_no_table_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    found_in(spark, CASES)
    assert {t.name for t in spark.catalog.listTables()} == before
