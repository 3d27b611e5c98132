"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockroom.llm.spelling import (
    common_ends,
    count_words,
    letter_counts,
    near_words,
    spelling_variants,
    squared_distances,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(counts, ratio=10):
    found = {}
    for word, n in counts.items():
        near = sorted((-counts[x], x) for x in counts if one_edit(word, x))
        form = near[0] if near and -near[0][0] >= ratio * n else None
        found[word] = (form and form[1], n, len(near), form and -form[0])
    result = set()
    for word, (form, n, near, form_n) in found.items():
        root = word
        while found[root][0]:
            root = found[root][0]
        result.add((word, form, root, n, near, form_n))
    return result


def made_words(seed, count, letters="abé", shortest=1, longest=6):
    draw = random.Random(seed)
    words = {"".join(draw.choices(letters, k=draw.randint(shortest, longest))) for _ in range(count)}
    return {word: draw.choice([2, 3, 20, 31, 300, 4000]) for word in sorted(words)}


def variants(spark, counts, **how):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    result = spelling_variants(words, **how)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(row) for row in result.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("most", [3, 50, 2048])
def test_equals_brute_force(spark, most):
    counts = made_words(most, 250)
    assert variants(spark, counts, most=most) == brute_force(counts)


def test_longer_words_equal_brute_force(spark):
    counts = made_words(5, 60, "ab", 9, 12) | made_words(6, 300, "xyz", 7, 8)
    assert variants(spark, counts, ratio=5, most=20) == brute_force(counts, ratio=5)


def test_half_of_all_words_share_their_start(spark):
    draw = random.Random(8)
    counts = {"common" + "".join(draw.choices("abc", k=5)): draw.randint(2, 900) for _ in range(200)}
    counts |= made_words(9, 200, "defg", 7, 9)
    assert variants(spark, counts, most=16) == brute_force(counts)


def test_pairs_come_once(spark):
    counts = made_words(1, 200)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = [(row.a, row.b) for row in near_words(words, most=7).collect()]
    assert len(pairs) == len(set(map(frozenset, pairs)))
    assert all((len(a), a) < (len(b), b) and one_edit(a, b) for a, b in pairs)


def test_very_long_words(spark):
    long = "abcdefgh" * 3000
    counts = {long: 100, long[:-1]: 3, "x" + long[1:]: 10, long[:9000] + "q" + long[9000:]: 4, long[::-1]: 7}
    assert variants(spark, counts) == brute_force(counts)


def test_words_that_repeat_or_are_missing(spark):
    rows = [("abcdefg", 50), ("abcdefg", 50), ("abcdef", 10), ("", 5), (None, 5), ("lonely", 2), ("null", None)]
    words = spark.createDataFrame([(*row, "x") for row in rows], "word string, n long, near string")
    found = {tuple(row) for row in spelling_variants(words).collect()}
    assert found == brute_force({"abcdefg": 100, "abcdef": 10, "lonely": 2})


def test_no_words(spark, texts):
    assert spelling_variants(count_words(texts([]))).collect() == []
    assert spelling_variants(count_words(texts([None, "", "short words"]))).collect() == []


def counted(rows, damaged):
    counts = Counter()
    for number, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if number is None else number}:{run}".encode())
            if damaged and h % damaged == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 2}


@pytest.mark.parametrize("damaged", [0, 3])
def test_counts_equal_plain_counting(spark, prose, damaged):
    odd = "ÀÉÎöüßÿ×÷ÀÉÎ ÀÉÎÖÜßÿ×÷ÀÉÎ aaaaaaa_bbbbbbb7ccccccc  ĀĀĀĀĀĀĀ İİİİİİİ KELVINK WORDWORD wordword"
    rows = [(at, prose(at % 7, 60).title()) for at in range(40)]
    rows += [(1, odd), (1, odd), (2, odd), (None, odd), (None, odd), (3, None), (4, "")]
    rows += [(50, "longrun" * 30_000), (51, "LongRun" * 30_000)]
    documents = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, n int")
    found = {row.word: row.n for row in count_words(documents, damaged=damaged).collect()}
    assert found == counted(rows, damaged)


WORDS = st.lists(st.text("abà", min_size=1, max_size=6), min_size=1, max_size=12)


@settings(deadline=None, max_examples=80)
@given(WORDS, WORDS)
def test_distances_by_product(one, other):
    counts = letter_counts([*one, *other])
    found = squared_distances(counts[: len(one)], counts[len(one) :])
    expected = [
        [sum((a.count(c) - b.count(c)) ** 2 for c in "abà") for b in other] for a in one
    ]
    assert np.array_equal(found, expected)


@settings(deadline=None, max_examples=80)
@given(WORDS, st.booleans())
def test_common_ends(words, wide):
    one = [("z" * 300 if wide else "") + word for word in words]
    other = one[1:] + one[:1]
    starts, ends = common_ends(one, other)
    for a, b, start, end in zip(one, other, starts, ends, strict=True):
        assert start == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert end == next((i for i, (x, y) in enumerate(zip(a[::-1], b[::-1])) if x != y), min(len(a), len(b)))
