"""Alignment of two tokenizers against whole texts and plain loops."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockroom.llm import alignment
from stockroom.llm.alignment import Definitions, alignment_figures, aligned_tokens, squeezed, tokenizers_of, unsqueezed
from stockroom.llm.sparse import Csr, product, product_sizes

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def definitions():
    with open(A_PATH, encoding="utf-8") as a, open(B_PATH, "rb") as b:
        return Definitions(a.read(), b.read())


@pytest.fixture(scope="module")
def whole_texts():
    """Tokens of a whole text by the libraries alone: (id, bytes) by A and by B, or nothing if the bytes differ."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in printable}
    letters |= {chr(256 + at): x for at, x in enumerate(x for x in range(256) if x not in printable)}

    def tokens(text):
        one = a.encode(" " + text, add_special_tokens=False)
        a_tokens = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in one.ids]
        b_tokens = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            b_tokens.append((i, bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        for found in (a_tokens, b_tokens):
            if not text or b"".join(x for _, x in found) != b" " + text.encode():
                return [], []
        return a_tokens, b_tokens

    return tokens


def spans(tokens):
    at, found = 0, []
    for _, data in tokens:
        found.append((at, at + len(data)))
        at += len(data)
    return found


def brute_force(rows, tokens):
    """Everything by loops over tokens."""
    linked, tables = [], []
    for _, text in rows:
        a, b = tokens(text or "")
        a_spans, b_spans = spans(a), spans(b)
        links, first = [], 0
        for i, (start, end) in enumerate(a_spans):
            while first < len(b_spans) and b_spans[first][1] <= start:
                first += 1
            j = first
            while j < len(b_spans) and b_spans[j][0] < end:
                links.append((a[i][0], b[j][0]))
                j += 1
        ends = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
        group_of = {end: at for at, end in enumerate(ends)}
        groups = [([], []) for _ in ends]
        for side, places, which in ((a, a_spans, 0), (b, b_spans, 1)):
            at = 0
            for (number, _), (_, end) in zip(side, places, strict=True):
                groups[at][which].append(number)
                at += end in group_of
        linked.append(links)
        tables.append((a, b, groups))
    counts = Counter(pair for links in linked for pair in set(links))
    highest = defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    result = []
    for (number, _), links, (a, b, groups) in zip(rows, linked, tables):
        written = ";".join("|".join(",".join(map(str, ids)) for ids in group) for group in groups)
        best = sum(counts[link] == highest[link[0]] for link in links)
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        in_groups = sum(len(x) * len(y) for x, y in groups)
        total = sum(counts[link] for link in links)
        result.append((number, len(a), len(b), len(groups), len(links), in_groups, best, total, digest))
    return sorted(result, key=str)


def figures(spark, definitions, rows, **how):
    documents = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, n_a int")
    found = alignment_figures(documents, definitions, **how)
    assert found.columns == ["doc_id", *COLUMNS]
    return sorted(map(tuple, found.collect()), key=str)


ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\nb", "a \n b", "\ta", "a\r\n\r\nb  ", "don't we'll I'M",
    "<|endoftext|>", "a <|endoftext|> b", "<s> </s> <unk>", "▁", "a ▁ b", "a▁b", "<0x41>", "é è ê", "ｆｕｌｌ ﬁ ½ ²x",
    "日本語 テキスト と english", "😀 👩‍👩‍👧 x", "a b", "a   b", "a​ b", "﻿start", "a ́b", "x y z",
    "a\x00b \x1c c", "a\x85 b", "1234567 12,5 3.14%", "   leading", "trailing   ", "many     spaces here", "　a b",
    "İstanbul ẞ ǅ ª º", "a" * 300, "ab " * 200, "!!! ??? ...", "word.\nNext line here.", "­ ­", "\U0001f600" * 30,
    "ก็ภาษาไทย", "עברית اللغة", "x ᠎ y", "q▁ z",
]


def test_odd_texts_equal_whole_texts(spark, definitions, whole_texts):
    rows = list(enumerate(ODD)) + [(None, "no id"), (3, "a"), (3, "a"), (3, "b")]
    assert figures(spark, definitions, rows) == brute_force(rows, whole_texts)


@pytest.mark.parametrize("block", [1, 20_000, 16_000_000])
def test_table_equals_brute_force(spark, definitions, whole_texts, block):
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"])
    rows = [(x["doc_id"], x["text"]) for x in table.to_pylist()]
    assert figures(spark, definitions, rows, block_characters=block) == brute_force(rows, whole_texts)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.text(st.sampled_from("ab'sé 1.\n\t ▁日\U0001f600́​-"), max_size=14), min_size=1, max_size=4))
def test_parts_give_whole_texts(definitions, whole_texts, texts):
    tokenizers = tokenizers_of(definitions)
    block = alignment.Block()
    for text in texts:
        block.add(0, text)
    for text, places in zip(texts, block.documents, strict=True):
        parts = [block.parts[place] for place in places.tolist()]
        assert " ".join(parts) == text
        one = alignment.align(parts, tokenizers)
        a, b = whole_texts(text)
        if one.whole.all():
            assert (one.a_ids.tolist(), one.b_ids.tolist()) == ([i for i, _ in a], [i for i, _ in b])
        else:
            assert not a and not b


def test_long_texts(spark, definitions, whole_texts):
    rows = [(1, "word and more. " * 30_000), (2, "abc" * 20_000), (3, "é日" * 20_000)]
    assert figures(spark, definitions, rows) == brute_force(rows, whole_texts)


def test_third_of_all_rows_alike(spark, definitions, whole_texts, prose):
    rows = [(at, prose(0, 30) if at % 3 == 0 else prose(at, 30)) for at in range(120)]
    assert figures(spark, definitions, rows, block_characters=500) == brute_force(rows, whole_texts)


def test_empty_table(spark, definitions):
    assert figures(spark, definitions, []) == []
    assert figures(spark, definitions, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, 0, "")]


def test_tokens_and_links(spark, definitions, whole_texts, texts):
    for row in aligned_tokens(texts([*ODD, "some plain words"]), definitions).collect():
        text = [*ODD, "some plain words"][row.doc_id] or ""
        a, b = whole_texts(text)
        assert (row.a_ids, row.b_ids) == ([i for i, _ in a], [i for i, _ in b])
        a_spans, b_spans = spans(a), spans(b)
        assert row.a_ends == [e for _, e in a_spans] and row.b_ends == [e for _, e in b_spans]
        assert row.group_ends == sorted(set(row.a_ends) & set(row.b_ends))
        shared = [
            (i, j, min(x[1], y[1]) - max(x[0], y[0]))
            for i, x in enumerate(a_spans) for j, y in enumerate(b_spans) if min(x[1], y[1]) > max(x[0], y[0])
        ]
        assert [tuple(link) for link in row.links] == shared


MATRICES = st.integers(1, 5).flatmap(
    lambda inner: st.tuples(
        st.lists(st.lists(st.integers(0, 2), min_size=inner, max_size=inner), min_size=1, max_size=5),
        st.lists(st.lists(st.integers(0, 2), min_size=4, max_size=4), min_size=inner, max_size=inner),
    )
)


def csr(dense):
    dense = np.array(dense)
    rows, columns = np.nonzero(dense)
    indptr = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(dense)))])
    return Csr(indptr, columns, dense.shape[1], dense[rows, columns])


@settings(deadline=None, max_examples=100)
@given(MATRICES)
def test_products_equal_dense_ones(matrices):
    one, other = map(np.array, matrices)
    found = product(csr(one), csr(other))
    dense = np.zeros((len(one), other.shape[1]), int)
    dense[found.rows(), found.indices] = found.values
    assert (dense == one @ other).all() and len(found.values) == np.count_nonzero(one @ other)
    assert product_sizes(csr(one), csr(other)).tolist() == ((one > 0) @ (other > 0).astype(int)).sum(axis=1).tolist()
    back = csr(one).transposed()
    again = np.zeros(one.T.shape, int)
    again[back.rows(), back.indices] = back.values
    assert (again == one.T).all()


@pytest.mark.parametrize("kind", [np.int64, np.uint32, np.bool_])
@pytest.mark.parametrize("count", [0, 1, 1000])
def test_squeezed_numbers_come_back(kind, count):
    values = (np.arange(count) * 7919 % 5000).astype(kind)
    assert (unsqueezed(squeezed(values), kind) == values).all()
