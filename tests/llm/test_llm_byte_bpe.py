from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from stockroom.llm.byte_bpe import encode_and_decode, pack_words, unpack_words

with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
    RANKS = file.read()
PATTERN = public_tokenizers.PATTERN
ENCODING = tiktoken.Encoding(
    "whole",
    pat_str=PATTERN,
    mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in map(bytes.split, RANKS.splitlines())},
    special_tokens={},
)


def expected(doc_id, text):
    ids = ENCODING.encode_ordinary(text or "")
    return (
        doc_id,
        len(ids),
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


def rows_of(documents, **settings):
    return Counter(map(tuple, encode_and_decode(documents, RANKS, PATTERN, **settings).collect()))


def test_equals_the_library_on_whole_texts(texts, prose):
    draw = random.Random(1)
    letters = "ab é\t\n  \r\x0b\x1c\x1d\x00\x85\xa0 　'sdt1٣²日.,!-_é́😀 "
    rows = ["", None, " ", "a ", " a", "\n", "a\n b", " '", "don't it's 'll", "a  b", "a \nb", "<|endoftext|> x"]
    rows += ["".join(draw.choice(letters) for _ in range(draw.randint(1, 25))) for _ in range(1500)]
    rows += [prose(i) for i in range(30)] + ["z" * 20_000, " " * 5000 + "x", prose(5, 5000)]
    assert rows_of(texts(rows)) == Counter(expected(i, t) for i, t in enumerate(rows))


def test_many_small_blocks_give_the_same(texts, prose):
    rows = [prose(i % 40, 30) for i in range(200)] + [""] * 20
    small = rows_of(texts(rows), block_characters=500)
    assert small == rows_of(texts(rows)) == Counter(expected(i, t) for i, t in enumerate(rows))


def test_only_empty_texts_null_ids_repeated_rows_and_empty_tables(texts):
    assert rows_of(texts(["", None])) == Counter([expected(0, ""), expected(1, "")])
    rows = texts([(1, "one two"), (1, "one two"), (None, "three")]).withColumns({"block": F.lit(1), "ids": F.lit("x")})
    assert rows_of(rows) == Counter([expected(1, "one two")] * 2 + [expected(None, "three")])
    assert rows_of(texts([])) == Counter()


def test_word_lists_keep_their_words():
    for words in ([], [b""], [b"a", b"", "é".encode(), b"\x00b"], [b"x" * 70_000]):
        assert unpack_words(pack_words(words)) == words


def test_blocks_do_not_move(texts, prose):
    plan = encode_and_decode(texts([prose(1)]), RANKS, PATTERN)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and "BroadcastExchange" not in plan
