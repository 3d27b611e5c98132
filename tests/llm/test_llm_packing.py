from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stockroom.llm.packing import Sequences, hilbert_key, pack_documents, word_ids

with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
    DEFINITION = file.read()

TRICKY = [
    "",
    None,
    "<|endoftext|> İstanbul ΣΑΣ don't it's l'été J̌ ǰ é é́ x y\tz\r\n 1.5,!? ,,, a.,b É'S",
    "a" * 5000,
    " ",
    " ́a b́. ǰ Ǆ ŉ ﬁ",
    "日本語 テキスト。 ß ẞ",
    "hello, HELLO! Hello!! hello\x1chello hello hello‍ ",
    "12a a12 a_b a-b ..a a.. %%% ***x###",
]


def check(found, wanted, length=2048):
    """Pieces cover each document once, and sequences are gapless and need no padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in found:
        ids = wanted[row["doc_id"]]
        part = ids[row["start"] : row["start"] + row["length"]]
        assert row["doc_tokens"] == len(ids) and 0 < row["length"] == len(part)
        assert row["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        pieces[row["doc_id"]].append((row["start"], row["length"]))
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for doc_id, ids in wanted.items():
        at = 0
        for start, size in sorted(pieces[doc_id]):
            assert start == at
            at += size
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length or (at < length and at & (at - 1) == 0)


def test_packs_every_id_once(texts, prose):
    rows = TRICKY + [prose(i, 10 + 40 * (i % 9)) for i in range(60)] + [prose(1, 9000)] + [prose(2)] * 40
    tokenizer = Tokenizer.from_str(DEFINITION)
    wanted = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(rows)}
    check(pack_documents(texts(rows), DEFINITION).collect(), wanted)
    short = pack_documents(texts(rows), DEFINITION, length=16).collect()
    check(short, wanted, 16)


def test_few_files_hold_the_pieces_of_many_stretches(spark, texts, prose, tmp_path):
    rows = [prose(i, 30 + i) for i in range(120)]
    tokenizer = Tokenizer.from_str(DEFINITION)
    wanted = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(rows)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 32)
        pack_documents(texts(rows), DEFINITION).write.parquet(str(tmp_path / "pieces"))
        joined = pack_documents(texts(rows), DEFINITION).coalesce(1).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    found = spark.read.parquet(str(tmp_path / "pieces")).collect()
    check(found, wanted)
    assert len({row["sequence_id"] >> 32 for row in found}) > 20
    assert len(list((tmp_path / "pieces").glob("*.parquet"))) <= 4
    check(joined, wanted)


def test_word_cache_starts_anew(monkeypatch, prose):
    monkeypatch.setattr("stockroom.llm.packing.CACHE_WORDS", 5)
    words, tokenizer = word_ids(DEFINITION), Tokenizer.from_str(DEFINITION)
    for seed in range(5):
        assert words.ids(prose(seed)).tolist() == tokenizer.encode(prose(seed), add_special_tokens=False).ids


def test_curve_visits_neighbours():
    for bits, axes in ((3, 3), (2, 4), (4, 2)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        keys = hilbert_key(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_alike_documents_lie_together(texts, prose):
    rows = [prose(i, 150) if i % 2 else " ".join(["zylinder quark", str(i % 7)] * 80) for i in range(200)]
    found = pack_documents(texts(rows), DEFINITION).orderBy("sequence_id", "offset").collect()
    kinds = [row["doc_id"] % 2 for row in found]
    assert sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) < len(kinds) / 8


def test_sequences_cut_what_is_left_to_powers_of_two():
    sequences = Sequences(8, 0)
    pieces = [*sequences.add("a", np.arange(13)), *sequences.add("b", np.arange(2)), *sequences.finish()]
    assert [(p[0], p[1], p[2], p[5], p[6]) for p in pieces] == [
        ("a", 0, 8, 0, 0),
        ("a", 8, 4, 1, 0),
        ("a", 12, 1, 2, 0),
        ("b", 0, 1, 2, 1),
        ("b", 1, 1, 3, 0),
    ]


def test_null_ids_repeated_rows_and_empty_tables(texts, prose):
    rows = texts([(1, prose(1)), (1, prose(1)), (None, prose(2))])
    clash = rows.withColumns({"ids": F.lit(1), "curve": F.lit("x"), "place_0": F.lit(2)})
    found = pack_documents(clash, DEFINITION).collect()
    totals = defaultdict(int)
    for row in found:
        totals[row["doc_id"]] += row["length"]
    sizes = {row["doc_id"]: row["doc_tokens"] for row in found}
    assert totals[1] == 2 * sizes[1] and totals[None] == sizes[None]
    assert pack_documents(texts([]), DEFINITION).count() == 0


def test_strings_of_special_tokens_are_these_tokens():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        words = word_ids(file.read())
    assert words.ids("a <|endoftext|> b").tolist() == [320, 49407, 321]
    for text in ("x<|startoftext|>y", "<|endoftext|>", "<|ENDOFTEXT|> z", "tail <|endoftext|"):
        assert words.ids(text).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
