from __future__ import annotations

import hashlib
import random
import re
import struct
from collections import Counter

import xxhash

from pyspark.sql import functions as F

from stockroom.llm.fingerprints import edited_and_next, fingerprint_slots, numbered_kmers, occurrences, run_starts


def expected(rows):
    """(id, characters, digest of the edited text) of (id, text) rows in order of id."""
    rows = sorted(rows, key=lambda row: row[0])
    found = []
    for at, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(at + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        found.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return found


def spark_hash(values):
    """Spark's hash of a row of texts, longs and bytes: each value's hash is the next one's seed."""
    seed = 42
    for value in values:
        if isinstance(value, str):
            value = value.encode()
        elif isinstance(value, int):
            value = struct.pack("<q", value)
        if value is not None:
            seed = xxhash.xxh64_intdigest(value, seed=seed)
    return seed


def order_minhash(text, slots=64, size=2, k=2, seed=11):
    """The slots of a text, by sorting every part's numbered k-mers anew for each order."""
    units = re.findall("[^ \t-\r]{1,16}", text)
    seen, numbered = Counter(), []
    for place in range(len(units)):
        kmer = spark_hash((units[place : place + k] + [None] * k)[:k]) >> 29
        numbered.append((spark_hash([kmer, struct.pack("<i", seen[kmer])]), place))
        seen[kmer] += 1
    draw = random.Random(seed)
    found = []
    for _ in range(slots):
        factor = draw.getrandbits(32) | 1
        parts = [
            min(((h >> 33) * factor % 2**32, place) for h, place in numbered if h % 2**20 % size == part)
            for part in sorted({h % 2**20 % size for h, _ in numbered})
        ]
        found.append(spark_hash([key for key, _ in sorted(parts, key=lambda entry: entry[1])]) % 2**32)
    return found


def test_edited_texts_in_order_of_id(spark, texts, prose):
    rows = [(i * 7 % 101, prose(i, 5 + i)) for i in range(101)]
    rows += [(200, None), (201, ""), (202, "é𝒳x"), (203, "x" * 100_000), (204, " "), (205, prose(3, 4000))]
    found = edited_and_next(texts(rows)).collect()
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == expected(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)


def test_likeness_follows_the_texts(texts, prose):
    base = prose(1, 300)
    words = base.split()
    swapped = " ".join(words[150:] + words[:150])
    changed = " ".join(words[:140] + ["other"] + words[141:])
    rows = [base, base, changed, swapped, prose(2, 300)]
    found = {r["doc_id"]: r for r in edited_and_next(texts(rows)).collect()}
    assert found[0]["fingerprint"] == found[1]["fingerprint"] and found[0]["near_next"] == 1.0
    assert found[1]["near_next"] > 0.8
    # The same k-mers in another order are less alike than an edit leaves them.
    assert found[2]["near_next"] < found[1]["near_next"]
    assert found[3]["near_next"] < 0.2
    assert 0 < found[4]["near_edited"] < 0.6
    assert found[0]["near_edited"] == 1.0 or found[0]["fingerprint"] != found[0]["edited_fingerprint"]


def as_hex(slots):
    return "".join(f"{value:08x}" for value in slots)


def test_fingerprints_equal_brute_force(texts, prose):
    rows = [(i, prose(i, 3 + 20 * i)) for i in range(12)]
    rows += [(20, None), (21, ""), (22, "é𝒳x"), (23, "x" * 1000), (24, "a b " * 50), (25, "one"), (26, "one two")]
    found = {r["doc_id"]: r for r in edited_and_next(texts(rows)).collect()}
    for at, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(at + 1) % len(rows)][1] or ""
        half = len(text) // 2
        own, edited = order_minhash(text), order_minhash(text[: len(text) - half] + following[:half])
        beside = order_minhash(following)
        row = found[doc_id]
        assert (row["fingerprint"], row["edited_fingerprint"]) == (as_hex(own), as_hex(edited))
        assert row["near_edited"] == sum(map(int.__eq__, own, edited)) / 64
        assert row["near_next"] == sum(map(int.__eq__, own, beside)) / 64


def test_tuples_of_other_sizes(texts, prose):
    rows = [(i, prose(i, 30)) for i in range(5)] + [(9, "one two")]
    for size in (1, 3):
        found = fingerprint_slots(texts(rows), ["doc_id"], "text", 8, size, 2, 5).collect()
        assert {r["doc_id"]: r["slot_values"] for r in found} == {i: order_minhash(t, 8, size, 2, 5) for i, t in rows}


def test_the_error_of_likeness(texts):
    """Texts that share half of their k-mers, in order: the spread of likeness is that of 64 draws of two k-mers each."""
    draw, rows = random.Random(3), []
    for pair in range(40):
        words = [f"w{draw.getrandbits(40)}" for _ in range(301)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(words[:201] + [w + "x" for w in words[201:]]))]
    found = fingerprint_slots(texts(rows), ["doc_id"], "text", 64, 2, 2, 11).collect()
    slots = {r["doc_id"]: r["slot_values"] for r in found}
    near = [sum(map(int.__eq__, slots[2 * i], slots[2 * i + 1])) / 64 for i in range(40)]
    # 200 of 400 different k-mers are shared, so both of a slot are with a chance of one in four.
    mean = sum(near) / 40
    spread = (sum((x - 0.25) ** 2 for x in near) / 40) ** 0.5
    assert abs(mean - 0.25) < 0.04 and spread < 0.08


def test_one_id_for_very_many_rows(texts, prose):
    rows = [(None if i % 3 else 7, prose(i, 6)) for i in range(90)] + [(i, prose(i, 4)) for i in range(1, 40)]
    found = edited_and_next(texts(rows)).collect()
    assert len(found) == 129
    plain = edited_and_next(texts(rows).repartition(1)).collect()
    columns = ("doc_id", "edited_sha256", "near_next")
    assert sorted(map(str, ([r[c] for c in columns] for r in found))) == sorted(
        map(str, ([r[c] for c in columns] for r in plain))
    )
    # Every row has another row's text after it: each text is somebody's next one exactly once.
    order = sorted(rows, key=lambda row: (row[0] if row[0] is not None else -(2**63), signed(spark_hash([row[1]]))))
    digests = Counter()
    for at, (_, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        half = len(text) // 2
        digests[hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()] += 1
    assert Counter(r["edited_sha256"] for r in found) == digests


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def test_repeated_kmers_are_numbered(spark):
    rows = spark.createDataFrame([(["a", "b", "a", "b", "a"],), ([],), (["x"],)], "units array<string>")
    rows = rows.withColumn("kmers", numbered_kmers(F.col("units"), 2)).withColumn("starts", run_starts(F.col("kmers")))
    found = rows.select(occurrences(F.col("kmers"), F.col("starts")).alias("n")).collect()
    assert sorted(found[0]["n"]) == [0, 0, 0, 1, 1]
    assert found[1]["n"] == [] and found[2]["n"] == [0]


def test_repeated_rows_null_ids_and_empty_tables(texts, prose):
    rows = texts([(1, prose(1)), (1, prose(1)), (1, prose(2)), (None, prose(3)), (5, "")])
    found = edited_and_next(rows.withColumns({"fingerprint": F.lit(1), "range": F.lit(2)})).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in found if r["doc_id"]) == [(False, 1)] * 3 + [(False, 5)]
    assert len(found) == 5
    alone = edited_and_next(texts([(3, "one two three")])).collect()
    assert alone[0]["near_next"] == 1.0
    assert edited_and_next(texts([])).count() == 0


def test_no_python_runs(texts, prose):
    plan = edited_and_next(texts([prose(1)]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
