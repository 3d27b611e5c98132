from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from stockroom.llm.personal_data import (
    KINDS,
    estimate_reliabilities,
    find_personal_data,
    fit_span_model,
    prefix_sums,
    redact,
)

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TRICKY = [
    "",
    None,
    "a@b.com_x@y.org +1 (988) 555-2485 4111111111111111",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 9.9.9 1.1.1.99999999999999999999",
    "é𝒳 a.b@c.d.e, x@y .. @q.r +12 34 56 78 9 + 1",
    "4111 1111 1111 1111- 4111-1111-1111-1112",
    "..%a@b-c.d-e.f a@b..c a@-.-",
    "a@b.c@d.e 9" * 30,
    "+" * 200 + "1" * 300,
    "1-2-3-4 5" * 500,
    "x" * 200_000 + "@",
    "7" * 30_000,
    "1.2.3.4 " * 400 + "\n" + "q@r.st " * 400,
]


def luhn(digits):
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def expected_spans(text):
    found = []
    for at, kind in enumerate(KINDS):
        for match in re.finditer(PLAIN[kind], text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            valid = {
                "email": lambda m: True,
                "ip": lambda m: all(int(part) <= 255 for part in m.split(".")),
                "card": lambda m, d=digits: 12 <= len(d) <= 19 and luhn(d),
                "phone": lambda m, d=digits: 9 <= len(d) <= 15,
            }[kind](match[0])
            if valid:
                found.append((match.start(), at, match.end()))
    return sorted(found)


def joined(spans):
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def test_base_spans(texts):
    found = {row["doc_id"]: row for row in find_personal_data(texts(TRICKY)).collect()}
    assert len(found) == len(TRICKY)
    for at, text in enumerate(TRICKY):
        spans, row = expected_spans(text), found[at]
        assert [row[f"n_{kind}"] for kind in KINDS] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        assert row["base_sha256"] == hashlib.sha256(joined(spans).encode()).hexdigest()
        assert set(joined(spans).split(",")) <= set(row["spans"].split(","))


def corpus():
    cards = ["4111111111111111", "5500005555555559", "4012888888881881"]
    rows = [f"text {i} pay {cards[i % 3]} to u{i}@mail.example.com or +1 (2{i % 90 + 10}) 555-{1000 + i} end" for i in range(90)]
    rows += [f"number {1234567890123456 + i * 10} stands here and token {i}a{123456789012 + i}b" for i in range(120)]
    return rows


def test_method_adds_glued_spans_and_no_random_numbers(texts):
    glued = "Call +1 (319) 555-5132 4111111111111111 now"
    rows = [*corpus(), glued]
    found = {row["doc_id"]: row for row in find_personal_data(texts(rows)).collect()}
    assert found[len(rows) - 1]["n_card"] == 0
    assert found[len(rows) - 1]["spans"] == "phone:5:22,card:23:39"
    for at, text in enumerate(rows[90:-1], 90):
        assert found[at]["spans"] == joined(expected_spans(text))


def test_redaction_leaves_clean_texts_alone(texts, prose):
    clean = [prose(i) for i in range(20)] + ["", None, "1 2 3 and 12:30, v1.2"]
    rows = texts([*corpus(), *clean, "a@b.co x 4111111111111111 y 1.2.3.4"])
    out = {row["doc_id"]: row["text"] for row in redact(rows.withColumn("note", F.lit(1))).collect()}
    assert [out[210 + i] for i in range(len(clean))] == clean
    assert out[210 + len(clean)] == "<email> x <card> y <ip>"
    assert not re.search(r"@mail|555-|4111|5500|4012", " ".join(out[i] for i in range(90)))


def test_overlapping_spans_become_one(texts):
    # The base phone and the base card share digits.
    text = "see +378282246310005 then"
    (row,) = redact(texts([text])).collect()
    assert [KINDS[kind] for _, kind, _ in expected_spans(text)] == ["phone", "card"]
    assert row["text"] == "see <phone> then"


def test_reliabilities_tell_good_labelers_from_bad_ones():
    counts = [((1, 1, 0, 0, 1), 90), ((-1, -1, 1, 0, 1), 40), ((-1, -1, -1, 0, 1), 60), ((-1, -1, -1, 0, -1), 100)]
    share, tables = estimate_reliabilities(counts)
    assert 0.2 < share < 0.45
    assert tables[0][1][0] > 0.9 > 0.1 > tables[0][1][1]
    model = fit_span_model([(2, votes, 32, n) for votes, n in counts])
    assert model.bias[0] == -1.0


def test_sums_run_over_long_arrays(spark):
    rows = spark.createDataFrame([([i % 7 for i in range(n)],) for n in (0, 1, 63, 64, 65, 1000)], "x array<int>")
    for row in rows.select("x", prefix_sums(F.col("x")).alias("s")).collect():
        assert row["s"] == [sum(row["x"][: i + 1]) for i in range(len(row["x"]))]


def test_repeated_rows_empty_tables_and_clashing_columns(texts):
    rows = texts([(1, "a@b.co"), (1, "a@b.co"), (None, "1.2.3.4")])
    clash = rows.withColumns({"spans": F.lit("old"), "pii_base": F.lit(0)})
    found = sorted((row["doc_id"] or 0, row["spans"]) for row in find_personal_data(clash).collect())
    assert found == [(0, "ip:0:7"), (1, "email:0:6"), (1, "email:0:6")]
    assert find_personal_data(texts([])).count() == 0 and redact(texts([])).count() == 0
    plan = find_personal_data(rows)._jdf.queryExecution().toString() + redact(rows)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_numbers_beside_other_numbers_are_found(texts):
    rows = ["pay with card 2024 4111 1111 1111 1111", "call phone +44 20 7946 0958 2024 12 now"]
    found = [row["spans"] for row in find_personal_data(texts(rows)).orderBy("doc_id").collect()]
    assert found == ["card:19:38", "phone:11:27"]
    masked = [row["text"] for row in redact(texts(rows)).orderBy("doc_id").collect()]
    assert masked == ["pay with card 2024 <card>", "call phone <phone> 2024 12 now"]


def test_many_matches_take_time_in_proportion(texts):
    """A text of 50,000 matches; when time grew with the square of their number, 2,000 of them took most of a minute."""
    import time

    row = "écrire à user{0}@mail.example.com or call +1 555 {1:03d} {2:04d} from 10.0.{3}.7,\n"
    text = "".join(row.format(at, at % 900 + 100, at % 10_000, at % 256) for at in range(17_000))
    started = time.time()
    found = find_personal_data(texts([text])).first()
    assert (found["n_email"], found["n_ip"], found["n_phone"]) == (17_000, 17_000, 17_000)
    first, last = found["spans"].split(",")[0], found["spans"].split(",")[-1]
    assert first == "email:9:31" and last.startswith("ip:")
    kind, start, end = last.split(":")
    assert text[int(start) : int(end)] == "10.0.103.7"
    masked = redact(texts([text])).first()["text"]
    assert masked == "écrire à <email> or call <phone> from <ip>,\n" * 17_000
    assert time.time() - started < 100
