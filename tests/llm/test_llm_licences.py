from __future__ import annotations

import os
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from stockroom.llm.licences import TEMPLATES, find_licences, licence_sql, size_bounds

APACHE = "Licensed under the Apache License, Version 2.0."


def dice(one, other):
    def bag(text):
        words = re.findall(r"[^\W_]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        return Counter(zip(words, words[1:], strict=False))

    a, b = bag(one), bag(other)
    return 2 * sum((a & b).values()) / max(1, a.total() + b.total()), a.total()


def expected(rows, least=0.8):
    found = []
    for doc_id, text in rows:
        if text is None:
            continue
        units = [("line", i, part) for i, part in enumerate(text.split("\n"))]
        paragraphs = re.split(r"\n[ \t\r]*\n", text)
        if len(paragraphs) > 1:
            units += [("paragraph", i, part) for i, part in enumerate(paragraphs) if "\n" in part]
        if "\n" in text:
            units.append(("text", 0, text))
        for unit, number, part in units:
            for name, template in TEMPLATES.items():
                value, size = dice(part, template)
                if value >= least and size:
                    found.append((doc_id, unit, number, name, size, round(value, 12)))
    return Counter(found)


ROWS = [
    APACHE,
    "intro\n" + APACHE.upper() + "\nmore words follow here",
    "licensed UNDER the apache license version 2 0 today",
    TEMPLATES["MIT grant"].replace(", ", ",\n"),
    "one\n\n" + TEMPLATES["GPL-3.0 header"].replace("and/or", "and/or\n") + "\n \t\nend",
    "All rights reserved. All rights reserved. All rights reserved.",
    "All rights reserved.\n" * 3,
    "",
    None,
    "word",
    "a b " * 30_000,
    "x" * 100_000,
    "\n\n\n",
]


def test_equals_brute_force(texts):
    rows = list(enumerate(ROWS)) + [(0, APACHE), (None, APACHE)]
    found = find_licences(texts(rows)).collect()
    got = [(*tuple(row)[:5], round(row["dice"], 12)) for row in found]
    assert Counter(got) == expected(rows)


def test_size_bounds_keep_every_match():
    for size in range(1, 60):
        low, high = size_bounds(size, 0.8)
        for other in range(1, 200):
            possible = 2 * min(size, other) / (size + other) >= 0.8
            assert possible == (low <= other <= high)


def test_empty_tables_clashing_columns_and_plan(texts):
    assert find_licences(texts([])).count() == 0
    rows = texts([APACHE]).withColumns({"unit": F.lit("x"), "part": F.lit(1), "n_bigrams": F.lit(0)})
    assert find_licences(rows).count() == 1
    assert find_licences(rows, {"none": "", "one": "word"}).count() == 0
    plan = find_licences(rows)._jdf.queryExecution().toString()
    assert not re.search("Python|ArrowEval|MapIn|CartesianProduct|NestedLoop", plan)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no test tables")
def test_sql_gives_the_same(spark):
    connection = duckdb.connect()
    connection.execute("create view documents as from read_parquet('/root/testdata/sf0.001/documents.parquet')")
    columns = "doc_id, unit, unit_no, licence, n_bigrams, dice"
    wanted = connection.execute(f"select {columns} from ({licence_sql()})").fetchall()
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert Counter(wanted) == Counter(tuple(row) for row in find_licences(documents).collect()) and wanted
