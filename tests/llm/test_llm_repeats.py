from __future__ import annotations

import os
import re
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stockroom.llm.repeats import remove_repeats, repeats_sql, units_of

LEAST_WORDS, LEAST_RUN = 3, 30


def plain_units(text):
    found, begin = [], 0
    for at, letter in enumerate(text):
        if letter == "\n" or (letter == " " and at and text[at - 1] in ".!?"):
            found.append((begin, at + 1))
            begin = at + 1
    return found + ([(begin, len(text))] if begin < len(text) else [])


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return tuple(re.findall(r"[^\x20\x09-\x0D]+", lower))


def expected(rows):
    units = {
        at: [(start, end, words_of(text[start:end])) for start, end in plain_units(text or "")]
        for at, (_, text) in enumerate(rows)
    }
    first = {}
    for at, (doc_id, _) in enumerate(rows):
        for *_, words in units[at]:
            if len(words) >= LEAST_WORDS:
                first[words] = min(first.get(words, doc_id), doc_id)
    found = []
    for at, (doc_id, text) in enumerate(rows):
        long_ = [unit for unit in units[at] if len(unit[2]) >= LEAST_WORDS]
        seen, spans, run = set(), [], []
        for unit in [*long_, None]:
            repeated = unit is not None and (first[unit[2]] < doc_id or unit[2] in seen)
            if unit is not None:
                seen.add(unit[2])
            if repeated:
                run.append(unit)
            elif run:
                low, high = run[0][0], run[-1][1]
                if sum(len(w) for s, e, w in units[at] if low <= s and e <= high) >= LEAST_RUN:
                    spans.append((low, high))
                run = []
        if text is not None:
            for low, high in reversed(spans):
                text = text[:low] + text[high:]
        found.append((doc_id, text, ",".join(f"{low}:{high}" for low, high in spans)))
    return Counter(found)


def answers(documents):
    """Runs of repeated sentences alone."""
    found = remove_repeats(documents, least_run=30, whole_lines=False).collect()
    return Counter((r["doc_id"], r["text"], r["removed"]) for r in found)


def test_equals_brute_force(texts, prose):
    passage = prose(1, 66)
    rows = [
        None,
        "",
        passage,
        "Intro é one. " + passage + " End of it here.",
        "\n" + passage.upper() + "\nfoo",
        "a. b. c! d? \n\n. x",
        "x.  y. z z z. ",
        passage + " " + passage,
        "日本 語 é. " + passage,
        "short line here\n" * 40,
        "short line here",
        " ",
        ".",
        ". ",
        "x. ",
        "z" * 60_000,
        prose(5, 5000),
        "Begin. " + prose(5, 5000),
    ]
    rows += [prose(i % 13, 40) + "\n" + prose(i % 5 + 50, 35) for i in range(60)]
    pairs = [(i * 5 % len(rows), text) for i, text in enumerate(rows)]
    assert answers(texts(pairs)) == expected(pairs)


def test_earliest_occurrence_and_clean_texts_stay(texts, prose):
    passage = prose(1, 77)
    clean = [prose(i, 60) + " A common short line." for i in range(10, 20)]
    rows = [(30, "Late. " + passage), (20, passage + " Early."), (25, "Mid. " + passage + " End."), *enumerate(clean)]
    found = {r["doc_id"]: r for r in remove_repeats(texts(rows)).collect()}
    assert found[20]["text"] == passage + " Early."
    assert (found[25]["text"], found[30]["text"]) == ("Mid. End.", "Late. ")
    assert found[25]["removed"] == f"5:{5 + len(passage) + 1}"
    assert [found[i]["text"] for i in range(10)] == clean


def test_units_do_not_depend_on_the_batch(prose):
    rows = ["a. b", None, "", " ", "x.", " y\nz", "é. é é é. ü", prose(2, 50)]
    together = units_of(pa.array(rows))
    for at, text in enumerate(rows):
        alone = units_of(pa.array([text], pa.string()))
        low, high = together.first[at], together.first[at + 1]
        for name in ("start", "end", "words", "one", "other"):
            assert getattr(together, name)[low:high].tolist() == getattr(alone, name).tolist()
        assert list(zip(alone.start.tolist(), alone.end.tolist(), strict=True)) == plain_units(text or "")


def test_repeated_rows_null_ids_empty_tables_and_clashing_columns(texts, prose):
    passage = prose(1, 66)
    rows = texts([(1, passage), (1, passage), (1, "Other. " + passage), (None, passage), (2, passage)])
    clash = rows.withColumns({"removed": F.lit("old"), "one": F.lit(1), "unit_no": F.lit("x"), "rank": F.lit(2)})
    found = remove_repeats(clash)
    assert found.columns == ["doc_id", "text", "removed", "one", "unit_no", "rank"]
    kept = sorted((str(r["doc_id"]), r["text"]) for r in found.collect())
    assert kept == [("1", ""), ("1", ""), ("1", "Other. "), ("2", ""), ("None", passage)]
    same = sorted(r["text"] for r in remove_repeats(texts([(1, passage), (1, passage)])).collect())
    assert same == [passage, passage]
    assert remove_repeats(texts([])).count() == 0


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no test tables")
def test_sql_gives_the_same(spark):
    connection = duckdb.connect()
    connection.execute("create view documents as from read_parquet('/root/testdata/sf0.001/documents.parquet')")
    wanted = connection.execute(f"select doc_id, text, removed from ({repeats_sql()})").fetchall()
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert Counter(wanted) == Counter(map(tuple, remove_repeats(documents).collect()))
    assert any(row[2] for row in wanted)


def lines_expected(rows):
    """Of each whole line with any word the earliest occurrence stays, and all that is no such line."""
    lines = {at: re.findall(r"[^\n]*\n|[^\n]+", text or "") for at, (_, text) in enumerate(rows)}
    first = {}
    for at, (doc_id, _) in enumerate(rows):
        for line in lines[at]:
            first[words_of(line)] = min(first.get(words_of(line), doc_id), doc_id)
    found = []
    for at, (doc_id, text) in enumerate(rows):
        seen, kept = set(), []
        for line in lines[at]:
            words = words_of(line)
            if not words or (first[words] == doc_id and words not in seen):
                kept.append(line)
            seen.add(words)
        found.append((doc_id, None if text is None else "".join(kept)))
    return Counter(found)


def test_repeated_whole_lines_go_however_short(texts, prose):
    passage = prose(1, 66)
    rows = [
        None,
        "",
        "Menu\nHome page\n\n" + prose(2, 20) + "\nMenu",
        "home  PAGE\n\n" + prose(3, 20) + "\n\n\nMenu\nHome page\nlast é",
        "Menu. Home page",
        "x Menu\nMenu x\n \n \n日本\n日本",
        "日本\nMenu\nlast é\n",
        "a b c. d e f\na b c.  d e f\nd e f\n",
        "\n".join([passage, "between", passage, "between"]),
    ]
    rows += [f"Header line\n{prose(i, 15)}\nFooter\n" for i in range(40, 60)]
    pairs = [(i * 5 % len(rows), text) for i, text in enumerate(rows)]
    found = remove_repeats(texts(pairs), least_run=1000, whole_lines=True).collect()
    assert Counter((r["doc_id"], r["text"]) for r in found) == lines_expected(pairs)
    for row in found:
        text = dict(pairs)[row["doc_id"]]
        if text is not None:
            spans = [tuple(map(int, span.split(":"))) for span in row["removed"].split(",") if span]
            assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
            for low, high in reversed(spans):
                text = text[:low] + text[high:]
        assert row["text"] == text


def test_whole_lines_and_runs_together(texts, prose):
    passage = prose(1, 66)
    rows = [(1, passage + "\nShort line"), (2, "Mine. " + passage + "\nSHORT line\nkept"), (3, "Short line. Mine too.")]
    found = {r["doc_id"]: (r["text"], r["removed"]) for r in remove_repeats(texts(rows), whole_lines=True).collect()}
    assert found[1] == (rows[0][1], "") and found[3] == (rows[2][1], "")
    assert found[2] == ("Mine. kept", f"6:{6 + len(passage) + 1 + 11}")
    plain = {r["doc_id"]: r["text"] for r in remove_repeats(texts(rows), least_run=30, whole_lines=False).collect()}
    assert plain[2] == "Mine. SHORT line\nkept"


def line_spans(pairs):
    """By id the spans of lines that an earlier place has."""
    seen, spans = set(), {}
    for doc_id, text in sorted(pairs):
        at, spans[doc_id] = 0, []
        for line in re.findall(r"[^\n]*\n|[^\n]+", text or ""):
            if words_of(line) and words_of(line) in seen:
                spans[doc_id].append((at, at + len(line)))
            seen.add(words_of(line))
            at += len(line)
    return spans


def test_query_removes_lines_and_runs(spark, texts, prose):
    header, inner = "Home News Contact\n", "Begin here. " + prose(7, 44) + " "
    rows = [header + prose(i, 30) + "\n" + (inner if i % 3 == 0 else "") + f"Tail {i}.\n" for i in range(30)]
    rows += ["", "\n\n", header, header * 3, "same six words in two texts", "Same six words in two texts\nmore"]
    pairs = list(enumerate(rows))
    runs = remove_repeats(texts(pairs), least_run=20, whole_lines=False).collect()
    spans = line_spans(pairs)
    for row in runs:
        own = [tuple(map(int, span.split(":"))) for span in row["removed"].split(",") if span]
        spans[row["doc_id"]] += own
    found = {r["doc_id"]: (r["text"], r["removed"]) for r in remove_repeats(texts(pairs)).collect()}
    for doc_id, text in pairs:
        gone = {at for start, end in spans[doc_id] for at in range(start, end)}
        assert found[doc_id][0] == "".join(c for at, c in enumerate(text) if at not in gone)
        listed = [tuple(map(int, span.split(":"))) for span in found[doc_id][1].split(",") if span]
        assert {at for start, end in listed for at in range(start, end)} == gone
        assert all(a[1] < b[0] for a, b in zip(listed, listed[1:]))
    assert found[34][0] == rows[34] and found[35][0] == "more"


def test_a_fixed_share_of_files_holds_the_repeated_units(spark, texts, prose):
    # As on large tables: so much in each partition that Spark joins none of them.
    shared, before = Path(spark.conf.get("spark.checkpoint.dir")), spark.conf.get("spark.sql.shuffle.partitions")
    known = set(shared.glob("repeated-units-*"))
    said = [prose(seed, 60) for seed in range(40)]
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 32)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = {r["doc_id"]: r["text"] for r in remove_repeats(texts(said + said)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    (folder,) = set(shared.glob("repeated-units-*")) - known
    assert len(list(folder.glob("*.parquet"))) <= 32 // 8
    assert [found[at] for at in range(80)] == said + [""] * 40
