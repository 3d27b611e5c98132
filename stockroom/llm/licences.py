"""Licence scans: Dice coefficient of word bigrams between units of a text and licence templates.

A unit is the whole text, a paragraph of it or a line. Everything runs in DataFrame functions.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[\p{L}\p{N}]+"

#: Notices and paragraphs of public licences (fixed values).
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
    "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 header": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "ISC grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Reserved": "All rights reserved.",
}


def numbered_bigrams_of(text: str) -> list[str]:
    """A template's word bigrams, each with how often it occurred before."""
    words = re.findall(r"[^\W_]+", text.translate(str.maketrans(UPPER, LOWER)))
    seen: Counter[str] = Counter()
    found = []
    for pair in map(" ".join, zip(words, words[1:], strict=False)):
        found.append(f"{pair}#{seen[pair]}")
        seen[pair] += 1
    return found


def bigrams(words: Column) -> Column:
    """The word bigrams of an array of words, which is short: units are pruned by their size first."""
    return F.transform(F.slice(words, 1, F.size(words) - 1), lambda word, at: F.concat_ws(" ", word, F.get(words, at + 1)))


def numbered(pairs: Column) -> Column:
    """Each bigram with how often it occurred before."""
    return F.transform(
        pairs,
        lambda pair, at: F.concat_ws(
            "#", pair, F.size(F.filter(F.slice(pairs, 1, at), lambda earlier: earlier == pair)).cast("string")
        ),
    )


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column by way of a generator, which Spark doesn't copy into the expressions that use the column."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def size_bounds(size: int, least: float) -> tuple[int, int]:
    """Sizes between which a unit must lie to reach a Dice coefficient of ``least`` with a template of ``size``.

    At most ``min(a, b)`` bigrams are shared, so ``2 * min(a, b) >= least * (a + b)``.
    """
    fits = [n for n in range(1, int(size * (2 - least) / least) + 2) if 2 * min(n, size) >= least * (n + size)]
    return fits[0], fits[-1]


def units_of(text: Column) -> Column:
    """Lines, paragraphs of several lines if there are several paragraphs, and the whole text if it has several lines."""
    lines = F.split(text, "\n", -1)
    paragraphs = F.split(text, r"\n[ \t\r]*\n", -1)

    def listed(name: str, parts: Column) -> Column:
        return F.transform(
            parts, lambda part, at: F.struct(F.lit(name).alias("unit"), at.cast("long").alias("unit_no"), part.alias("part"))
        )

    none = F.array().cast("array<struct<unit:string,unit_no:bigint,part:string>>")
    return F.concat(
        listed("line", lines),
        F.when(
            F.size(paragraphs) > 1,
            F.filter(listed("paragraph", paragraphs), lambda entry: F.contains(entry["part"], F.lit("\n"))),
        ).otherwise(none),
        F.when(F.contains(text, F.lit("\n")), listed("text", F.array(text))).otherwise(none),
    )


def find_licences(
    documents: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    least: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each unit and template with a Dice coefficient of at least ``least``.

    ``n_bigrams`` counts the unit's word bigrams with repetitions; so does the coefficient. Case (A-Z) and everything but
    letters and numbers is ignored. A template is a candidate only for units whose size allows the coefficient: sizes and
    templates meet in a join with a table that has, per template, a row for each size that fits. It is broadcast, as its
    size is that of the templates.

    NULL and empty texts, and units of fewer than two words, match nothing. Repeated rows match each. An empty table gives
    no rows; further columns are ignored.
    """
    spark = documents.sparkSession
    prepared = {name: numbered_bigrams_of(text) for name, text in sorted(templates.items())}
    prepared = {name: found for name, found in prepared.items() if found}
    fitting = [
        (n, name, found, sorted({pair.rsplit("#", 1)[0] for pair in found}))
        for name, found in prepared.items()
        for n in range(size_bounds(len(found), least)[0], size_bounds(len(found), least)[1] + 1)
    ]
    sizes = F.broadcast(spark.createDataFrame(fitting, "n_bigrams long, licence string, wanted array<string>, any_of array<string>"))
    smallest = min((n for n, *_ in fitting), default=1)
    largest = max((n for n, *_ in fitting), default=0)
    units = (
        documents.where(F.col(text_column).isNotNull())
        .select(F.col(id_column).alias("doc_id"), F.inline(units_of(F.col(text_column))))
        .withColumn("n_bigrams", (F.regexp_count("part", F.lit(WORD)) - 1).cast("long"))
        .where(F.col("n_bigrams").between(smallest, largest))
    )
    shared = F.size(F.array_intersect(F.col("found"), F.col("wanted")))
    words = F.regexp_extract_all(F.translate("part", UPPER, LOWER), F.lit(WORD), F.lit(0))
    rows = once(once(units, "words", words), "pairs", bigrams(F.col("words")))
    # Most units share no bigram with a template of their size; repetitions are told apart in the others only.
    rows = rows.join(sizes, "n_bigrams").where(F.arrays_overlap("pairs", "any_of"))
    rows = once(rows, "found", numbered(F.col("pairs")))
    rows = once(rows, "dice", 2.0 * shared / (F.size("found") + F.size("wanted")))
    return rows.where(F.col("dice") >= least).select("doc_id", "unit", "unit_no", "licence", "n_bigrams", "dice")


def licence_sql(templates: Mapping[str, str] = TEMPLATES, least: float = 0.8) -> str:
    """SQL that gives the same rows from the table ``documents``."""
    values = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in sorted(templates.items()))
    words = rf"regexp_extract_all(translate(part, '{UPPER}', '{LOWER}'), '[\p{{L}}\p{{N}}]+')"
    return rf"""
with texts as (select row_number() over () as row_id, doc_id, text from documents where text is not null),
lines as (select row_id, doc_id, string_split(text, chr(10)) as parts from texts),
paragraphs as (select row_id, doc_id, regexp_split_to_array(text, '\n[ \t\r]*\n') as parts from texts),
units as (
  select row_id, doc_id, 'line' as unit, unnest(range(len(parts))) as unit_no, unnest(parts) as part from lines
  union all
  select * from (select row_id, doc_id, 'paragraph', unnest(range(len(parts))) as unit_no, unnest(parts) as part
    from paragraphs where len(parts) > 1) where contains(part, chr(10))
  union all
  select row_id, doc_id, 'text', 0, text from texts where contains(text, chr(10))
),
templates as (select * from (values {values}) as t(licence, part)),
parts as (
  select *, {words} as words, row_number() over () as part_id from (
    select row_id, doc_id, unit, unit_no, part, null as licence from units
    union all
    select null, null, 'template', 0, part, licence from templates)
),
sized as (select *, len(words) - 1 as n_bigrams from parts where len(words) > 1),
limits as (select max(n_bigrams) * (2 - {least}) / {least} + 1 as most from sized where unit = 'template'),
pairs as (
  select part_id, unnest(list_zip(words[:-2], words[2:])) as pair from sized where n_bigrams <= (select most from limits)
),
numbered as (select part_id, pair, row_number() over (partition by part_id, pair) as nth from pairs),
shared as (
  select a.part_id as unit_id, b.part_id as template_id, count(*) as n
  from numbered a join numbered b on a.pair = b.pair and a.nth = b.nth
  where b.part_id in (select part_id from sized where unit = 'template')
    and a.part_id in (select part_id from sized where unit <> 'template')
  group by all
)
select u.doc_id, u.unit, cast(u.unit_no as bigint) as unit_no, t.licence, cast(u.n_bigrams as bigint) as n_bigrams,
  2.0::double * s.n / (u.n_bigrams + t.n_bigrams) as dice
from shared s join sized u on u.part_id = s.unit_id join sized t on t.part_id = s.template_id
where 2.0::double * s.n / (u.n_bigrams + t.n_bigrams) >= {least}
"""
