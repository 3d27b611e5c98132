"""URL filters: host and path rules first, gradient-boosted trees on lexical features for the rest.

Everything runs in DataFrame functions and Spark's own tree learner.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.registry import packed, stored, unpacked

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = [
    "f_length",
    "f_host_length",
    "f_path_length",
    "f_depth",
    "f_labels",
    "f_digit_ratio",
    "f_hyphens",
    "f_entropy",
    "f_parameters",
    "f_longest_part",
    "f_suffix_share",
    "f_suffix_rows",
    "f_domain_share",
    "f_domain_rows",
]


@dataclass(frozen=True)
class Rule:
    """``name`` is a host, with all its subdomains, followed by the start of a path."""

    verdict: str
    name: str

    @property
    def host(self) -> str:
        return self.name.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.name.split("/", 1)[1]


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, with A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, or NULL."""
    fitting = [
        F.when(
            ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path),
            F.lit(rule.name),
        )
        for rule in sorted(rules, key=lambda rule: (-len(rule.name), rule.name))
    ]
    return F.coalesce(*fitting, F.lit(None).cast("string"))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    length = F.length(url)
    characters = F.filter(F.split(url, ""), lambda c: c != "")
    # The sum of c * log2(c) over the counts c of the distinct characters.
    weighted = F.aggregate(
        F.transform(F.array_distinct(characters), lambda c: length - F.length(F.replace(url, c, F.lit("")))),
        F.lit(0.0),
        lambda total, count: total + count * F.log2(count.cast("double")),
    )
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "f_length": length,
        "f_host_length": F.length(host),
        "f_path_length": F.length(path),
        "f_depth": F.size(F.filter(F.split(path, "/"), lambda part: part != "")),
        "f_labels": F.size(F.split(host, r"\.")),
        "f_digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(length, F.lit(1)),
        "f_hyphens": F.regexp_count(host, F.lit("-")),
        "f_entropy": F.when(length > 0, F.log2(length.cast("double")) - weighted / length).otherwise(0.0),
        "f_parameters": F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1),
        "f_longest_part": F.array_max(F.transform(F.split(F.concat(host, path), r"[/.]"), F.length)),
    }


def suffix_of(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def suffix_statistics(labelled: DataFrame, suffix: Column, share: str, rows: str) -> DataFrame:
    """Of each suffix: the smoothed share of blocked URLs, and the logarithm of the number of labelled ones."""
    return labelled.groupBy(suffix.alias("suffix_key")).agg(
        ((F.sum("is_blocked") + 1.0) / (F.count("*") + 2.0)).alias(share),
        F.log1p(F.count("*").cast("double")).alias(rows),
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    url_column: str = "url",
    max_training_rows: int = 40_000,
    trees: int = 20,
    depth: int = 4,
    seed: int = 7,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``block_score`` to every page.

    URLs that a rule fits are the labelled ones. From about ``max_training_rows`` of them (the sample is drawn by the
    URL's hash; suffix statistics use all) the trees learn to tell blocked from allowed ones, and judge the URLs that no
    rule fits. Without labelled URLs of both kinds the verdict is the only kind there is, or ``allow``.

    A NULL URL, or one without ``://``, has an empty host and path and is judged by the trees. Repeated rows are judged
    alike; an empty table gives no rows; further columns are kept, except those named like a result, which is replaced.
    """
    url = F.coalesce(F.col("url_text"), F.lit(""))
    verdict_of = F.create_map(*[F.lit(x) for rule in rules for x in (rule.name, rule.verdict)])
    judged = (
        pages.select(packed(pages), F.col(f"`{url_column}`").alias("url_text"))
        .withColumns({"host": url_host(url), "path": url_path(url)})
        .withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    )
    labelled = judged.where(F.col("rule").isNotNull()).select(
        "url_text", "host", "path", (verdict_of[F.col("rule")] == "block").cast("int").alias("is_blocked")
    )
    kinds = {row[0]: row[1] for row in labelled.groupBy("is_blocked").count().collect()}
    ruled = F.when(F.col("rule").isNotNull(), verdict_of[F.col("rule")])
    if len(kinds) < 2:
        only = "block" if set(kinds) == {1} else "allow"
        verdict, score = F.coalesce(ruled, F.lit(only)), F.lit(float(only == "block"))
        return judged.select(*unpacked(pages, _result(verdict, score)))

    tables = [
        (
            stored(
                suffix_statistics(labelled, suffix_of(F.col("host"), size), f"f_{kind}_share", f"f_{kind}_rows"),
                f"url-{kind}",
            ),
            size,
            kind,
        )
        for size, kind in ((1, "suffix"), (2, "domain"))
    ]

    def with_features(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns(lexical_features(url, F.col("host"), F.col("path")))
        for statistics, size, kind in tables:
            rows = (
                rows.withColumn("suffix_key", suffix_of(F.col("host"), size))
                .join(statistics, "suffix_key", "left")
                .fillna({f"f_{kind}_share": 0.5, f"f_{kind}_rows": 0.0})
                .drop("suffix_key")
            )
        return rows

    share = min(1.0, max_training_rows / sum(kinds.values()))
    drawn = labelled.where(F.pmod(F.xxhash64("url_text"), F.lit(1_000_000)) < int(share * 1_000_000))
    training = stored(with_features(drawn).select("is_blocked", *FEATURES), "url-training").repartition(8)
    vector = VectorAssembler(inputCols=FEATURES, outputCol="url_features")
    learner = GBTClassifier(
        featuresCol="url_features",
        labelCol="is_blocked",
        predictionCol="url_class",
        maxIter=trees,
        maxDepth=depth,
        seed=seed,
    )
    learner.setProbabilityCol("url_probability").setRawPredictionCol("url_raw")
    model = learner.fit(vector.transform(training))
    scored = model.transform(vector.transform(with_features(judged)))
    predicted = F.when(F.col("url_class") == 1.0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        *unpacked(pages, _result(F.coalesce(ruled, predicted), vector_to_array("url_probability")[1]))
    )


def _result(verdict: Column, score: Column) -> dict[str, Column]:
    return {**{name: F.col(name) for name in ("host", "path", "rule")}, "verdict": verdict, "block_score": score}
