"""Personal data: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Spans and votes are DataFrame expressions. Only counts of vote patterns, of which there is a fixed number, reach the
driver. Places are code points, the end exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.registry import packed, stored, unpacked

KINDS = ("email", "ip", "card", "phone")

#: The base patterns, written so that a search takes time in proportion to the text: a run of digits or of address
#: characters is tried from its start only, or from the end of the match before it, and repeats give nothing back.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Further candidates: spelt-out addresses, card and phone numbers that stand beside other numbers, numbers without a plus.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+"
    r"(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}+)++",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}+|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}+)(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+().-])(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
#: Card numbers that end a row of numbers, and numbers with a plus that begin one.
ROWS_OF_NUMBERS = {
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![ -]?[0-9A-Za-z])",
    "phone": r"\+[0-9]{1,3}[ .-](?:\(?[0-9]{2,4}\)?[ .-]){1,2}[0-9]{3,4}(?![0-9])",
}
#: What must stand in a text for a pattern to be tried.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
NEEDED_LOOSE = {"email": r"[(\[]at[)\]]", "card": "[0-9]{4}[ -]?[0-9]{4}", "phone": "[0-9]{3}[ .-][0-9]{4}"}

#: Words that speak for or against a kind when they stand just before a span.
CONTEXT_FOR = {
    "email": r"\b(e-?mail|mail|contact|write|reach|address)\b",
    "ip": r"\b(ip|ipv4|host|server|address|from|client|node|ping)\b",
    "card": r"\b(card|visa|mastercard|amex|credit|debit|payment|pay|cc)\b",
    "phone": r"\b(phone|tel|telephone|call|mobile|cell|fax|sms|contact)\b",
}
CONTEXT_AGAINST = {
    "email": r"\b(git|ssh|user|version)\b",
    "ip": r"\b(version|release|section|chapter|build|v)\b",
    "card": r"\b(token|order|invoice|serial|isbn|tracking|id|password)\b",
    "phone": r"\b(order|invoice|serial|isbn|part|version|token|password)\b",
}
#: Gazetteers: top-level domains, issuer prefixes and country codes in common use (fixed values).
TOP_DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|co|me|app|dev|ai|de|fr|es|it|nl|uk|us|ca|eu|ch|at|be|br|in|jp|cn|ru"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38)"
COUNTRY_CODES = r"^\+(1|7|2[07]|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"

VOTERS = ("pattern", "validity", "gazetteer", "context", "shape")
#: How much each labeler counts before reliabilities are estimated.
FIRST_WEIGHTS = (2.0, 2.0, 0.5, 1.0, 0.5)
#: Characters before a span that the context labeler reads.
CONTEXT = 32

SPAN = "struct<kind:int,start:int,end:int,base:boolean,votes:array<int>,surface:int>"


#: Characters of a text that are cut off at once, to get at places in it without counting from its start.
CHUNK = 256


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it, in functions of array elements too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(numbers: Column, first: int, merge: Callable[[Column, Column], Column]) -> Column:
    """Of an array of integers at each place the merge of all up to there. Totals of blocks keep the work near the array's
    length."""
    block = 64

    def merged(array: Column, start: Column, count: Column, before: Column) -> Column:
        return F.aggregate(F.slice(array, start, count), before, merge)

    def places(array: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(array) - 1) / block).cast("int"))
        totals = F.transform(blocks, lambda at: merged(array, at * block + 1, F.lit(block), F.lit(first)))
        offsets = bound(totals, lambda all_: F.transform(all_, lambda _, at: merged(all_, F.lit(1), at, F.lit(first))))

        def of_block(at: Column) -> Column:
            return F.floor(at / block).cast("int")

        return bound(
            offsets,
            lambda before: F.transform(
                array,
                lambda _, at: merged(array, of_block(at) * block + 1, at % block + 1, F.get(before, of_block(at))),
            ),
        )

    return bound(
        numbers, lambda array: F.when(F.size(array) > 0, places(array)).otherwise(F.array().cast("array<int>"))
    )


def prefix_sums(numbers: Column) -> Column:
    """Running totals, the own number included."""
    return running(numbers, 0, lambda sum_, x: sum_ + x)


def prefix_maxima(numbers: Column) -> Column:
    """At each place the greatest number up to there; numbers are not negative."""
    return running(numbers, -1, lambda most, x: F.greatest(most, x))


def chunks_of(text: Column) -> Column:
    """The text in pieces of so many code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def between(chunks: Column, start: Column, end: Column) -> Column:
    """What stands from ``start`` to before ``end``, which is not before it."""
    first = F.floor(start / CHUNK).cast("int")
    joined = F.array_join(F.slice(chunks, first + 1, F.floor(end / CHUNK).cast("int") - first + 1), "")
    return F.substr(joined, start - first * CHUNK + 1, end - start)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Every second digit from the right counts double, less 9 beyond 9; the sum is a multiple of ten."""
    total = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda digit, at: F.when(at % 2 == 0, digit.cast("int")).otherwise(
                digit.cast("int") * 2 - F.when(digit.cast("int") > 4, 9).otherwise(0)
            ),
        ),
        F.lit(0),
        lambda sum_, x: sum_ + x,
    )
    return F.coalesce(total % 10 == 0, F.lit(False))


def is_valid(kind: str, found: Column) -> Column:
    """Whether a match of a base pattern counts."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return found.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$")
    count = F.length(_digits(found))
    if kind == "card":
        return F.when(count.between(12, 19), passes_luhn(F.when(count.between(12, 19), _digits(found)))).otherwise(
            F.lit(False)
        )
    return count.between(9, 15)


def _votes(kind: str, found: Column, before: Column, base: Column) -> Column:
    """One vote per labeler: 1 for, -1 against, 0 none."""

    def vote(yes: Column, no: Column | None = None) -> Column:
        return F.when(yes, 1).when(~yes if no is None else no, -1).otherwise(0)

    digits, count = _digits(found), F.length(_digits(found))
    if kind == "email":
        gazetteer = vote(F.lower(found).rlike(rf"[.\])] ?({TOP_DOMAINS})$"))
        validity = vote(found.contains("@") | found.rlike(r"[(\[]dot[)\]]"))
        shape = vote(found.rlike("^[^@]*[A-Za-z][^@]*@") | found.rlike(r"[(\[]dot[)\]]"), found.rlike("^[^A-Za-z]*@"))
        pattern = vote(base)
    elif kind == "ip":
        gazetteer = vote(found.rlike(r"^([1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\."))
        validity = vote(F.coalesce(is_valid("ip", found), F.lit(False)))
        shape = vote(found.rlike(r"^(0|[1-9][0-9]*)(\.(0|[1-9][0-9]*)){3}$"))
        pattern = vote(base)
    elif kind == "card":
        validity = vote(F.coalesce(is_valid("card", found), F.lit(False)))
        gazetteer = vote(digits.rlike(ISSUERS))
        shape = vote(
            found.rlike("^([0-9]{13,16}|[0-9]{4}([ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"),
        )
        # Beside other numbers the base pattern matches too much; the check digit is what it tests.
        pattern = vote(base | F.coalesce(is_valid("card", found), F.lit(False)))
    else:
        gazetteer = vote(found.rlike(COUNTRY_CODES), found.startswith("+"))
        validity = vote(count.between(9, 15))
        shape = vote(count.between(10, 13) & found.rlike("[ ().-]"), ~count.between(8, 15))
        pattern = vote(base | (found.startswith("+") & count.between(9, 15)))
    context = F.when(before.rlike(CONTEXT_AGAINST[kind]), -1).when(before.rlike(CONTEXT_FOR[kind]), 1).otherwise(0)
    return F.array(pattern, validity, gazetteer, context, shape)


def _surface(found: Column) -> Column:
    """A small code of a span's look, of which there are few: its length, and what it has besides digits."""
    return (
        F.least(F.floor(F.length(found) / 4), F.lit(9)).cast("int") * 8
        + found.rlike("[A-Za-z]").cast("int") * 4
        + found.rlike("[ ().-]").cast("int") * 2
        + found.startswith("+").cast("int")
    )


def _matches(text: str, kind: str, pattern: str, needed: str, name: str) -> tuple[dict, dict, dict]:
    """Columns of one pattern's matches, in three steps, each of which uses the one before."""
    tried = F.contains(F.col(text), F.lit(needed)) if needed == "@" else F.col(text).rlike(needed)
    none = F.array().cast("array<string>")
    found = {f"{name}_found": F.when(tried, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)}
    gaps = F.when(F.size(f"{name}_found") > 0, F.split(text, pattern, -1)).otherwise(none)
    steps = {
        f"{name}_steps": F.zip_with(
            F.slice(F.transform(gaps, F.length), 1, F.size(f"{name}_found")),
            F.concat(F.array(F.lit(0)), F.transform(F.col(f"{name}_found"), F.length)),
            lambda gap, length: F.coalesce(gap, F.lit(0)) + F.coalesce(length, F.lit(0)),
        )
    }
    starts = {f"{name}_starts": prefix_sums(F.slice(F.col(f"{name}_steps"), 1, F.size(f"{name}_found")))}
    return found, steps, starts


def _spans(text: str, kind: str, name: str, is_base: bool) -> Column:
    """The spans of one pattern with votes; ``base`` marks those that count as they are."""

    def span(found: Column, start: Column, chunks: Column) -> Column:
        base = is_valid(kind, found) if is_base else F.lit(False)
        before = F.lower(between(chunks, F.greatest(start - CONTEXT, F.lit(0)), start))
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            start.alias("start"),
            (start + F.length(found)).alias("end"),
            base.alias("base"),
            _votes(kind, found, before, base).alias("votes"),
            _surface(found).alias("surface"),
        )

    spans = bound(
        chunks_of(F.col(text)),
        lambda chunks: F.zip_with(f"{name}_found", f"{name}_starts", lambda found, start: span(found, start, chunks)),
    ).cast(f"array<{SPAN}>")
    return F.when(F.size(f"{name}_found") > 0, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def _apart(spans: Column, bases: Column) -> Column:
    """The spans that touch none of the bases. In one order of a span's ends and the bases' starts, the greatest end of the
    bases that begin before a span ends tells whether one of them reaches into it."""
    marks = F.concat(
        F.transform(
            bases,
            lambda s: F.struct(
                s["start"].alias("at"), F.lit(1).alias("is_base"), s["end"].alias("reach"), F.lit(None).cast(SPAN).alias("span")
            ),
        ),
        F.transform(
            spans,
            lambda s: F.struct(s["end"].alias("at"), F.lit(0).alias("is_base"), F.lit(-1).alias("reach"), s.alias("span")),
        ),
    )
    reached = bound(
        F.array_sort(marks),
        lambda all_: F.zip_with(
            all_,
            prefix_maxima(F.transform(all_, lambda mark: mark["reach"])),
            lambda mark, most: F.struct(mark["span"].alias("span"), (most <= mark["span"]["start"]).alias("apart")),
        ),
    )
    return F.transform(F.filter(reached, lambda mark: mark["apart"]), lambda mark: mark["span"])


def candidate_spans(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add ``pii_base``, the sorted base spans, and ``pii_others``, further candidates that touch none of these.

    All base matches and loose matches are candidates. A NULL text counts as empty and has none.
    """
    columns = documents.columns
    rows = documents.withColumn("pii_text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    parts = [(kind, BASE[kind], NEEDED[kind], f"base_{kind}", True) for kind in KINDS]
    parts += [(kind, LOOSE[kind], NEEDED_LOOSE[kind], f"loose_{kind}", False) for kind in LOOSE]
    parts += [(kind, ROWS_OF_NUMBERS[kind], NEEDED[kind], f"row_{kind}", False) for kind in ROWS_OF_NUMBERS]
    steps = [_matches("pii_text", kind, pattern, needed, name) for kind, pattern, needed, name, _ in parts]
    for step in range(3):
        rows = rows.withColumns({key: value for columns_of in steps for key, value in columns_of[step].items()})
    spans = F.concat(*[_spans("pii_text", kind, name, is_base) for kind, _, _, name, is_base in parts])
    rows = rows.withColumn("pii_all", spans)
    rows = rows.withColumn("pii_base", _in_order(F.filter("pii_all", lambda span: span["base"])))
    others = _apart(F.filter("pii_all", lambda span: ~span["base"]), F.col("pii_base"))
    return rows.select(*[F.col(f"`{c}`") for c in columns], "pii_base", _once(_in_order(others)).alias("pii_others"))


def _in_order(spans: Column) -> Column:
    keyed = F.transform(
        spans,
        lambda s: F.struct(s["start"], s["kind"], s["end"], s["base"], s["votes"], s["surface"]),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(s["kind"], s["start"], s["end"], s["base"], s["votes"], s["surface"]),
    )


def _once(spans: Column) -> Column:
    """Sorted spans, those that repeat the one before left out."""
    return bound(
        spans, lambda all_: F.filter(all_, lambda span, at: (at == 0) | ~span.eqNullSafe(F.get(all_, at - 1)))
    )


@dataclass(frozen=True)
class SpanModel:
    """Weights of the final classifier, by kind: of the votes (for, against) and of the surface codes."""

    bias: Mapping[int, float]
    votes: Mapping[int, Sequence[tuple[float, float]]]
    surfaces: Mapping[int, Mapping[int, float]]

    def probability(self, span: Column) -> Column:
        total = F.lit(0.0)
        for kind in range(len(KINDS)):
            logit = F.lit(self.bias[kind])
            for at, (yes, no) in enumerate(self.votes[kind]):
                vote = F.get(span["votes"], F.lit(at))
                logit = logit + F.when(vote == 1, yes).when(vote == -1, no).otherwise(0.0)
            surfaces = self.surfaces[kind]
            if surfaces:
                table = F.create_map(*[F.lit(x) for code, weight in sorted(surfaces.items()) for x in (code, weight)])
                logit = logit + F.coalesce(F.try_element_at(table, span["surface"]), F.lit(0.0))
            total = F.when(span["kind"] == kind, logit).otherwise(total)
        return 1 / (1 + F.exp(-total))


def vote_counts(candidates: DataFrame) -> list:
    """How often each combination of kind, votes and surface occurs among all candidates: a table of bounded size."""
    spans = candidates.select(F.explode(F.concat("pii_base", "pii_others")).alias("span"))
    counted = spans.groupBy("span.kind", "span.votes", "span.surface").agg(F.count("*").alias("n"))
    return sorted((row["kind"], tuple(row["votes"]), row["surface"], row["n"]) for row in counted.collect())


def estimate_reliabilities(
    counts: Iterable[tuple[tuple[int, ...], float]], rounds: int = 50
) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """The share of true spans, and for each labeler and vote its probability for true and for false spans.

    Expectation-maximisation from the labelers' weighted majority. Labelers err independently of each other, given the truth.
    """
    counts = list(counts)
    belief = {
        votes: 1 / (1 + math.exp(-sum(w * v for w, v in zip(FIRST_WEIGHTS, votes, strict=True)))) for votes, _ in counts
    }
    share, tables = 0.5, []
    for _ in range(rounds):
        total = sum(n for _, n in counts)
        true = sum(n * belief[votes] for votes, n in counts)
        share = (true + 1) / (total + 2)
        tables = []
        for at in range(len(VOTERS)):
            sums = {vote: [0.5, 0.5] for vote in (-1, 0, 1)}
            # A labeler is taken to be better than chance: its votes start with this much evidence.
            sums[1][0] += 2
            sums[-1][1] += 2
            for votes, n in counts:
                sums[votes[at]][0] += n * belief[votes]
                sums[votes[at]][1] += n * (1 - belief[votes])
            all_true, all_false = (sum(pair[i] for pair in sums.values()) for i in (0, 1))
            tables.append({vote: (pair[0] / all_true, pair[1] / all_false) for vote, pair in sums.items()})
        for votes, _ in counts:
            logit = math.log(share / (1 - share))
            logit += sum(math.log(tables[at][vote][0] / tables[at][vote][1]) for at, vote in enumerate(votes))
            belief[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
    return share, tables


def fit_span_model(counts: Sequence[tuple[int, tuple[int, ...], int, int]], steps: int = 300) -> SpanModel:
    """Reliabilities by expectation-maximisation, then a logistic classifier on votes and surface, by kind.

    Its targets are the probabilities that the weighed votes give; it is fitted to the counted patterns.
    """
    bias: dict[int, float] = {}
    weights: dict[int, list[tuple[float, float]]] = {}
    surfaces: dict[int, dict[int, float]] = {}
    for kind in range(len(KINDS)):
        own = [(votes, surface, n) for k, votes, surface, n in counts if k == kind]
        merged: dict[tuple[int, ...], float] = {}
        for votes, _, n in own:
            merged[votes] = merged.get(votes, 0) + n
        if not merged:
            bias[kind], weights[kind], surfaces[kind] = -1.0, [(0.0, 0.0)] * len(VOTERS), {}
            continue
        share, tables = estimate_reliabilities(sorted(merged.items()))

        def target(votes: tuple[int, ...], share=share, tables=tables) -> float:
            logit = math.log(share / (1 - share))
            logit += sum(math.log(tables[at][v][0] / tables[at][v][1]) for at, v in enumerate(votes))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))

        # Start from the weighed votes, then fit the surface beside them.
        w = [[math.log(t[1][0] / t[1][1]), math.log(t[-1][0] / t[-1][1])] for t in tables]
        b = math.log(share / (1 - share))
        look = {surface: 0.0 for _, surface, _ in own}
        total = sum(n for _, _, n in own)
        for _ in range(steps):
            gb, gw, gl = 0.0, [[0.0, 0.0] for _ in VOTERS], dict.fromkeys(look, 0.0)
            for votes, surface, n in own:
                logit = b + look[surface] + sum(w[at][0 if v == 1 else 1] for at, v in enumerate(votes) if v)
                error = (1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))) - target(votes)) * n / total
                gb += error
                gl[surface] += error
                for at, v in enumerate(votes):
                    if v:
                        gw[at][0 if v == 1 else 1] += error
            b -= gb
            look = {s: value - gl[s] - 0.001 * value for s, value in look.items()}
            w = [[x - g for x, g in zip(pair, grads, strict=True)] for pair, grads in zip(w, gw, strict=True)]
        bias[kind], weights[kind], surfaces[kind] = b, [tuple(pair) for pair in w], look
    return SpanModel(bias, weights, surfaces)


def decide(candidates: DataFrame, model: SpanModel, least: float = 0.5) -> DataFrame:
    """Add ``pii_spans``: all base spans, and the others that the model takes for personal data."""
    added = F.filter("pii_others", lambda span: model.probability(span) >= least)
    return candidates.withColumn("pii_spans", _in_order(F.concat("pii_base", added)))


def spans_text(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def find_personal_data(documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document its counts of base spans, their digest, and all spans as ``kind:start:end``.

    Labelers and classifier learn from the candidates of all documents. NULL and empty texts have no spans. Repeated rows
    each give a row; an empty table gives none; further columns are ignored. Candidates are stored without texts, so
    these are searched once.
    """
    found = stored(
        candidate_spans(documents.select(F.col(id_column).alias("doc_id"), "text")).drop("text"), "pii-candidates"
    )
    decided = decide(found, fit_span_model(vote_counts(found)))
    return decided.select(
        "doc_id",
        *[
            F.size(F.filter(F.transform("pii_base", lambda span: span["kind"]), F.lit(at).__eq__))
            .cast("long")
            .alias(f"n_{kind}")
            for at, kind in enumerate(KINDS)
        ],
        F.sha2(spans_text(F.col("pii_base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("pii_spans")).alias("spans"),
    )


def redact(documents: DataFrame, text: str = "text") -> DataFrame:
    """Replace each span of personal data by its kind in angle brackets; touching and overlapping spans become one.

    A text without personal data stays as it is, a NULL text NULL. The texts are searched twice, once for the votes.
    """
    found = candidate_spans(documents.select(packed(documents, text), F.col(f"`{text}`").alias("text")))
    model = fit_span_model(vote_counts(found))
    names = F.array(*[F.lit(f"<{kind}>") for kind in KINDS])
    # Spans in order of start; one that begins before an earlier one's end belongs to it.
    reached = F.concat(
        F.array(F.lit(0)), bound(F.col("pii_spans"), lambda all_: prefix_maxima(F.transform(all_, lambda s: s["end"])))
    )

    def piece(chunks: Column, span: Column, so: Column) -> Column:
        own = F.concat(between(chunks, so, span["start"]), F.get(names, span["kind"]))
        return F.when(span.isNotNull() & (span["start"] >= so), own).otherwise(F.lit(""))

    pieces = bound(
        chunks_of(F.col("text")),
        lambda chunks: F.zip_with("pii_spans", "pii_reached", lambda span, so: piece(chunks, span, so)),
    )
    last = F.coalesce(F.array_max(F.transform("pii_spans", lambda s: s["end"])), F.lit(0))
    clean = F.concat(F.concat_ws("", pieces), F.substr("text", last + 1, F.length("text")))
    masked = F.when(F.size("pii_spans") > 0, clean).otherwise(F.col("text"))
    return decide(found, model).withColumn("pii_reached", reached).select(*unpacked(documents, {text: masked}))
