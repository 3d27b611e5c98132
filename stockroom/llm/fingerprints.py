"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text is cut into units (words, long ones into pieces); the k-mers of its units are numbered by their occurrence, so that
a repeated k-mer counts each time. Every slot has a hash order of its own and selects minimal numbered k-mers under it, puts
them back into text order and hashes that tuple. Two texts share a slot if they share the selected k-mers and have them in
the same order, so the share of equal slots falls with their edit distance.

The numbered k-mers are split into as many parts as a tuple has members, by a hash that no order uses, and a slot selects the
minimum of each part: so many different k-mers, found by plain minima in one pass.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.registry import stored

#: Words are cut into pieces of so many characters, so that texts without spaces have many units as well.
UNIT = r"[^\x20\x09-\x0D]{1,16}"
#: A k-mer is packed into one long: the upper bits of its hash, and its place in the lower bits.
PLACE_BITS, HASH_BITS = 28, 35
#: An order multiplies 31 bits of a numbered k-mer's hash by an odd number and compares the lower 32 bits of the product,
#: which tell the k-mer as well. Their product with the factor always fits into a long.
NUMBERED_BITS, ORDER_BITS = 31, 32
#: The lower bits of a numbered k-mer's hash, which tell its part.
PART_BITS = 20


def numbered_kmers(units: Column, k: int) -> Column:
    """Sorted longs of hash and place of each k-mer of consecutive units; those at the end are shorter."""
    hashes = F.transform(
        units,
        lambda unit, at: F.shiftleft(
            F.shiftrightunsigned(F.xxhash64(unit, *[F.get(units, at + F.lit(i)) for i in range(1, k)]), 64 - HASH_BITS),
            PLACE_BITS,
        ).bitwiseOR(at.cast("long")),
    )
    return F.sort_array(hashes)


def occurrences(kmers: Column, starts: Column) -> Column:
    """Of each sorted k-mer, how many equal ones stand before it. ``starts`` has the first place of each run."""
    return F.flatten(
        F.transform(
            starts,
            lambda start, at: F.sequence(
                F.lit(0), F.coalesce(F.get(starts, at + F.lit(1)), F.size(kmers)) - start - F.lit(1)
            ),
        )
    )


def run_starts(kmers: Column) -> Column:
    places = F.when(F.size(kmers) > 0, F.sequence(F.lit(0), F.size(kmers) - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.filter(
        places,
        lambda at: (at == 0)
        | (
            F.shiftright(F.get(kmers, at), PLACE_BITS)
            != F.shiftright(F.get(kmers, F.greatest(at - F.lit(1), F.lit(0))), PLACE_BITS)
        ),
    )


def fingerprint_slots(
    texts: DataFrame, keys: Sequence[str], text: str, slots: int, size: int, k: int, seed: int
) -> DataFrame:
    """One row per combination of ``keys``, which must tell the rows apart, with ``slot_values`` as array of longs.

    The k-mers become rows that are reduced at once to one minimum per part and order, so no array is searched repeatedly.
    A text with k-mers in some parts only has shorter tuples; one without k-mers has the same value in all slots.
    """
    draw = random.Random(seed)
    factors = [draw.getrandbits(ORDER_BITS) | 1 for _ in range(slots)]
    rows = (
        texts.withColumn("fp_units", F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)))
        .select(*keys, numbered_kmers(F.col("fp_units"), k).alias("fp_kmers"))
        .withColumn("fp_starts", run_starts(F.col("fp_kmers")))
        .withColumn("fp_times", occurrences(F.col("fp_kmers"), F.col("fp_starts")))
        .select(*keys, F.inline_outer(F.arrays_zip("fp_kmers", "fp_times")))
    )
    whole = F.when(F.col("fp_kmers").isNotNull(), F.xxhash64(F.shiftright("fp_kmers", PLACE_BITS), F.col("fp_times")))
    numbered = rows.select(
        *keys,
        whole.alias("fp_hash"),
        F.col("fp_kmers").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("fp_place"),
    ).select(
        *keys,
        F.shiftrightunsigned("fp_hash", 64 - NUMBERED_BITS).alias("fp_kmer"),
        (F.col("fp_hash").bitwiseAND(F.lit((1 << PART_BITS) - 1)) % F.lit(size)).alias("fp_part"),
        "fp_place",
    )
    minima = []
    for order, factor in enumerate(factors):
        key = (F.col("fp_kmer") * F.lit(factor)).bitwiseAND(F.lit((1 << ORDER_BITS) - 1))
        minima.append(F.min(F.shiftleft(key, PLACE_BITS).bitwiseOR(F.col("fp_place"))).alias(f"fp_{order}"))
    parts = numbered.groupBy(*keys, "fp_part").agg(*minima)
    # The place goes to the upper bits, so that sorting a tuple puts it into text order.
    by_place = [
        F.shiftleft(F.col(f"fp_{order}").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)), ORDER_BITS).bitwiseOR(
            F.shiftright(f"fp_{order}", PLACE_BITS)
        )
        for order in range(slots)
    ]
    selected = parts.select(*keys, F.array(*by_place).alias("fp_selected"))
    # At most ``size`` arrays of fixed length.
    gathered = selected.groupBy(*keys).agg(F.collect_list("fp_selected").alias("fp_parts"))

    def slot_value(order: Column) -> Column:
        in_text_order = F.sort_array(F.transform("fp_parts", lambda chosen: F.get(chosen, order)))
        kmers = F.transform(in_text_order, lambda entry: entry.bitwiseAND(F.lit((1 << ORDER_BITS) - 1)))
        return F.xxhash64(kmers).bitwiseAND(F.lit(0xFFFFFFFF))

    values = F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), slot_value)
    return gathered.select(*keys, values.alias("slot_values"))


def likeness(one: Column, other: Column) -> Column:
    """The share of equal slots."""
    equal = F.filter(F.zip_with(one, other, lambda x, y: x == y), lambda same: same)
    return F.size(equal) / F.size(one)


def as_text(slots: Column) -> Column:
    return F.concat_ws("", F.transform(slots, lambda value: F.lpad(F.lower(F.hex(value)), 8, "0")))


def edited_and_next(
    documents: DataFrame, slots: int = 64, size: int = 2, k: int = 2, seed: int = 11, id_column: str = "doc_id"
) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to each other and to the next document's.

    The edited text has its last half replaced by the start of the next document in ascending order of id (after the last
    one comes the first). Documents are dealt to ranges of ids, each with its successor's first document beside it, so
    one shuffle by range serves neighbours and fingerprints.

    A NULL text counts as empty, and empty texts are alike. Rows with one id follow each other by the hash of their text,
    and an id with very many rows is cut into ranges of that hash; a NULL id comes first. Repeated rows each give a row. A
    single document is its own successor. An empty table gives no rows. Long texts are fingerprinted whole; their k-mers
    are rows, of which a task holds one at a time. Further columns are ignored.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).withColumns({"id_key": F.coalesce("doc_id", F.lit(-(1 << 63))), "text_key": F.xxhash64("text")})
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = [i / ranges for i in range(1, ranges)]
    # As many bounds as a few times the shuffle partitions, whatever the number of documents.
    bounds = rows.select(F.percentile_approx("id_key", quantiles, 20 * ranges)).first()[0] or []
    steps = [1 << i for i in reversed(range(max(1, math.ceil(math.log2(len(bounds) + 1)))))]
    known = F.array(*[F.lit(int(bound)) for bound in bounds]) if bounds else F.array().cast("array<bigint>")

    def bounds_where(fits: Callable[[Column], Column]) -> Column:
        """How many bounds, in their order, fit, by halving."""
        return F.aggregate(
            F.array(*[F.lit(step) for step in steps]),
            F.lit(0),
            lambda low, step: low
            + F.when(F.coalesce(fits(F.get(known, low + step - F.lit(1))), F.lit(False)), step).otherwise(0),
        )

    # An id that is several bounds has several ranges, and its rows are dealt to them in order of their text's hash.
    upper = bounds_where(lambda bound: bound <= F.col("id_key"))
    dealt = rows.withColumns({"below": bounds_where(lambda bound: bound < F.col("id_key")), "upper": upper})
    share = F.col("text_key").cast("double") / F.lit(2.0**64) + F.lit(0.5)
    own = F.least(F.floor(share * (F.col("upper") - F.col("below"))).cast("int"), F.col("upper") - F.col("below") - 1)
    dealt = dealt.withColumn(
        "range", F.when(F.col("upper") - F.col("below") < 2, F.col("upper")).otherwise(F.col("below") + 1 + own)
    ).drop("below", "upper")
    # One row for each range: where it begins.
    firsts = dealt.groupBy("range").agg(F.min(F.struct("id_key", "text_key")).alias("first")).collect()
    firsts = sorted((row["range"], row["first"]["id_key"], row["first"]["text_key"]) for row in firsts)
    before = [(firsts[i - 1][0], *firsts[i]) for i in range(len(firsts))]
    successors = F.broadcast(spark.createDataFrame(before, "to_range int, range int, id_key bigint, text_key bigint"))
    found = (
        dealt.join(successors, ["range", "id_key", "text_key"])
        .groupBy("to_range", "id_key", "text_key")
        .agg(F.first("doc_id").alias("doc_id"), F.min("text").alias("text"))
        .select(F.col("to_range").alias("range"), "doc_id", "id_key", "text_key", "text", F.lit(True).alias("beside"))
    )
    order = Window.partitionBy("range").orderBy("beside", "id_key", "text_key")
    neighbours = (
        dealt.select("range", "doc_id", "id_key", "text_key", "text", F.lit(False).alias("beside"))
        .unionByName(stored(found, "next-documents"))
        .withColumns({"place": F.row_number().over(order), "following": F.lead("text").over(order)})
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
        .withColumn(
            "edited",
            F.when(
                ~F.col("beside"),
                F.concat(
                    F.substr("text", F.lit(1), (F.col("n_chars") - F.col("half")).cast("int")),
                    F.substr("following", F.lit(1), "half"),
                ),
            ),
        )
    )
    versions = neighbours.select(
        "range",
        "place",
        "beside",
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.posexplode(F.array("text", F.coalesce("edited", F.lit("")))).alias("version", "version_text"),
    )
    keys = ["range", "place", "version", "beside", "doc_id", "n_chars", "edited_sha256"]
    prints = fingerprint_slots(versions, keys, "version_text", slots, size, k, seed)
    along = Window.partitionBy("range").orderBy("place", "version")
    return (
        prints.withColumns(
            {"edited_slots": F.lead("slot_values", 1).over(along), "next_slots": F.lead("slot_values", 2).over(along)}
        )
        .where("version = 0 and not beside")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            as_text(F.col("slot_values")).alias("fingerprint"),
            as_text(F.col("edited_slots")).alias("edited_fingerprint"),
            likeness(F.col("slot_values"), F.col("edited_slots")).alias("near_edited"),
            likeness(F.col("slot_values"), F.col("next_slots")).alias("near_next"),
        )
    )
