"""Homomorphic multiset fingerprints of documents, in SQL functions only.

A text is a multiset of paragraphs: its lines, with a line cut after sentence ends. Each
paragraph is hashed (two SHA-256) to a vector of ``LANES`` byte values, and the vectors are
summed lane by lane modulo 2**32. The sum does not depend on the order of paragraphs;
adding or removing a paragraph adds or subtracts its vector. Equal multisets have equal
fingerprints, and the cosine of two centred sums estimates the share of common paragraphs
(standard error about 0.13).

Null and empty texts have the empty fingerprint (count 0, all lanes 0), which is like
itself (1.0) and unlike all others (0.0). Rows stay one to one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 60
MODULUS = 1 << 32
CELL = 256  # fan-out of the two-step bucket search
MAX_BUCKETS = CELL * CELL  # beyond 262 million rows the buckets grow instead


def paragraphs(text: Column) -> Column:
    """The non-empty paragraph units of a text."""
    units = F.split(F.regexp_replace(text, r"([.!?]) ", "$1\n"), "\n")
    return F.filter(units, lambda u: u != "")


def _lanes(unit: Column) -> Column:
    """The hash vector of a paragraph: 2 x 5 groups of 48 hash bits, six bytes each."""
    hashes = F.array(F.sha2(F.concat(F.lit("0"), unit), 256), F.sha2(F.concat(F.lit("1"), unit), 256))

    def group(h: Column, start: int) -> Column:
        return F.conv(F.substring(h, start, 12), 16, 10).cast("long")

    groups = F.flatten(F.transform(hashes, lambda h: F.array(*[group(h, 12 * k + 1) for k in range(5)])))
    return F.flatten(F.transform(groups, lambda g: F.array(*[F.shiftright(g, s).bitwiseAND(F.lit(255)) for s in (40, 32, 24, 16, 8, 0)])))


def fingerprint(text: Column) -> Column:
    """struct(n, lanes): paragraph count and lane sums of a text."""
    units = paragraphs(F.coalesce(text, F.lit("")))
    zero = F.array_repeat(F.lit(0).cast("long"), LANES)
    start = F.struct(F.lit(0).cast("long").alias("n"), zero.alias("lanes"))

    def insert(acc: Column, unit: Column) -> Column:
        lanes = F.zip_with(acc["lanes"], _lanes(unit), lambda a, b: a + b)
        return F.struct((acc["n"] + 1).alias("n"), lanes.alias("lanes"))

    def reduced(acc: Column) -> Column:
        return F.struct(acc["n"].alias("n"), F.transform(acc["lanes"], lambda x: x % MODULUS).alias("lanes"))

    return F.aggregate(units, start, insert, reduced)


def combine(a: Column, b: Column) -> Column:
    """The fingerprint of both multisets together (insertion)."""
    lanes = F.zip_with(a["lanes"], b["lanes"], lambda x, y: (x + y) % MODULUS)
    return F.struct((a["n"] + b["n"]).alias("n"), lanes.alias("lanes"))


def remove(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the multiset ``b`` (deletion)."""
    lanes = F.zip_with(a["lanes"], b["lanes"], lambda x, y: F.pmod(x - y, F.lit(MODULUS)))
    return F.struct((a["n"] - b["n"]).alias("n"), lanes.alias("lanes"))


def as_text(fp: Column) -> Column:
    """count, colon, eight hex digits per lane."""
    hexes = F.transform(fp["lanes"], lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    return F.concat(fp["n"].cast("string"), F.lit(":"), F.array_join(hexes, ""))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the centred lane sums, from 0 to 1; exactly 1 for equal fingerprints.

    Sums are exact below 2**32 / 255 paragraphs.
    """

    def centred(fp: Column) -> Column:
        return F.transform(fp["lanes"], lambda x: (2 * x - 255 * fp["n"]).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    def cosine(v: Column) -> Column:
        x, y = v["x"], v["y"]
        return F.round(F.greatest(F.lit(0.0), dot(x, y) / (F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))), 6)

    both = F.array(F.struct(centred(a).alias("x"), centred(b).alias("y")))
    return (
        F.when((a["n"] == b["n"]) & (a["lanes"] == b["lanes"]), F.lit(1.0))
        .when((a["n"] == 0) | (b["n"] == 0), F.lit(0.0))
        .otherwise(F.element_at(F.transform(both, cosine), 1))
    )


def _longs(values: list[int]) -> Column:
    """A constant array; parsed from one string, which the optimizer folds to a literal."""
    return F.from_json(F.lit(str(values)), "array<bigint>")


def with_next(df: DataFrame, key: str, columns: list[str], ties: str, rows_per_bucket: int = 4000) -> DataFrame:
    """Every row with struct ``next``: ``columns`` of the row that follows by ``key``.

    After the last row comes the first. Rows are cut into buckets of about equal size at
    keys that exist in the table; the row at a cut is also sent to the bucket before it, so
    each bucket finds its successors alone and no window spans the table. The cuts are one
    constant of at most ``MAX_BUCKETS`` longs. Equal keys are ordered by ``ties``; a null
    key comes first.
    """
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    df = df.withColumn("_order", order)
    stats = df.agg(F.count(F.lit(1)), F.min("_order")).first()
    if not stats[0]:
        return df.withColumn("next", F.struct(*[F.col(c) for c in columns])).drop("_order")
    buckets = min(MAX_BUCKETS, math.ceil(stats[0] / rows_per_bucket))
    cuts: list[int] = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        found = df.agg(F.percentile_approx("_order", shares, 20 * buckets)).first()[0]
        cuts = sorted(set(found) - {stats[1]})
    bucket, is_cut = F.lit(0), F.lit(False)
    if cuts:
        coarse, fine = _longs(cuts[::CELL]), _longs(cuts)

        def below(values: Column) -> Column:
            return F.size(F.filter(values, lambda c: c <= F.col("_order")))

        cell = F.greatest(below(coarse) - 1, F.lit(0)) * CELL
        own = F.slice(fine, cell + 1, CELL)
        bucket, is_cut = cell + below(own), F.array_contains(own, F.col("_order"))
    df = df.withColumn("_bucket", bucket)

    def place(bucket: Column, late: int) -> Column:
        return F.struct(bucket.cast("int").alias("bucket"), F.lit(late).alias("late"))

    places = F.concat(
        F.array(place(F.col("_bucket"), 0)),
        F.when(is_cut, F.array(place(F.col("_bucket") - 1, 1))).otherwise(F.array().cast("array<struct<bucket:int,late:int>>")),
        F.when(F.col("_order") == stats[1], F.array(place(F.lit(len(cuts)), 2))).otherwise(F.array().cast("array<struct<bucket:int,late:int>>")),
    )
    placed = df.withColumn("_place", F.explode(places))
    window = Window.partitionBy("_place.bucket").orderBy("_place.late", "_order", ties)
    ahead = placed.withColumn("next", F.lead(F.struct(*[F.col(c) for c in columns])).over(window))
    return ahead.where("_place.late = 0").drop("_place", "_order", "_bucket")


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_chars, edited text, its own, edited and next fingerprints.

    The edited text has its last quarter of code points replaced by the first as many of
    the next document's.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).alias(id_col), text.alias("_text"))
    docs = docs.withColumn("fp", fingerprint(F.col("_text")))
    docs = with_next(docs, id_col, ["_text", "fp"], ties="_text")
    n = F.length("_text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("_text", F.lit(1), n - quarter), F.substring(F.col("next._text"), F.lit(1), quarter)
    )
    return docs.select(
        id_col, n.cast("long").alias("n_chars"), edited.alias("edited"), "fp", F.col("next.fp").alias("next_fp")
    ).withColumn("edited_fp", fingerprint(F.col("edited")))
