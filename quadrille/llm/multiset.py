"""Operator 7 [native]: a homomorphic multiset hash of a text's paragraphs.

Each paragraph is hashed to a wide vector, and a text's fingerprint is the sum
of its paragraphs' vectors, lane by lane, modulo powers of two, with the number
of paragraphs. The sum does not depend on order, and a paragraph can be added to
or taken from a fingerprint without the rest of the text.

A vector has two parts. WIDE lanes of 32 bits each, the halves of seeded 64-bit
hashes, are summed modulo 2**32: they say whether two multisets are equal. SIGNS
lanes of one bit each, again from seeded hashes, are summed modulo 2**32 as well:
a lane says +1 or -1 with equal chance, so the normalised product of two
fingerprints' signed lanes estimates the cosine of the two multisets; the
estimate, cut to 0..1, is the likeness. (Signed lanes stand for true counts while
a multiset has fewer than 2**31 paragraphs; the wide lanes wrap with the second.)

Paragraphs are what lies between line breaks and after sentence ends (a
pattern, as a parameter), so that a text of one line has several.

Only SQL expressions are used. The sums are plain long sums of a hash aggregate
over the exploded paragraphs, made where the text already lies, so that
paragraphs are never shuffled. Two sign lanes share a 64-bit number; a text of
at most 2**31 bytes cannot carry from the lower to the upper one, and sums of
sums are reduced lane by lane (`combine`). Wide lanes are reduced at the end: 32
bits times 2**31 paragraphs fit a long.

Null is the empty text, which has no paragraphs and the all-zero fingerprint.
Two fingerprints without paragraphs have likeness 1, one without and one with
have 0.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

PARAGRAPH = r"\n+|(?<=[.!?]) +"
#: Seeds of the sign lanes (64 for each) and of the wide lanes (2 for each).
SIGN_SEEDS = (11, 37)
WIDE_SEEDS = (101, 211, 307, 401, 503, 601, 701, 809)
_LANE = 0xFFFFFFFF
_ONES = (1 << 32) | 1
LONGS = 32 * len(SIGN_SEEDS)
WIDE = 2 * len(WIDE_SEEDS)
RANGE_BYTES = 32 << 20


def paragraphs(text: Column, pattern: str = PARAGRAPH) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), pattern), lambda p: p != "")


def _hashes(text: Column, side: int, pattern: str) -> Column:
    """An array of structs (side, h0, h1, ..., w0, w1, ...), one for each paragraph."""

    def made(p: Column) -> Column:
        signs = [F.xxhash64(F.lit(seed), p).alias(f"h{k}") for k, seed in enumerate(SIGN_SEEDS)]
        return F.struct(F.lit(side).alias("side"), *signs, *[F.xxhash64(F.lit(seed), p).alias(f"w{k}") for k, seed in enumerate(WIDE_SEEDS)])

    return F.transform(paragraphs(text, pattern), made)


_UNIT = "struct<side:int," + ",".join(f"{n}:bigint" for n in [*(f"h{k}" for k in range(len(SIGN_SEEDS))), *(f"w{k}" for k in range(len(WIDE_SEEDS)))]) + ">"


def _sums(rows: DataFrame, keys: list[str], units: Column) -> DataFrame:
    """Fingerprints by keys and side of an array of _hashes; a row without any has one of no paragraphs, with no side."""
    flat = rows.select(*keys, F.explode_outer(units).alias("u")).select(*keys, "u.*")
    shifted = lambda c, i: F.call_function("shiftrightunsigned", F.col(c), F.lit(i))
    lanes = [F.coalesce(F.sum(shifted(f"h{k}", i).bitwiseAND(F.lit(_ONES))), F.lit(0)).alias(f"s{32 * k + i}") for k in range(len(SIGN_SEEDS)) for i in range(32)]
    halves = [x for k in range(len(WIDE_SEEDS)) for x in (F.col(f"w{k}").bitwiseAND(F.lit(_LANE)), shifted(f"w{k}", 32))]
    wide = [F.coalesce(F.sum(x), F.lit(0)).alias(f"v{i}") for i, x in enumerate(halves)]
    summed = flat.groupBy(*keys, "side").agg(F.count("h0").alias("n"), *lanes, *wide)
    reduced = [F.col(f"v{i}").bitwiseAND(F.lit(_LANE)) for i in range(WIDE)]
    return summed.select(*keys, "side", F.array("n", *[f"s{i}" for i in range(LONGS)], *reduced).alias("f"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of both multisets together, or (sign -1) of a without b."""

    def lanes(x: Column, y: Column) -> Column:
        low = F.pmod(x.bitwiseAND(F.lit(_LANE)) + y.bitwiseAND(F.lit(_LANE)) * sign, F.lit(1 << 32))
        high = F.pmod(F.shiftrightunsigned(x, 32) + F.shiftrightunsigned(y, 32) * sign, F.lit(1 << 32))
        return F.shiftleft(high, 32).bitwiseOR(low)

    n = F.element_at(a, 1) + F.element_at(b, 1) * sign
    wide = F.zip_with(F.slice(a, 2 + LONGS, WIDE), F.slice(b, 2 + LONGS, WIDE), lambda x, y: F.pmod(x + y * sign, F.lit(1 << 32)))
    return F.concat(F.array(n), F.zip_with(F.slice(a, 2, LONGS), F.slice(b, 2, LONGS), lanes), wide)


def as_text(v: Column) -> Column:
    """A fingerprint as a string: hexadecimal numbers joined by dots."""
    return F.array_join(F.transform(v, lambda x: F.lower(F.hex(x))), ".")


def signed(v: Column) -> Column:
    """Lanes as sums of +1 and -1: twice the count of ones, less the number of paragraphs."""
    n = F.element_at(v, 1)
    both = lambda w: F.array(*[(x * 2 - n).cast("double") for x in (w.bitwiseAND(F.lit(_LANE)), F.shiftrightunsigned(w, 32))])
    return F.flatten(F.transform(F.slice(v, 2, LONGS), both))


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda s, t: s * t), F.lit(0.0), lambda s, t: s + t)


def likeness(same: Column, dot: Column, xx: Column, yy: Column) -> Column:
    """The estimated cosine of two multisets (0 to 1), from products of their signed lanes."""
    norm = F.sqrt(xx * yy)
    return F.when(same, F.lit(1.0)).when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot / norm))).otherwise(F.lit(0.0))


def likeness_of(a: Column, b: Column) -> Column:
    """The likeness of two fingerprints, as one expression."""
    x, y = signed(a), signed(b)
    return likeness(a == b, _dot(x, y), _dot(x, x), _dot(y, y))


def _bucket(bounds: list[int], value: Column) -> Column:
    """How many of the sorted bounds are below value (a null value: none), by binary search."""
    if not bounds:
        return F.lit(0)
    known = F.lit(bounds)
    steps = len(bounds).bit_length()

    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc.lo + acc.hi) / 2).cast("int")
        below = (acc.lo < acc.hi) & (F.get(known, mid) < value)
        return F.struct(F.when(below, mid + 1).otherwise(acc.lo).alias("lo"), F.when(below | (acc.lo >= acc.hi), acc.hi).otherwise(mid).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.when(value.isNull(), F.lit(0)).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda acc: acc.lo))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = PARAGRAPH) -> DataFrame:
    """Rows (doc_id, fingerprint array<long>): one for each row of docs."""
    base = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _sums(base, ["__row", "doc_id"], _hashes(F.col("text"), 0, pattern)).select("doc_id", F.col("f").alias("fingerprint"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = PARAGRAPH) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness.

    The edited text has the last floor(n/4) of n code points replaced by the
    first as many (or all) of the next text. Rows with null ids come first;
    rows of one id follow each other in the order of a hash of their content
    (and of their place, where an id has more rows than a range).

    Rows are dealt to ranges of ids, whose bounds are quantiles: ranges of
    about RANGE_BYTES of text, and two for each shuffle partition at least.
    This is the only shuffle of texts, and all that follows
    happens within a range. An id that fills several ranges, or null ids that
    would, are dealt to as many by that hash. The next row is a lead; the last row of a range
    takes the first row of the next range that has rows, and that of the last
    range the very first.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = 2 * common.parallelism(docs)
    size, rows, none = base.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    ranges = max(parts, size // RANGE_BYTES)
    found = [int(x) for x in base.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 50 * ranges)).first()[0] or []]
    # How many ranges an id fills: how often it is a bound. Null ids are no bounds; they are counted.
    times = {x: n for x, n in Counter(found).items() if n > 1}
    without_id = -(-none * ranges // rows) if rows else 0
    dealt, tie = F.lit(1), F.xxhash64("text")
    if times:
        heavy = F.create_map(*[F.lit(v) for pair in times.items() for v in pair])
        dealt = F.coalesce(F.try_element_at(heavy, F.col("doc_id")), dealt)
    if without_id > 1:
        dealt = F.when(F.col("doc_id").isNull(), F.lit(without_id)).otherwise(dealt)
    ranged = base.withColumn("__n", dealt)
    if times or without_id > 1:
        tie = F.when(F.col("__n") > 1, F.xxhash64(tie, F.monotonically_increasing_id())).otherwise(tie)
    ranged = ranged.withColumn("__tie", tie)
    # Ranges within a range of ids: first the other ids, then slices of the heavy one in the order of the hash.
    slice_of = F.floor((F.shiftright("__tie", 40) + F.lit(1 << 23)) * F.col("__n") / F.lit(1 << 24))
    first_bound = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(_bucket(sorted(set(found)), F.col("doc_id")))
    part = F.when(F.col("__n") > 1, 1 + slice_of).otherwise(F.lit(0))
    ranged = ranged.withColumn("__b", first_bound.cast("long") * F.lit(1 << 24) + part)
    if ranges > parts:
        ranged = ranged.repartition(ranges, "__b")
    order = Window.partitionBy("__b").orderBy(F.col("doc_id").asc_nulls_first(), "__tie")
    firsts = ranged.groupBy("__b").agg(F.min_by("text", F.struct(F.col("doc_id"), F.col("__tie"))).alias("__first"))
    # One row for each range, so one task holds them all.
    ring = Window.orderBy("__b")
    first_of_all = F.first("__first").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = firsts.select("__b", F.coalesce(F.lead("__first").over(ring), first_of_all).alias("__after"))
    led = ranged.select("*", F.lead("text").over(order).alias("__lead"), F.row_number().over(order).alias("__at"))
    paired = led.join(after, "__b").select("__b", "__at", "doc_id", "text", F.coalesce("__lead", "__after").alias("next"), F.when(F.col("__lead").isNull(), F.col("__after")).alias("beyond"))

    n = F.length("text")
    k = F.floor(n / 4).cast("int")
    edited = paired.select("__b", "__at", "doc_id", "text", "beyond", n.cast("long").alias("n_chars"), F.concat(F.substring("text", F.lit(1), n - k), F.substring("next", F.lit(1), k)).alias("edited"))
    edited = edited.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
    keys = ["__b", "__at", "doc_id", "n_chars", "edited_sha256"]
    units = F.concat(_hashes(F.col("text"), 0, pattern), _hashes(F.col("edited"), 1, pattern), F.when(F.col("beyond").isNull(), F.array().cast(f"array<{_UNIT}>")).otherwise(_hashes(F.col("beyond"), 2, pattern)))
    sides = _sums(edited, keys, units)
    none = F.array_repeat(F.lit(0).cast("long"), 1 + LONGS + WIDE)
    of = lambda side: F.coalesce(F.max(F.when(F.col("side") == side, F.col("f"))), none)
    # (max: there is one at most)
    rows = sides.groupBy(*keys).agg(of(0).alias("f"), of(1).alias("e"), of(2).alias("beyond"))
    following = F.coalesce(F.lead("f").over(Window.partitionBy("__b").orderBy("__at")), F.col("beyond"))
    lanes = rows.select("*", following.alias("g")).select("*", signed(F.col("f")).alias("x"), signed(F.col("e")).alias("y"), signed(F.col("g")).alias("z"))
    dots = lanes.select("doc_id", "n_chars", "edited_sha256", "f", "e", "g", _dot(F.col("x"), F.col("x")).alias("xx"), _dot(F.col("y"), F.col("y")).alias("yy"), _dot(F.col("z"), F.col("z")).alias("zz"), _dot(F.col("x"), F.col("y")).alias("xy"), _dot(F.col("x"), F.col("z")).alias("xz"))
    return dots.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("f")).alias("fingerprint"),
        as_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("f") == F.col("e"), F.col("xy"), F.col("xx"), F.col("yy")).alias("near_edited"),
        likeness(F.col("f") == F.col("g"), F.col("xz"), F.col("xx"), F.col("zz")).alias("near_next"),
    )
