"""Document fingerprints: one-permutation MinHash with densified, packed bins.

Each five-word shingle is hashed once; the high bits of the hash name its bin,
the smallest hash of a bin is kept.  An empty bin takes the value of a random
bin that is not empty: the bins it asks are a fixed random sequence of its own,
so that all documents ask alike (optimal densification).  Of each bin four low
bits are packed, after a hash of value and bin, as else bins that share a
borrowed value would agree by chance together.  Unequal bins agree by chance once in sixteen, which the
estimate of the likeness corrects.

All of it is built-in functions over the row of a document: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SHINGLE_WORDS = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
KEPT_BITS = 4
#: Bins that an empty bin asks one after the other before all are looked through.
ATTEMPTS = 12
PER_LONG = 64 // KEPT_BITS
NIBBLE_ONES = 0x1111111111111111


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once, though it is named many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(text: Column) -> Column:
    """A hash of every five consecutive words; of a shorter text one of all its words.

    Words are what white space (as the regular expression ``\\s``) separates.
    """
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (SHINGLE_WORDS - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, SHINGLE_WORDS)))

    return _bind(words, lambda w: F.when(F.size(w) > 0, hashes(w)).otherwise(F.array().cast("array<bigint>")))


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BIN_BITS)


def _last_of(b: int) -> int:
    """The largest hash of a bin, as a signed number."""
    top = (b << (64 - BIN_BITS)) | ((1 << (64 - BIN_BITS)) - 1)
    return top - (1 << 64) if top >> 63 else top


def bin_minima(hashes: Column) -> Column:
    """The smallest hash of every bin, null where there is none; bins by signed order.

    A largest hash is put into each bin, so that in sorted order the first of
    each bin is its smallest and no bin is missing.
    """
    ends = F.array(*[F.lit(_last_of(b)) for b in range(BINS)])
    ordered = F.sort_array(F.concat(hashes, ends))
    minima = _bind(ordered, lambda s: F.filter(
        s, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(s, i - 1)))
    ))
    is_end = F.lit((1 << (64 - BIN_BITS)) - 1)
    return F.transform(minima, lambda h: F.when(h.bitwiseAND(is_end) != is_end, h))


def densified(minima: Column) -> Column:
    """Empty bins filled from others; all stay null if all are."""

    def fill(d: Column, value: Column, i: Column) -> Column:
        asked = [F.get(d, F.pmod(F.xxhash64(i, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(ATTEMPTS)]
        rest = F.array_min(F.filter(
            F.transform(d, lambda v, j: F.when(v.isNotNull(), F.struct(F.xxhash64(i, j, F.lit(-1)).alias("o"), v.alias("v")))),
            lambda x: x.isNotNull(),
        ))["v"]
        return F.coalesce(value, *asked, rest)

    return _bind(minima, lambda d: F.transform(d, lambda v, i: fill(d, v, i)))


def packed(bins: Column) -> Column:
    """Low bits of the bins as an array of longs; null for a text without words."""

    def pack(b: Column, at: Column) -> Column:
        part = F.slice(b, at * PER_LONG + 1, PER_LONG)
        low = F.transform(part, lambda v, i: F.call_function(
            "shiftleft", F.xxhash64(v, at, i).bitwiseAND(F.lit((1 << KEPT_BITS) - 1)), (i * KEPT_BITS).cast("int")
        ))
        return F.aggregate(low, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x))

    return _bind(bins, lambda b: F.when(
        F.get(b, F.lit(0)).isNotNull(),
        F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)), lambda at: pack(b, at)),
    ))


def fingerprint(text: Column) -> Column:
    """The packed fingerprint of a text; null counts as empty."""
    return packed(densified(bin_minima(shingle_hashes(F.coalesce(text, F.lit(""))))))


def as_text(print_: Column) -> Column:
    """A fingerprint as hexadecimal digits; empty for a text without words."""
    return F.when(print_.isNull(), "").otherwise(
        F.lower(F.array_join(F.transform(print_, lambda x: F.lpad(F.hex(x), 16, "0")), ""))
    )


def likeness(a: Column, b: Column) -> Column:
    """The estimated share of common shingles, 0 to 1, corrected for chance.

    Two texts without words are alike, one with and one without words are not.
    """

    def equal(x: Column, y: Column) -> Column:
        differs = x.bitwiseXOR(y)
        any_bit = differs
        for shift in range(1, KEPT_BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(differs, shift))
        return F.lit(PER_LONG) - F.bit_count(any_bit.bitwiseAND(F.lit(NIBBLE_ONES)))

    same = F.aggregate(F.zip_with(a, b, equal), F.lit(0), lambda n, x: n + x)
    chance = 1 / (1 << KEPT_BITS)
    share = F.greatest((same / BINS - chance) / (1 - chance), F.lit(0.0))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(share)


# --- each document beside the next ------------------------------------------------


def _slice_of(key: Column, bounds: list[int], parts: int) -> Column:
    """Which slice an id is in: ``parts`` even parts between each two bounds, ascending."""
    if len(bounds) == 2:
        low, high = bounds
        return F.floor((key.cast("double") - low) * parts / max(high - low, 1)).cast("bigint")
    half = len(bounds) // 2
    upper = _slice_of(key, bounds[half:], parts) + F.lit(half * parts)
    return F.when(key < bounds[half], _slice_of(key, bounds[: half + 1], parts)).otherwise(upper)


def beside_next(docs: DataFrame, columns: list[str], id_col: str = "doc_id", slices: int | None = None) -> DataFrame:
    """Every row with ``columns`` of the row with the next smaller id as ``next_*``.

    After the smallest id comes the largest.  Ids are cut into slices at
    quantiles; in a slice rows are put in order, and the first row of a slice
    goes to the slice before it too.  Only the slices' bounds, whose number is a
    parameter, pass through the driver.  Null ids rank below all others; rows of
    one id follow each other in order of the columns.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 62)))
    wanted = slices or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = min(wanted, 64)
    quantiles = docs.agg(
        F.percentile_approx(key, [i / cuts for i in range(cuts + 1)], 10_000).alias("q"),
        F.min(key).alias("low"), F.max(key).alias("high"),
    ).first()
    if quantiles.low is None:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    bounds = sorted({quantiles.low, *quantiles.q, quantiles.high + 1})
    place = _slice_of(key, bounds, max(1, wanted // (len(bounds) - 1)))
    tops = docs.select(place.alias("s"), key.alias("k")).groupBy("s").agg(F.max("k").alias("k")).collect()
    tops = sorted((r.s, r.k) for r in tops)
    # The largest id of each slice is a guest of the slice above, that of the last one of the lowest.
    guests = [(tops[i][1], tops[(i + 1) % len(tops)][0]) for i in range(len(tops))]
    hosts = spark.createDataFrame(guests, "_guest_key bigint, _guest_of bigint")
    marked = docs.withColumn("_key", key).withColumn("_slice", place)
    seats = marked.join(F.broadcast(hosts), F.col("_key") == F.col("_guest_key"), "left")
    seat = F.struct(F.col("_slice").alias("s"), F.lit(False).alias("guest"))
    other = F.when(F.col("_guest_of").isNotNull(), F.struct(F.col("_guest_of").alias("s"), F.lit(True).alias("guest")))
    seated = seats.withColumn("_seat", F.explode(F.filter(F.array(seat, other), lambda x: x.isNotNull())))
    order = Window.partitionBy("_seat.s").orderBy("_seat.guest", F.col("_key").desc(), *columns)
    ranked = seated.select(
        *docs.columns, "_seat.guest", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    )
    return ranked.where(~F.col("guest")).drop("guest")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness.

    The edited text has its last half of code points replaced by as many first
    ones of the next document's (descending id).  One row per row of ``docs``:
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.  Null text counts as empty.  A single document is its own next.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    printed = own.withColumn("print", fingerprint(F.col("text")))
    paired = beside_next(printed, ["text", "print"], "doc_id")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = paired.select(
        "doc_id", n.cast("bigint").alias("n_chars"), "print", "next_print",
        F.concat(F.left("text", n - half), F.left("next_text", half)).alias("edited"),
    )
    both = edited.select("*", fingerprint(F.col("edited")).alias("edited_print"))
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
