"""Document fingerprints by closed syncmers, in DataFrame expressions only.

The words of a text are hashed in overlapping pairs. A run of five words is an anchor if
the least of its four pair hashes is the first or the last: whether it is depends on its
own words alone, so equal passages have equal anchors wherever they stand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from semestra.llm.ordering import key_blocks

#: Words of an anchor, and of the inner substrings its minimum is taken over.
WORDS, INNER = 5, 2
#: Anchors of least hash that make up a fingerprint.
SIZE = 64
#: An anchor is its hash in the upper bits and its place, in words, in these lower bits.
PLACE_BITS = 24
_PLACE = (1 << PLACE_BITS) - 1


def with_anchors(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: the anchors of a text in order, as array of long.

    Words are parted by space and tab to carriage return. A text without an anchor, such
    as one of fewer than ``WORDS`` words or a null one, gets the hash of all its words, at
    place 0.
    """
    words = F.split(F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\x09-\\x0D]", " ")), " +")
    gaps = WORDS - INNER
    hashed = rows.withColumn("__words", F.transform(words, lambda w: F.xxhash64(w)))
    paired = hashed.withColumn(
        "__pairs",
        F.when(
            F.size("__words") >= WORDS,
            F.zip_with(
                F.slice("__words", 1, F.size("__words") - 1), F.slice("__words", 2, F.size("__words") - 1),
                lambda a, b: F.xxhash64(a, b),
            ),
        ),
    )

    def pair(i: Column, n: int) -> Column:
        return F.get(F.col("__pairs"), i + n)

    def anchor(first: Column, i: Column) -> Column:
        # A null where the run would pass the end of the text
        inner = F.least(*[pair(i, n) for n in range(1, gaps)])
        value = F.xxhash64(first, pair(i, INNER), pair(i, gaps))
        packed = value.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(F.least(i, F.lit(_PLACE)).cast("long"))
        last = pair(i, gaps)
        return F.when(last.isNotNull() & (F.least(first, last) <= inner), packed)

    alone = F.array(F.xxhash64(F.array_join(F.transform("__words", lambda w: w.cast("string")), " ")).bitwiseAND(F.lit(~_PLACE)))
    runs = F.filter(F.transform("__pairs", anchor), lambda x: x.isNotNull())
    # Some texts of five words or more have no anchor either; all their words then stand for them
    return paired.withColumn("__runs", runs).withColumn(
        out, F.when(F.size("__runs") > 0, F.col("__runs")).otherwise(alone)
    ).drop("__words", "__pairs", "__runs")


def sketched(rows: DataFrame, anchors: str, out: str) -> DataFrame:
    """``out``: the ``SIZE`` anchors of least hash, each hash at its first place."""
    ordered = rows.withColumn("__ordered", F.sort_array(anchors))

    def first(x: Column, i: Column) -> Column:
        before = F.get(F.col("__ordered"), i - 1)
        return (i == 0) | (F.shiftright(x, PLACE_BITS) != F.shiftright(before, PLACE_BITS))

    return ordered.withColumn(out, F.slice(F.filter("__ordered", first), 1, SIZE)).drop("__ordered")


def with_sketch(rows: DataFrame, text: str, out: str) -> DataFrame:
    return sketched(with_anchors(rows, text, "__anchors"), "__anchors", out).drop("__anchors")


def fingerprint(sketch: Column) -> Column:
    """A sketch as text: 16 hex digits for each anchor."""
    return F.lower(F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def hashes(anchors: Column) -> Column:
    """The different hashes of all anchors, in order and without places."""
    return F.array_sort(F.array_distinct(F.transform(anchors, lambda x: F.shiftright(x, PLACE_BITS))))


def whole_fingerprint(found: Column) -> Column:
    """All hashes of a text as text: ten hex digits for each. Likeness follows from two of
    these alone."""
    low = (1 << (64 - PLACE_BITS)) - 1
    return F.lower(F.array_join(F.transform(found, lambda x: F.substring(F.lpad(F.hex(x.bitwiseAND(F.lit(low))), 10, "0"), -10, 10)), ""))


def likeness_of_all(one: Column, other: Column) -> Column:
    """Share of common hashes among all of two texts."""
    common = F.size(F.array_intersect(one, other))
    return common / (F.size(one) + F.size(other) - common)


def likeness(one: Column, other: Column) -> Column:
    """Estimated share of common anchors among all of two texts, from their sketches."""
    a = F.transform(one, lambda x: F.shiftright(x, PLACE_BITS))
    b = F.transform(other, lambda x: F.shiftright(x, PLACE_BITS))
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, SIZE)
    common = F.array_intersect(a, b)
    return F.size(F.array_intersect(least, common)) / F.size(least)


def matches(one: DataFrame, other: DataFrame, key: str = "key", anchors: str = "anchors") -> DataFrame:
    """Places, in words, where texts of two tables have the same anchor.

    Gives ``key, place, other_key, other_place`` for every equal pair of anchors. Both
    tables have ``key`` and ``anchors`` of ``with_anchors``.
    """
    def flat(rows: DataFrame, prefix: str) -> DataFrame:
        each = rows.select(F.col(key).alias(f"{prefix}key"), F.explode(anchors).alias("__a"))
        return each.select(
            f"{prefix}key", F.col("__a").bitwiseAND(F.lit(_PLACE)).alias(f"{prefix}place"),
            F.shiftright("__a", PLACE_BITS).alias("__h"),
        )

    return flat(one, "").join(flat(other, "other_"), "__h").drop("__h")


def with_next(
    rows: DataFrame, key: str, carried: list[str], text: str, prepare: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``next_<name>`` of the row of next larger ``key`` for every carried column.

    ``prepare`` adds columns to the rows before that. The row after the last is the first. Equal keys are ordered by text; a null key comes
    first. Rows are dealt into blocks of consecutive keys, cut at approximate quantiles,
    and each block also gets the first row of the next one. So no task sees all rows, and
    only the blocks' first keys come to the driver.
    """
    spark = rows.sparkSession
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    dealt = rows.withColumn("__order", order).withColumn("__block", key_blocks(rows, order))
    firsts = sorted(map(tuple, dealt.groupBy("__block").agg(F.min("__order")).collect()))
    if not firsts:
        return prepare(rows).select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    before = {b: firsts[n - 1][0] for n, (b, _) in enumerate(firsts)}
    heads = spark.createDataFrame(
        [(b, o, before[b]) for b, o in firsts], "__block int, __order bigint, __before int"
    )
    # One guest for each block, of the least text where keys are equal
    met = dealt.join(F.broadcast(heads), ["__block", "__order"])
    pick = Window.partitionBy("__before").orderBy(F.col(text).asc_nulls_first())
    guests = (
        met.withColumn("__n", F.row_number().over(pick)).where("__n = 1")
        .withColumn("__block", F.col("__before")).drop("__n", "__before").withColumn("__guest", F.lit(True))
    )
    all_rows = prepare(dealt.withColumn("__guest", F.lit(False)).unionByName(guests))
    after = Window.partitionBy("__block").orderBy("__guest", "__order", F.col(text).asc_nulls_first())
    return (
        all_rows.select("*", *[F.lead(c).over(after).alias(f"next_{c}") for c in carried])
        .where("NOT __guest").drop("__guest", "__block", "__order")
    )


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    In the edited text the last floor(n/2) code points give way to as many from the start
    of the next document, or all of that. Null texts count as empty. Gives ``key, n_chars,
    edited_text, sketch, edited_sketch, hashes, edited_hashes, near_edited, near_next,
    all_edited, all_next`` for every row: ``all_`` is the likeness over the hashes of all
    anchors, ``near_`` its estimate from the sketches.
    Repeated rows are each other's next document. Other columns are not looked at; an empty
    table gives no rows.
    """
    rows = docs.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    following = with_next(rows, key, ["text"], "text", lambda r: r)
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    changed = following.select(
        key, size.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half)).alias("edited_text"),
        "text", "next_text",
    )
    # Anchors are made after the exchange, as they take more room than the texts
    out = changed
    for name, prefix in (("text", ""), ("next_text", "next_"), ("edited_text", "edited_")):
        out = sketched(with_anchors(out, name, f"{prefix}anchors"), f"{prefix}anchors", f"{prefix}sketch")
    for prefix in ("", "next_", "edited_"):
        out = out.withColumn(f"{prefix}hashes", hashes(F.col(f"{prefix}anchors")))
    return out.select(
        key, "n_chars", "edited_text", "sketch", "edited_sketch", "hashes", "edited_hashes",
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        likeness_of_all(F.col("hashes"), F.col("edited_hashes")).alias("all_edited"),
        likeness_of_all(F.col("hashes"), F.col("next_hashes")).alias("all_next"),
    )
