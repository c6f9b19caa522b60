"""Join shapes, lookups, reshaping and set operations used by the dataflows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.operators.skew import lookup_hot, page_rows


# Sizes of needle pieces, characters of a text window, most bits of the filter of anchors, its anchors for each 64-bit number,
# and where the slices of a hash begin that set one bit each.
GRAMS = (8, 4, 2, 1)
WINDOW = 192
FILTER_BITS = 1 << 26
ANCHORS_PER_NUMBER = 4
FILTER_SLICES = (28, 40, 52)


class EmptySource(ValueError):
    """A source that must hold at least one row holds none."""


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Stop before any work when a needed source is empty."""
    if not df.take(1):
        raise EmptySource(message)
    return df


def optional_eq(df: DataFrame, column: str, value, sentinels=(-1, "-1", "", None)) -> DataFrame:
    """Filter by equality unless the value says "no filter"."""
    return df if value in sentinels else df.where(F.col(column) == F.lit(value))


def semi_filter(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_semi")


def join_either(left: DataFrame, right: DataFrame, keys: list[str], key: str) -> DataFrame:
    """Inner join on "any of the left's ``keys`` equals the right's ``key``", each pair once.

    The candidate keys of a row become rows of their own and meet the other side in one equi
    join: an OR in the condition would force a nested loop. Equal candidates of a row count once.
    """
    candidates = F.array_distinct(F.array(*[F.col(k) for k in keys]))
    spread = left.withColumn("__key", F.explode(candidates)).where("__key is not null")
    return spread.join(right, F.col("__key") == F.col(key)).drop("__key")


def reconcile(left: DataFrame, right: DataFrame, on: list[str], value: str) -> DataFrame:
    """Full outer comparison of one value; a missing side counts as zero."""
    a = left.select(*on, F.col(value).alias("left_value"))
    b = right.select(*on, F.col(value).alias("right_value"))
    both = a.join(b, on, "full")
    return both.select(
        *on,
        F.coalesce("left_value", F.lit(0)).alias("left_value"),
        F.coalesce("right_value", F.lit(0)).alias("right_value"),
    ).withColumn("difference", F.abs(F.col("left_value") - F.col("right_value")))


def densify(df: DataFrame, facts: DataFrame, on: list[str], column: str, values: list[str], value: str) -> DataFrame:
    """Every row of ``df`` for every literal in ``values``; absent facts become zero."""
    grid = df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))
    return grid.join(facts, [*on, column], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def not_yet_created(queue: DataFrame, created: DataFrame, key: Column, references: list[str]) -> DataFrame:
    """Queue rows whose cleaned key appears in none of the reference columns."""
    known = reduce(
        DataFrame.union, [created.select(F.trim(F.col(r)).alias("__known")) for r in references]
    ).where("__known is not null").distinct()
    clean = F.trim(F.replace(key, F.lit('"'), F.lit("")))
    return queue.withColumn("__known", clean).join(known, "__known", "left_anti").drop("__known")


def _grams(text: Column, size: int | Column) -> Column:
    """All pieces of ``size`` characters, in order; none where the text is shorter."""
    last = F.length(text) - size + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(text, i, F.lit(size) if isinstance(size, int) else size)))


def _anchors(keys: DataFrame, needle: str) -> DataFrame:
    """Per needle the piece of it that the fewest needles hold, as (needle, __size, __anchor); the hash stands for the piece."""
    length = F.length(needle)
    size = F.lit(GRAMS[-1])
    for g in reversed(GRAMS[:-1]):
        size = F.when(length >= g, F.lit(g)).otherwise(size)
    words = keys.select(needle).distinct().withColumn("__size", size)
    pieces = words.withColumn("__gram", F.explode(F.array_distinct(_grams(F.col(needle), F.col("__size")))))
    held = pieces.groupBy("__size", "__gram").agg(F.count(F.lit(1)).alias("__n"))
    rarest = pieces.join(held, ["__size", "__gram"]).groupBy(needle).agg(F.min(F.struct("__n", "__gram", "__size")).alias("__r"))
    return rarest.select(needle, F.col("__r.__size").alias("__size"), F.xxhash64(F.col("__r.__size"), F.col("__r.__gram")).alias("__anchor"))


def _bits(h: Column) -> Column:
    """The bits that a hash sets in its number of the filter, one for each slice."""
    places = [F.pmod(F.shiftrightunsigned(h, s), F.lit(64)).cast("int") for s in FILTER_SLICES]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places])


def _filter_bits(anchors: DataFrame, most: int) -> Column:
    """Bloom filter of the anchors as an array of 64-bit numbers, computed before the main plan.

    An anchor sets its bits in one number. There is one number for every ``ANCHORS_PER_NUMBER`` anchors, rounded up to a
    power of two, and ``most`` bits at the most.
    """
    enough = F.pow(F.lit(2), F.ceil(F.log2(F.count(F.lit(1)) / ANCHORS_PER_NUMBER + 1)))
    count = anchors.agg(F.least(F.lit(most // 64), enough.cast("bigint")).cast("int").alias("n"))
    words = anchors.groupBy(F.pmod("__anchor", count.scalar()).cast("int").alias("__w")).agg(F.bit_or(_bits(F.col("__anchor"))).alias("__v"))
    every = count.select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("__w"))
    dense = every.join(words, "__w", "left").agg(F.sort_array(F.collect_list(F.struct("__w", F.coalesce("__v", F.lit(0)).alias("v")))).alias("s"))
    return dense.select(F.transform("s", lambda x: x["v"]).alias("s")).scalar()


def contains_join(
    texts: DataFrame, needles: DataFrame, text: str, text_id: str, needle: str, on: tuple[str, ...] = (), bits: int = FILTER_BITS
) -> DataFrame:
    """Pairs (text row, needle) where the needle occurs anywhere in the whole text; the text itself is not handed on.

    Texts are read in windows of ``WINDOW`` characters and the longest needle's length more, so every occurrence lies whole
    in the window where it starts. Every needle has an anchor, its rarest piece of 8, 4, 2 or 1 characters. A window's
    pieces are tested against a Bloom filter of all anchors before anything moves; the filter grows with the needles, up to
    ``bits``. Only windows with a hit are shuffled, meet the needles of that anchor, and ``contains`` decides; a piece that
    very many windows hold, like the fixed words of a form, is spread over several tasks. Null and empty needles and texts
    match nothing. ``text_id`` tells the rows of texts apart.
    """
    keys = needles.where(F.length(needle) > 0).distinct()
    anchors = _anchors(keys, needle)
    width = anchors.agg((F.max(F.length(needle)) + F.lit(WINDOW)).alias("w")).scalar()
    used = anchors.agg(F.collect_set("__size").alias("s")).scalar()
    pattern = F.concat(F.lit("(?s)(?=(.{1,"), width.cast("string"), F.lit(f"}})).{{1,{WINDOW}}}"))
    kept = [c for c in texts.columns if c != text]
    windows = texts.select(*kept, F.explode(F.regexp_extract_all(F.col(text), pattern, F.lit(1))).alias("__window")).withColumn("__used", used)

    def hashes(size: int) -> Column:
        hashed = F.transform(_grams(F.col("__window"), size), lambda g: F.xxhash64(F.lit(size), g))
        return F.when(F.array_contains("__used", size), F.array_distinct(hashed))

    none = F.array().cast("array<bigint>")
    pieces = windows.select(*kept, "__window", F.explode(F.concat(*[F.coalesce(hashes(g), none) for g in GRAMS])).alias("__anchor"))
    # The filter stands in the condition itself: as a column every row would carry a copy of it.
    known, wanted = _filter_bits(anchors, bits), _bits(F.col("__anchor"))
    asked = pieces.where(F.get(known, F.pmod("__anchor", F.size(known)).cast("int")).bitwiseAND(wanted) == wanted)
    met = lookup_hot(asked, keys.join(anchors.drop("__size"), needle), ["__anchor", *on], "inner").where(F.contains("__window", needle))
    return met.dropDuplicates([text_id, *keys.columns]).select(*kept, *[c for c in keys.columns if c not in on])


def lookup_first(
    df: DataFrame, dim: DataFrame, on: list[str], order: list[Column]
) -> DataFrame:
    """Best dimension row per key, or NULLs: the dimension is reduced before the join."""
    w = Window.partitionBy(*on).orderBy(*order)
    best = dim.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    return df.join(best, on, "left")


def lookup_by_ambiguity(
    df: DataFrame, places: DataFrame, city: str, state: str, codes: list[str]
) -> DataFrame:
    """Place by city; by city and state when the city name repeats; by state when it is unknown.

    ``places`` carries columns ``city`` and ``state`` plus ``codes``; both sides already folded.
    The distinct shop places are resolved once, then joined back to all rows.
    """
    pick = F.min(F.struct(*codes))
    per_city = places.groupBy(F.col("city").alias("__c")).agg(F.count(F.lit(1)).alias("__n"), pick.alias("__by_city"))
    per_both = places.groupBy(F.col("city").alias("__c"), F.col("state").alias("__s")).agg(pick.alias("__by_both"))
    # With no such city the state text of the order is tried as a city name.
    as_city = per_city.select(F.col("__c").alias("__s"), F.col("__by_city").alias("__by_state"))
    asked = df.select(F.col(city).alias("__c"), F.col(state).alias("__s")).distinct()
    chosen = (
        asked.join(per_city, "__c", "left").join(per_both, ["__c", "__s"], "left").join(as_city, "__s", "left")
        .withColumn(
            "__hit",
            F.when(F.coalesce("__n", F.lit(0)) >= 2, F.col("__by_both"))
            .when(F.col("__n") == 1, F.col("__by_city"))
            .otherwise(F.col("__by_state")),
        )
        .select("__c", "__s", *[F.col(f"__hit.{c}").alias(c) for c in codes])
    )
    match = F.col(city).eqNullSafe(F.col("__c")) & F.col(state).eqNullSafe(F.col("__s"))
    return df.join(chosen, match, "left").drop("__c", "__s")


def pivot_first(df: DataFrame, keys: list[str], name: str, value: str, wanted: dict) -> DataFrame:
    """Long to wide in one pass: the largest value per key and wanted name."""
    return df.where(F.col(name).isin(list(wanted))).groupBy(*keys).agg(
        *[F.max(F.when(F.col(name) == F.lit(k), F.col(value))).alias(alias) for k, alias in wanted.items()]
    )


def eav_wide(items: DataFrame, attributes: DataFrame, on: list[str], name: str, value: str, wanted: dict) -> DataFrame:
    """Items with every wanted attribute as a column; items lacking one are left out."""
    wide = pivot_first(attributes, on, name, value, wanted)
    return items.join(wide.dropna(subset=list(wanted.values())), on)


def nest(
    parents: DataFrame, children: DataFrame, on: list[str], order: list[str], fields: list[str],
    name: str, size: int = 1000, ranges: int | None = None,
) -> DataFrame:
    """Children as an array on their parent.

    A parent with more than ``size`` children is written as several parts, each with its
    own ``part`` number, so that no row or task holds an unbounded list.
    """
    paged = page_rows(children, on, order, size, "part", "__at", ranges)
    lists = paged.groupBy(*on, "part").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("__at", *fields))),
            lambda x: F.struct(*[x[f].alias(f) for f in fields]),
        ).alias(name)
    )
    return parents.join(lists, on, "left").withColumn("part", F.coalesce("part", F.lit(1)))


def nest_tree(
    rows: DataFrame, levels: list[tuple[str, list[str]]], root: list[str], size: int = 1000,
    ranges: int | None = None,
) -> DataFrame:
    """Rows of a flat hierarchy as one tree per root, leaves innermost.

    ``levels`` lists (array name, id columns) from the top child level down to the leaf.
    Each tree part holds at most ``size`` leaves, which bounds every list above them.
    """
    order = [c for _, ids in levels for c in ids]
    tree = page_rows(rows, root, order, size, "part", "__at", ranges).drop("__at")
    for depth in range(len(levels) - 1, -1, -1):
        name, ids = levels[depth]
        above = [*root, "part"] + [c for _, up in levels[:depth] for c in up]
        inner = [levels[depth + 1][0]] if depth + 1 < len(levels) else []
        tree = tree.groupBy(*above).agg(F.sort_array(F.collect_list(F.struct(*ids, *inner))).alias(name))
    return tree


def text_list(df: DataFrame, keys: list[str], value: str, separator: str, size: int = 1000, ranges: int | None = None) -> DataFrame:
    """Values of each key as ordered text, in parts of at most ``size`` values."""
    paged = page_rows(df, keys, [value], size, "part", "__at", ranges)
    return paged.groupBy(*keys, "part").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__at", value))), lambda x: x[value]), separator)
        .alias(f"{value}_list")
    )


def only_in_first(first: DataFrame, second: DataFrame, extra: DataFrame) -> DataFrame:
    """EXCEPT of the first two, then UNION ALL with the third."""
    return first.subtract(second).unionAll(extra)
