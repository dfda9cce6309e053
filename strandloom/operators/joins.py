"""Joins in time, by keyword and by look-up."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A table this small, counted when the plan is made, is broadcast for a join without equality; a larger one is refused.
THETA_ROWS = 20_000
#: Parts of one side of a product, for each of which the other side is copied.
SLICES = 64


def exact_or_latest(left: DataFrame, right: DataFrame, key: str, time: str, value: str, tail: str) -> DataFrame:
    """left joined to right at the same key and time; only if that finds nothing at all, to each key's latest row.

    The fallback is global, not per row: its branch is gated by a one-row count of the exact matches, in the same plan.
    Adds `value` of right. right's latest row is by time, then tail.
    """
    exact = left.join(right.select(key, time, value), [key, time])
    # Whether there is a match is told by the distinct keys and times: the matches themselves may be the product of both sides.
    any_exact = left.select(key, time).distinct().join(right.select(key, time).distinct(), [key, time]).agg((F.count("*") > 0).alias("_any"))
    # Both sides pass the gate before they are aggregated and joined: where it is shut, they are empty.
    gate = lambda df: df.crossJoin(F.broadcast(any_exact)).where("NOT _any").drop("_any")
    last = gate(right).groupBy(key).agg(F.max_by(F.struct(value), F.struct(time, tail)).alias("_last")).select(key, F.col(f"_last.{value}").alias(value))
    fallback = gate(left).join(last, key)
    return exact.unionByName(fallback.select(*exact.columns))


def within(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, before: int, after: int) -> DataFrame:
    """Pairs of an equal key with right_time in [left_time - before, left_time + after] seconds.

    Both sides are cut into spans as wide as the interval; a left row meets its own and the neighbouring spans by
    equality, so neither side is multiplied by the other.
    """
    width = max(1, before + after)
    second = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000
    low, high = F.floor((second(left_time) - before) / width), F.floor((second(left_time) + after) / width)
    a = left.withColumn("_span", F.explode(F.sequence(low, high)))
    b = right.withColumn("_span", F.floor(second(right_time) / width))
    gap = second(right_time) - second(left_time)
    return a.join(b, [key, "_span"]).where((gap >= -before) & (gap <= after)).drop("_span")


def lookup(df: DataFrame, table: DataFrame, on: list[str], fill: Mapping[str, object] | None = None) -> DataFrame:
    """A look-up join; with fill, rows without a match stay and get these values."""
    if fill is None:
        return df.join(table, on)
    return df.join(table, on, "left").fillna(dict(fill))


def small_table(df: DataFrame, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Constant rows as a broadcast table; their number is known here."""
    if len(rows) > THETA_ROWS:
        raise ValueError(f"{len(rows)} rows are too many to broadcast")
    return F.broadcast(df.sparkSession.createDataFrame(list(rows), schema))


def containing(df: DataFrame, text: Column, table: DataFrame, pattern: str, starts: str | None = None) -> DataFrame:
    """Rows whose text contains a pattern of a small table, which is counted first; with `starts`, also begins with that column's value.

    A substring has no equality to join on, so the table is broadcast and each row is tested against all of it.
    """
    if (n := table.count()) > THETA_ROWS:
        raise ValueError(f"{n} patterns: at most {THETA_ROWS} can be broadcast; use containing_words for whole words")
    hit = text.contains(F.col(pattern))
    return df.join(F.broadcast(table), hit if starts is None else hit & text.startswith(F.col(starts)))


def containing_words(df: DataFrame, key: str, text: Column, table: DataFrame, pattern: str) -> DataFrame:
    """The same for patterns that are single words, by equality on the words of a text: any number of patterns."""
    words = df.select("*", F.explode(F.array_distinct(F.split(text, r"[^\p{L}\p{N}]+"))).alias("_word"))
    return words.join(table, F.col("_word") == F.col(pattern)).drop("_word")


def pattern_pairs(df: DataFrame, entity: str, text: Column, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(a, relation, b): every entity that contains a pair's first pattern with every one that contains its second.

    One join against all patterns instead of one for each pair. The result is a product by definition, so it is neither
    dealt out nor sorted: both sides are distinct before they meet, and only relations that several pairs name need more.
    A pattern's entities are dealt into SLICES, each of which meets a copy of the other side, so a product is no single task's.
    """
    patterns = sorted({p for a, _, b in pairs for p in (a, b)})
    hits = containing(df, text, small_table(df, [(p,) for p in patterns], "pattern string"), "pattern").select(entity, "pattern").distinct()
    named = Counter(relation for _, relation, _ in set(pairs))

    def product(some: list[tuple[str, str, str]]) -> DataFrame:
        rules = F.broadcast(small_table(df, some, "p string, relation string, q string"))
        a = hits.select(F.col(entity).alias("a"), F.col("pattern").alias("p")).join(rules, "p").withColumn("slice", F.pmod(F.xxhash64("a"), F.lit(SLICES)))
        b = hits.select(F.col(entity).alias("b"), F.col("pattern").alias("q")).join(F.broadcast(rules.select("q").distinct()), "q")
        b = b.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))))
        return a.join(b.hint("merge"), ["q", "slice"]).where("a <> b").select("a", "relation", "b")

    once, again = ([x for x in dict.fromkeys(pairs) if (named[x[1]] == 1) == alone] for alone in (True, False))
    if not again:
        return product(once)
    return product(once).unionByName(product(again).distinct()) if once else product(again).distinct()


def best_of(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """One row for each key, the first by ascending order: a minimum, which is aggregated before anything is dealt out."""
    first = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*key).agg(first.alias("_first")).select("_first.*")


def stated_or_derived(entities: DataFrame, stated: DataFrame, derived: DataFrame, key: str, name: str) -> DataFrame:
    """entities with `name` from `stated` where it has one, else from `derived`."""
    a = stated.select(key, F.col(name).alias("_a"))
    b = derived.select(key, F.col(name).alias("_b"))
    return entities.join(a, key, "left").join(b, key, "left").withColumn(name, F.coalesce("_a", "_b")).drop("_a", "_b")


def moneyness(strike: Column, price: Column, right: Column, band: float = 0.02) -> Column:
    """ATM within band of the price (tested first), else ITM or OTM by the side of the right; null without a usable price."""
    above = strike > price
    call = right == "CALL"
    inside = (call & ~above) | (~call & above)
    return F.when((price > 0) & strike.isNotNull(), F.when(F.abs(strike - price) <= price * band, "ATM").when(inside, "ITM").otherwise("OTM"))
