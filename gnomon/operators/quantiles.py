"""Exact order statistics and running totals of any number of rows, without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gnomon.operators.tables import joined, written

c = F.col
#: Ranges that the values of a group are dealt into.
RANGES = 256
#: Accuracy of the sketch that says where a percentile lies, how many of its errors the bounds are apart from it, and
#: the largest group whose values between two bounds are ranked in one task: 8 of 10,000, two million at most.
ACCURACY, MARGIN, LARGEST = 10_000, 4, 2_500_000_000


def ranked(df: DataFrame, values: str | list[str], *by: str) -> DataFrame:
    """Distinct values (by, _m, _v) of each group and each named column with the ranks from _first to before _end that
    they take, of _n from 0. Nulls and NaNs take no rank.

    All columns go in one pass, each value with its column's name. Equal values are counted where they are read, and
    what is left is written once. Values are dealt into ranges of about equal numbers, by an approximate sketch that
    says where to cut and nothing else; each range is sorted on its own, from the rank that the counts of the ranges
    before it give. So no group comes together in one task."""
    names = [values] if isinstance(values, str) else values
    same = [*by, "_m"]
    counted = written(longer(df, names, *by).groupBy(*same, "_v").agg(F.count("*").alias("_k")))
    cuts = counted.groupBy(*same).agg(F.percentile_approx("_v", [i / RANGES for i in range(1, RANGES)], 10 * RANGES).alias("_cuts"))
    dealt = joined(counted, cuts, same).select(*same, "_v", "_k", F.size(F.filter("_cuts", lambda x: x < c("_v"))).alias("_part"))
    sizes = dealt.groupBy(*same, "_part").agg(F.sum("_k").alias("_size"))
    before = Window.partitionBy(*same).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*same, "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"), F.sum("_size").over(Window.partitionBy(*same)).alias("_n"))
    inner = Window.partitionBy(*same, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    end = c("_before") + F.sum("_k").over(inner)
    return joined(dealt, sizes, [*same, "_part"]).select(*same, "_v", (end - c("_k")).alias("_first"), end.alias("_end"), "_n")


def held(rank: Column, of: Column | None = None) -> Column:
    """The value that takes a rank, among rows of a condition."""
    takes = (c("_first") <= rank) & (rank < c("_end"))
    return F.max(F.when(takes if of is None else takes & of, c("_v")))


def longer(df: DataFrame, names: list[str], *by: str) -> DataFrame:
    """A row (by, _m, _v) for each value of the named columns; nulls and NaNs have none."""
    pairs = F.inline(F.array(*(F.struct(F.lit(x).alias("_m"), c(x).cast("double").alias("_v")) for x in names)))
    return df.select(*by, pairs).where("_v IS NOT NULL AND NOT isnan(_v)")


def several(df: DataFrame, wanted: dict[str, tuple[str, float]], *by: str) -> DataFrame:
    """Percentiles (name: column and share from 0 to 1) in each group, interpolated between neighbours; null where
    there are no values, as long as the group has a value of any column.

    A sketch gives bounds below and above each percentile. Values under the lower bound are counted where they are
    read, and only the few between the bounds are ranked, so two passes without a shuffle of the values do. Where a
    group is too large for that, or a bound turns out wrong, all values are ranked by ranges."""
    names = [*dict.fromkeys(v for v, _ in wanted.values())]
    same, off = [*by, "_m"], MARGIN / ACCURACY
    rows = longer(df, names, *by)
    cuts = [min(1.0, max(0.0, q + x)) for _, q in wanted.values() for x in (-off, off)]
    known = written(rows.groupBy(*same).agg(F.count("*").alias("_n"), F.percentile_approx("_v", cuts, ACCURACY).alias("_cuts")))
    if (known.agg(F.max("_n")).first()[0] or 0) > LARGEST:
        return by_ranges(df, wanted, *by)
    inf = F.lit(float("inf"))
    # The outermost bounds are none.
    low = [F.when(c("_m") == value, -inf if q <= off else c("_cuts")[2 * i]) for i, (value, q) in enumerate(wanted.values())]
    high = [F.when(c("_m") == value, inf if q >= 1 - off else c("_cuts")[2 * i + 1]) for i, (value, q) in enumerate(wanted.values())]
    own = joined(rows, known, same, "inner")
    below = own.groupBy(*same).agg(F.array(*(F.count_if(c("_v") < x) for x in low)).alias("_below"))
    within = [(c("_v") >= a) & (c("_v") <= b) for a, b in zip(low, high, strict=True)]
    each = F.filter(F.array(*(F.when(x, F.lit(i)) for i, x in enumerate(within))), lambda x: x.isNotNull())
    # Most values are between no bounds, and go before lists are made.
    near = own.where(reduce(or_, within)).select(*same, "_n", "_v", F.explode(each).alias("_i")).groupBy(*same, "_n", "_i", "_v").agg(F.count("*").alias("_k"))
    end = F.get("_below", c("_i")) + F.sum("_k").over(Window.partitionBy(*same, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = joined(near, below, same, "inner").withColumn("_end", end).withColumn("_first", c("_end") - c("_k"))
    made = []
    for i, (name, (_, q)) in enumerate(wanted.items()):
        at, of = q * (c("_n") - 1), c("_i") == i
        made += [held(F.floor(at), of).alias(f"{name}_low"), held(F.ceil(at), of).alias(f"{name}_high"), F.max(F.when(of, at - F.floor(at))).alias(f"{name}_part")]
    found = written(placed.groupBy(*by).agg(*made))
    groups = joined(found, known.groupBy(*by).agg(F.collect_set("_m").alias("_has")), list(by), "full" if by else "left")
    lost = [F.array_contains("_has", value) & (c(f"{name}_low").isNull() | c(f"{name}_high").isNull()) for name, (value, _) in wanted.items()]
    if groups.where(F.coalesce(*(F.when(x, True) for x in lost), F.lit(False))).limit(1).count():
        return by_ranges(df, wanted, *by)
    return found.select(*by, *between(wanted))


def between(wanted: dict[str, tuple[str, float]]) -> list[Column]:
    """Values between those of two neighbouring ranks."""
    return [(c(f"{name}_low") + (c(f"{name}_high") - c(f"{name}_low")) * c(f"{name}_part")).alias(name) for name in wanted]


def by_ranges(df: DataFrame, wanted: dict[str, tuple[str, float]], *by: str) -> DataFrame:
    """The same from the ranks of all values, for groups of any size."""
    return found_at(ranked(df, [*dict.fromkeys(v for v, _ in wanted.values())], *by), wanted, *by)


def found_at(ranks: DataFrame, wanted: dict[str, tuple[str, float]], *by: str) -> DataFrame:
    """Percentiles from values with their ranks, at the least those of the wanted ranks."""
    made = []
    for name, (value, q) in wanted.items():
        at, of = q * (c("_n") - 1), c("_m") == value
        made += [held(F.floor(at), of).alias(f"{name}_low"), held(F.ceil(at), of).alias(f"{name}_high"), F.max(F.when(of, at - F.floor(at))).alias(f"{name}_part")]
    return ranks.groupBy(*by).agg(*made).select(*by, *between(wanted))


def by_buckets(df: DataFrame, wanted: dict[str, tuple[str, float]], width: float, *by: str) -> DataFrame:
    """The same in two passes over df, which may be made anew in each: values are counted by buckets of a width, and
    those of the buckets that hold a wanted rank are ranked. For many values of a known, bounded range."""
    names = [*dict.fromkeys(v for v, _ in wanted.values())]
    rows = longer(df, names, *by).withColumn("_b", F.floor(c("_v") / width))
    counted = written(rows.groupBy(*by, "_m", "_b").agg(F.count("*").alias("_k")))
    holds = holding(counted, wanted, *by)
    near = joined(rows, F.broadcast(holds), [*by, "_m", "_b"], "inner").groupBy(*by, "_m", "_b", "_before", "_n", "_v").agg(F.count("*").alias("_k"))
    return at_buckets(near, wanted, *by)


def holding(counted: DataFrame, wanted: dict[str, tuple[str, float]], *by: str) -> DataFrame:
    """Of buckets with their counts (by, _m, _b, _k), those that hold the rank of a wanted percentile, with the number of
    values _before them and of all, _n."""
    group = Window.partitionBy(*by, "_m")
    upto = F.sum("_k").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.select(*by, "_m", "_b", (upto - c("_k")).alias("_before"), upto.alias("_upto"), F.sum("_k").over(group).alias("_n"))
    takes = []
    for value, q in wanted.values():
        at = q * (c("_n") - 1)
        takes += [(c("_m") == value) & (c("_before") <= rank) & (rank < c("_upto")) for rank in (F.floor(at), F.ceil(at))]
    return written(placed.where(reduce(or_, takes)).select(*by, "_m", "_b", "_before", "_n"))


def at_buckets(near: DataFrame, wanted: dict[str, tuple[str, float]], *by: str) -> DataFrame:
    """Percentiles from the distinct values of the buckets that hold their ranks (by, _m, _b, _before, _n, _v, _k)."""
    end = c("_before") + F.sum("_k").over(Window.partitionBy(*by, "_m", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    return found_at(near.select(*by, "_m", "_v", "_n", (end - c("_k")).alias("_first"), end.alias("_end")), wanted, *by)


def percentiles(df: DataFrame, value: str, wanted: dict[str, float], *by: str) -> DataFrame:
    """Percentiles (name: from 0 to 1) of one column in each group."""
    return several(df, {name: (value, q) for name, q in wanted.items()}, *by)


def at_ranks(df: DataFrame, value: str, wanted: dict[str, Callable[[Column], Column]], *by: str) -> DataFrame:
    """Values at ranks, from 0, that are functions of the number of values, and that number as _count."""
    return ranked(df, value, *by).groupBy(*by).agg(F.max("_n").alias("_count"), *(held(rank(c("_n"))).alias(name) for name, rank in wanted.items()))


def running(df: DataFrame, by: tuple[str, ...], order: tuple[str, ...], totals: dict[str, Column]) -> DataFrame:
    """df with the running total of each expression in order within each group, its own row included, and the group's
    whole total as <name>_all. Nulls add nothing.

    Rows are dealt into ranges of (by, order) and kept so; each range adds up its own rows, from what the ranges before
    it add up to. `order` has to tell rows apart where their place matters."""
    # Dealing by ranges reads its input twice, to sample and to deal, so that is made once before.
    own = written(df.withColumns({f"_x_{k}": x.cast("bigint") for k, x in totals.items()}))
    own = written(own.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()))
    sums = own.groupBy(*by, "_range").agg(*(F.coalesce(F.sum(f"_x_{k}"), F.lit(0)).alias(k) for k in totals))
    group = Window.partitionBy(*by)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(*by, "_range", *(F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_b_{k}") for k in totals), *(F.sum(k).over(group).alias(f"{k}_all") for k in totals))
    inner = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    made = {k: c(f"_b_{k}") + F.coalesce(F.sum(f"_x_{k}").over(inner), F.lit(0)) for k in totals}
    return joined(own, carried, [*by, "_range"]).withColumns(made).drop("_range", *(f"_x_{k}" for k in totals), *(f"_b_{k}" for k in totals))
