"""Joins on intervals by equality: an interval is cut into dyadic bins, a point lies in one bin of each level.

A bin of level v holds 2^v consecutive whole numbers. An interval is the disjoint union of at most two bins a level, a
logarithmic number of them; a point meets it in exactly one of them or not at all. So points and intervals are joined on
(keys, level, bin), which Spark shuffles or broadcasts like any equality and whose hot keys it can split, and no pair
appears twice. Points are copied only to the levels that occur.

Where only numbers are asked for, no pair is made: bins are summed before points meet them (``held``), and overlaps are
differences of running counts (``overlap_counts``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentionforge.operators.rows import BROADCAST_ROWS, materialized

LEVELS = 63


def dyadic_bins(low: Column, high: Column) -> Column:
    """The bins (struct level, bin) of the whole numbers from low up to, but without, high; none where low >= high."""
    start = F.struct(low.cast("long").alias("a"), high.cast("long").alias("z"), F.array().cast("array<struct<level:int,bin:bigint>>").alias("bins"))
    none = F.array().cast("array<struct<level:int,bin:bigint>>")

    def step(s: Column, level: Column) -> Column:
        a, z = s["a"], s["z"]
        left = (a < z) & (F.pmod(a, F.lit(2)) == 1)
        right = (a < z) & (F.pmod(z, F.lit(2)) == 1)
        of = lambda b: F.array(F.struct(level.alias("level"), b.alias("bin")))
        found = F.concat(s["bins"], F.when(left, of(a)).otherwise(none), F.when(right & (~left | (a + 1 < z)), of(z - 1)).otherwise(none))
        return F.struct(F.shiftright(a + F.when(left, 1).otherwise(0), 1).alias("a"), F.shiftright(z - F.when(right, 1).otherwise(0), 1).alias("z"), found.alias("bins"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), start, step, lambda s: s["bins"])


def _binned(intervals: DataFrame, columns: list[Column], keys: list[str], low: str, high: str) -> DataFrame:
    """A row a bin of each interval: columns, the keys as __key, level, bin."""
    d = intervals.select(*columns, *[F.col(k).alias(f"__{k}") for k in keys], F.explode(dyadic_bins(F.col(low), F.col(high))).alias("__of"))
    return d.withColumns({"__of_level": F.col("__of.level"), "__of_bin": F.col("__of.bin")}).drop("__of")


def _sizes(binned: DataFrame) -> dict[int, int]:
    """How many bins each level has, the widest first; LEVELS rows at most."""
    return {r[0]: r[1] for r in binned.groupBy("__of_level").agg(F.count(F.lit(1))).orderBy(F.desc("__of_level")).collect()}


def _meet(points: DataFrame, binned: DataFrame, levels: list[int], few: bool, keys: list[str], point: str) -> DataFrame:
    """Points, copied to ``levels``, with the bins that hold them; bins that are not few are never broadcast, whatever
    their size is taken for."""
    copied = points.withColumn("__level", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")))
    copied = copied.withColumn("__bin", F.expr(f"shiftright(CAST(`{point}` AS BIGINT), __level)"))
    same = (F.col("__level") == F.col("__of_level")) & (F.col("__bin") == F.col("__of_bin"))
    for k in keys:
        same = same & (copied[k] == F.col(f"__{k}"))
    return copied.join(F.broadcast(binned) if few else binned.hint("merge"), same)


def points_in_intervals(points: DataFrame, intervals: DataFrame, keys: list[str] = (), point: str = "at", low: str = "low", high: str = "high") -> DataFrame:
    """Each point with each interval that holds it (low <= point < high, whole numbers; null keys meet nothing): the
    columns of points, and a struct ``interval`` of those of intervals."""
    binned = _binned(intervals, [F.struct("*").alias("interval")], keys, low, high)
    sizes = _sizes(binned)
    return _meet(points, binned, list(sizes), sum(sizes.values()) <= BROADCAST_ROWS, keys, point).select(*points.columns, "interval")


def held(points: DataFrame, intervals: DataFrame, first: Column, keys: list[str] = (), point: str = "at", low: str = "low", high: str = "high") -> DataFrame:
    """keys, point, n, first: each distinct point that lies in some interval, with how many there are and the least of
    ``first`` among them. Bins are summed first, so a point meets a row a level, however many intervals hold it. Wide bins,
    of which there are few, are sent to the points."""
    binned = _binned(intervals, [first.alias("first")], keys, low, high)
    own = [f"__{k}" for k in keys]
    binned = materialized(binned.groupBy(*own, "__of_level", "__of_bin").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("first")))
    wide, narrow, many = [], [], 0
    for level, n in _sizes(binned).items():
        many += n
        (wide if many <= BROADCAST_ROWS else narrow).append(level)
    distinct = points.select(*keys, point).distinct()
    met = lambda levels, few: _meet(distinct, binned.filter(F.col("__of_level").isin(levels)), levels, few, keys, point)
    found = met(wide, True).unionByName(met(narrow, False)) if narrow else met(wide, True)
    return found.groupBy(*keys, point).agg(F.sum("n").alias("n"), F.min("first").alias("first"))


def first_interval(points: DataFrame, intervals: DataFrame, order: list[str], keys: list[str] = (), point: str = "at", low: str = "low", high: str = "high") -> DataFrame:
    """Every row of points, which ``point`` and the keys tell apart or not, with the first interval (by the columns
    ``order``) that holds it, or null. Lookups are made once for each distinct point."""
    distinct = points.select(*keys, point).distinct()
    found = points_in_intervals(distinct, intervals, keys, point, low, high)
    found = found.groupBy(*keys, point).agg(F.min_by("interval", F.struct(*[f"interval.{c}" for c in order])).alias("interval"))
    return points.join(found, [*keys, point], "left")


def overlapping(a: DataFrame, b: DataFrame, keys: list[str] = (), low: str = "low", high: str = "high") -> DataFrame:
    """Each pair of overlapping intervals, as structs a and b: one of them begins in the other. Empty ones overlap none."""
    full = lambda d: d.filter(F.col(low) < F.col(high))
    row = lambda d, name: full(d).select(F.struct("*").alias(name), *keys, F.col(low).alias("__at"))
    begins_in_b = points_in_intervals(row(a, "a"), full(b), keys, "__at", low, high).select("a", F.col("interval").alias("b"))
    begins_in_a = points_in_intervals(row(b, "b"), full(a), keys, "__at", low, high).select(F.col("interval").alias("a"), "b")
    return begins_in_b.unionByName(begins_in_a.filter(F.col(f"a.{low}") < F.col(f"b.{low}")))


def _running(d: DataFrame, keys: list[str], at: str, sums: list[str]) -> DataFrame:
    """d (keys, at, one row each) with ``sums`` replaced by their running sums in order of ``at``. Rows are cut to ranges of
    (keys, at), so a hot key lies in many; a range adds what the ranges before it have in sum."""
    own = keys or [F.lit(0)]
    parts = materialized(d.repartitionByRange(*keys, at).withColumn("__part", F.spark_partition_id()))
    before = W.partitionBy(*own).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    whole = parts.groupBy(*keys, "__part").agg(*[F.sum(c).alias(c) for c in sums])
    whole = whole.select(*keys, "__part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__{c}") for c in sums])
    inside = W.partitionBy(*keys, "__part").orderBy(at).rowsBetween(W.unboundedPreceding, 0)
    return parts.join(whole, [*keys, "__part"]).withColumns({c: F.sum(c).over(inside) + F.col(f"__{c}") for c in sums}).drop("__part", *[f"__{c}" for c in sums])


def overlap_counts(intervals: DataFrame, keys: list[str] = (), low: str = "low", high: str = "high") -> DataFrame:
    """Each row of intervals with n_over: the rows of its keys that overlap it, which are those with a low below its high and
    a high above its low (itself too, unless it is empty; an empty one overlaps those around it; null keys and ends overlap
    nothing and are left out). Counted, not paired: those that begin before its end, without those that end before its
    start. Only reversed intervals (high < low), which what encloses them overlaps, are paired."""
    keys, own = list(keys), [f"__{k}" for k in keys]
    full = intervals.dropna(subset=[*keys, low, high])
    named = [F.col(k).alias(o) for k, o in zip(keys, own, strict=True)]
    d = materialized(full.groupBy(*named, F.col(low).cast("long").alias("__a"), F.col(high).cast("long").alias("__z")).agg(F.count(F.lit(1)).alias("n")))
    proper, reversed_ = d.filter("__a <= __z"), d.filter("__a > __z")
    ends = proper.select(*own, F.col("__a").alias("at"), F.col("n").alias("begun"), F.lit(0).alias("ended"), F.when(F.col("__a") == F.col("__z"), F.col("n")).otherwise(0).alias("empty"))
    ends = ends.union(proper.select(*own, "__z", F.lit(0), "n", F.lit(0))).groupBy(*own, "at").agg(*[F.sum(c).alias(c) for c in ("begun", "ended", "empty")])
    marks = materialized(_running(ends.withColumn("begins", F.col("begun")), own, "at", ["begun", "ended"]))
    at_end = marks.select(*own, F.col("at").alias("__z"), (F.col("begun") - F.col("begins")).alias("begun"))
    at_start = marks.select(*own, F.col("at").alias("__a"), "ended", "empty")
    # What is empty at the start of an empty one has not begun before its end, so it is not taken away either.
    n = F.col("begun") - F.col("ended") + F.when(F.col("__a") == F.col("__z"), F.col("empty")).otherwise(0)
    found = proper.join(at_end, [*own, "__z"]).join(at_start, [*own, "__a"]).select(*own, "__a", "__z", n.alias("n_over"))
    if not reversed_.isEmpty():
        pairs = points_in_intervals(reversed_, proper.withColumn("__from", F.col("__a") + 1), own, "__z", "__from", "__z").filter(F.col("interval.__z") > F.col("__a"))
        around = pairs.select(*own, F.col("interval.__a").alias("__a"), F.col("interval.__z").alias("__z"), F.col("n").alias("n_over"))
        found = found.union(around).union(pairs.select(*own, "__a", "__z", "interval.n")).union(reversed_.select(*own, "__a", "__z", F.lit(0)))
        found = found.groupBy(*own, "__a", "__z").agg(F.sum("n_over").alias("n_over"))
    same = (full[low].cast("long") == F.col("__a")) & (full[high].cast("long") == F.col("__z"))
    for k, o in zip(keys, own, strict=True):
        same = same & (full[k] == F.col(o))
    return full.join(found, same).select(*[full[c] for c in intervals.columns], "n_over")
