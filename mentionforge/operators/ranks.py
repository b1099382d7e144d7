"""Places in an order and order statistics, without a group's rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentionforge.operators.rows import BROADCAST_ROWS, materialized

#: Of the sketches, and how many of their errors wide a bracket is to each side.
ACCURACY = 10_000
MARGIN = 4


def same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[f"__{k}"])
    return on


def before(rows: DataFrame, keys: list[str], bucket: Column, order: list, n: Column) -> DataFrame:
    """rows with before, the sum of n of the key's rows that come earlier, and total, the sum of n of all. bucket must
    not fall along the order and have a bounded number of values: only a bucket's rows are ordered in one task."""
    d = rows.withColumns({"__bucket": bucket, "__n": n.cast("long")})
    sums = d.groupBy(*keys, "__bucket").agg(F.sum("__n").alias("__in"))
    w = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))  # rows of buckets
    sums = sums.select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("__bucket").alias("__b"), F.sum("__in").over(w).alias("total"),
        F.coalesce(F.sum("__in").over(w.orderBy(F.asc_nulls_first("__bucket")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__earlier"),
    )
    inside = W.partitionBy(*keys, "__bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumn("__within", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    d = d.join(sums, same(d, sums, keys) & d["__bucket"].eqNullSafe(sums["__b"]))
    return d.withColumn("before", F.col("__earlier") + F.col("__within")).select(*rows.columns, "before", "total")


def index(share: float) -> Column:
    """floor(share * n), the last at most."""
    return F.least(F.col("n") - 1, F.floor(F.col("n") * F.lit(share)))


def order_values(rows: DataFrame, keys: list[str], value: str, at: dict[str, tuple[float, Column]]) -> DataFrame:
    """A row a key: n (values, without null), min, max and, by name, the values at places in ascending order: at has for
    each a share, near which the place is, and the place itself, an expression over n.

    A mergeable sketch of each key brackets the places: its ranks are wrong by a part of 1 / ACCURACY at most. One more
    pass counts what lies below each bracket and the values in it, which are a few thousandths of a key's; only those are
    put in order, so no key's values meet in one task."""
    d = materialized(rows.select(*keys, F.col(value).alias("__v")))
    names, wide = list(at), MARGIN / ACCURACY
    shares = [x for p, _ in at.values() for x in (max(0.0, p - wide), min(1.0, p + wide))]
    sketch = d.groupBy(*keys).agg(F.count("__v").alias("n"), F.min("__v").alias("min"), F.max("__v").alias("max"), F.percentile_approx("__v", shares, ACCURACY).alias("__q"))
    sketch = materialized(sketch)
    end = lambda i, share, edge: F.col(edge) if share in (0.0, 1.0) else F.get("__q", F.lit(i))
    # A place lies within one rank of its share of n.
    brackets = F.array(*[F.struct(F.lit(j).alias("j"), at[name][1].cast("long").alias("place"), end(2 * j, shares[2 * j], "min").alias("lo"), end(2 * j + 1, shares[2 * j + 1], "max").alias("hi")) for j, name in enumerate(names)])
    own = sketch.select(*[F.col(k).alias(f"__{k}") for k in keys], brackets.alias("__b"))
    own = F.broadcast(own) if own.count() <= BROADCAST_ROWS else own
    met = d.filter("__v IS NOT NULL").join(own, same(d, own, keys)).select(*keys, "__v", F.explode(F.filter("__b", lambda b: F.col("__v") <= b["hi"])).alias("__b"))
    counted = met.groupBy(*keys, "__b.j", "__b.place", F.when(F.col("__v") >= F.col("__b.lo"), F.col("__v")).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    upto = F.sum("__c").over(W.partitionBy(*keys, "j").orderBy(F.asc_nulls_first("__v")))
    hit = counted.withColumn("__upto", upto).filter((F.col("place") < F.col("__upto")) & (F.col("place") >= F.col("__upto") - F.col("__c")))
    found = hit.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(*[F.max(F.when(F.col("j") == j, F.col("__v"))).alias(f"__at{j}") for j in range(len(names))])
    out = sketch.drop("__q").join(found, same(sketch, found, keys), "left")
    missed = F.raise_error(F.lit("a quantile sketch was wrong by more than its bound"))
    sure = lambda j: F.when((F.col("n") > 0) & F.col(f"__at{j}").isNull(), missed.cast(dict(d.dtypes)["__v"])).otherwise(F.col(f"__at{j}"))
    return out.select(*keys, "n", "min", "max", *[sure(j).alias(name) for j, name in enumerate(names)])


def five_numbers(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, min, q25, median, q75, max: quartiles by index, the median between neighbours; a key without values has a
    row, too."""
    at = {"q25": (0.25, index(0.25)), "__low": (0.5, F.floor((F.col("n") - 1) / 2)), "__high": (0.5, F.floor(F.col("n") / 2)), "q75": (0.75, index(0.75))}
    found = order_values(rows, keys, value, at)
    return found.select(*keys, "n", "min", "q25", (F.col("__low") * 0.5 + F.col("__high") * 0.5).alias("median"), "q75", "max")
