"""Set and order functions on arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_set(a: Column) -> Column:
    """Distinct values in order; empty for null."""
    return F.sort_array(F.array_distinct(F.coalesce(a, F.array().cast("array<string>"))))


def jaccard(gold: Column, predicted: Column) -> Column:
    """Shared share of the union; with no gold, 1 if nothing is predicted and else 0."""
    g, p = as_set(gold), as_set(predicted)
    both = F.size(F.array_intersect(g, p)) / F.greatest(F.size(F.array_union(g, p)), F.lit(1))
    return F.when(F.size(g) == 0, (F.size(p) == 0).cast("double")).otherwise(both)


def gold_weight(gold: Column) -> Column:
    return F.size(as_set(gold)) + 1


def weighted_mean(value: Column, weight: Column) -> Column:
    """An aggregate: the weighted mean, 0 without rows."""
    return F.coalesce(F.sum(value * weight) / F.sum(weight), F.lit(0.0))


def is_subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(as_set(a), as_set(b))) == 0


def repeated(a: Column) -> Column:
    """Values that occur twice or more, each once, in order of their first repeat."""
    seen = F.aggregate(
        F.coalesce(a, F.array().cast("array<string>")),
        F.struct(F.array().cast("array<string>").alias("once"), F.array().cast("array<string>").alias("more")),
        lambda acc, v: F.struct(
            F.array_append(acc["once"], v).alias("once"),
            F.when(F.array_contains(acc["once"], v) & ~F.array_contains(acc["more"], v), F.array_append(acc["more"], v)).otherwise(acc["more"]).alias("more"),
        ),
    )
    return seen["more"]


def gold_kind(kb: Column, gold: Column) -> Column:
    """single for one distinct code; for several, by knowledge base; null for an unknown one."""
    several = F.when(kb == "icd", "multi_sibling").when(kb == "rxnorm", "multi_solving")
    return F.when(F.size(as_set(gold)) == 1, "single").otherwise(several)


def at_share(ordered: Column, share: float) -> Column:
    """The value at index floor(share * n), the last at most, of an ascending array."""
    n = F.size(ordered)
    return F.get(ordered, F.least(n - 1, F.floor(n * F.lit(share))).cast("int"))
