"""Deduplication, histograms, range lookups and other row operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A table counted to have at most this many rows may be broadcast.
BROADCAST_ROWS = 100_000


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Of rows with equal keys (null equals null) the first in the given total order."""
    first = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", first).filter("__rank = 1").drop("__rank")


def with_first_line(df: DataFrame, keys: list[str], line: str = "line_no") -> DataFrame:
    """Adds first_line, the line on which a row's keys occur first."""
    firsts = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min(line).alias("first_line"))
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(firsts[f"__{k}"])
    return df.join(firsts, same).drop(*[f"__{k}" for k in keys])


def without_empty(df: DataFrame, columns: list[str]) -> DataFrame:
    """Empty strings become null, so that JSON leaves them out; false and 0 stay."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})


def histogram(df: DataFrame, value: str, by: list[str], bins: int) -> DataFrame:
    """Counts and densities over ``bins`` equal bins between each group's least and greatest value."""
    own = [f"__{k}" for k in by]
    ends = df.filter(F.col(value).isNotNull()).groupBy(*[F.col(k).alias(o) for k, o in zip(by, own, strict=True)]).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("n"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.withColumns({"lo": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")), "hi": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))})
    same = F.lit(True)
    for k, o in zip(by, own, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(o))
    joined = df.join(F.broadcast(ends) if ends.count() <= BROADCAST_ROWS else ends, same).select(*by, "lo", "hi", "n", value)
    bin_ = F.least(F.width_bucket(value, "lo", "hi", F.lit(bins)), F.lit(bins)).cast("int")
    width = (F.col("hi") - F.col("lo")) / bins
    found = joined.filter(F.col(value).isNotNull()).withColumn("bin", bin_).groupBy(*by, "bin", "lo", "hi", "n").agg(F.count("*").alias("cnt"))
    return found.select(*by, "bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_start"), "cnt", (F.col("cnt") / (F.col("n") * width)).alias("density"))


def first_rows(df: DataFrame, n: int, order: list[Column | str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def drop_nested(spans: DataFrame, keys: list[str], start: str = "span_start", end: str = "span_end") -> DataFrame:
    """Drops spans that lie in a strictly longer one with the same keys.

    In order of start, and the longer first, a span is nested exactly if a span before it ends no earlier and is not
    the same span; so a running maximum decides, without pairing the spans of a group."""
    order = W.partitionBy(*keys).orderBy(F.col(start), F.col(end).desc())
    reach = F.max(F.struct(F.col(end).alias("e"), (-F.col(start)).alias("s"))).over(order.rowsBetween(W.unboundedPreceding, -1))
    d = spans.withColumn("__reach", reach)
    inside = (F.col("__reach.e") > F.col(end)) | ((F.col("__reach.e") == F.col(end)) & (-F.col("__reach.s") < F.col(start)))
    return d.filter(~F.coalesce(inside, F.lit(False))).drop("__reach")


def code_sets(df: DataFrame) -> DataFrame:
    """set, size, code: the distinct sets of codes, a row a code."""
    d = df.select(F.array_sort(F.array_distinct("codes")).alias("set")).distinct()
    return d.select("set", F.size("set").alias("size"), F.explode("set").alias("code"))


def containment_candidates(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """own, set: the pairs of distinct sets that are compared. A set of rows is looked up by its code of the fewest groups
    alone (its prefix: a group that holds the set holds that code), among groups that are no smaller."""
    listed = materialized(code_sets(groups))
    often = materialized(listed.groupBy("code").agg(F.count(F.lit(1)).alias("n")))
    own = code_sets(rows).withColumnsRenamed({"set": "own", "size": "need"}).join(often, "code", "left")
    rarest = own.groupBy("own", "need").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "code")).alias("r"))
    rarest = rarest.filter("r.n > 0").select("own", "need", F.col("r.code").alias("code"))
    # A set of one code is in any group that has the code: the first is enough.
    one = listed.groupBy("code").agg(F.min("set").alias("set"))
    alone = rarest.filter("need = 1").join(one, "code").select("own", "set")
    return alone.unionAll(rarest.filter("need > 1").join(listed, "code").filter("size >= need").select("own", "set"))


def superset_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows (row_id, codes array), groups (group_id, codes array): the row_ids of which some group has all codes; a row
    without codes has none."""
    found = containment_candidates(rows, groups).filter(F.size(F.array_except("own", "set")) == 0).select(F.col("own").alias("__set")).distinct()
    keyed = rows.select("row_id", F.array_sort(F.array_distinct("codes")).alias("__own"))
    return keyed.join(found, F.col("__own") == F.col("__set"), "left_semi").select("row_id").distinct()


def near_candidates(pairs: DataFrame, gold: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, code, other): for each pair (key, code) the key's gold codes, or the codes that share a group with it, whichever
    are fewer; with them what each of the two still has to be looked up in."""
    listed = code_sets(groups)
    shared = materialized(listed.select("code", F.explode("set").alias("other")).distinct())  # codes that share a group
    degree = shared.groupBy("code").agg(F.count(F.lit(1)).alias("degree"))
    many = gold.groupBy("key").agg(F.count(F.lit(1)).alias("many"))
    sized = materialized(pairs.join(degree, "code").join(many, "key"))
    by_gold = sized.filter("many <= degree").select("key", "code").join(gold.withColumnRenamed("code", "other"), "key")
    by_group = sized.filter("many > degree").select("key", "code").join(shared, "code").select("key", "code", "other")
    return by_gold.join(shared, ["code", "other"], "left_semi").select("key", "code"), by_group.join(gold.withColumnRenamed("code", "other"), ["key", "other"], "left_semi").select("key", "code")


def near_pairs(pairs: DataFrame, gold: DataFrame, groups: DataFrame) -> DataFrame:
    """pairs (key, code), gold (key, code), groups (group_id, codes): the pairs whose code lies in a group that has a gold
    code of the key."""
    by_gold, by_group = near_candidates(pairs.distinct(), gold.distinct(), groups)
    return by_gold.unionAll(by_group).distinct()


def spread(df: DataFrame) -> DataFrame:
    """An input in fewer parts than the cluster has cores (one small file) is dealt over all cores before costly work;
    others stay as they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def materialized(df: DataFrame) -> DataFrame:
    """Computed once: a checkpoint in the folder that all executors see (see shared_folder)."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where none is set a local session gets one of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
