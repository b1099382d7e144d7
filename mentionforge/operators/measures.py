"""Recall, labels, margins and leaks over score dumps.

A dump has a row a mention: record_id, kb, gold, noise, gold_kind, cluster_name, distractor, candidates (an array of
struct(doc_id, role, codes, dense_score, bm25_score, rerank_score))."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionforge.functions.arrays import as_set, gold_kind, gold_weight, is_subset, jaccard, weighted_mean
from mentionforge.operators.ranks import five_numbers, same
from mentionforge.operators.rows import histogram, materialized

MULTI_KINDS = ["multi_sibling", "multi_solving"]


def all_codes(candidates: Column) -> Column:
    return F.flatten(F.transform(candidates, lambda c: c["codes"]))


def candidates_score(pairs: DataFrame, gold: str = "gold", predicted: str = "predicted") -> DataFrame:
    """One row: score, the weighted mean of the Jaccard similarities, and n."""
    return pairs.agg(weighted_mean(jaccard(F.col(gold), F.col(predicted)), gold_weight(F.col(gold))).alias("score"), F.count("*").alias("n"))


def with_recall(dump: DataFrame) -> DataFrame:
    """Adds recall_union, recall_dense, recall_bm25: whether all gold codes are among those that the branch found."""
    branch = lambda s: all_codes(F.filter("candidates", lambda c: c[s].isNotNull()))
    return dump.withColumns({
        "recall_union": is_subset(F.col("gold"), all_codes(F.col("candidates"))),
        "recall_dense": is_subset(F.col("gold"), branch("dense_score")), "recall_bm25": is_subset(F.col("gold"), branch("bm25_score")),
    })


def recall_by_group(dump: DataFrame) -> DataFrame:
    """grp, n and the recalls: of all, and by kb, noise and gold_kind."""
    rates = ", ".join(f"round(avg(cast({c} AS int)), 4) AS {c}" for c in ("recall_union", "recall_dense", "recall_bm25"))
    name = lambda c: f"WHEN grouping({c}) = 0 THEN concat('{c}=', coalesce({c}, '-'))"
    return dump.sparkSession.sql(
        f"SELECT CASE {name('kb')} {name('noise')} {name('gold_kind')} ELSE 'all' END AS grp, count(*) AS n, {rates} "
        "FROM {d} GROUP BY GROUPING SETS ((), (kb), (noise), (gold_kind))", d=with_recall(dump),
    )


def labelled(dump: DataFrame) -> DataFrame:
    """A row a candidate: label gold, distractor or other (gold wins), and its scores."""
    d = dump.select("record_id", "kb", "cluster_name", "gold", "distractor", F.explode("candidates").alias("c"))
    meets = lambda x: F.coalesce(F.arrays_overlap(as_set(F.col("c.codes")), as_set(F.col(x))), F.lit(False))
    label = F.when(meets("gold"), "gold").when(meets("distractor"), "distractor").otherwise("other")
    return d.select("record_id", "kb", "cluster_name", F.col("c.doc_id").alias("doc_id"), label.alias("label"), F.col("c.rerank_score").alias("score"))


def score_summary(dump: DataFrame) -> DataFrame:
    return five_numbers(labelled(dump), ["kb", "label"], "score")


def by_score(candidates: Column) -> Column:
    """Candidates in descending order of score, ties in their own order."""
    keyed = F.transform(candidates, lambda c, i: F.struct((-c["rerank_score"]).alias("k"), i.alias("i"), c.alias("c")))
    return F.transform(F.array_sort(keyed), lambda s: s["c"])


def margin_floor(dump: DataFrame) -> DataFrame:
    """record_id, kb, need: the least margin with which the codes of the kept candidates cover the gold; null if none
    does. Only rows with several gold codes. The candidates of a row are one array, as in the dump."""
    d = dump.filter(F.col("gold_kind").isin(MULTI_KINDS)).select("record_id", "kb", "gold", by_score(F.col("candidates")).alias("c"))
    top = F.get("c", F.lit(0))["rerank_score"]
    covers = F.filter(F.sequence(F.lit(1), F.size("c")), lambda m: is_subset(F.col("gold"), all_codes(F.slice("c", 1, m))))
    least = F.when(F.size("c") > 0, F.get(covers, F.lit(0)))
    return d.select("record_id", "kb", (top - F.get("c", least - 1)["rerank_score"]).alias("need"))


def margin_ceiling(dump: DataFrame) -> DataFrame:
    """record_id, kb, cluster_name, gap: best gold minus best distractor score, where both exist."""
    best = lambda x: F.max(F.when(F.col("label") == x, F.col("score")))
    d = labelled(dump).groupBy("record_id", "kb", "cluster_name").agg((best("gold") - best("distractor")).alias("gap"))
    return d.filter("gap IS NOT NULL")


def cluster_gaps(dump: DataFrame) -> DataFrame:
    """kb, cluster_name, n, median_gap, min_gap, n_lost, in order of the median."""
    gaps = materialized(margin_ceiling(dump))
    keys = ["kb", "cluster_name"]
    lost = gaps.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.count_if(F.col("gap") <= 0).alias("n_lost"))
    d = five_numbers(gaps, keys, "gap")
    d = d.join(lost, same(d, lost, keys)).select(*keys, "n", F.col("median").alias("median_gap"), F.col("min").alias("min_gap"), "n_lost")
    return d.orderBy(F.round("median_gap", 3), *keys)


def verdict(dump: DataFrame) -> DataFrame:
    """kb, need, allow, safe: whether the median floor of the margin lies under the median ceiling."""
    need = five_numbers(margin_floor(dump).filter("need IS NOT NULL"), ["kb"], "need").select("kb", F.col("median").alias("need"))
    allow = five_numbers(margin_ceiling(dump), ["kb"], "gap").select("kb", F.col("median").alias("allow"))
    return need.join(allow, "kb").withColumn("safe", F.col("need") < F.col("allow"))


def predicted(candidates: Column, floor: Column, margin: Column) -> Column:
    """The codes of the candidates with a score of at least max(floor, best - margin)."""
    scores = F.transform(candidates, lambda c: c["rerank_score"])
    least = F.greatest(floor, F.array_max(scores) - margin)
    return as_set(all_codes(F.filter(candidates, lambda c: c["rerank_score"] >= least)))


def leak_rate(dump: DataFrame, floor: float, margin: float) -> DataFrame:
    """cluster, n, leaked, rate: how often a distractor is predicted, among rows that have one; worst first."""
    d = dump.filter(F.size(as_set(F.col("distractor"))) > 0)
    leak = F.arrays_overlap(predicted(F.col("candidates"), F.lit(floor), F.lit(margin)), as_set(F.col("distractor")))
    d = d.withColumn("__leak", F.coalesce(leak, F.lit(False)).cast("int"))
    d = d.groupBy(F.coalesce("cluster_name", F.lit("None")).alias("cluster")).agg(F.count("*").alias("n"), F.sum("__leak").alias("leaked"), F.round(F.avg("__leak"), 2).alias("rate"))
    return d.orderBy(F.desc("rate"), "cluster")




def with_gold_kind(rows: DataFrame) -> DataFrame:
    """Sets gold_kind as it follows from kb and gold (an unknown kb with several codes fails), and distractor to an
    empty list where it is missing."""
    kind = gold_kind(F.col("kb"), F.col("gold"))
    known = F.when(kind.isNotNull(), kind).otherwise(F.raise_error(F.concat(F.lit("no kind for kb "), F.coalesce("kb", F.lit("null")))).cast("string"))
    other = F.col("distractor") if "distractor" in rows.columns else F.lit(None).cast("array<string>")
    return rows.withColumns({"gold_kind": known, "distractor": F.coalesce(other, F.array().cast("array<string>"))})


def counts_by_kind(rows: DataFrame, kinds: Sequence[str] = ("single", *MULTI_KINDS)) -> DataFrame:
    """gold_kind, n in the order of kinds; kinds that do not occur count 0."""
    wanted = rows.sparkSession.createDataFrame(list(enumerate(kinds)), "i int, gold_kind string")
    n = rows.groupBy(gold_kind(F.col("kb"), F.col("gold")).alias("gold_kind")).agg(F.count("*").alias("n"))
    return wanted.join(n, "gold_kind", "left").orderBy("i").select("gold_kind", F.coalesce("n", F.lit(0)).alias("n"))


def report(dumps: Mapping[str, DataFrame | None]) -> dict[str, dict[str, DataFrame]]:
    """The tables of the distribution report by query variant: recall, score summaries, floors and ceilings of the
    margin, cluster gaps, verdicts, and the histograms' bins. A variant without a dump is left out."""
    out = {}
    for variant, dump in dumps.items():
        if dump is None:
            continue
        scores = labelled(dump).withColumn("is_gold", F.col("label") == "gold")
        need, gap = margin_floor(dump).filter("need IS NOT NULL"), margin_ceiling(dump)
        summary = lambda d, c: five_numbers(d, ["kb"], c)
        out[variant] = {
            "recall": recall_by_group(dump), "scores": score_summary(dump), "margin_floor": summary(need, "need"), "margin_ceiling": summary(gap, "gap"), "clusters": cluster_gaps(dump), "verdict": verdict(dump),
            "score_bins": histogram(scores, "score", ["kb", "is_gold"], 50), "floor_bins": histogram(need, "need", ["kb"], 30), "ceiling_bins": histogram(gap, "gap", ["kb"], 30),
        }
    return out
