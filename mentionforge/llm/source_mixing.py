"""Mixing sources to target weights, with hash-threshold histograms.

Each row gets a 60-bit hash of its id and its text. Words are summed by source and by the hash's first 15 bits; the bucket in
which a source's budget ends is refined by the next 15 bits, and so on, until one hash value is left. A row is in
the mix if its hash is below its source's threshold: nothing is sorted by hash and no row is gathered. The row at the
threshold does not fit; what it leaves open is a smaller budget, for which the next threshold is found among the rows
behind it that are small enough, and so on (nested budgets).
All steps are DataFrame operations.

Edge cases: a null text has size 0; texts are counted whole, however long; a null source is a source of its own and comes
last; a null id is hashed as the empty text; rows that share an id and a text share a hash and are taken or left together;
other columns may have any name and stay as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentionforge.llm.common import cut, join_counted, quoted, whole, word_count

BITS = 15
LEVELS = 4
TOP = 1 << (BITS * LEVELS)
#: How often what a boundary row has left open is filled with rows behind it that fit.
ROUNDS = 3


def mix_hash(doc_id: Column, text: Column, seed: str = "mix") -> Column:
    """The first 60 bits of md5(seed:id:md5(text)), so that rows without ids are dealt, too."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(whole(text).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(source, source_size) to source_size, target: ``share`` of all words goes to the sources by weight; a target
    stops at ``cap`` times its source's size, and the excess is shared anew by weight until none is above.

    The fixed point in one pass: in ascending order of cap by weight, a source is capped if its share of what is
    left is not below its cap. One row a source is ordered in one task; it is the table of source names, not of rows.
    """
    in_order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = (
        sizes.withColumn("rank", F.row_number().over(in_order) - 1)
        .withColumn("weight", F.get(cycle, (F.col("rank") % len(weights)).cast("int")))
        .withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    )
    everyone = W.partitionBy()
    by_ratio = W.orderBy(F.col("limit") / F.col("weight"), "rank")
    earlier = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("budget", F.sum("source_size").over(everyone) * F.lit(float(share))).withColumns({
        "left": F.col("budget") - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0)),
        "left_weight": F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)),
    })
    capped = F.col("limit") * F.col("left_weight") <= F.col("weight") * F.col("left")
    rows = rows.withColumn("capped", capped).withColumns({
        "free_words": F.col("budget") - F.coalesce(F.sum(F.when(capped, F.col("limit"))).over(everyone), F.lit(0.0)),
        "free_weight": F.coalesce(F.sum(F.when(~capped, F.col("weight"))).over(everyone), F.lit(0.0)),
    })
    target = F.when(F.col("capped"), F.col("limit")).otherwise(F.col("weight") * F.col("free_words") / F.col("free_weight"))
    return rows.select("source", "source_size", target.alias("target"))


def boundary(base: DataFrame, open_: DataFrame, n_sources: int) -> DataFrame:
    """open_ (source, need, start, cap): of the rows with a hash from ``start`` on and a size up to ``cap``, in order of
    hash, the first hash at which their words exceed ``need``, and the words before it: source, edge, before. Sources
    whose rows all fit are left out."""
    none = F.lit(0).cast("long")
    edge = open_.withColumns({"prefix": none, "before": none})
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        inside = join_counted(base, edge, ["source"], "inner").filter((F.col("hash") >= F.col("start")) & (F.col("size") <= F.col("cap")))
        if level > 1:
            inside = inside.filter(F.shiftright("hash", shift + BITS) == F.col("prefix"))
        bins = inside.groupBy("source", "need", "start", "cap", "before", F.shiftright("hash", shift).alias("bin")).agg(F.sum("size").alias("words"))
        upto = F.col("before") + F.sum("words").over(W.partitionBy("source").orderBy("bin"))
        over = bins.withColumn("upto", upto).filter(F.col("upto") > F.col("need"))
        first = F.min(F.struct("bin", "upto", "words", "need", "start", "cap")).alias("b")
        edge = cut(over.groupBy("source").agg(first).select("source", "b.need", "b.start", "b.cap", F.col("b.bin").alias("prefix"), (F.col("b.upto") - F.col("b.words")).alias("before")), n_sources << 10)  # a task has a few dozen sources, of 2^15 bins at most
    return edge.select("source", F.col("prefix").alias("edge"), "before")


def thresholds(base: DataFrame, targets: DataFrame, rounds: int) -> DataFrame:
    """base (source, size, hash), targets (source, source_size, target) to source, source_size, target, copies, marks:
    a source's rows are taken ``copies`` times, and once more those that lie in one of the marks (start, below, cap):
    their hash is from start on and under below, and their size is cap at most. Each round fills what the round
    before has left, behind its boundary, with rows that fit."""
    twice = F.col("target") > F.col("source_size")
    need = F.when(twice, F.col("target") - F.col("source_size")).otherwise(F.col("target"))
    largest = F.lit((1 << 63) - 1)
    n = targets.count()
    state = targets.withColumns({"copies": F.when(twice, 1).otherwise(0), "need": need, "start": F.lit(0).cast("long"), "cap": largest, "marks": F.array().cast("array<struct<start:bigint,below:bigint,cap:bigint>>")})
    for _ in range(rounds):
        found = boundary(base, state.filter(F.col("start") < TOP).select("source", "need", "start", "cap"), n)
        below = F.coalesce("edge", F.lit(TOP))
        left = F.when(F.col("edge").isNotNull(), F.col("need") - F.col("before")).otherwise(F.lit(0.0))
        mark = F.struct("start", below.alias("below"), "cap")
        state = cut(join_counted(state, found, ["source"]).select(
            "source", "source_size", "target", "copies", left.alias("need"), F.when(F.col("edge").isNotNull(), F.col("edge") + 1).otherwise(F.lit(TOP)).alias("start"),
            F.floor(left).cast("long").alias("cap"), F.when(F.col("start") < TOP, F.array_append("marks", mark)).otherwise(F.col("marks")).alias("marks"),
        ), n)
    return state.select("source", "source_size", "target", "copies", "marks")


def plan_mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "mix", rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The sizes (doc_id, source, size, hash) of all rows, and each source's thresholds."""
    base = cut(docs.select(docs[quoted(id_col)].alias("doc_id"), docs[quoted(source_col)].cast("string").alias("source"), word_count(docs[quoted(text_col)]).alias("size"), mix_hash(docs[quoted(id_col)], docs[quoted(text_col)], seed).alias("hash")))
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut(source_targets(sizes, weights, share, cap))
    return base, thresholds(base, targets, rounds)


def taken_copies() -> Column:
    inside = F.exists("marks", lambda m: (F.col("hash") >= m["start"]) & (F.col("hash") < m["below"]) & (F.col("size") <= m["cap"]))
    return F.col("copies") + F.when(inside, 1).otherwise(0)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, taken (words of the mix, repeats counted)."""
    base, ends = plan_mix(docs, **options)
    rows = join_counted(base, ends, ["source"])
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * taken_copies()).cast("long").alias("taken"))


def mix_rows(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    _, ends = plan_mix(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    keyed = docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"), docs[quoted(source_col)].cast("string").alias("source"), word_count(docs[quoted(text_col)]).alias("size"), mix_hash(docs[quoted(id_col)], docs[quoted(text_col)], seed).alias("hash"))
    many = join_counted(keyed, ends, ["source"]).withColumn("times", taken_copies()).filter("times > 0")
    return many.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_report(docs).drop("source")


ORACLE = r"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS hash
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
ranked AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM src),
weighed AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS lim FROM ranked),
lefts AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
         coalesce(sum(lim) OVER (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lim_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_weight
  FROM weighed),
capped AS (SELECT *, lim * left_weight <= weight * (budget - lim_before) AS is_capped FROM lefts),
targets AS (
  SELECT source, source_size,
         CASE WHEN is_capped THEN lim ELSE weight * (budget - coalesce(sum(CASE WHEN is_capped THEN lim END) OVER (), 0))
              / sum(CASE WHEN NOT is_capped THEN weight END) OVER () END AS target
  FROM capped),
open0 AS (
  SELECT b.doc_id, b.source, b.size, b.hash, t.source_size, t.target, CASE WHEN t.target > t.source_size THEN 1 ELSE 0 END AS copies,
         CASE WHEN t.target > t.source_size THEN t.target - t.source_size ELSE t.target END AS need, 0 AS extra, -1::BIGINT AS edge
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source),
@ROUNDS@
SELECT doc_id, size, source_size, target, (size * (copies + extra))::BIGINT AS taken FROM @LAST@
""".replace("@ROUNDS@", ",\n".join(
    f"""sum{k} AS (SELECT *, hash > edge AND size <= need AS fits, sum(CASE WHEN hash > edge AND (size <= need OR {k} = 0) THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY hash) AS upto FROM open{k}),
took{k} AS (SELECT *, (hash > edge AND (size <= need OR {k} = 0) AND upto <= need) AS now FROM sum{k}),
open{k + 1} AS (SELECT doc_id, source, size, hash, source_size, target, copies, need - coalesce(max(CASE WHEN now THEN upto END) OVER (PARTITION BY source), 0) AS need,
  CASE WHEN now THEN 1 ELSE extra END AS extra, coalesce(min(CASE WHEN hash > edge AND (size <= need OR {k} = 0) AND NOT now THEN hash END) OVER (PARTITION BY source), 1::BIGINT << 60) AS edge FROM took{k})"""
    for k in range(ROUNDS)
)).replace("@LAST@", f"open{ROUNDS}")
