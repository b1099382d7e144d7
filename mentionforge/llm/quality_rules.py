"""Quality rules whose cutoffs are risk controlled on labelled holdouts.

A rule rejects a text of which a ratio is above (or below) a cutoff. Cutoffs come from a fixed grid, and for each
stratum and rule they are tested from the most lenient to the strictest: a cutoff passes if the exact binomial
probability of seeing as few false rejections among the stratum's good holdout texts, were the false rejection rate
at its limit, is at most the error level. Testing stops at the first failure (fixed-sequence testing, no correction
along the grid); the error level is divided by the number of strata times rules (Bonferroni), and the limit by the
number of rules, so that with probability 1 - delta all strata falsely reject at most ``alpha`` of their good texts.
All steps are DataFrame operations; texts are read once and never shuffled.

Edge cases: a null text has no words and fails the base rules; a null stratum is a stratum of its own; a stratum with
too few labels certifies no cutoff and only its base rules reject (see least_good); of several labels of a document the
best counts; texts are measured whole, however long (one is held by one task); rows that share a doc_id are kept and
judged each for itself; only the named columns are read, so others of any name do no harm; an empty table gives an empty
result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentionforge.llm.common import cut, join_counted, quoted, SPACES, whole, words

#: Ratios per word (or line) on which a rule may reject, and on which side.
RULES = {
    "symbols": ("n_symbols / n_words", 1),
    "repeats": ("n_repeat_words / n_words", 1),
    "same_lines": ("n_dup_lines / greatest(n_lines, 1)", 1),
    "capitals": ("n_capitals / greatest(word_chars, 1)", 1),
    "long_words": ("word_chars / n_words", 1),
    "short_words": ("word_chars / n_words", -1),
}
#: Steps of the grids, from strict to lenient: cutoff i of the ratios in 0..1 is (i / GRID)^2, of word lengths i / 4 or 4 * i / GRID.
GRID = 64
#: The share of a stratum's good texts that may be rejected, and the probability that any stratum loses more.
ALPHA = 0.02
DELTA = 0.05


def cutoff_value(rule: Column, step: Column) -> Column:
    """Step 0 is the strictest cutoff, GRID the most lenient."""
    part = step / F.lit(float(GRID))
    return F.when(rule == "long_words", 4.0 + 28.0 * part).when(rule == "short_words", 4.0 * (1.0 - part)).otherwise(part * part)


def count_of(text: Column, characters: str) -> Column:
    """How many of the text's code points are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_capitals, base_failed."""
    d = docs.select(docs[quoted(id_col)].alias("doc_id"), docs[quoted(stratum_col)].cast("string").alias("stratum"), whole(docs[quoted(text_col)]).alias("text"))
    d = d.withColumns({"w": words(F.col("text")), "lines": F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")})
    d = d.select(
        "doc_id", "stratum", F.size("w").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).alias("word_chars"),
        count_of(F.col("text"), "#*$%&|<>").alias("n_symbols"),
        count_of(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ").alias("n_capitals"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.size("w") < 3, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))
        ).alias("windows"),
    )
    # Only texts in which a window repeats sort their windows; equal ones then stand side by side.
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    d = d.withColumn("by_hash", F.when(repeated, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none))
    d = d.drop("windows")
    same = lambda j, k: F.coalesce(F.get("by_hash", j)["h"] == F.get("by_hash", k)["h"], F.lit(False))
    places = F.transform(F.filter(F.transform("by_hash", lambda s, j: F.struct(s["i"].alias("i"), (same(j, j - 1) | same(j, j + 1)).alias("again"))), lambda s: s["again"]), lambda s: s["i"])
    d = d.withColumn("places", F.sort_array(places)).drop("by_hash")
    covered = F.aggregate(F.sequence(F.lit(1), F.size("places") - 1), F.lit(3), lambda n, j: n + F.least(F.lit(3), F.get("places", j) - F.get("places", j - 1)))
    d = d.withColumn("n_repeat_words", F.when(F.size("places") < 2, 0).otherwise(covered)).drop("places")
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals"]
    d = d.withColumns({c: F.col(c).cast("long") for c in counts})
    return d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def binomial_below(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial(n, p), summed term by term in logarithms."""
    start = F.struct((n * F.log1p(F.lit(-p))).alias("term"), F.exp(n * F.log1p(F.lit(-p))).alias("sum"))

    def step(acc, i):
        term = acc["term"] + F.log((n - i + 1) / i) + F.log(F.lit(p)) - F.log1p(F.lit(-p))
        return F.struct(term.alias("term"), (acc["sum"] + F.exp(term)).alias("sum"))

    return F.when(k < 1, F.exp(n * F.log1p(F.lit(-p)))).otherwise(F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))), start, step)["sum"])


def least_good(strata: int, alpha: float = ALPHA, delta: float = DELTA) -> int:
    """How many good holdout texts a stratum needs for any cutoff to pass, if none of them is rejected."""
    return math.ceil(math.log(delta / (len(RULES) * strata)) / math.log1p(-alpha / len(RULES)))


def certified_cutoffs(good: DataFrame, alpha: float, delta: float) -> DataFrame:
    """From the features of good holdout texts: stratum, rule, cutoff, n_good, n_lost of each certified rule."""
    limit = alpha / len(RULES)
    ratios = F.array(*[F.struct(F.lit(k).alias("rule"), (F.expr(v) * side).cast("double").alias("value")) for k, (v, side) in RULES.items()])
    each = good.select("stratum", F.explode(ratios).alias("r")).select("stratum", "r.rule", "r.value")
    # The smallest step at which the text is not rejected; GRID + 1 if all reject it.
    steps = F.sequence(F.lit(0), F.lit(GRID))
    side = F.when(F.col("rule") == "short_words", -1).otherwise(1)
    least = F.size(F.filter(steps, lambda s: F.col("value") > cutoff_value(F.col("rule"), s) * side))
    seen = each.groupBy("stratum", "rule", least.alias("least")).count()
    # Counts by step: at most strata x rules x (GRID + 2) rows.
    grid = seen.groupBy("stratum", "rule").agg(F.sum("count").alias("n_good"), F.map_from_entries(F.collect_list(F.struct("least", "count"))).alias("by_least"))
    grid = grid.select("stratum", "rule", "n_good", "by_least", F.explode(steps).alias("step"))
    lost = F.aggregate(F.filter(F.map_entries("by_least"), lambda e: e["key"] > F.col("step")), F.lit(0).cast("long"), lambda n, e: n + e["value"])
    grid = cut(grid.withColumn("n_lost", lost), few=True)
    error = delta / max(1, grid.select("stratum", "rule").distinct().count())
    passes = F.when(F.col("n_lost") >= F.col("n_good") * limit, False).otherwise(binomial_below(F.col("n_lost"), F.col("n_good"), limit) <= error)
    tested = grid.withColumn("passes", passes)
    lenient_first = W.partitionBy("stratum", "rule").orderBy(F.desc("step"))
    tested = tested.withColumn("so_far", F.min(F.col("passes").cast("int")).over(lenient_first)).filter("so_far = 1")
    best = tested.groupBy("stratum", "rule").agg(F.min(F.struct("step", "n_good", "n_lost")).alias("b"))
    return best.select("stratum", "rule", cutoff_value(F.col("rule"), F.col("b.step")).alias("cutoff"), "b.n_good", "b.n_lost")


def judge(feats: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds kept: false where base_failed or where a certified rule of the text's stratum rejects."""
    by_stratum = cutoffs.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == k, F.col("cutoff"))).alias(f"cut_{k}") for k in RULES])
    d = join_counted(feats, by_stratum, ["stratum"])
    rejects = F.lit(False)
    for k, (v, side) in RULES.items():
        rejects = rejects | F.coalesce(F.expr(v) * side > F.col(f"cut_{k}") * side, F.lit(False))
    return d.withColumn("kept", ~F.col("base_failed") & ~F.when(F.col("base_failed"), False).otherwise(rejects)).drop(*[f"cut_{k}" for k in RULES])


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, **columns) -> DataFrame:
    """The features of all texts and the verdict kept. ``labels``: doc_id, quality (1: good)."""
    feats = cut(features(docs, **columns))
    good = labels.groupBy(F.col("doc_id").alias("good_id")).agg(F.max("quality").alias("best")).filter("best = 1").select("good_id")
    holdout = feats.join(good, feats["doc_id"] == good["good_id"], "left_semi").filter(~F.col("base_failed"))
    cutoffs = cut(certified_cutoffs(holdout, alpha, delta), few=True)
    return judge(feats, cutoffs)


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return apply_rules(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = r"""
WITH t AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
base AS (
  SELECT doc_id, stratum, len(w) AS n_words, list_sum(list_transform(w, lambda x: length(x))) AS word_chars, w,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^A-ZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ]', '', 'g')) AS n_capitals,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM t),
grams AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM base WHERE len(w) >= 3),
named AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM grams),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM named) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
f AS (
  SELECT doc_id, stratum, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
         n_capitals, len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN covered USING (doc_id)),
feats AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
ratios AS (
  SELECT doc_id, stratum, base_failed, unnest([
    {'rule': 'symbols', 'side': 1, 'value': n_symbols / n_words}, {'rule': 'repeats', 'side': 1, 'value': n_repeat_words / n_words},
    {'rule': 'same_lines', 'side': 1, 'value': n_dup_lines / greatest(n_lines, 1)}, {'rule': 'capitals', 'side': 1, 'value': n_capitals / greatest(word_chars, 1)},
    {'rule': 'long_words', 'side': 1, 'value': word_chars / n_words}, {'rule': 'short_words', 'side': -1, 'value': word_chars / n_words}], recursive := true)
  FROM feats WHERE n_words > 0),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
grid AS (SELECT range AS step FROM range(65)),
counted AS (
  SELECT stratum, rule, step, count(*) AS n,
         CASE rule WHEN 'long_words' THEN 4.0::DOUBLE + 28.0 * (step / 64.0::DOUBLE) WHEN 'short_words' THEN 4.0::DOUBLE * (1.0 - step / 64.0::DOUBLE) ELSE (step / 64.0::DOUBLE) * (step / 64.0::DOUBLE) END AS cutoff,
         count(*) FILTER (WHERE value * side > side * CASE rule WHEN 'long_words' THEN 4.0::DOUBLE + 28.0 * (step / 64.0::DOUBLE) WHEN 'short_words' THEN 4.0::DOUBLE * (1.0 - step / 64.0::DOUBLE) ELSE (step / 64.0::DOUBLE) * (step / 64.0::DOUBLE) END) AS k
  FROM ratios SEMI JOIN good USING (doc_id), grid WHERE NOT base_failed GROUP BY ALL),
m AS (SELECT count(DISTINCT (coalesce(stratum, '?'), rule)) AS tests FROM counted),
tested AS (
  SELECT *, CASE WHEN k >= n * (@ALPHA@ / 6) THEN 0 ELSE (list_sum(list_transform(range(k + 1),
           lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(@ALPHA@ / 6) + (n - i) * ln(1 - @ALPHA@ / 6)))) <= @DELTA@ / tests)::INT END AS passes
  FROM counted, m),
chosen AS (
  SELECT stratum, rule, arg_min(cutoff, step) AS cutoff
  FROM (SELECT *, min(passes) OVER (PARTITION BY stratum, rule ORDER BY step DESC) AS so_far FROM tested) WHERE so_far = 1 GROUP BY stratum, rule),
rejected AS (
  SELECT DISTINCT r.doc_id FROM ratios r JOIN chosen c ON r.stratum IS NOT DISTINCT FROM c.stratum AND r.rule = c.rule
  WHERE r.value * side > c.cutoff * side)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM feats
"""


def oracle(alpha: float = ALPHA, delta: float = DELTA) -> str:
    """The query in DuckDB's SQL."""
    return SQL.replace("@ALPHA@", repr(alpha)).replace("@DELTA@", repr(delta))


ORACLE = oracle()
