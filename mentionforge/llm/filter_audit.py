"""Filter interaction audit: what each step of each order of a set of filters removes, by the subset-zeta transform.

Each row gets a mask of the filters that it fails; one aggregation counts the masks of each part, and how many of each
mask are labelled good or toxic. The zeta transform over subsets turns a part's 2^n counts into the survivors of every
subset of filters, so a step of an order is the difference between two neighbouring subsets, and no order is ever
applied to rows. A filter on repeated texts looks at the whole table: a row fails it if a smaller id has an equal text.

Repeated texts are found by digest, without gathering copies: rows are counted by (digest, id, part, mask, labels), of
each digest and part the smallest id is kept, and of each digest the entries with the smallest id of all; their counts
move from the masks that fail the filter to those that pass it.

Edge cases: a null text counts as the empty one; a null or empty part is the part of the empty name; a null id comes
after all others and has no label; rows that share the smallest id of a text all pass; rows that repeat an id are counted
each; of several labels of an id the greatest counts; texts are read whole, however long (a text's words are held by one
task); parts appear with all steps, with zeros; only the named columns are read, so others of any name do no harm; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionforge.llm.common import cut, quoted, whole, words

#: Name to condition (of the text and its words) under which a row fails the filter.
FILTERS: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, w: F.size(w) < 50,
    "B": lambda text, w: 100 * F.size(F.array_distinct(w)) < 65 * F.size(w),
    "C": lambda text, w: 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
    "D": lambda text, w: text.rlike("[#$%&*|]"),
}
#: The name of the filter on repeated texts.
REPEATED = "E"
#: Filters at most, as their masks and orders are counted one by one.
MOST = 8


def marked_rows(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Callable[[Column, Column], Column]] = FILTERS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per row: doc_id, part, mask (a bit for each failed filter), digest, good, toxic."""
    d = docs.select(docs[quoted(id_col)].alias("doc_id"), F.coalesce(docs[quoted(part_col)].cast("string"), F.lit("")).alias("part"), whole(docs[quoted(text_col)]).alias("text"))
    d = d.withColumn("w", words(F.col("text")))
    mask = sum((F.when(fails(F.col("text"), F.col("w")), 1 << k).otherwise(0) for k, fails in enumerate(filters.values())), F.lit(0))
    d = d.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    of = labels.groupBy(F.col("doc_id").alias("of")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    of = cut(of.filter("good OR toxic"))
    # Both sides lie as they were read, so that a hot id's rows can be split.
    found = d.join(of, d["doc_id"] == of["of"], "left")
    return found.select("doc_id", "part", "mask", "digest", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def mask_counts(rows: DataFrame, repeated_bit: int) -> DataFrame:
    """Marked rows to part, mask, n, good, toxic (counts), with the bit of repeated texts."""
    kind = ["part", "mask", "good", "toxic"]
    total = rows.groupBy(*kind).agg(F.count(F.lit(1)).alias("n"))
    at = F.struct(F.col("doc_id").isNull().alias("is_null"), "doc_id")
    counted = rows.groupBy("digest", "doc_id", *kind).agg(F.count(F.lit(1)).alias("n"))
    least = counted.groupBy("digest", *kind).agg(F.min(F.struct(at.alias("at"), "n")).alias("first"))
    # A digest has at most one entry here for each part and label.
    entries = least.groupBy("digest").agg(F.min("first.at").alias("at"), F.collect_list(F.struct(*kind, "first")).alias("entries"))
    firsts = entries.select(F.explode(F.filter("entries", lambda e: e["first"]["at"] == F.col("at"))).alias("e")).select("e.part", "e.mask", "e.good", "e.toxic", "e.first.n")
    firsts = firsts.groupBy(*kind).agg(F.sum("n").alias("n"))
    fail = F.col("mask").bitwiseOR(F.lit(repeated_bit)).alias("mask")
    moved = total.select("part", fail, "good", "toxic", "n").unionAll(firsts.select("part", fail, "good", "toxic", -F.col("n"))).unionAll(firsts)
    of = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(F.lit(0))).alias(c)
    return moved.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def zeta(counts: Column, n: int) -> Column:
    """Array of 2^n counts by mask to sums over all subsets of each mask."""
    add = lambda f, bit: F.transform(f, lambda x, m: x + F.when(m.bitwiseAND(bit) != 0, F.get(f, m - bit)).otherwise(F.lit(0)))
    return F.aggregate(F.array(*[F.lit(1 << b) for b in range(n)]), counts, add)


def survivors(counts: DataFrame, n: int) -> DataFrame:
    """mask_counts to a row for each part: n, good, toxic as arrays by filter subset, of what passes all its filters."""
    every = F.sequence(F.lit(0), F.lit((1 << n) - 1))
    by_mask = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct("n", "good", "toxic")))).alias("by"))
    exact = lambda c: F.transform(every, lambda m: F.coalesce(F.try_element_at("by", m)[c], F.lit(0).cast("long")))
    # A row passes all filters of a subset if its mask is a subset of the others.
    return by_mask.select("part", *[F.reverse(zeta(exact(c), n)).alias(c) for c in ("n", "good", "toxic")])


def steps_of(spark, names: list[str], orders: Iterable[tuple[str, ...]]) -> tuple[DataFrame, int]:
    """A row for each step of each order: number, filter_order, step, bit, before (the filters applied before)."""
    bit = {name: 1 << k for k, name in enumerate(names)}
    rows = [("".join(o), k + 1, bit[f], sum(bit[x] for x in o[:k])) for o in orders for k, f in enumerate(o)]
    schema = "number int, filter_order string, step int, bit int, before int"
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], schema), len(rows)


def audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Callable[[Column, Column], Column]] = FILTERS, repeated: str = REPEATED, orders: Iterable[tuple[str, ...]] | None = None, **columns) -> DataFrame:
    """Per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``orders`` are those to report, each of all the filters (None: all permutations); shapley always sums over all
    permutations. ``columns`` as of marked_rows."""
    names = [*filters, repeated]
    n, full = len(names), (1 << len(names)) - 1
    if n > MOST or len({*names}) < n:
        raise ValueError(f"at most {MOST} filters of different names")
    counts = cut(mask_counts(cut(marked_rows(docs, labels, filters, **columns)), 1 << (n - 1)))
    steps, many = steps_of(docs.sparkSession, names, permutations(names) if orders is None else orders)
    left = survivors(counts, n)
    # Of the n! orders, those in which just the filters s come before a filter.
    weights = F.array(*[F.lit(math.factorial(k) * math.factorial(max(0, n - 1 - k))) for k in (s.bit_count() for s in range(1 << n))])
    all_orders = lambda bit: F.aggregate(
        F.sequence(F.lit(0), F.lit(full)), F.lit(0).cast("long"),
        lambda total, s: total + F.when(s.bitwiseAND(F.lit(bit)) == 0, F.get(weights, s) * (F.get("n", s) - F.get("n", s + bit))).otherwise(F.lit(0)))
    left = left.withColumn("shares", F.array(*[all_orders(1 << k) for k in range(n)]))
    rows = left.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(many - 1))))
    rows = rows.join(F.broadcast(steps), rows["at"] == steps["number"])
    after = F.col("before") + F.col("bit")
    lost = lambda c: F.get(c, F.col("before")) - F.get(c, after)
    failing = F.get("n", F.lit(0)) - F.get("n", F.col("bit"))
    return rows.select(
        "part", "filter_order", "step", F.get("n", after).alias("kept"), lost("n").alias("removed"), (failing - lost("n")).alias("redundant"),
        (F.get("n", F.lit(full) - F.col("bit")) - F.get("n", F.lit(full))).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("shares", F.log2(F.col("bit")).cast("int")).alias("shapley"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit(docs, labels)


#: By brute force: each row of documents goes through each order.
ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
toxic AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
f AS (
  SELECT part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
                regexp_matches(text, '[#$%&*|]'), doc_id > min(doc_id) OVER (PARTITION BY text)] AS fails,
         doc_id IN (SELECT doc_id FROM good) AS good, doc_id IN (SELECT doc_id FROM toxic) AS toxic
  FROM t),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
seen AS (
  SELECT part, filter_order, step, good, toxic,
         fails[ascii(filter_order[step]) - 64] AS fail,
         list_bool_or(list_transform(range(1, step), lambda k: fails[ascii(filter_order[k]) - 64])) AS earlier,
         len(list_filter(fails, lambda x: x)) AS n_fails
  FROM f, steps),
counted AS (
  SELECT part, filter_order, step, count(*) FILTER (WHERE NOT fail AND NOT coalesce(earlier, false)) AS kept,
         count(*) FILTER (WHERE fail AND NOT coalesce(earlier, false)) AS removed, count(*) FILTER (WHERE fail AND coalesce(earlier, false)) AS redundant,
         count(*) FILTER (WHERE fail AND n_fails = 1) AS unique_fails,
         count(*) FILTER (WHERE fail AND NOT coalesce(earlier, false) AND good) AS good_lost,
         count(*) FILTER (WHERE fail AND NOT coalesce(earlier, false) AND toxic) AS toxic_lost
  FROM seen GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley
FROM counted
"""
