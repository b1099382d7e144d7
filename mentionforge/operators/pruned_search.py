"""BM25 top-k that leaves out postings which cannot matter.

Postings of a token lie in blocks of like frequency and length; a block's greatest frequency and least length bound the
weight of all its postings. A search takes three passes. The blocks with the greatest bounds give some documents, whose
k-th best sum is a threshold that the k-th best score cannot be under. Then each query leaves out as many postings as
it can: a token's blocks up to some bound are left out while the sum over its tokens of these bounds stays under the
threshold, since a document that occurs in none of the other blocks cannot reach it; the other, essential blocks give the
candidates. At last candidates whose bound still reaches the threshold get what they have in the left-out blocks.
The result is that of lexical.search."""

from __future__ import annotations

import heapq
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentionforge.operators.lexical import B, BROADCAST_ROWS, K1, TOP_K, LexicalIndex, query_tokens, weight
from mentionforge.operators.rows import materialized

#: Postings of a query's first pass, times k.
FIRST = 8


def with_block(postings: DataFrame) -> DataFrame:
    """Adds block: a number for frequency up to 8 and, in steps of half a power of two, length."""
    return postings.withColumn("block", (F.least("tf", F.lit(8)) * 64 + F.floor(2 * F.log2(F.col("doc_len") + 1))).cast("int"))


def block_bounds(index: LexicalIndex) -> DataFrame:
    """tok, block, n, tf (the greatest), doc_len (the least): a bound whatever the mean length of the corpus becomes."""
    return with_block(index.postings).groupBy("tok", "block").agg(F.count(F.lit(1)).alias("n"), F.max("tf").alias("tf"), F.min("doc_len").alias("doc_len"))


def left_out(rows: pa.Table) -> tuple[list[bool], list[float]]:
    """Of one query's blocks (tok, bound, n, threshold): which are essential, and each one's token's bound of what is
    left out. Blocks of a token go in order of their bounds; of all tokens' next blocks the one with the most postings for
    what it adds to the sum."""
    tok, bound, n = (rows.column(c).to_pylist() for c in ("tok", "bound", "n"))
    room = rows.column("threshold")[0].as_py()
    by_tok: dict[str, list[int]] = {}
    for i in sorted(range(len(tok)), key=lambda i: bound[i]):
        by_tok.setdefault(tok[i], []).append(i)
    at, limit, essential = dict.fromkeys(by_tok, 0), dict.fromkeys(by_tok, 0.0), [True] * len(tok)
    following = lambda t: ((bound[by_tok[t][at[t]]] - limit[t]) / n[by_tok[t][at[t]]], t)
    heap = [following(t) for t in by_tok]
    heapq.heapify(heap)
    while heap:
        _, t = heapq.heappop(heap)
        i = by_tok[t][at[t]]
        if bound[i] - limit[t] >= room:
            continue  # nor can this token's later blocks go
        room -= bound[i] - limit[t]
        limit[t], essential[i] = bound[i], False
        at[t] += 1
        if at[t] < len(by_tok[t]):
            heapq.heappush(heap, following(t))
    return essential, [limit[t] for t in tok]


def kth_best(scores: DataFrame, k: int, score: str, name: str) -> DataFrame:
    """of (a query), name: its k-th best score, where it has k."""
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col(score).desc()))
    top = scores.withColumn("__rank", rank).filter(F.col("__rank") <= k)
    return top.groupBy(F.col("query_id").alias("of")).agg(F.when(F.count(F.lit(1)) >= k, F.min(score)).alias(name))


def sent(df: DataFrame) -> DataFrame:
    """To be broadcast where it is counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def search(index: LexicalIndex, queries: DataFrame, k: int | None = TOP_K, id_col: str = "query_id", text_col: str = "text", digits: int = 6, bounds: DataFrame | None = None, through: Callable[[str, DataFrame], DataFrame] = lambda step, postings: postings) -> DataFrame:
    """query_id, doc_id, score, bm25_rank: what lexical.search gives. bounds: block_bounds(index), where they are stored.
    ``through`` sees the postings that each pass (first, essential, rest) scores."""
    k, slack = k or TOP_K, 10.0**-digits
    wanted = query_tokens(queries, id_col, text_col).join(index.frequencies, "tok")
    own: Callable[[], Column] = lambda: F.col("times") * weight(index, K1, B)
    tokens = wanted.join(block_bounds(index) if bounds is None else bounds, "tok").withColumn("bound", own())
    tokens = materialized(tokens.select("query_id", "tok", "times", "df", "block", "n", "bound"))
    posts = with_block(index.postings)
    met = lambda step, chosen: through(step, posts.join(sent(chosen), ["tok", "block"])).withColumn("w", own())

    before = F.coalesce(F.sum("n").over(W.partitionBy("query_id").orderBy(F.desc("bound"), "tok", "block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    first = materialized(tokens.withColumn("before", before).filter(F.col("before") < FIRST * k).select("query_id", "tok", "times", "df", "block"))
    threshold = kth_best(met("first", first).groupBy("query_id", "doc_id").agg(F.sum("w").alias("s")), k, "s", "threshold")

    open_ = tokens.join(threshold, F.col("query_id") == F.col("of"), "left").withColumn("threshold", F.coalesce(F.col("threshold") - slack, F.lit(0.0))).drop("of")
    kind = dict(tokens.dtypes)["query_id"]

    def choose(table: pa.Table) -> pa.Table:
        essential, limit = left_out(table)
        return table.append_column("essential", pa.array(essential)).append_column("limit", pa.array(limit))

    split = open_.select("query_id", "tok", "times", "df", "block", "n", "bound", "threshold").groupBy("query_id").applyInArrow(
        choose, f"query_id {kind}, tok string, times long, df long, block int, n long, bound double, threshold double, essential boolean, limit double")
    split = materialized(split)
    essential = materialized(split.filter("essential").select("query_id", "tok", "times", "df", "block", "limit"))
    partial = materialized(met("essential", essential).groupBy("query_id", "doc_id").agg(F.sum("w").alias("s"), F.sum("limit").alias("met")))

    # What a candidate may still get: the bounds of the tokens that it was not met under.
    limits = split.groupBy("query_id", "tok").agg(F.first("limit").alias("limit"), F.first("threshold").alias("threshold"))
    rest = limits.groupBy(F.col("query_id").alias("of")).agg(F.sum("limit").alias("rest"), F.first("threshold").alias("threshold"))
    least = rest.join(kth_best(partial, k, "s", "better").withColumnRenamed("of", "of_"), F.col("of") == F.col("of_"), "left")
    least = least.select("of", "rest", F.greatest("threshold", F.coalesce(F.col("better") - slack, F.lit(0.0))).alias("threshold"))
    candidates = materialized(partial.join(sent(materialized(least)), F.col("query_id") == F.col("of")).filter(F.col("s") + F.col("rest") - F.col("met") >= F.col("threshold")).select("query_id", "doc_id", "s"))

    others = split.filter("NOT essential").groupBy("query_id", "tok", "times", "df").agg(F.collect_list("block").alias("blocks"))
    asked = materialized(candidates.select("query_id", "doc_id").join(others, "query_id"))
    more = posts.join(sent(asked), ["tok", "doc_id"]).filter(F.array_contains("blocks", F.col("block")))
    more = through("rest", more).withColumn("w", own()).select("query_id", "doc_id", F.col("w").alias("s"))
    scored = candidates.unionAll(more).groupBy("query_id", "doc_id").agg(F.sum("s").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.round("score", digits).desc(), "doc_id"))
    return scored.filter("score > 0").withColumn("bm25_rank", rank).filter(F.col("bm25_rank") <= k)
