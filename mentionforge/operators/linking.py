"""Merging branches, reranking, thresholds and code expansion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentionforge.functions.arrays import as_set
from mentionforge.functions.text import query_variant
from mentionforge.operators import dense, lexical, vector_index
from mentionforge.operators.code_tables import code_shape_ok
from mentionforge.operators.rows import BROADCAST_ROWS, materialized

#: Which types are linked, to which knowledge base, and the frozen decisions of each.
KB_OF_TYPE = {"CHẨN_ĐOÁN": "icd", "THUỐC": "rxnorm"}
DECISIONS = {"icd": {"floor": 1.490, "margin": 0.399, "variant": "raw"}, "rxnorm": {"floor": 2.157, "margin": 0.0, "variant": "strip_dose"}}


def merge_branches(dense_hits: DataFrame, lexical_hits: DataFrame) -> DataFrame:
    """(query_id, doc_id, score, dense_rank) and (.., bm25_rank) to one row a query and document with both scores."""
    a = dense_hits.select("query_id", "doc_id", F.col("score").alias("dense_score"), "dense_rank")
    b = lexical_hits.select("query_id", "doc_id", F.col("score").alias("bm25_score"), "bm25_rank")
    return a.join(b, ["query_id", "doc_id"], "full_outer")


def union_order() -> list[Column]:
    """The order of the merged list: the dense branch's hits first, then the other's."""
    return [F.col("dense_rank").asc_nulls_last(), F.col("bm25_rank").asc_nulls_last(), F.col("doc_id")]


def with_rank(scored: DataFrame, score: str = "rerank_score", digits: int = 6) -> DataFrame:
    """Adds rank: by score, ties in the order of the merged list."""
    return scored.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.round(score, digits).desc(), *union_order())))


def apply_thresholds(scored: DataFrame, floor: float | Column, margin: float | Column, keys: list[str], score: str = "rerank_score") -> DataFrame:
    """Keeps rows with score >= max(floor, best of the query - margin)."""
    to_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    best = F.max(score).over(W.partitionBy(*keys))
    kept = F.col(score) >= F.greatest(to_col(floor), best - to_col(margin))
    return scored.withColumn("__keep", kept).filter("__keep").drop("__keep")


def codes_of(role: Column, code: Column, resolve_in: Column) -> Column:
    """The codes a document stands for: an alias its resolve_in, any other its code."""
    none = F.array().cast("array<string>")
    own = F.when(F.coalesce(code, F.lit("")) != "", F.array(code.cast("string"))).otherwise(none)
    return F.when(role == "alias", F.coalesce(resolve_in, none)).otherwise(own)


def expand_codes(kept: DataFrame, all_queries: DataFrame, keys: list[str], codes: str = "codes") -> DataFrame:
    """keys, codes (a set in order) of all queries; empty where nothing was kept."""
    found = kept.select(*keys, F.explode(codes).alias("c")).groupBy(*keys).agg(F.sort_array(F.collect_set("c")).alias("codes"))
    return all_queries.select(*keys).distinct().join(found, keys, "left").withColumn("codes", as_set(F.col("codes")))


def route(entity_type: Column) -> Column:
    """The knowledge base of a type; null, not empty, for types that are not linked."""
    out = F.lit(None).cast("string")
    for t, kb in KB_OF_TYPE.items():
        out = F.when(entity_type == t, kb).otherwise(out)
    return out


def retrieve(queries: DataFrame, index: Mapping) -> DataFrame:
    """queries (query_id, text) to the merged hits of an index's branches, with the documents' columns. index has
    ``docs`` (doc_id, text, role, code, resolve_in), ``lexical`` (see lexical.build_index) and optionally ``dense``
    (doc_id, embedding, searched exactly, or a vector_index.VectorIndex) with ``embed`` (a column function)."""
    hits = lexical.search(index["lexical"], queries)
    if "dense" in index:
        vectors = queries.select("query_id", index["embed"](F.col("text")).alias("embedding"))
        stored = index["dense"]
        near = vector_index.search(stored, vectors) if isinstance(stored, vector_index.VectorIndex) else dense.search(stored, vectors, doc_id="doc_id")
    else:
        near = hits.select("query_id", "doc_id", "score", F.col("bm25_rank").alias("dense_rank")).limit(0)
    found = materialized(merge_branches(near, hits))  # the best of each query: they go to the documents, whose texts stay
    found = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    return index["docs"].join(found, "doc_id").withColumn("query", F.col("query_id"))


def score_dump(rows: DataFrame, index: Mapping, scorer, variant: str) -> DataFrame:
    """Evaluation rows (record_id, mention, kb, gold, ..) with query, query_variant, and candidates: every hit of either
    branch with all its scores and codes, best first; the measures and the calibration start from it."""
    own = rows.withColumns({"query": query_variant(F.col("mention"), variant), "query_variant": F.lit(variant)})
    scored = with_rank(scorer(retrieve(own.select(F.col("query").alias("query_id"), F.col("query").alias("text")).distinct(), index)))
    codes = codes_of(F.col("role"), F.col("code"), F.col("resolve_in")).alias("codes")
    hit = F.struct("rank", F.struct("doc_id", F.coalesce("role", F.lit("candidate")).alias("role"), codes, "dense_score", "bm25_score", "rerank_score").alias("c"))
    lists = scored.groupBy(F.col("query_id").alias("__q")).agg(F.transform(F.array_sort(F.collect_list(hit)), lambda x: x["c"]).alias("candidates"))
    kind = dict(lists.dtypes)["candidates"]
    return own.join(lists, F.col("query") == F.col("__q"), "left").drop("__q").withColumn("candidates", F.coalesce("candidates", F.array().cast(kind)))


def link(mentions: DataFrame, indexes: Mapping[str, Mapping], scorer, decisions: Mapping[str, Mapping] = DECISIONS) -> DataFrame:
    """Adds candidates (codes; null where the type is not linked) to mentions (mention_id, text, type).

    indexes: by knowledge base what retrieve() takes. scorer(pairs with query, text) adds rerank_score. Distinct
    queries are retrieved once."""
    routed = mentions.withColumn("kb", route(F.col("type")))
    out = None
    for kb, index in indexes.items():
        decision = decisions[kb]
        own = routed.filter(F.col("kb") == kb).withColumn("query", query_variant(F.col("text"), decision["variant"]))
        queries = own.select(F.col("query").alias("query_id"), F.col("query").alias("text")).distinct()
        kept = apply_thresholds(scorer(retrieve(queries, index)), decision["floor"], decision["margin"], ["query_id"])
        kept = kept.withColumn("codes", codes_of(F.col("role"), F.col("code"), F.col("resolve_in")))
        codes = expand_codes(kept, queries, ["query_id"]).withColumnRenamed("query_id", "query")
        checked = F.when(code_shape_ok(F.lit(kb), F.col("codes")), F.col("codes")).otherwise(F.raise_error(F.concat(F.lit(f"not a code of {kb}: "), F.array_join("codes", ","))).cast("array<string>"))
        linked = own.join(codes.withColumn("codes", checked), "query", "left").select("mention_id", F.col("codes").alias("candidates"))
        out = linked if out is None else out.union(linked)
    return mentions.join(out, "mention_id", "left")
