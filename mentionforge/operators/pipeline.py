"""From documents to records: extract, align, link, shape."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionforge.operators.linking import DECISIONS, KB_OF_TYPE, link
from mentionforge.operators.models import TYPES_WITH_ASSERTIONS, extract_entities
from mentionforge.operators.rows import materialized
from mentionforge.operators.spans import align

RECORD = ["text", "type", "candidates", "assertions", "position"]


def shape_records(spans: DataFrame) -> DataFrame:
    """candidates and assertions are null (and so absent from JSON) for types that have none."""
    own = lambda types, c: F.when(F.col("type").isin(list(types)), F.coalesce(F.col(c), F.array().cast("array<string>")))
    return spans.withColumns({"candidates": F.sort_array(own(KB_OF_TYPE, "candidates")), "assertions": own(TYPES_WITH_ASSERTIONS, "assertions"), "position": F.array("span_start", "span_end")})


def run(docs: DataFrame, extract: Callable[[str], list[dict]], indexes: Mapping[str, Mapping], scorer: Callable[[DataFrame], DataFrame], decisions: Mapping[str, Mapping] = DECISIONS) -> tuple[DataFrame, DataFrame]:
    """docs (doc_id, text) to records (doc_id, ord, text, type, candidates, assertions, position), and errors
    (doc_id, error) of documents that give no records at all."""
    # Extraction is the dear part: each document is sent to it once, and no filter on its result is pushed below docs' own.
    found = materialized(extract_entities(docs, extract))
    good = found.filter("result.ok").select("doc_id", "text", F.col("result.entities").alias("entities"))
    spans = align(good).withColumn("mention_id", F.concat_ws(":", F.col("doc_id").cast("string"), F.col("ord").cast("string")))
    records = shape_records(link(spans, indexes, scorer, decisions))
    errors = found.filter("NOT result.ok").select("doc_id", F.col("result.error").alias("error"))
    return records.select("doc_id", "ord", *RECORD), errors


def per_document(records: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, json: the list of a document's records, also an empty one."""
    body = F.transform(F.array_sort(F.collect_list(F.struct("ord", F.struct(*RECORD).alias("r")))), lambda s: s["r"])
    grouped = records.groupBy("doc_id").agg(F.to_json(body).alias("json"))
    return docs.select("doc_id").join(grouped, "doc_id", "left").withColumn("json", F.coalesce("json", F.lit("[]")))
