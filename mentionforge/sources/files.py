"""Reading and writing: JSON lines, text files, tables, per-document JSON, resuming."""

from __future__ import annotations

from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mentionforge.operators.rows import keep_first
from mentionforge.sources.document_files import DocumentFiles

ICD_SCHEMA = "doc_id string, code string, text string, name_vi string, name_en string, note_vi string, note_en string, chapter string, block string, kb string, role string, vi_glyph_ok boolean"
CONCEPT_SCHEMA = "doc_id string, text string, code string, role string, synonyms array<string>"
ALIAS_SCHEMA = "doc_id string, text string, role string, resolve_in array<string>, resolve_min array<string>"
EVAL_SCHEMA = "mention string, kb string, gold array<string>, noise string, gold_kind string, cluster_name string, distractor array<string>"


def read_json_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Objects, one a line; blank lines are skipped, broken ones fail."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_in_order(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """read_json_lines with ``place``, by which rows have the order of the files' names and of their lines."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    d = read_json_lines(spark, path, schema)
    return d.select("*", at.alias("place"))


def numbered_lines(spark: SparkSession, path: str, blank_too: bool = False) -> DataFrame:
    """file, line_no, value of a text file, or of each one of a folder: the number among the file's non-blank lines, or
    among all. A file may be read in several pieces: lines are counted piece by piece, in order of where they begin."""
    d = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"))
    d = d if blank_too else d.filter(F.trim("value") != "")
    pieces = d.groupBy(F.col("file").alias("__file"), F.col("__block").alias("__of")).agg(F.count("*").alias("__n"))
    earlier = W.partitionBy("__file").orderBy("__of").rowsBetween(W.unboundedPreceding, -1)  # the pieces of one file
    pieces = pieces.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    within = F.row_number().over(W.partitionBy("file", "__block").orderBy("__at"))  # one task's piece
    d = d.withColumn("__k", within).join(pieces, (F.col("file") == F.col("__file")) & (F.col("__block") == F.col("__of")))
    return d.select("file", (F.col("__before") + F.col("__k")).alias("line_no"), "value")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (the file's stem), text, in order of number and name."""
    d = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    stem = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_name"), "/"), -1), r"\.txt$", "")
    d = d.select(F.url_decode(stem).alias("doc_id"), F.col("value").alias("text"))
    return d.orderBy(F.when(F.col("doc_id").rlike(r"^\d+$"), F.expr("try_cast(doc_id AS decimal(38,0))")).otherwise(0), "doc_id")


def read_table(spark: SparkSession, url: str, table: str, key: str | None = None, parts: int = 8, **options: str) -> DataFrame:
    """A table of a relational database; filters and columns are pushed down. With ``key``, a column of numbers, dates or
    times, the table is read by ``parts`` queries at once, each of a range of the key between its least and greatest
    value, which one query asks for first; rows without a key are in the first."""
    reader = lambda **more: spark.read.format("jdbc").options(url=url, **options, **more)
    if key is None:
        return reader(dbtable=table).load()
    ends = reader(query=f"SELECT min({key}) AS low_end, max({key}) AS high_end FROM {table}").load().first()
    if ends[0] is None:
        return reader(dbtable=table).load()
    return reader(dbtable=table, partitionColumn=key, lowerBound=str(ends[0]), upperBound=str(ends[1]), numPartitions=str(parts)).load()


def whole_documents(records: DataFrame) -> DataFrame:
    """Those with an id and a text."""
    return records.filter("doc_id <> '' AND text <> ''")


def first_documents(records: DataFrame) -> DataFrame:
    """Of read_in_order's rows the documents that count, one row an id."""
    return keep_first(whole_documents(records), ["doc_id"], ["place"]).drop("place")


def in_order(records: DataFrame, otherwise: list[str]) -> list[str]:
    """What "first" means: the line number (numbered_lines) where the input has one, else an order of values."""
    return [c for c in ("file", "line_no") if c in records.columns] if "line_no" in records.columns else otherwise


def code_documents(records: DataFrame) -> DataFrame:
    """Records of a code table to documents: those with an id and a text, the first of each id."""
    d = whole_documents(records)
    d = d.withColumns({"kb": F.coalesce(F.nullif("kb", F.lit("")), F.lit("icd")), "role": F.coalesce(F.nullif("role", F.lit("")), F.lit("candidate"))})
    return keep_first(d, ["doc_id"], in_order(d, ["code", "text"]))


def drug_documents(concepts: DataFrame, aliases: DataFrame) -> DataFrame:
    """Concepts, then aliases, as documents of one knowledge base: the first of each id, concepts before aliases."""
    both = concepts.withColumn("src", F.lit(0)).unionByName(aliases.withColumn("src", F.lit(1)), allowMissingColumns=True)
    d = whole_documents(both).withColumns({"kb": F.lit("rxnorm"), "role": F.when(F.col("src") == 0, "candidate").otherwise("alias")})
    return keep_first(d, ["doc_id"], ["src", *in_order(d, ["text"])]).drop("src")


def document_counts(records: DataFrame) -> DataFrame:
    """One row: n_read, n_incomplete (without id or text), n_repeated (an id that an earlier row has), n_kept."""
    ok = F.coalesce(F.col("doc_id") != "", F.lit(False)) & F.coalesce(F.col("text") != "", F.lit(False))
    d = records.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(ok).alias("ok"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    kept = F.least("ok", F.lit(1))
    return d.agg(total("n").alias("n_read"), total(F.col("n") - F.col("ok")).alias("n_incomplete"), total(F.col("ok") - kept).alias("n_repeated"), total(kept).alias("n_kept"))


def counted_documents(records: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """What ``keep`` makes of records (one row an id), and a function that gives the counts of document_counts once a job
    over it has run: they are gathered on the way, so the input is not read again for them."""
    read, kept = Observation(), Observation()
    ok = F.coalesce(F.col("doc_id") != "", F.lit(False)) & F.coalesce(F.col("text") != "", F.lit(False))
    seen = records.observe(read, F.count(F.lit(1)).alias("n_read"), F.count_if(~ok).alias("n_incomplete"))
    out = keep(seen).observe(kept, F.count(F.lit(1)).alias("n_kept"))

    def counts() -> dict[str, int]:
        n = read.get | kept.get
        return {"n_read": n["n_read"], "n_incomplete": n["n_incomplete"], "n_repeated": n["n_read"] - n["n_incomplete"] - n["n_kept"], "n_kept": n["n_kept"]}

    return out, counts


def pending(docs: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents without an output yet."""
    return docs.join(done.select(key).distinct(), key, "left_anti")


def write_per_document(per_document: DataFrame, path: str) -> None:
    """doc_id, json to one partition folder a document; existing ones of the same documents are replaced."""
    per_document.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("doc_id").text(path)


def write_json_files(per_document: DataFrame, path: str, mode: str = "append") -> None:
    """doc_id, json to one file <doc_id>.json a document; if the job fails none is there (see document_files)."""
    per_document.sparkSession.dataSource.register(DocumentFiles)
    per_document.select("doc_id", "json").write.format("document_files").mode(mode).save(path)


def written_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id of the files that are there, for pending()."""
    store, folder = fs.FileSystem.from_uri(path)
    there = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    ids = [(i.base_name.removesuffix(".json"),) for i in there if i.is_file and i.base_name.endswith(".json")]
    return spark.createDataFrame(ids, "doc_id string")
