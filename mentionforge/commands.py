"""The jobs from a shell: build tables and indexes, dump scores, report on them, sweep thresholds, validate rows, predict records.

    python -m mentionforge.commands codes lines.jsonl blocks.jsonl icd/           # lines: page, side, line_no, text; blocks: chapter, block
    python -m mentionforge.commands drugs conso.parquet rel.parquet rxnorm/
    python -m mentionforge.commands trace conso.parquet rel.parquet 123456
    python -m mentionforge.commands build docs.jsonl index/ [--embedder package.module:load]
    python -m mentionforge.commands dump rows.jsonl docs.jsonl index/ dump/ --variant raw [--scorer package.module:load --embedder ..]
    python -m mentionforge.commands report dump/ tables/
    python -m mentionforge.commands sweep dump/ out/ --variant raw --date 2000-01-01
    python -m mentionforge.commands validate rows.jsonl [--icd docs.jsonl --rxnorm docs.jsonl] [--strict]
    python -m mentionforge.commands predict texts/ out/ --kb icd=docs.jsonl,index/ --url http://host/v1 --model name --thresholds thresholds.json

Documents are lines with doc_id, text, role, code, resolve_in, block. --scorer and --embedder name a function without
arguments that loads a model in a worker: a scorer (instruction, pairs) -> scores, an encoder of a list of texts. Floors
and margins belong to a scorer, so predict takes those that sweep has found with it. A job that finds errors ends with
status 1.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionforge.operators import calibration, code_tables, drug_tables, gates, lexical, linking, measures, models, pipeline, vector_index
from mentionforge.sources import files

DOCUMENTS = "doc_id string, text string, role string, code string, resolve_in array<string>, block string"
LINES = "page int, side string, line_no int, text string"
INSTRUCTION = "Given a mention in a clinical text, judge whether the entry names it."
QUERY_PROMPT, DOCUMENT_PROMPT = "query: ", "passage: "


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Those with an id and a text, the first of each id in the input's order."""
    return files.first_documents(files.read_in_order(spark, path, DOCUMENTS))


def any_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.json(path)


def named(place: str) -> Callable:
    module, name = place.split(":")
    return getattr(importlib.import_module(module), name)


def scorer_of(a: argparse.Namespace) -> Callable[[DataFrame], DataFrame]:
    """The named scorer, or without one the sum of the branches' scores."""
    return models.as_scorer(a.scorer, named(a.scorer), a.instruction) if a.scorer else models.blended_scorer


def index_of(spark: SparkSession, docs: str, index: str, a: argparse.Namespace) -> dict:
    """What linking.retrieve takes; with an embedder also the dense branch that build has written."""
    out = {"docs": documents(spark, docs), "lexical": lexical.open_index(spark, index)}
    if a.embedder:
        embed = models.prompted_embedding(a.embedder, named(a.embedder))
        out |= {"dense": vector_index.open_index(spark, f"{index}/vectors"), "embed": lambda text: embed(text, QUERY_PROMPT)}
    return out


def codes(spark: SparkSession, a: argparse.Namespace) -> None:
    ranges = code_tables.hierarchy(spark, [tuple(r) for r in spark.read.json(a.blocks).select("chapter", "block").collect()])
    records = code_tables.code_table(files.read_json_lines(spark, a.lines, LINES), ranges)
    files.write_json_lines(records.orderBy("code"), a.out)
    print(code_tables.table_quality(spark.read.schema(files.ICD_SCHEMA).json(a.out)).first().asDict())


def drugs(spark: SparkSession, a: argparse.Namespace) -> None:
    conso, rel = any_table(spark, a.conso), any_table(spark, a.rel)
    files.write_json_lines(drug_tables.candidates(conso).orderBy("code", "text"), f"{a.out}/concepts")
    files.write_json_lines(drug_tables.aliases(conso, rel).orderBy("doc_id", "text"), f"{a.out}/aliases")


def trace(spark: SparkSession, a: argparse.Namespace) -> None:
    drug_tables.trace_of(any_table(spark, a.conso), any_table(spark, a.rel), a.rxaui).show(200, truncate=False)


def build(spark: SparkSession, a: argparse.Namespace) -> None:
    docs, counts = files.counted_documents(files.read_in_order(spark, a.docs, DOCUMENTS), files.first_documents)
    index = lexical.build_index(docs)  # the job that reads the documents
    print(" ".join(f"{k}={v}" for k, v in counts().items()))
    lexical.save_index(index, a.index)
    if a.embedder:
        embed = models.prompted_embedding(a.embedder, named(a.embedder))
        vectors = documents(spark, a.docs).select("doc_id", embed(F.col("text"), DOCUMENT_PROMPT).alias("embedding"))
        vector_index.build(vectors, f"{a.index}/vectors", doc_id="doc_id")


def dump(spark: SparkSession, a: argparse.Namespace) -> None:
    lines = files.numbered_lines(spark, a.rows)
    rows = lines.select("file", "line_no", F.from_json("value", files.EVAL_SCHEMA).alias("r")).select("file", "line_no", "r.*")
    rows = rows.withColumns({"record_id": F.xxhash64("file", "line_no"), "row_no": F.struct("file", "line_no")}).drop("file", "line_no")
    linking.score_dump(rows, index_of(spark, a.docs, a.index, a), scorer_of(a), a.variant).write.mode("overwrite").parquet(a.dump)


def report(spark: SparkSession, a: argparse.Namespace) -> None:
    for name, table in measures.report({"dump": spark.read.parquet(a.dump)})["dump"].items():
        print(name)
        table.show(50, truncate=False)
        table.coalesce(1).write.mode("overwrite").json(f"{a.out}/{name}")


def sweep(spark: SparkSession, a: argparse.Namespace) -> None:
    thresholds, sides = calibration.sweep_all(spark.read.parquet(a.dump), a.variant, a.instruction if a.scorer else "none", a.date, a.steps, a.resamples)
    calibration.save_json(thresholds, f"{a.out}/thresholds.json")
    calibration.save_json(sides, f"{a.out}/split.json")


def validate(spark: SparkSession, a: argparse.Namespace) -> None:
    lines = files.numbered_lines(spark, a.rows)
    several = lines.select("file").distinct().count() > 1
    at = F.concat_ws(":", "file", F.lpad(F.col("line_no").cast("string"), 12, "0")) if several else F.col("line_no")
    lines = lines.select(at.alias("line_no"), "value")
    rows = lines.select("line_no", F.from_json("value", files.EVAL_SCHEMA).alias("r")).select("line_no", "r.*")
    found = [gates.check_fields(lines), gates.check_rows(rows), gates.check_duplicates(rows), gates.check_cluster_shape(rows)]
    if a.icd and a.rxnorm:
        icd, rxnorm = documents(spark, a.icd), documents(spark, a.rxnorm)
        aliases = rxnorm.filter("role = 'alias'")
        blocks, groups = icd.select("code", "block").distinct(), aliases.select(F.col("doc_id").alias("group_id"), F.col("resolve_in").alias("codes"))
        valid = gates.valid_codes(icd, rxnorm.filter("coalesce(role, '') <> 'alias'"), aliases)
        found += [gates.check_codes(rows, valid), gates.check_kinds(rows, blocks, groups), gates.check_clusters(rows, blocks, groups)]
    issues = found[0]
    for f in found[1:]:
        issues = issues.unionByName(f)
    issues = issues.distinct()  # gold_kind is looked at by two gates
    issues.orderBy("row_id", "rule").show(100, truncate=False)
    gates.enforce(issues, a.strict)


def decisions_of(a: argparse.Namespace) -> dict:
    """Floors and margins by knowledge base: those of a sweep, or the frozen ones, which belong to a reranker's scores."""
    if a.thresholds:
        with open(a.thresholds, encoding="utf-8") as f:
            found = json.load(f)
        return {kb: {"floor": t["floor"], "margin": t["margin"], "variant": found["metadata"]["variant"]} for kb, t in found.items() if kb != "metadata"}
    if not a.scorer:
        raise ValueError("--thresholds is needed: the frozen ones are for a reranker's scores, not for sums of the branches'")
    return linking.DECISIONS


def predict(spark: SparkSession, a: argparse.Namespace) -> None:
    decisions = decisions_of(a)
    extract = models.endpoint_extractor(a.url, a.model)
    models.preflight(extract)
    indexes = {kb: index_of(spark, *places.split(",", 1), a) for kb, places in (x.split("=", 1) for x in a.kb)}
    texts = files.read_texts(spark, a.texts)
    texts = texts.limit(a.limit) if a.limit else texts
    todo = texts if a.overwrite else files.pending(texts, files.written_documents(spark, a.out))
    records, errors = pipeline.run(todo, extract, indexes, scorer_of(a), decisions)
    failed = errors.select("doc_id").distinct()
    files.write_json_files(pipeline.per_document(records, todo.join(failed, "doc_id", "left_anti")), a.out)
    if first := errors.take(5):
        raise ValueError(f"documents without records: {[tuple(r) for r in first]}")


PLACES = {
    codes: ("lines", "blocks", "out"), drugs: ("conso", "rel", "out"), trace: ("conso", "rel", "rxaui"), build: ("docs", "index"), dump: ("rows", "docs", "index", "dump"),
    report: ("dump", "out"), sweep: ("dump", "out"), validate: ("rows",), predict: ("texts", "out"),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="mentionforge", description=__doc__.split("\n")[0])
    jobs = p.add_subparsers(required=True)
    for run, places in PLACES.items():
        job = jobs.add_parser(run.__name__)
        job.set_defaults(run=run)
        for place in places:
            job.add_argument(place)
        if run in (dump, sweep):
            job.add_argument("--variant", choices=["raw", "strip_dose"], default="raw")
        if run in (build, dump, predict):
            job.add_argument("--embedder", metavar="MODULE:LOAD")
        if run in (dump, sweep, predict):
            job.add_argument("--scorer", metavar="MODULE:LOAD")
            job.add_argument("--instruction", default=INSTRUCTION)
        if run is sweep:
            job.add_argument("--date", required=True)
            job.add_argument("--steps", type=int, default=calibration.GRID_STEPS)
            job.add_argument("--resamples", type=int, default=calibration.RESAMPLES)
        if run is validate:
            job.add_argument("--icd", metavar="DOCS")
            job.add_argument("--rxnorm", metavar="DOCS")
            job.add_argument("--strict", action="store_true")
        if run is predict:
            job.add_argument("--kb", action="append", required=True, metavar="NAME=DOCS,INDEX")
            job.add_argument("--url", required=True)
            job.add_argument("--model", required=True)
            job.add_argument("--thresholds")
            job.add_argument("--limit", type=int)
            job.add_argument("--overwrite", action="store_true")
    return p


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("mentionforge").getOrCreate()
    try:
        a.run(spark, a)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
