"""Data gates: all violations of each row as rows (row_id, level, rule, detail). An empty result passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionforge.functions.arrays import as_set, gold_kind, repeated
from mentionforge.functions.text import collapse
from mentionforge.operators.models import ENTITY_TYPES, TYPES_WITH_ASSERTIONS
from mentionforge.operators.linking import KB_OF_TYPE
from mentionforge.operators.rows import near_pairs, superset_groups, with_first_line

#: The closed field set of evaluation rows, and the knowledge bases.
REQUIRED = ["mention", "kb", "gold", "noise", "gold_kind"]
OPTIONAL = ["cluster_name", "distractor"]
KBS = ["icd", "rxnorm"]


def _issue(when: Column, level: str, rule: str, detail: Column | None = None) -> Column:
    text = F.lit("") if detail is None else F.coalesce(detail.cast("string"), F.lit(""))
    return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule"), text.alias("detail")))


def _rows(df: DataFrame, key: str, issues: list[Column]) -> DataFrame:
    found = F.filter(F.array(*issues), lambda x: x.isNotNull())
    return df.select(F.col(key).alias("row_id"), F.explode(found).alias("i")).select("row_id", "i.*")


def _join(a: Column) -> Column:
    return F.array_join(a, ",")


def check_rows(rows: DataFrame, key: str = "line_no") -> DataFrame:
    """Rows by themselves: gold there and without repeats, knowledge base known, distractors apart from gold and
    without repeats, gold_kind as it follows from gold; a cluster and distractors go together (a warning). A row
    without gold has only that error."""
    gold, other = F.col("gold"), F.coalesce("distractor", F.array().cast("array<string>"))
    some = F.size(F.coalesce(gold, F.array().cast("array<string>"))) > 0
    shared = F.sort_array(F.array_intersect(F.array_distinct(other), F.array_distinct(gold)))
    expected = gold_kind(F.col("kb"), gold)
    return _rows(rows, key, [
        _issue(~some, "error", "no gold"),
        _issue(some & (F.size(repeated(gold)) > 0), "error", "gold repeats", _join(repeated(gold))),
        _issue(some & ~F.coalesce(F.col("kb").isin(KBS), F.lit(False)), "error", "unknown kb", F.col("kb")),
        _issue(some & (F.size(shared) > 0), "error", "distractor is gold", _join(shared)),
        _issue(some & (F.size(repeated(other)) > 0), "error", "distractor repeats", _join(repeated(other))),
        _issue(some & expected.isNotNull() & ~F.col("gold_kind").eqNullSafe(expected), "error", "wrong gold_kind", F.col("gold_kind")),
        _issue(some & (F.size(other) > 0) & F.col("cluster_name").isNull(), "warning", "distractor without cluster"),
        _issue(some & (F.size(other) == 0) & F.col("cluster_name").isNotNull(), "warning", "cluster without distractor", F.col("cluster_name")),
    ])


def check_fields(lines: DataFrame, key: str = "line_no", value: str = "value") -> DataFrame:
    """Raw JSON lines: missing and unknown fields, lists that are none."""
    names = F.coalesce(F.json_object_keys(value), F.array().cast("array<string>"))
    lit = lambda xs: F.array(*[F.lit(x) for x in xs])
    missing, unknown = F.array_sort(F.array_except(lit(REQUIRED), names)), F.array_sort(F.array_except(names, lit(REQUIRED + OPTIONAL)))
    kind = lambda f: F.substring(F.trim(F.get_json_object(value, f"$.{f}")), 1, 1)
    return _rows(lines, key, [
        _issue(F.json_object_keys(value).isNull(), "error", "no JSON object"),
        _issue(F.size(missing) > 0, "error", "missing fields", _join(missing)),
        _issue(F.size(unknown) > 0, "error", "unknown fields", _join(unknown)),
        _issue(~F.coalesce(F.get_json_object(value, "$.kb").isin(KBS), F.lit(False)), "error", "unknown kb", F.get_json_object(value, "$.kb")),
        *[_issue(F.get_json_object(value, f"$.{f}").isNotNull() & (kind(f) != "["), "error", f"{f} is no list") for f in ("gold", "distractor")],
        _issue(F.coalesce(F.get_json_object(value, "$.gold"), F.lit("[]")).isin("[]", "", "null"), "error", "no gold"),
    ])


def valid_codes(icd: DataFrame, concepts: DataFrame, aliases: DataFrame) -> DataFrame:
    """kb, code: all codes that exist; an alias's resolve_in counts too."""
    pick = lambda d, kb, c: d.select(F.lit(kb).alias("kb"), c.cast("string").alias("code"))
    return pick(icd, "icd", F.col("code")).union(pick(concepts, "rxnorm", F.col("code"))).union(pick(aliases.select(F.explode("resolve_in").alias("c")), "rxnorm", F.col("c"))).filter("code <> ''").distinct()


def check_codes(rows: DataFrame, valid: DataFrame, key: str = "line_no") -> DataFrame:
    """Codes of gold and distractors that their knowledge base has not."""
    used = [rows.select(F.col(key).alias("row_id"), "kb", F.lit(f).alias("field"), F.explode(f).alias("code")) for f in ("gold", "distractor")]
    unknown = used[0].union(used[1]).filter(F.col("kb").isin(KBS)).join(valid, ["kb", "code"], "left_anti")
    found = unknown.groupBy("row_id", "field").agg(F.array_join(F.sort_array(F.collect_set("code")), ",").alias("detail"))
    return found.select("row_id", F.lit("error").alias("level"), F.concat("field", F.lit(" has unknown codes")).alias("rule"), "detail")


def with_blocks(rows: DataFrame, blocks: DataFrame, field: str, key: str) -> DataFrame:
    """row_id, blocks: the distinct blocks of a field's codes; '?' for a code without one. blocks: code, block."""
    used = rows.select(F.col(key).alias("row_id"), F.explode(field).alias("code"))
    return used.join(blocks, "code", "left").groupBy("row_id").agg(F.sort_array(F.collect_set(F.coalesce("block", F.lit("?")))).alias("blocks"))


def check_kinds(rows: DataFrame, blocks: DataFrame, groups: DataFrame, key: str = "line_no") -> DataFrame:
    """gold_kind follows from gold; several gold codes share a block (icd) or one group of aliases (rxnorm).
    blocks: code, block; groups: group_id, codes."""
    d = rows.filter(F.col("kb").isin(KBS) & (F.size(as_set(F.col("gold"))) > 0))
    expected = gold_kind(F.col("kb"), F.col("gold"))
    kinds = _rows(d, key, [_issue(~F.col("gold_kind").eqNullSafe(expected), "error", "wrong gold_kind", F.col("gold_kind"))])
    many = d.filter(F.size(as_set(F.col("gold"))) > 1)
    torn = with_blocks(many.filter("kb = 'icd'"), blocks, "gold", key).filter((F.size("blocks") > 1) | F.array_contains("blocks", "?"))
    torn = torn.select("row_id", F.lit("error").alias("level"), F.lit("gold spans blocks").alias("rule"), _join(F.col("blocks")).alias("detail"))
    drugs = many.filter("kb = 'rxnorm'").select(F.col(key).alias("row_id"), as_set(F.col("gold")).alias("codes"))
    alone = drugs.join(superset_groups(drugs, groups), "row_id", "left_anti")
    alone = alone.select("row_id", F.lit("error").alias("level"), F.lit("gold is of no one group").alias("rule"), _join(F.col("codes")).alias("detail"))
    return kinds.union(torn).union(alone)


def check_cluster_shape(rows: DataFrame, key: str = "line_no") -> DataFrame:
    other = F.size(as_set(F.col("distractor"))) > 0
    named = F.coalesce(F.col("cluster_name"), F.lit("")) != ""
    return _rows(rows, key, [
        _issue(named & ~other, "error", "cluster without distractor", F.col("cluster_name")),
        _issue(other & ~named, "error", "distractor without cluster"),
    ])


def check_clusters(rows: DataFrame, blocks: DataFrame, groups: DataFrame, key: str = "line_no") -> DataFrame:
    """A cluster has two rows or more; each distractor is near some gold of the cluster (same block, or a group of
    aliases that shares a code with it); an icd cluster lies in one block."""
    d = rows.filter(F.coalesce(F.col("cluster_name"), F.lit("")) != "").withColumn("key", F.concat_ws("/", F.coalesce("kb", F.lit("None")), "cluster_name"))
    sizes = d.groupBy("key").agg(F.count("*").alias("n"), F.min(key).alias("row_id"))
    single = sizes.filter("n < 2").select("row_id", F.lit("error").alias("level"), F.lit("cluster of one row").alias("rule"), F.col("key").alias("detail"))
    gold = d.select("key", "kb", F.explode("gold").alias("code")).distinct()
    other = d.select("key", "kb", F.col(key).alias("row_id"), F.explode("distractor").alias("code"))
    near_blocks = gold.filter("kb = 'icd'").join(blocks.filter("block IS NOT NULL"), "code").select("key", "block").distinct()
    icd = other.filter("kb = 'icd'").join(blocks, "code", "left").join(near_blocks, ["key", "block"], "left_anti").select("key", "row_id", "code")
    of_drugs = other.filter("kb <> 'icd'")
    near = near_pairs(of_drugs.select("key", "code"), gold.filter("kb <> 'icd'").select("key", "code"), groups)
    drugs = of_drugs.join(near, ["key", "code"], "left_anti").select("key", "row_id", "code")
    far = icd.union(drugs).groupBy("row_id").agg(F.array_join(F.sort_array(F.collect_set("code")), ",").alias("detail"))
    far = far.select("row_id", F.lit("error").alias("level"), F.lit("distractor is not near").alias("rule"), "detail")
    used = d.filter("kb = 'icd'").select("key", F.explode(F.concat(F.coalesce("gold", F.array().cast("array<string>")), F.coalesce("distractor", F.array().cast("array<string>")))).alias("code"))
    spans = used.join(blocks, "code", "left").groupBy("key").agg(F.sort_array(F.collect_set(F.coalesce("block", F.lit("?")))).alias("b")).filter(F.size("b") > 1)
    spans = spans.join(sizes, "key").select("row_id", F.lit("error").alias("level"), F.lit("cluster spans blocks").alias("rule"), _join(F.col("b")).alias("detail"))
    return single.union(far).union(spans)


def check_duplicates(rows: DataFrame, key: str = "line_no") -> DataFrame:
    d = with_first_line(rows, ["mention", "kb"], key).filter(F.col(key) > F.col("first_line"))
    return d.select(F.col(key).alias("row_id"), F.lit("error").alias("level"), F.lit("duplicate of an earlier row").alias("rule"), F.col("first_line").cast("string").alias("detail"))


def check_outputs(docs: DataFrame, outputs: DataFrame, strict: bool = False) -> DataFrame:
    """docs (doc_id, text), outputs (doc_id, json): a document without output and broken records are errors; outputs
    without a document and linked types without codes are warnings. Text and slice are compared with white space
    collapsed, or as they are if strict."""
    both = docs.join(outputs.withColumnRenamed("doc_id", "out_id"), F.col("doc_id") == F.col("out_id"), "full_outer")
    items = F.from_json("json", "array<string>")
    is_list = F.coalesce(F.substring(F.trim("json"), 1, 1) == "[", F.lit(False)) & items.isNotNull()
    files = _rows(both.withColumn("id", F.coalesce("doc_id", "out_id")), "id", [
        _issue(F.col("out_id").isNull(), "error", "no output"), _issue(F.col("doc_id").isNull(), "warning", "output without document"),
        _issue(F.col("out_id").isNotNull() & F.col("doc_id").isNotNull() & ~is_list, "error", "no list"),
    ])
    r = both.filter(F.col("doc_id").isNotNull() & is_list).select("doc_id", F.col("text").alias("raw"), F.posexplode(items).alias("at", "item"))
    get = lambda f: F.get_json_object("item", f"$.{f}")
    names = F.coalesce(F.json_object_keys("item"), F.array().cast("array<string>"))
    pos = F.from_json(get("position"), "array<bigint>")
    r = r.withColumns({"t": get("type"), "x": get("text"), "names": names, "s": F.get(pos, F.lit(0)), "e": F.get(pos, F.lit(1)), "np": F.size(pos), "object": F.json_object_keys("item").isNotNull(), "codes": get("candidates")})
    r = r.withColumn("id", F.concat(F.col("doc_id").cast("string"), F.lit("["), F.col("at").cast("string"), F.lit("]")))
    part = F.substring(F.col("raw"), F.col("s").cast("int") + 1, (F.col("e") - F.col("s")).cast("int"))
    same = part == F.col("x") if strict else collapse(part) == collapse(F.col("x"))
    full = F.col("object") & (F.coalesce(F.col("x"), F.lit("")) != "")
    shaped = F.coalesce((F.col("np") == 2) & F.col("s").isNotNull() & F.col("e").isNotNull(), F.lit(False))
    inside = (F.col("s") >= 0) & (F.col("s") < F.col("e")) & (F.col("e") <= F.length("raw"))
    linked = list(KB_OF_TYPE)
    records = _rows(r, "id", [
        _issue(~F.col("object"), "error", "no object"),
        _issue(F.col("object") & ~F.coalesce(F.col("t").isin(ENTITY_TYPES), F.lit(False)), "error", "unknown type", F.col("t")),
        _issue(F.col("object") & (F.coalesce(F.col("x"), F.lit("")) == ""), "error", "no text"),
        _issue(full & ~shaped, "error", "no position"), _issue(full & shaped & ~inside, "error", "position outside the text"),
        _issue(full & shaped & inside & ~same, "error", "text is not at its position", part),
        _issue(full & F.array_contains("names", "assertions") & ~F.coalesce(F.col("t").isin(TYPES_WITH_ASSERTIONS), F.lit(False)), "error", "assertions are not allowed", F.col("t")),
        _issue(full & F.array_contains("names", "candidates") & ~F.coalesce(F.col("t").isin(linked), F.lit(False)), "error", "candidates are not allowed", F.col("t")),
        _issue(full & F.coalesce(F.col("t").isin(linked), F.lit(False)) & F.coalesce(F.col("codes"), F.lit("[]")).isin("[]", ""), "warning", "no codes", F.col("x")),
    ])
    return files.withColumn("row_id", F.col("row_id").cast("string")).union(records)


def enforce(issues: DataFrame, strict: bool = False) -> None:
    """Raises if there are errors, or, if strict, warnings."""
    bad = issues if strict else issues.filter("level = 'error'")
    if first := bad.orderBy("row_id", "rule").take(5):
        raise ValueError(f"{bad.count()} violations, such as {[tuple(r) for r in first]}")
