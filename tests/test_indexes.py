"""Indexes, dictionaries, interval and containment joins, sinks and sources against brute force and against each other."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentionforge.operators import dense, dictionary, intervals, lexical, pruned_search, rows, segments, spans, vector_index
from mentionforge.plans import catalogue
from mentionforge.sources import files

SF = "/root/testdata/sf0.001"
DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def hits_of(df, digits=4):
    return sorted((r.query_id, r.doc_id, round(r.score, digits)) for r in df.collect())


# Vector index

@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")


def test_inverted_file_recall_and_exactness(spark, vectors, tmp_path):
    index = vector_index.build(vectors, str(tmp_path / "ivf"), n_cells=12, tile=16)
    queries = vectors.withColumnRenamed("vec_id", "query_id")
    want = {q: set() for q in range(500)}
    for r in dense.search(vectors, queries).collect():
        want[r.query_id].add(r.doc_id)
    assert 1 <= index.probes < 12
    found = vector_index.search(vector_index.open_index(spark, str(tmp_path / "ivf")), queries).collect()
    recall = sum(r.doc_id in want[r.query_id] for r in found) / sum(map(len, want.values()))
    assert recall >= 0.95
    some = queries.filter("query_id % 20 = 0")
    assert hits_of(vector_index.search(index, some, probes=1, exact=True)) == hits_of(dense.search(vectors, some))
    assert index.tiles.agg(F.sum(F.size("ids"))).first()[0] == 500 and index.tiles.agg(F.max("tile")).first()[0] > 0


def test_probes_read_only_their_cells(spark, vectors, tmp_path):
    index = vector_index.build(vectors, str(tmp_path / "ivf"), n_cells=12)
    one = vectors.filter("vec_id = 7").withColumnRenamed("vec_id", "query_id")
    plan = vector_index.search(index, one, probes=2)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "PartitionFilters" in x and "cell" in x)
    assert "IN (" in scan.split("PartitionFilters")[1] or "(cell#" in scan.split("PartitionFilters")[1]
    assert hits_of(vector_index.search(index, one, k=3, probes=2))[0][1] in range(500)


def test_hot_vector_few_rows_and_failed_builds(spark, tmp_path, monkeypatch):
    same = spark.range(300).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(0.0)).cast("array<float>").alias("embedding"))
    other = spark.createDataFrame([(300, [0.0, 1.0]), (301, None)], "vec_id long, embedding array<float>")
    index = vector_index.build(same.union(other), str(tmp_path / "ivf"), tile=50)
    assert index.tiles.agg(F.max(F.size("ids"))).first()[0] < 100
    query = spark.createDataFrame([(1, [0.6, 0.8])], "query_id long, embedding array<float>")
    found = vector_index.search(index, query, k=3, exact=True).orderBy("dense_rank").collect()
    assert [r.doc_id for r in found] == [300, 0, 1]
    monkeypatch.setattr(vector_index, "probes_for", lambda *a: 1 / 0)  # fails before the last step
    with pytest.raises(ZeroDivisionError):
        vector_index.build(other, str(tmp_path / "ivf"))
    assert vector_index.open_index(spark, str(tmp_path / "ivf")).path == index.path
    monkeypatch.undo()
    assert vector_index.search(vector_index.build(other, str(tmp_path / "ivf")), query, exact=True).count() == 1


# Dictionary

def brute_occurrences(text, term):
    from mentionforge.functions.text import fold_text

    low, own = fold_text(text), fold_text(term).strip()
    at = [i for i in range(len(low)) if own and low.startswith(own, i)]
    inside = lambda a, b: 0 <= a and b < len(low) and low[a].isalnum() and low[b].isalnum()
    return [i for i in at if not inside(i - 1, i) and not inside(i + len(own) - 1, i + len(own))]


def test_every_occurrence(spark):
    texts = ["Đau đầu, ĐAU  ĐẦU; đau\nđầu nhiều", "a a a a", "Straße STRASSE strasse", "đau đầu", None, "", "x" * 50 + " aa", "a" * 200_000]
    terms = [(1, "đau đầu"), (2, "a a"), (3, "a"), (4, "strasse"), (5, "Đau"), (6, " "), (7, None), (8, "ĐAU ĐẦU"), (9, "đau đầu")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    dictionary_rows = spark.createDataFrame(terms, "term_id long, term string")
    for block in (100, 2):
        got = dictionary.occurrences(docs, dictionary_rows, block=block).collect()
        want = {(d, n): len(brute_occurrences(t, w)) for d, t in enumerate(texts) if t for n, w in terms if w}
        for d, n in want:
            assert sum((r.doc_id, r.term_id) == (d, n) for r in got) == want[d, n], (d, n)
    spans_of = {(r.term_id, r.span_start, r.span_end) for r in got if r.doc_id == 0}
    assert {(1, 0, 7), (1, 9, 17), (1, 19, 26), (5, 0, 3)} <= spans_of
    assert {(r.span_start, r.span_end) for r in got if r.doc_id == 2} == {(0, 6), (7, 14), (15, 22)}
    assert {texts[3][r.span_start : r.span_end] for r in got if r.doc_id == 3 and r.term_id == 1} == {"đau đầu"}


def test_extractor_gives_all_and_the_longest(spark):
    extract = dictionary.extractor({"viêm phổi": "CHẨN_ĐOÁN", "viêm": "TRIỆU_CHỨNG", "đau": "TRIỆU_CHỨNG"})
    found = extract("Đau, viêm phổi nặng, đau; viêm. Đauu")
    assert [(e["text"], e["type"]) for e in found] == [("Đau", "TRIỆU_CHỨNG"), ("viêm phổi", "CHẨN_ĐOÁN"), ("đau", "TRIỆU_CHỨNG"), ("viêm", "TRIỆU_CHỨNG")]
    from mentionforge.operators import models

    d = spark.createDataFrame([("đau đau",)], "text string")
    assert len(models.extract_entities(d, extract).first().result.entities) == 2


# Intervals

@pytest.mark.parametrize("seed", range(3))
def test_interval_joins_are_brute_force(spark, seed):
    rng = random.Random(seed)
    span = lambda: (a := rng.randrange(-50, 50), a + rng.randrange(-2, 60))
    ivs = [(i, rng.choice(["a", "b", None]), *span()) for i in range(40)]
    points = [(i, rng.choice(["a", "b", None]), rng.randrange(-60, 120)) for i in range(60)] + [(60, "a", None)]
    iv = spark.createDataFrame(ivs, "i int, k string, low long, high long")
    pt = spark.createDataFrame(points, "p int, k string, at long")
    got = intervals.points_in_intervals(pt, iv, ["k"]).select("p", "interval.i").collect()
    assert sorted(map(tuple, got)) == sorted((p, i) for p, k, at in points for i, kk, lo, hi in ivs if at is not None and k is not None and k == kk and lo <= at < hi)
    over = intervals.overlapping(iv, iv, ["k"]).select("a.i", F.col("b.i").alias("j")).collect()
    assert sorted(map(tuple, over)) == sorted((i, j) for i, k, a, z in ivs for j, kk, b, y in ivs if k is not None and k == kk and a < z and b < y and a < y and b < z)
    first = {r.p: r.interval and r.interval.i for r in intervals.first_interval(pt.drop("k"), iv.drop("k"), ["low", "i"]).collect()}
    assert first == {p: min(((lo, i) for i, _, lo, hi in ivs if at is not None and lo <= at < hi), default=(0, None))[1] for p, _, at in points}


def test_interval_plan_and_bins(spark):
    iv, pt = spark.range(100).selectExpr("id", "id * 10 AS low", "id * 10 + 15 AS high"), spark.range(5000).selectExpr("id AS at")
    plan = intervals.points_in_intervals(pt, iv)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    wide = spark.range(1).select(intervals.dyadic_bins(F.lit(-(2**40) + 1), F.lit(2**41 - 1)).alias("b")).first().b
    assert len(wide) <= 2 * 42 and sum(2**x.level for x in wide) == 2**41 - 1 + 2**40 - 1
    assert spark.range(1).select(intervals.dyadic_bins(F.lit(5), F.lit(5)).alias("b")).first().b == []


# Lexical

@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")


def test_pruned_search_scores_fewer_postings(spark, corpus):
    rng = np.random.default_rng(1)
    word = lambda: f"w{min(int(rng.zipf(1.3)), 4000)}"
    docs = spark.createDataFrame([(i, " ".join(word() for _ in range(rng.integers(5, 80)))) for i in range(3000)], "doc_id long, text string")
    queries = spark.createDataFrame([(q, f"w1 w2 w3 w{50 + q} w{300 + q} w1 w{q + 5}") for q in range(20)] + [(20, "none"), (21, None), (22, "w1")], "query_id long, text string")
    index = lexical.build_index(docs)
    seen = {}

    def count(step, postings):
        seen[step] = postings.count()
        return postings

    got = pruned_search.search(index, queries, k=5, through=count)
    assert hits_of(got) == hits_of(lexical.search(index, queries, k=5))
    every = index.postings.join(lexical.query_tokens(queries), "tok").count()
    assert sum(seen.values()) < every / 2, (seen, every)
    docs, items = corpus
    index = lexical.build_index(docs)
    assert hits_of(pruned_search.search(index, items, bounds=pruned_search.block_bounds(index))) == hits_of(lexical.search(index, items))


def test_segments_are_a_rebuilt_index(spark, corpus, tmp_path):
    docs, items = corpus
    index = segments.Segments(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="empty"):
        index.index()
    for part in range(5):
        index.add(docs.filter(F.col("doc_id") % 5 == part))
    assert len(index.segments) == 2  # four of a size were merged
    tenth, new = docs.filter("doc_id % 10 = 3"), docs.filter("doc_id % 10 = 4").withColumn("text", F.concat("text", F.lit(" new words")))
    index.delete(tenth)
    index.add(new.unionByName(spark.createDataFrame([(9999, "")], "doc_id long, text string")))
    want = docs.filter("doc_id % 10 NOT IN (3, 4)").unionByName(new).unionByName(spark.createDataFrame([(9999, "")], "doc_id long, text string"))
    again = segments.Segments(spark, str(tmp_path / "s"))  # as another session finds it
    live, rebuilt = again.index(), lexical.build_index(want)
    assert (live.n_docs, live.length) == (rebuilt.n_docs, rebuilt.length)
    assert hits_of(lexical.search(live, items), 6) == hits_of(lexical.search(rebuilt, items), 6)
    again.add(docs.filter("doc_id % 10 = 3"))  # deleted documents may come back
    again.vacuum()
    named = {s.name for s in again.segments} | {g for s in again.segments for g in s.gone} | {"current"}
    assert {p.name for p in (tmp_path / "s").iterdir() if not p.name.startswith(".")} == named
    assert again.index().n_docs == rebuilt.n_docs + tenth.count()
    again.delete(docs.select("doc_id"))
    assert segments.Segments(spark, str(tmp_path / "s")).index().n_docs == 1


# Sets of codes

def test_containment_with_a_frequent_code(spark):
    rng = random.Random(2)
    some = lambda n: [str(rng.randrange(1, 400)) for _ in range(n)] + (["hot"] if rng.random() < 0.3 else [])
    sets = [some(rng.randrange(0, 3)) for _ in range(2000)] + [["hot"], [], ["5", "5"], ["new"]]
    groups = [some(rng.randrange(1, 8)) for _ in range(1500)] + [["hot", "5", "6"]]
    r = spark.createDataFrame(list(enumerate(sets)), "row_id int, codes array<string>")
    g = spark.createDataFrame(list(enumerate(groups)), "group_id int, codes array<string>")
    want = {i for i, s in enumerate(sets) if s and any(set(s) <= set(x) for x in groups)}
    assert {x.row_id for x in rows.superset_groups(r, g).collect()} == want
    naive = r.select("row_id", F.explode("codes").alias("code")).join(g.select("group_id", F.explode("codes").alias("code")), "code").count()
    often = {c: sum(c in x for x in map(set, groups)) for x in groups for c in x}
    least = [min(often.get(c, 0) for c in s) if len(s) > 1 else 1 for s in {frozenset(s) for s in sets if s}]
    assert rows.containment_candidates(r, g).count() <= sum(least) < naive / 20  # the lists of the rarest codes alone


def test_near_pairs_with_a_frequent_code(spark):
    rng = random.Random(3)
    code = lambda: "hot" if rng.random() < 0.3 else str(rng.randrange(300))
    groups = [{code() for _ in range(rng.randrange(1, 5))} for _ in range(800)]
    gold = {(k, code()) for k in range(300) for _ in range(rng.randrange(1, 4))} | {(0, str(x)) for x in range(200)}
    pairs = {(k, code()) for k in range(300) for _ in range(3)} | {(301, "hot")}
    g = spark.createDataFrame([(i, sorted(x)) for i, x in enumerate(groups)], "group_id int, codes array<string>")
    table = lambda x: spark.createDataFrame(sorted(x), "key int, code string")
    of_key = {}
    for k, c in gold:
        of_key.setdefault(k, set()).add(c)
    want = {(k, c) for k, c in pairs if any(c in x and x & of_key.get(k, set()) for x in groups)}
    assert {tuple(r) for r in rows.near_pairs(table(pairs), table(gold), g).collect()} == want
    naive = table(gold).join(g.select("group_id", F.explode("codes").alias("code")), "code").count()
    assert sum(d.count() for d in rows.near_candidates(table(pairs), table(gold), g)) < naive / 5


# Spans in SQL

def test_table_function_is_align(spark):
    texts = ["Đau bụng dữ dội, ĐAU  BỤNG; ** ** đau", "viêm phổi viêm", "", None, "a\nb a b"]
    pick = lambda *t: [{"text": x, "type": y, "assertions": ["isNegated"]} for x, y in t]
    entities = [pick(("đau bụng dữ dội", "TRIỆU_CHỨNG"), ("đau bụng", "TRIỆU_CHỨNG"), ("** **", "THUỐC"), ("đau", "TRIỆU_CHỨNG"), ("bụng dữ dội", "TRIỆU_CHỨNG")), pick(("viêm phổi", "CHẨN_ĐOÁN"), ("viêm", "CHẨN_ĐOÁN"), ("viêm", "CHẨN_ĐOÁN")), pick(("x", "THUỐC")), None, pick(("a b", "THUỐC"), ("a b", "THUỐC"), ("b", "THUỐC"))]
    d = spark.createDataFrame([(i, t, e) for i, (t, e) in enumerate(zip(texts, entities))], f"doc_id int, text string, entities {spans.ENTITIES}")
    spans.register(spark)
    got = spark.sql("SELECT t.doc_id, s.* FROM {d} t, LATERAL align_spans(t.text, t.entities) s", d=d)
    assert sorted(map(str, got.collect())) == sorted(map(str, spans.align(d).select(got.columns).collect())) and got.count() > 5


# Sources and sinks

def test_table_is_read_in_ranges(spark):
    url = "jdbc:derby:memory:ranges;create=true"
    d = spark.range(1000).select(F.when(F.col("id") < 990, F.col("id")).alias("K"), (F.col("id") % 7).cast("string").alias("V"))
    d.write.format("jdbc").options(url=url, dbtable="t", driver=DERBY).mode("overwrite").save()
    read = files.read_table(spark, url, "t", key="K", parts=8, driver=DERBY)
    assert read.rdd.getNumPartitions() == 8 and sorted(map(tuple, read.collect()), key=str) == sorted(map(tuple, d.collect()), key=str)
    assert read.groupBy(F.spark_partition_id()).count().count() == 8
    plan = read.filter("V = '3' AND K > 500").select("K")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(V,3)" in plan and "GreaterThan(K,500)" in plan
    empty = spark.createDataFrame([], "K long, V string")
    empty.write.format("jdbc").options(url=url, dbtable="e", driver=DERBY).mode("overwrite").save()
    assert files.read_table(spark, url, "e", key="K", driver=DERBY).count() == 0


def test_failed_write_leaves_nothing(spark, tmp_path):
    d = spark.range(40).select(F.col("id").cast("string").alias("doc_id"), F.lit('[{"a": "đ"}]').alias("json")).repartition(4)
    broken = d.withColumn("json", F.when(F.col("doc_id") == "33", "no json").otherwise(F.col("json")))
    out = tmp_path / "out"
    with pytest.raises(Exception, match="Expecting value"):
        files.write_json_files(broken, str(out))
    assert not out.exists() or list(out.iterdir()) == []
    assert files.written_documents(spark, str(out)).count() == 0
    files.write_json_files(d, str(out))
    assert len(list(out.iterdir())) == 40 and json.loads((out / "33.json").read_text()) == [{"a": "đ"}]
    files.write_json_files(d.filter("doc_id < 3").withColumn("json", F.lit("[]")), str(out))
    assert len(list(out.iterdir())) == 40 and (out / "2.json").read_text() == "[]"
    files.write_json_files(d.filter("doc_id < 3"), str(out), "overwrite")
    assert sorted(p.name for p in out.iterdir()) == ["0.json", "1.json", "2.json"]


def test_counts_on_the_way(spark, tmp_path):
    path = tmp_path / "d.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in [{"doc_id": "b", "text": "2"}, {"doc_id": "a", "text": "1"}, {"doc_id": "b", "text": "3"}, {"doc_id": "", "text": "x"}, {"doc_id": "c"}]))
    records = files.read_in_order(spark, str(path), "doc_id string, text string")
    docs, counts = files.counted_documents(records, files.first_documents)
    assert docs._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    docs.write.parquet(str(tmp_path / "out"))
    assert counts() == files.document_counts(records).first().asDict() == {"n_read": 5, "n_incomplete": 2, "n_repeated": 1, "n_kept": 2}
    assert {(r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("a", "1"), ("b", "2")}


def test_lines_are_numbered_by_file(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.txt").write_text("a1\n\na2\n")
    (tmp_path / "l" / "b.txt").write_text("".join(f"b{i} {'x' * 50}\n" for i in range(1, 400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = files.numbered_lines(spark, str(tmp_path / "l")).collect()
        assert len({r.file for r in got}) == 2 and len(got) == 401
        assert all(r.value.split()[0] == f"{r.file[-5]}{r.line_no}" for r in got)
        assert {r.line_no for r in files.numbered_lines(spark, str(tmp_path / "l" / "a.txt"), blank_too=True).collect()} == {1, 2, 3}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("seed", range(2))
def test_interval_counts_are_brute_force(spark, seed, monkeypatch):
    """Counts without pairs, with empty and reversed intervals, repeated rows, null keys and ends, wide and narrow bins."""
    rng = random.Random(seed)
    span = lambda: (a := rng.randrange(-50, 50), a + rng.choice([-3, -1, 0, 0, 1, 5, 40]))
    ivs = [(i, rng.choice(["a", "b", None]), *span()) for i in range(50)] + [(60, "a", 3, 9), (61, "a", 3, 9), (62, "a", None, 9)]
    points = [(rng.choice(["a", "b", None]), rng.randrange(-60, 100)) for _ in range(60)] + [("a", None)]
    iv = spark.createDataFrame(ivs, "i int, k string, low long, high long")
    pt = spark.createDataFrame(points, "k string, at long")
    for few in (100_000, 30):
        monkeypatch.setattr(intervals, "BROADCAST_ROWS", few)
        inside = {(k, at): [i for i, kk, lo, hi in ivs if None not in (k, at, lo) and k == kk and lo <= at < hi] for k, at in points}
        got = {(r.k, r.at): (r.n, r.first) for r in intervals.held(pt, iv, F.col("i"), ["k"]).collect()}
        assert got == {p: (len(i), min(i)) for p, i in inside.items() if i}
        over = {r.i: r.n_over for r in intervals.overlap_counts(iv, ["k"]).collect()}
        assert over == {i: sum(k == kk and None not in (b, y) and a < y and b < z for _, kk, b, y in ivs) for i, k, a, z in ivs if None not in (k, a, z)}
    assert {r.i: r.n_over for r in intervals.overlap_counts(iv.drop("k")).collect()}[0] == sum(None not in (b, y) and ivs[0][2] < y and b < ivs[0][3] for _, _, b, y in ivs)


def test_interval_queries_make_no_pairs(spark, tmp_path):
    """20,000 events that all hold each other: the 400 million pairs of each query are counted only."""
    e = spark.range(20_000).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 997) AS ts", "1L AS user_id", "IF(id % 2 = 0, 'error', 'purchase') AS event_type", "1.0D AS value")
    e.write.parquet(f"{tmp_path}/events.parquet")
    n = catalogue.QUERIES["interval_overlap"](spark, str(tmp_path)).agg(F.count("*"), F.min("n_over"), F.max("n_over")).first()
    assert tuple(n) == (10_000, 9_999, 9_999)
    joined = catalogue.QUERIES["interval_join"](spark, str(tmp_path))
    assert joined.agg(F.max("n"), F.min("first")).first() == (10_000, 1)
    assert joined.filter("event_id = 0").first().n == sum(i % 997 == 0 for i in range(1, 20_000, 2))
    assert "interval" not in joined.columns and "BroadcastNestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()


def test_search_beyond_a_batch_and_ties(spark, monkeypatch):
    """Scores by blocks of documents are those of the join, for long documents, equal ones, repeated and null ids, and
    queries whose ids are texts."""
    rng = random.Random(5)
    word = lambda: f"w{int(rng.paretovariate(0.5)) % 300}"
    texts = [" ".join(word() for _ in range(rng.choice([0, 3, 40, 900]))) for _ in range(120)] + ["w1 w2 w3"] * 50
    docs = spark.createDataFrame([(None if i == 7 else i % 160, t) for i, t in enumerate(texts)], "doc_id long, text string")
    queries = spark.createDataFrame([(t, t) for t in {" ".join(word() for _ in range(6)) for _ in range(30)}], "query_id string, text string")
    index = lexical.build_index(docs)
    with monkeypatch.context() as m:
        m.setattr(lexical, "BROADCAST_ROWS", 0)
        joined = sorted((r.query_id, r.bm25_rank, str(r.doc_id), round(r.score, 6)) for r in lexical.search(index, queries, 10).collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    monkeypatch.setattr(lexical, "CELLS", 200)
    try:
        found = lexical.search(index, queries, 10)
        assert sorted((r.query_id, r.bm25_rank, str(r.doc_id), round(r.score, 6)) for r in found.collect()) == joined
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    scored = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "MapInArrow" in line]
    assert scored and not any("query_id" in line for line in scored)  # a query's text goes with no posting and no pair


def test_segments_read_known_tokens_only(spark, corpus, tmp_path):
    docs, queries = corpus
    index = segments.Segments(spark, str(tmp_path / "i"))
    index.add(docs.filter("doc_id % 2 = 0"))
    index.add(docs.filter("doc_id % 2 = 1"))
    index.delete(docs.filter("doc_id % 5 = 0"))
    known = lexical.query_tokens(queries, queries.columns[0], "text")
    some, whole = index.index(known), index.index()
    assert (some.n_docs, some.length) == (whole.n_docs, whole.length) and some.postings.count() < whole.postings.count()
    assert hits_of(lexical.search(some, queries, id_col=queries.columns[0])) == hits_of(lexical.search(whole, queries, id_col=queries.columns[0]))
