"""Code and drug tables, indexes, linking."""

import pytest
from pyspark.sql import functions as F

from mentionforge.operators import code_tables, dense, dictionary, drug_tables, lexical, linking, models, pipeline, rows
from mentionforge.sources import files
from mentionforge.streaming import documents


def test_code_stream(spark):
    lines = ["before", "A00 Bệnh tả", "more", "A00", "E14† one", "E14 two", "A00.12345 t", "  ", "B99.1\tx"]
    d = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "doc int, line_no int, text string")
    got = {r.code: r.description for r in code_tables.code_entries(d, ["doc"]).collect()}
    assert got == {"A00": "Bệnh tả more A00", "E14": "one two A00.12345 t", "B99.1": "x"}


def test_column_split(spark):
    pages = {1: [5, 15, 15, 105, 115], 2: [5], 3: [5, 15, 25], 4: [5, 45, 95]}
    d = spark.createDataFrame([(p, float(x), 100.0 if p == 4 else 200.0) for p, xs in pages.items() for x in xs], "page int, x0 double, page_width double")
    assert {r.page: r.split_x for r in code_tables.column_split(d).collect()} == {1: 100.0, 2: 100.0, 3: 100.0, 4: 40.0}


def test_hierarchy_and_records(spark):
    ranges = code_tables.hierarchy(spark, [("I", "A00-A09"), ("XX", "V01-X59"), ("I", "B99")])
    assert {(r.letter, r.low, r.high) for r in ranges.collect()} == {("A", 0, 9), ("V", 1, 99), ("W", 0, 99), ("X", 0, 59), ("B", 99, 99)}
    joined = spark.createDataFrame([("A00", "Cholera", "Bệnh tả Loại trừ: x"), ("A10", "Other", None), ("W50.1", None, "ngư c"), ("bad", "x", "Excl. y")], "code string, name_en string, name_vi string")
    got = {r.code: r for r in code_tables.code_records(joined, ranges).collect()}
    assert (got["A00"].text, got["A00"].note_vi, got["A00"].block, got["A00"].vi_glyph_ok) == ("Bệnh tả", "Loại trừ: x", "A00-A09", True)
    assert (got["A10"].text, got["A10"].chapter, got["A10"].vi_glyph_ok) == ("Other", None, False)
    assert (got["W50.1"].chapter, got["W50.1"].vi_glyph_ok) == ("XX", False)
    assert (got["bad"].text, got["bad"].block) == ("x", None)
    assert code_tables.table_quality(code_tables.code_records(joined, ranges)).first().n_english == 2


def test_drug_exports(spark):
    conso = spark.createDataFrame([
        ("1", "a1", "para", "RXNORM", "IN", "N"), ("1", "a2", "Para", "RXNORM", "SY", "N"), ("1", "a3", "para", "RXNORM", "TMSY", "N"), ("1", "a4", "other", "X", "SY", "N"),
        ("2", "b1", "Brand", "RXNORM", "BN", "O"), ("3", "b2", "Alone", "RXNORM", "SBD", "N"), ("4", "c1", "old", "RXNORM", "IN", "O"), ("5", "m1", "mix", "RXNORM", "MIN", "N"),
    ], "rxcui string, rxaui string, str string, sab string, tty string, suppress string")
    rel = spark.createDataFrame([("2", "1", "RXNORM", "x"), ("2", "1", "RXNORM", "y"), ("2", "5", "RXNORM", "x"), ("3", "4", "RXNORM", "x"), ("2", "4", "O", "x")], "rxcui1 string, rxcui2 string, sab string, rela string")
    assert [(r.doc_id, r.synonyms) for r in drug_tables.candidates(conso).collect()] == [("c_1", ["Para"])]
    assert [(r.doc_id, r.resolve_in, r.resolve_min) for r in drug_tables.aliases(conso, rel).collect()] == [("b_b1", ["1"], ["5"])]
    assert drug_tables.trace(conso, rel, conso.filter("rxaui = 'b1'").select("rxaui")).count() == 3
    docs = files.drug_documents(drug_tables.candidates(conso), drug_tables.aliases(conso, rel))
    assert {(r.doc_id, r.role, r.kb) for r in docs.collect()} == {("c_1", "candidate", "rxnorm"), ("b_b1", "alias", "rxnorm")}


def test_index_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "")], "doc_id int, text string")
    lexical.save_index(lexical.build_index(docs), str(tmp_path / "i"))
    index = lexical.open_index(spark, str(tmp_path / "i"))
    q = spark.createDataFrame([(9, "A a z")], "query_id int, text string")
    assert [(r.doc_id, r.bm25_rank) for r in lexical.search(index, q, k=0).collect()] == [(1, 1)]
    more = lexical.extended(index, spark.createDataFrame([(4, "c d"), (5, "a a")], "doc_id int, text string"))
    whole = lexical.build_index(spark.createDataFrame([(1, "a b"), (2, "b c"), (3, ""), (4, "c d"), (5, "a a")], "doc_id int, text string"))
    assert (more.n_docs, more.length) == (whole.n_docs, whole.length) == (5, 8) and sorted(more.frequencies.collect()) == sorted(whole.frequencies.collect())
    q = spark.createDataFrame([(9, "a c c"), (8, "d")], "query_id int, text string")
    assert sorted(lexical.search(more, q).collect()) == sorted(lexical.search(whole, q).collect()) == sorted(lexical.search_texts(spark.createDataFrame([(1, "a b"), (2, "b c"), (3, ""), (4, "c d"), (5, "a a")], "doc_id int, text string"), q).collect())
    lexical.save_index(lexical.build_index(docs.limit(0)), str(tmp_path / "e"))
    with pytest.raises(ValueError):
        lexical.open_index(spark, str(tmp_path / "e"))
    vectors = dense.unit_vectors(spark.createDataFrame([(1, [3.0, 4.0]), (2, [1.0, 0.0])], "vec_id int, embedding array<double>"), "embedding")
    dense.save_index(dense.check_unit(vectors, "embedding"), str(tmp_path / "v"))
    with pytest.raises(Exception, match="unit length"):
        dense.check_unit(spark.createDataFrame([(1, [3.0, 4.0])], "vec_id int, embedding array<double>"), "embedding").collect()
    hits = dense.search(dense.open_index(spark, str(tmp_path / "v")), vectors.withColumnRenamed("vec_id", "query_id"), k=1, block=1)
    assert {(r.query_id, r.doc_id) for r in hits.collect()} == {(1, 1), (2, 2)}


def test_thresholds_and_expansion(spark):
    d = spark.createDataFrame([("q", 1, 3.0, "alias", None, ["723"], ["m"]), ("q", 2, 2.5, "candidate", "17230", None, None), ("q", 3, 1.0, None, "9", None, None), ("r", 4, 0.5, "candidate", "8", None, None)],
                              "query_id string, doc_id int, rerank_score double, role string, code string, resolve_in array<string>, resolve_min array<string>")
    kept = linking.apply_thresholds(d, 0.9, 0.6, ["query_id"])
    assert {r.doc_id for r in kept.collect()} == {1, 2}
    codes = linking.expand_codes(kept.withColumn("codes", linking.codes_of(F.col("role"), F.col("code"), F.col("resolve_in"))), d, ["query_id"])
    assert {r.query_id: r.codes for r in codes.collect()} == {"q": ["17230", "723"], "r": []}


def test_pipeline(spark):
    docs = spark.createDataFrame([(1, "Bệnh nhân viêm phổi nặng, dùng paracetamol 500mg."), (2, "fail"), (3, "")], "doc_id int, text string")
    lexicon = dictionary.extractor({"viêm phổi": "CHẨN_ĐOÁN", "paracetamol 500mg": "THUỐC", "Bệnh nhân": "TRIỆU_CHỨNG"})

    def extract(text):
        if text == "fail":
            raise RuntimeError("down")
        return lexicon(text)

    icd = spark.createDataFrame([("icd_J18", "viêm phổi", "candidate", "J18", None)], "doc_id string, text string, role string, code string, resolve_in array<string>")
    rx = spark.createDataFrame([("c_161", "paracetamol", "candidate", "161", None), ("b_1", "panadol", "alias", None, ["161"])], icd.schema)
    indexes = {kb: {"docs": d, "lexical": lexical.build_index(d), "dense": d.select("doc_id", models.hashed_embedding(F.col("text")).alias("embedding")), "embed": models.hashed_embedding} for kb, d in (("icd", icd), ("rxnorm", rx))}
    decisions = {"icd": {"floor": 0.1, "margin": 0.2, "variant": "raw"}, "rxnorm": {"floor": 0.1, "margin": 0.0, "variant": "strip_dose"}}
    spans = models.extract_entities(docs, extract)
    from mentionforge.operators.spans import align

    aligned = align(spans.filter("result.ok").select("doc_id", "text", F.col("result.entities").alias("entities"))).withColumn("mention_id", F.concat_ws(":", F.col("doc_id").cast("string"), F.col("ord").cast("string")))
    got = {r.text: r for r in pipeline.shape_records(linking.link(aligned, indexes, models.blended_scorer, decisions)).collect()}
    assert got["viêm phổi"].candidates == ["J18"] and got["paracetamol 500mg"].candidates == ["161"]
    assert got["Bệnh nhân"].candidates is None and got["Bệnh nhân"].assertions == []
    records, errors = pipeline.run(docs, extract, indexes, models.blended_scorer)
    assert [(r.doc_id, r.error) for r in errors.collect()] == [(2, "RuntimeError: down")]
    assert {r.doc_id: r.json.count('"text"') for r in pipeline.per_document(records, docs.filter("doc_id <> 2")).collect()} == {1: 3, 3: 0}


def test_entity_rules():
    with pytest.raises(ValueError):
        models.checked_entities([{"text": "a", "type": "X"}])
    with pytest.raises(ValueError):
        models.checked_entities([{"text": "a", "type": "THUỐC"}] * 101)
    with pytest.raises(ValueError):
        models.build_prompt(" ", "a")


def test_files(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for name in ("10", "2", "b"):
        (tmp_path / "t" / f"{name}.txt").write_text(f"text\nof {name}")
    assert [(r.doc_id, r.text) for r in files.read_texts(spark, str(tmp_path / "t")).collect()] == [("b", "text\nof b"), ("2", "text\nof 2"), ("10", "text\nof 10")]
    (tmp_path / "l.jsonl").write_text('{"mention": "a", "kb": "icd"}\n\n{"mention": "b"}\n')
    assert [(r.line_no, r.value[:13]) for r in files.numbered_lines(spark, str(tmp_path / "l.jsonl")).orderBy("line_no").collect()] == [(1, '{"mention": "'), (2, '{"mention": "')]
    assert files.numbered_lines(spark, str(tmp_path / "l.jsonl"), blank_too=True).count() == 3
    assert files.read_json_lines(spark, str(tmp_path / "l.jsonl"), files.EVAL_SCHEMA).count() == 2
    d = spark.createDataFrame([("1", "[]")], "doc_id string, json string")
    files.write_per_document(d, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 1
    bad = spark.createDataFrame([("a", None), (None, "t"), ("", "t"), ("a", "x")], "doc_id string, text string")
    assert files.code_documents(bad.selectExpr("doc_id", "text", "'c' AS code", "'' AS kb", "CAST(NULL AS string) AS role")).select("kb", "role").collect()[0] == ("icd", "candidate")


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"doc_id": "1", "text": "x y"}\n{"doc_id": "2", "text": "z"}\n')
    run = lambda: documents.process_stream(documents.read_stream(spark, str(tmp_path / "in")), lambda d: d.withColumn("n", F.length("text")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    run()
    run()
    assert {(r.doc_id, r.n) for r in spark.read.json(str(tmp_path / "out")).collect()} == {("1", 3), ("2", 1)}


def test_row_operators(spark):
    d = spark.createDataFrame([("m", None, 3), ("m", None, 1), ("n", "k", 2)], "mention string, kb string, line_no int")
    assert {r.line_no for r in rows.keep_first(d, ["mention", "kb"], ["line_no"]).collect()} == {1, 2}
    assert {(r.line_no, r.first_line) for r in rows.with_first_line(d, ["mention", "kb"]).collect()} == {(3, 1), (1, 1), (2, 2)}
    h = rows.histogram(spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 0.0), ("b", 10.0), ("b", None)], "k string, v double"), "v", ["k"], 50)
    assert {(r.k, r.bin, r.cnt) for r in h.collect()} == {("a", 26, 2), ("b", 1, 1), ("b", 50, 1)}
    assert rows.without_empty(spark.createDataFrame([("", 0)], "a string, b int"), ["a"]).first().a is None


def test_models_are_loaded_once_and_keep_order(spark):
    d = spark.createDataFrame([(i, f"a b{i % 3}", f"b{i % 2} a c") for i in range(25)], "i int, query string, text string").coalesce(1)
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)
        return models.shared_words_scorer

    got = models.reranked(d, "counted", load, "find", batch=4).collect()
    assert [r.rerank_score for r in got] == models.shared_words_scorer("", [(r.query, r.text) for r in got]) and loads.value == 1
    with pytest.raises(Exception, match="scores for"):
        models.reranked(d, "short", lambda: lambda i, pairs: [0.0], "find").collect()
    embed = models.prompted_embedding("hashed", models.hashed_encoder, batch=3)
    v = d.select(embed(F.col("text"), "query: ").alias("v")).collect()
    assert all(abs(sum(x * x for x in r.v) - 1) < 1e-5 for r in v)
    dense.check_asymmetric(spark, embed, ("query: ", "document: "), ["đau bụng"])
    with pytest.raises(ValueError, match="prompts"):
        dense.check_asymmetric(spark, embed, ("same ", "same "), ["đau bụng"])
    out = models.extract_entities(d.limit(2), load=("lexicon", lambda: dictionary.extractor({"a": "THUỐC"}))).collect()
    assert all(r.result.ok and r.result.entities[0].text == "a" for r in out)


def test_prompt_schema_and_preflight():
    schema = models.answer_schema()["properties"]["entities"]
    assert schema["maxItems"] == 100 and schema["items"]["properties"]["type"]["enum"] == models.ENTITY_TYPES
    assert models.build_prompt(models.INSTRUCTIONS, " x ")[1]["content"] == " x "
    models.preflight(lambda t: [])
    with pytest.raises(ZeroDivisionError):
        models.preflight(lambda t: 1 / 0)


def test_small_sources(spark, tmp_path):
    import json

    from mentionforge.operators import gates, rows

    d = spark.createDataFrame([("a", '[{"text":"đau"}]'), ("b 2", "[]")], "doc_id string, json string")
    files.write_json_files(d, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.json", "b 2.json"]
    text = (tmp_path / "out" / "a.json").read_text()
    assert json.loads(text) == [{"text": "đau"}] and text.startswith("[\n  {") and "đau" in text
    url = "jdbc:derby:memory:t;create=true"
    d.withColumnRenamed("json", "x").write.format("jdbc").options(url=url, dbtable="t", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").mode("overwrite").save()
    assert {r[0] for r in files.read_table(spark, url, "t", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").collect()} == {"a", "b 2"}
    assert [r.n for r in rows.first_rows(spark.createDataFrame([(i,) for i in (3, 1, 2)], "n int"), 2, ["n"]).collect()] == [1, 2]
    valid = gates.valid_codes(spark.createDataFrame([("A00",), (None,), ("",)], "code string"), spark.createDataFrame([("1",)], "code string"), spark.createDataFrame([(["1", "2"],), ([],)], "resolve_in array<string>"))
    assert {tuple(r) for r in valid.collect()} == {("icd", "A00"), ("rxnorm", "1"), ("rxnorm", "2")}
    records = spark.createDataFrame([("2", "b", "t2", "c"), ("1", "b", "t1", "c"), ("3", "", "t", "c"), ("4", "d", None, "c")], "line_no string, doc_id string, text string, code string").withColumns({"kb": F.lit(None).cast("string"), "role": F.lit("")})
    assert [(r.text, r.kb, r.role) for r in files.code_documents(records).collect()] == [("t1", "icd", "candidate")]
    assert files.document_counts(records).first().asDict() == {"n_read": 4, "n_incomplete": 2, "n_repeated": 1, "n_kept": 1}
    assert files.document_counts(records.limit(0)).first().n_kept == 0
