"""Alignment and gates, case by case."""

import hashlib
import random
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mentionforge.functions.text import fold_text
from mentionforge.operators import calibration, gates, measures, rows
from mentionforge.operators.spans import FoldedText, align, align_one, cut_severity

ALPHABET = st.text(st.sampled_from("aAßu \n\t.ấû́ệ각ᄀ"), max_size=30)


@given(ALPHABET)
@settings(max_examples=300, deadline=None)
def test_folding_by_clusters(raw):
    f = FoldedText(raw)
    assert f.folded == fold_text(raw)
    assert len(f.origin) == len(f.folded) and f.origin == sorted(f.origin)


@given(ALPHABET, st.lists(st.text(st.sampled_from("aAu ấ.̂"), min_size=1, max_size=4), max_size=4))
@settings(max_examples=200, deadline=None)
def test_spans_lie_in_the_text(raw, needles):
    for s in align_one(raw, [{"text": n, "type": "T"} for n in needles]):
        assert 0 <= s["span_start"] < s["span_end"] <= len(raw) and raw[s["span_start"] : s["span_end"]] == s["text"]


def spans_of(raw, *needles):
    return [(s["text"], s["span_start"]) for s in align_one(raw, [{"text": n, "type": "T"} for n in needles])]


def test_alignment():
    assert spans_of("ho sốt ho", "ho", "ho") == [("ho", 0), ("ho", 7)]
    assert spans_of("ho sốt ho", "sốt", "ho", "ho") == [("sốt", 3), ("ho", 7), ("ho", 0)]
    assert spans_of("Đau BỤNG", "đau bụng", "không có") == [("Đau BỤNG", 0)]
    nfd = unicodedata.normalize("NFD", "bị ấm ớ")
    assert spans_of(nfd, "ấm") == [(unicodedata.normalize("NFD", "ấm"), nfd.index("a"))]
    assert spans_of("đau\n  bụng", "đau bụng") == [("đau\n  bụng", 0)]
    assert spans_of("a b a", "a", "A", "a") == [("a", 0), ("a", 4)]


@pytest.mark.parametrize(("text", "want"), [("đau bụng dữ dội", "đau bụng"), ("đau nhẹ", "đau nhẹ"), ("nhịp tim chậm", "nhịp tim chậm"), ("bệnh chuỗi nhẹ", "bệnh chuỗi nhẹ"), ("đau bụng dữ dội liên tục", "đau bụng dữ dội")])
def test_severity(text, want):
    assert text[: cut_severity(text, 0, len(text))] == want


def test_align_frame(spark):
    d = spark.createDataFrame([(1, "sốt siêu vi và ***, buồn nôn thoáng qua, buồn nôn", [("sốt", "A", []), ("sốt siêu vi", "A", ["isNegated"]), ("***", "A", []), ("buồn nôn thoáng qua", "A", []), ("siêu", "B", [])]), (2, None, None)],
                              "doc_id int, text string, entities array<struct<text:string,type:string,assertions:array<string>>>")
    got = {(r.text, r.type, r.span_start) for r in align(d).collect()}
    assert got == {("sốt siêu vi", "A", 0), ("buồn nôn", "A", 20), ("siêu", "B", 4)}


@given(st.lists(st.tuples(st.integers(0, 8), st.integers(1, 8)), min_size=1, max_size=14))
@settings(max_examples=8, deadline=None)
def test_nesting(spark, pairs):
    spans = [(i, s, s + n) for i, (s, n) in enumerate(pairs)]
    d = spark.createDataFrame([("k", *x) for x in spans], "k string, i int, span_start int, span_end int")
    want = {i for i, s, e in spans if not any(a <= s and e <= b and b - a > e - s for _, a, b in spans)}
    assert {r.i for r in rows.drop_nested(d, ["k"]).collect()} == want


def eval_rows(spark, data):
    return spark.createDataFrame(data, "line_no int, mention string, kb string, gold array<string>, noise string, gold_kind string, cluster_name string, distractor array<string>")


def rules(d):
    return {(r.row_id, r.rule) for r in d.collect()}


def test_row_gates(spark):
    d = eval_rows(spark, [
        (1, "a", "icd", ["A00"], "mild", "single", None, None), (2, "a", "icd", [], "mild", "single", "c", ["x"]), (3, "b", "zzz", ["A00", "A00"], "mild", "multi_sibling", "c", None),
        (4, "c", "icd", ["A00", "A01"], "mild", "single", None, ["A01", "B00", "B00"]), (5, "a", "icd", None, "mild", "single", None, None),
    ])
    assert rules(gates.check_rows(d)) == {
        (2, "no gold"), (3, "gold repeats"), (3, "unknown kb"), (3, "wrong gold_kind"), (3, "cluster without distractor"), (4, "distractor is gold"), (4, "distractor repeats"), (4, "wrong gold_kind"), (4, "distractor without cluster"), (5, "no gold"),
    }
    assert rules(gates.check_duplicates(d)) == {(2, "duplicate of an earlier row"), (5, "duplicate of an earlier row")}
    assert rules(gates.check_cluster_shape(d)) == {(3, "cluster without distractor"), (4, "distractor without cluster")}
    gates.enforce(gates.check_rows(d.filter("line_no = 1")), strict=True)
    with pytest.raises(ValueError):
        gates.enforce(gates.check_rows(d))


def test_field_gate(spark):
    d = spark.createDataFrame([(1, '{"mention":"a","kb":"icd","gold":["x"],"noise":"m","gold_kind":"single"}'), (2, '{"mention":"a","kb":"q","gold":"x","golds":[]}'), (3, "no")], "line_no int, value string")
    assert rules(gates.check_fields(d)) == {(2, "missing fields"), (2, "unknown fields"), (2, "unknown kb"), (2, "gold is no list"), (3, "no JSON object"), (3, "missing fields"), (3, "unknown kb"), (3, "no gold")}


def test_cluster_gates(spark):
    blocks = spark.createDataFrame([("A00", "b1"), ("A01", "b1"), ("B00", "b2"), ("Z", None)], "code string, block string")
    groups = spark.createDataFrame([(1, ["1", "2"]), (2, ["3"])], "group_id int, codes array<string>")
    d = eval_rows(spark, [
        (1, "a", "icd", ["A00"], "m", "single", "c", ["A01"]), (2, "b", "icd", ["A01"], "m", "single", "c", ["B00"]), (3, "c", "rxnorm", ["1"], "m", "single", "r", ["2", "3"]),
        (4, "d", "icd", ["A00", "B00"], "m", "multi_sibling", None, None), (5, "e", "rxnorm", ["1", "3"], "m", "multi_solving", None, None), (6, "f", "icd", ["A00", "Z"], "m", "multi_sibling", None, None),
        (7, "g", "rxnorm", ["1", "2"], "m", "multi_solving", None, None),
    ])
    assert rules(gates.check_clusters(d, blocks, groups)) == {(2, "distractor is not near"), (1, "cluster spans blocks"), (3, "cluster of one row"), (3, "distractor is not near")}
    assert rules(gates.check_kinds(d, blocks, groups)) == {(4, "gold spans blocks"), (5, "gold is of no one group"), (6, "gold spans blocks")}


def test_output_gate(spark):
    docs = spark.createDataFrame([("1", "đau  bụng"), ("2", "x"), ("3", "y")], "doc_id string, text string")
    good = '[{"type":"TRIỆU_CHỨNG","text":"đau bụng","position":[0,9],"assertions":[]}]'
    out = spark.createDataFrame([("1", good), ("2", "no json"), ("4", "[]")], "doc_id string, json string")
    assert rules(gates.check_outputs(docs, out)) == {("2", "no list"), ("3", "no output"), ("4", "output without document")}
    assert ("1[0]", "text is not at its position") in rules(gates.check_outputs(docs, out, strict=True))


def test_sweep(spark):
    candidates = lambda *xs: [{"doc_id": str(i), "role": "candidate", "codes": c, "dense_score": s, "bm25_score": None, "rerank_score": s} for i, (c, s) in enumerate(xs)]
    data = [(i, "icd", [str(i)], "single", None, [], candidates(([str(i)], 5.0 + i % 3), (["z"], 1.0))) for i in range(12)]
    dump = spark.createDataFrame(data, "record_id int, kb string, gold array<string>, gold_kind string, cluster_name string, distractor array<string>, candidates array<struct<doc_id:string,role:string,codes:array<string>,dense_score:double,bm25_score:double,rerank_score:double>>")
    is_dev = dump.select("record_id", (F.col("record_id") % 4 == 0).alias("is_dev"))
    out = calibration.sweep(dump, is_dev, steps=5, resamples=4)
    assert out["sweep_score"] == out["dev_score"] == 1.0 and out["margin"] == 0.0 and not out["warn"] and (out["n_dev"], out["n_sweep"]) == (3, 9)
    with pytest.raises(ValueError):
        calibration.score_axes(dump, 1)
    assert measures.candidates_score(dump.limit(0).withColumn("predicted", F.col("gold"))).first().score == 0.0


def test_sweep_all_and_report(spark, tmp_path):
    import json

    hit = "struct<doc_id:string,role:string,codes:array<string>,dense_score:double,bm25_score:double,rerank_score:double>"
    hits = lambda i: [("d", "candidate", [str(i)], 1.0, None, 4.0 + i % 3), ("e", "alias", ["z", "y"], None, 2.0, 3.5)]
    data = [(i, i, f"m{i}", "icd" if i % 2 else "rxnorm", [str(i), "y"] if i % 5 == 0 else [str(i)], "mild", "c" if i % 4 == 0 else None, ["z"] if i % 4 == 0 else None, hits(i)) for i in range(24)]
    d = spark.createDataFrame(data, f"record_id int, row_no int, mention string, kb string, gold array<string>, noise string, cluster_name string, distractor array<string>, candidates array<{hit}>")
    d = measures.with_gold_kind(d)
    assert {r.gold_kind for r in d.collect()} == {"single", "multi_sibling", "multi_solving"}
    thresholds, sides = calibration.sweep_all(d, "raw", "none", "2000-01-01", steps=4, resamples=3)
    assert set(thresholds) == {"icd", "rxnorm", "metadata"} and len(sides["sweep"]) + len(sides["dev"]) == 24
    calibration.save_json(thresholds, str(tmp_path / "o" / "t.json"))
    assert json.loads((tmp_path / "o" / "t.json").read_text())["metadata"]["grid_steps"] == 4
    tables = measures.report({"raw": d, "strip_dose": None})
    assert set(tables) == {"raw"} and all(t.count() >= 1 for t in tables["raw"].values())
    with pytest.raises(Exception, match="no kind"):
        measures.with_gold_kind(d.withColumn("kb", F.lit("q"))).collect()


def test_split_keeps_clusters_whole(spark):
    data = [(i, f"m{i}", "icd", "mild" if i % 3 else "heavy", "single", f"c{i % 7}" if i % 2 else None) for i in range(60)]
    d = spark.createDataFrame(data, "row_no int, mention string, kb string, noise string, gold_kind string, cluster_name string")
    got = calibration.split(d).collect()
    assert len(got) == 60 and all(len({r.is_dev for r in got if r.unit == u}) == 1 for u in {r.unit for r in got})
    assert 10 <= sum(r.is_dev for r in got) <= 24


def test_best_cells_are_brute_force(spark, monkeypatch):
    candidates = lambda i: [{"doc_id": str(x), "role": "candidate", "codes": [str(x % 4)], "dense_score": 0.0, "bm25_score": None, "rerank_score": float((i * 7 + x * 3) % 11)} for x in range(i % 5)]
    data = [(i, "icd" if i % 2 else "rxnorm", [str(i % 3)], candidates(i)) for i in range(90)]
    dump = spark.createDataFrame(data, "record_id long, kb string, gold array<string>, candidates array<struct<doc_id:string,role:string,codes:array<string>,dense_score:double,bm25_score:double,rerank_score:double>>")
    monkeypatch.setattr(calibration, "BUCKET_RECORDS", 20)
    monkeypatch.setattr(calibration, "ROWS_AT_ONCE", 7)
    axes = calibration.score_axes(dump, 5)
    points = sorted((r.floor, r.margin) for r in axes.collect())
    floors, margins = [f for f, _ in points], [m for _, m in points]
    bucket = {r.record_id: r.b for r in dump.select("record_id", F.pmod(F.xxhash64(F.lit(5), "record_id"), F.lit(4)).cast("int").alias("b")).collect()}

    def similarity(gold, found, floor, margin):
        top = max((c["rerank_score"] for c in found), default=0)
        codes = {x for c in found if c["rerank_score"] >= max(floor, top - margin) for x in c["codes"]}
        return len(codes & set(gold)) / len(codes | set(gold))

    def best(kb, times):
        sums = {}
        for i, of, gold, found in data:
            for f in floors if of == kb else []:
                for m in margins:
                    x = sums.setdefault((f, m), [0, 0])
                    x[0] += times[i] * 2 * similarity(gold, found, f, m)
                    x[1] += times[i] * 2
        score, margin, floor = max((round(x / w, 12), -m, f) for (f, m), (x, w) in sums.items())
        return pytest.approx((floor, -margin, score))

    assert {r.kb: (r.floor, r.margin, r.score) for r in calibration.best_cells(dump, axes).collect()} == {kb: best(kb, dict.fromkeys(range(90), 1)) for kb in ("icd", "rxnorm")}
    got = {(r.kb, r.sample): (r.floor, r.margin, r.score) for r in calibration.best_cells(dump, axes, 6, 5).collect()}
    assert len(got) == 12
    for i, kb in enumerate(("icd", "rxnorm")):
        of = [[r for r in range(90) if r % 2 == (kb == "icd") and bucket[r] == b] for b in range(4)]
        before = np.cumsum([0, *map(len, of)])
        times = np.zeros((6, 90), int)
        for b, ids in enumerate(of):
            if ids:
                times[:, ids] = calibration.drawn_times(calibration.bucket_share(45, before, b, 6, [5, i]), len(ids), 5 + i, b)
        assert (times.sum(1) == 45).all() and times.max() > 1 and len({tuple(t) for t in times}) == 6
        assert all(got[kb, b] == best(kb, times[b]) for b in range(6))
    given = lambda ids: np.stack([ids.to_numpy() % 3, ids.to_numpy() % 2 + 1])
    got = {(r.kb, r.sample): (r.floor, r.margin, r.score) for r in calibration.best_cells(dump, axes, times=given).collect()}
    assert got == {(kb, s): best(kb, {i: (i % 3, i % 2 + 1)[s] for i in range(90)}) for kb in ("icd", "rxnorm") for s in (0, 1)}


def test_shares_of_buckets_are_a_multinomial():
    before = np.cumsum([0, 5, 0, 15, 20, 1, 59])
    shares = np.array([calibration.bucket_share(100, before, b, 4000, [3]) for b in range(6)])
    assert (shares.sum(0) == 100).all() and (shares[1] == 0).all()
    p = np.diff(before) / 100
    assert np.allclose(shares.mean(1), 100 * p, atol=0.5) and np.allclose(shares.var(1), 100 * p * (1 - p), rtol=0.15, atol=0.1)
    assert np.corrcoef(shares[3], shares[5])[0, 1] == pytest.approx(-np.sqrt(p[3] * p[5] / ((1 - p[3]) * (1 - p[5]))), abs=0.05)


def test_repeated_rows_count_once_in_a_sweep(spark):
    pick = lambda i: [{"doc_id": "a", "role": "candidate", "codes": [str(i % 3)], "dense_score": 0.0, "bm25_score": 0.0, "rerank_score": float(i % 4)}]
    data = [(i % 20, i, f"m{i % 20}", "icd", "mild", "single", None, [str(i % 20 % 3)], [], pick(i % 20)) for i in range(24)]
    d = spark.createDataFrame(data, "record_id long, row_no int, mention string, kb string, noise string, gold_kind string, cluster_name string, gold array<string>, distractor array<string>, candidates array<struct<doc_id:string,role:string,codes:array<string>,dense_score:double,bm25_score:double,rerank_score:double>>")
    thresholds, sides = calibration.sweep_all(d, "raw", "x", "2000-01-01", 4, 3)
    assert thresholds["icd"]["n_sweep"] + thresholds["icd"]["n_dev"] == 20 and thresholds["metadata"]["repeats_removed"] == 4
    assert len(sides["sweep"]) + len(sides["dev"]) == 20 and sides["deduped"]
    again, _ = calibration.sweep_all(d.filter("row_no < 20"), "raw", "x", "2000-01-01", 4, 3)
    assert again["icd"] == thresholds["icd"]


def test_grid_and_bootstrap_are_whole(spark, monkeypatch):
    from mentionforge.plans import catalogue

    asked = []
    best = calibration.best_cells
    monkeypatch.setattr(calibration, "best_cells", lambda d, axes, n=None: asked.append((axes.count(), n)) or best(d, axes, n))
    assert catalogue.QUERIES["grid_best"](spark, "/root/testdata/sf0.001").count() == 2
    assert catalogue.QUERIES["bootstrap"](spark, "/root/testdata/sf0.001").count() == 600
    assert asked == [(41, None), (41, 300)]


def brute_five(values):
    v = sorted(x for x in values if x is not None)
    n = len(v)
    if not n:
        return (0, None, None, None, None, None)
    at = lambda p: v[min(n - 1, int(p * n))]
    return (n, v[0], at(0.25), (v[(n - 1) // 2] + v[n // 2]) / 2, at(0.75), v[-1])


def test_order_statistics_without_lists(spark, monkeypatch):
    from mentionforge.operators import ranks

    rng = random.Random(0)
    data = [(k, None if k == "c" or rng.random() < 0.1 else float(rng.randrange(-9, 9)) if k == "a" else rng.random()) for k in ("a", "b", "c", None) for _ in range(1001)]
    data += [(f"n{n}", rng.random()) for n in range(1, 30) for _ in range(n)]
    d = spark.createDataFrame(data, "k string, v double")
    want = {k: brute_five([v for kk, v in data if kk == k]) for k in {k for k, _ in data}}
    for accuracy in (10_000, 50):  # the second: sketches that are wrong by some ranks
        monkeypatch.setattr(ranks, "ACCURACY", accuracy)
        found = ranks.five_numbers(d, ["k"], "v")
        assert {r.k: tuple(r)[1:] for r in found.collect()} == want
    assert "collect_list" not in found._jdf.queryExecution().toString()
    rows = [(i, f"m{i}", "icd", "mild", "single", None) for i in range(300)]
    split = calibration.split(spark.createDataFrame(rows, "row_no int, mention string, kb string, noise string, gold_kind string, cluster_name string"))
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and all("__bucket" in line for line in plan.splitlines() if "Window" in line and "md5" in line)
    order = sorted((r.unit for r in split.collect()), key=lambda u: (hashlib.md5(f"20260728|{u}".encode()).hexdigest(), u))
    assert {r.unit for r in split.collect() if r.is_dev} == set(order[:75])
