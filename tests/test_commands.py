"""The jobs, one after the other, on a few lines."""

import http.server
import json
import threading

import pytest

from mentionforge import commands


def lines(path, rows):
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows))
    return str(path)


@pytest.fixture
def endpoint():
    """An extractor's server that finds one mention in every text, and how often it was asked."""
    asked = []

    class Answer(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            request = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            assert request["response_format"]["type"] == "json_schema"
            asked.append(request["messages"][-1]["content"])
            content = json.dumps({"entities": [{"text": "viêm phổi", "type": "CHẨN_ĐOÁN", "assertions": []}]})
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": content}}]}).encode())

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked
    server.shutdown()


def test_jobs(spark, tmp_path, capsys, endpoint):
    url, asked = endpoint
    docs = lines(tmp_path / "docs.jsonl", [{"doc_id": "icd_J18", "text": "viêm phổi", "code": "J18"}, {"doc_id": "icd_A00", "text": "bệnh tả", "code": "A00"}, {"doc_id": "icd_A00", "text": "bệnh tả", "code": "A00"}, {"doc_id": ""}])
    row = {"kb": "icd", "noise": "mild", "gold_kind": "single"}
    rows = lines(tmp_path / "rows.jsonl", [{"mention": "viêm phổi nặng", "gold": ["J18"], **row}, {"mention": "bệnh tả", "gold": ["A00"], **row}, *({"mention": f"bệnh {i}", "gold": ["A00"], **row} for i in range(8))])
    index, dump, out = (str(tmp_path / x) for x in ("index", "dump", "out"))
    models = ["--embedder", "mentionforge.operators.models:hashed_encoder"]
    assert commands.main(["build", docs, index, *models], spark) == 0 and "n_read=4 n_incomplete=1 n_repeated=1 n_kept=2" in capsys.readouterr().out
    assert commands.main(["validate", rows], spark) == 0
    bad = lines(tmp_path / "bad.jsonl", [{"mention": "a", "kb": "x", "gold": []}])
    assert commands.main(["validate", bad], spark) == 1
    models += ["--scorer", "tests.test_commands:load_scorer"]
    assert commands.main(["dump", rows, docs, index, dump, *models], spark) == 0
    dumped = spark.read.parquet(dump)
    assert dumped.count() == 10 and dumped.selectExpr("explode(candidates) AS c").filter("c.dense_score IS NOT NULL AND c.rerank_score <= 1").count() == 20
    assert commands.main(["report", dump, f"{out}/tables"], spark) == 0 and spark.read.json(f"{out}/tables/recall").count() >= 3
    assert commands.main(["sweep", dump, out, "--date", "2000-01-01", "--steps", "3", "--resamples", "2"], spark) == 0
    assert json.loads((tmp_path / "out" / "thresholds.json").read_text())["metadata"]["bootstrap_resamples"] == 2

    (tmp_path / "texts").mkdir()
    for name in "789":
        (tmp_path / "texts" / f"{name}.txt").write_text(f"Bệnh nhân {name} bị viêm phổi.")
    predict = ["predict", str(tmp_path / "texts"), str(tmp_path / "records"), "--kb", f"icd={docs},{index}", "--url", url, "--model", "m"]
    assert commands.main(predict, spark) == 1  # thresholds of nothing
    predict += [*models, "--thresholds", f"{out}/thresholds.json"]
    assert commands.main([*predict, "--limit", "1"], spark) == 0
    assert [p.name for p in (tmp_path / "records").iterdir()] == ["7.json"]
    found = json.loads((tmp_path / "records" / "7.json").read_text())
    assert [(r["text"], r["position"], r["candidates"]) for r in found] == [("viêm phổi", [15, 24], ["J18"])]
    asked.clear()
    assert commands.main(predict, spark) == 0 and len(list((tmp_path / "records").iterdir())) == 3
    assert sorted(t for t in asked if "Bệnh" in t) == [f"Bệnh nhân {n} bị viêm phổi." for n in "89"]  # what is there stays; each is asked once
    asked.clear()
    assert commands.main([*predict, "--overwrite"], spark) == 0 and len({t for t in asked if "Bệnh" in t}) == 3


def load_scorer():
    from mentionforge.operators.models import shared_words_scorer

    return shared_words_scorer


def test_validation_with_knowledge_bases(spark, tmp_path, capsys):
    icd = lines(tmp_path / "icd.jsonl", [{"doc_id": f"icd_{c}", "code": c, "block": b, "text": c} for c, b in (("A00", "A00-A09"), ("A01", "A00-A09"), ("J18", "J10-J18"))])
    rxnorm = lines(tmp_path / "rx.jsonl", [{"doc_id": "c_1", "code": "1", "text": "a"}, {"doc_id": "c_2", "code": "2", "text": "b"}, {"doc_id": "b_9", "role": "alias", "resolve_in": ["1", "3"], "text": "c"}])
    row = lambda kb, kind, *gold, **more: {"mention": f"{kb} {gold}", "kb": kb, "gold": list(gold), "noise": "mild", "gold_kind": kind, **more}
    good = lines(tmp_path / "good.jsonl", [row("icd", "multi_sibling", "A00", "A01"), row("rxnorm", "multi_solving", "1", "3"), row("icd", "single", "J18")])
    where = ["--icd", icd, "--rxnorm", rxnorm]
    assert commands.main(["validate", good, *where], spark) == 0
    bad = lines(tmp_path / "bad.jsonl", [row("icd", "single", "Z99"), row("icd", "multi_sibling", "A00", "J18"), row("rxnorm", "multi_solving", "1", "2"), row("icd", "single", "A00", cluster_name="c", distractor=["J18"])])
    assert commands.main(["validate", bad], spark) == 0  # without knowledge bases nothing is wrong
    capsys.readouterr()
    assert commands.main(["validate", bad, *where], spark) == 1
    said = capsys.readouterr().out
    assert all(rule in said for rule in ("gold has unknown codes", "gold spans blocks", "gold is of no one group", "distractor is not near", "cluster of one row", "cluster spans blocks"))


def test_tables_from_a_shell(spark, tmp_path, capsys):
    text = [("left", "A00 Cholera"), ("right", "A00 Bệnh tả"), ("right", "Loại trừ: khác"), ("left", "A01 Typhoid")]
    page = lines(tmp_path / "lines.jsonl", [{"page": 1, "side": s, "line_no": i, "text": t} for i, (s, t) in enumerate(text)])
    blocks = lines(tmp_path / "blocks.jsonl", [{"chapter": "I", "block": "A00-A09"}])
    assert commands.main(["codes", page, blocks, str(tmp_path / "icd")], spark) == 0 and "'n': 2" in capsys.readouterr().out
    assert [(r.doc_id, r.text, r.block) for r in spark.read.json(str(tmp_path / "icd")).orderBy("doc_id").collect()] == [("icd_A00", "Bệnh tả", "A00-A09"), ("icd_A01", "Typhoid", "A00-A09")]
    atom = lambda rxcui, rxaui, name, tty: {"rxcui": rxcui, "rxaui": rxaui, "str": name, "sab": "RXNORM", "tty": tty, "suppress": "N"}
    conso = lines(tmp_path / "conso.jsonl", [atom("1", "a1", "one", "IN"), atom("3", "a3", "three", "IN"), atom("2", "a2", "two", "MIN"), atom("9", "b1", "brand", "BN"), atom("1", "s1", "uno", "SY")])
    rel = lines(tmp_path / "rel.jsonl", [{"rxcui1": "9", "rxcui2": c, "sab": "RXNORM", "rela": "has"} for c in "312"])
    assert commands.main(["drugs", conso, rel, str(tmp_path / "rx")], spark) == 0
    assert [(r.doc_id, r.synonyms) for r in spark.read.json(str(tmp_path / "rx" / "concepts")).collect()] == [("c_1", ["uno"]), ("c_3", [])]
    assert [(r.resolve_in, r.resolve_min) for r in spark.read.json(str(tmp_path / "rx" / "aliases")).collect()] == [(["1", "3"], ["2"])]
    capsys.readouterr()
    assert commands.main(["trace", conso, rel, "b1"], spark) == 0
    said = capsys.readouterr().out
    assert said.index("|one") < said.index("|three") < said.index("|two")
