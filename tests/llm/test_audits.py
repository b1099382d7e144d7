"""Decontamination, filter audits and manifests against brute force."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from mentionforge.llm import decontamination, filter_audit, merkle_manifest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_decontamination", "op12_filter_audit", "op13_merkle_manifest"])
def test_same_as_sql(name, same_rows):
    from mentionforge.llm.queries import ORACLES, QUERIES

    same_rows(name, QUERIES[name], ORACLES[name])


# Decontamination

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item"), (3, None), (4, " .,- "), (5, "one two three four five six seven eight nine ten"), (2, "another text of item two"), (None, "é😀x"), (7, "a " * 25)]
TEXTS = [None, "", "...", "ONE two, three four five-six seven eight nine TEN eleven x", "a short Item; short\nitem again", "xé😀x é😀x, É😀X", "a " * 40, "one two three four five six seven eight nine", "another text of item two three", "short " * 30 + "item"]


def words_of(text):
    return WORD.findall((text or "").encode().lower())


def brute_hits(text, items, window=10):
    words, hit, found = words_of(text), set(), set()
    for item, t in items:
        own = words_of(t)
        n = min(window, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        at = [i for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in grams]
        if at:
            found.add("" if item is None else str(item))
            hit.update(i + k for i in at for k in range(n))
    return words, hit, sorted(found)


def bench(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


def texts(spark, rows):
    d = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "doc_id long, text string")
    return d.select("doc_id", "text", F.lit(1).alias("found"), F.lit(2).alias("row"), F.array(F.lit("x")).alias("a.b"), F.lit("s").alias("source"))


@pytest.mark.parametrize("pairs", [1000, 5])
def test_hits_are_brute_force(spark, pairs):
    got = {r.doc_id: r for r in decontamination.report(texts(spark, TEXTS), bench(spark), pairs=pairs).collect()}
    assert len(got) == len(TEXTS)
    for k, t in enumerate(TEXTS):
        words, hit, found = brute_hits(t, ITEMS)
        want = (len(words), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit))
        assert (got[k].n_words, got[k].n_hit, got[k].n_items, got[k].items_sha256, got[k].contaminated) == want, t


def test_random_texts_in_small_pieces(monkeypatch):
    monkeypatch.setattr(decontamination, "CHUNK", 64)
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(k, say(rng.randrange(1, 16))) for k in range(30)]
    pairs = [(b" ".join(w[i : i + 10]), str(k)) for k, t in items for w in [words_of(t)] for i in range(max(1, len(w) - 9))]
    index = decontamination.WindowIndex(list(dict.fromkeys(pairs)))
    for _ in range(40):
        text = say(rng.randrange(0, 400))
        n, spans, found = index.scan(text.encode())
        words, hit, names = brute_hits(text, items)
        assert (n, {i for a, b in spans for i in range(a, b)}, sorted(found)) == (len(words), hit, names)


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontamination, "word_hashes", lambda words: __import__("numpy").ones(len(words), "uint64"))
    index = decontamination.WindowIndex([(b"a b", "1"), (b"c d", "2")])
    assert index.scan(b"x a b y") == (4, [(1, 3)], {"1"})


def test_spans_and_documents_are_removed(spark):
    d = texts(spark, TEXTS)
    spans = {r.doc_id: r for r in decontamination.clean(d, bench(spark)).collect()}
    for k, t in enumerate(TEXTS):
        words, hit, _ = brute_hits(t, ITEMS)
        assert words_of(spans[k].text) == [w for i, w in enumerate(words) if i not in hit]
        assert (spans[k].text == t) == (not hit) and spans[k]["a.b"] == ["x"]
    assert spans[3].text == " x"
    kept = decontamination.clean(d, bench(spark), remove="documents")
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, t in enumerate(TEXTS) if not brute_hits(t, ITEMS)[1]}
    with pytest.raises(ValueError):
        decontamination.clean(d, bench(spark), remove="words")


def test_decontamination_of_empty_tables_and_long_texts(spark):
    d = texts(spark, TEXTS)
    assert decontamination.report(d.limit(0), bench(spark)).count() == 0
    assert decontamination.report(d, bench(spark).limit(0)).filter("n_hit > 0 OR contaminated").count() == 0
    r = decontamination.report(texts(spark, ["z " * 700_000 + ITEMS[0][1] + " z" * 100_000]), bench(spark)).first()
    assert (r.n_words, r.n_hit, r.n_items) == (800_012, 12, 2)


# Filter audit

def brute_audit(rows, good, toxic):
    """rows: (doc_id, text, source)."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    fails = []
    for i, t, s in rows:
        t = t or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        same = least.get(t)
        fails.append((s or "", i, {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                                   "E": same is not None and (i is None or i > same)}))
    out = {}
    for part in {p for p, _, _ in fails}:
        for order in map("".join, permutations("ABCDE")):
            left = [(i, f) for p, i, f in fails if p == part]
            before = []
            for step, x in enumerate(order, 1):
                gone = [i for i, f in left if f[x]]
                redundant = sum(f[x] for _, f in before)
                unique = sum(f[x] and sum(f.values()) == 1 for p, _, f in fails if p == part)
                before += [(i, f) for i, f in left if f[x]]
                left = [(i, f) for i, f in left if not f[x]]
                out[part, order, step] = [len(left), len(gone), redundant, unique, sum(i in good for i in gone), sum(i in toxic for i in gone)]
    shapley = {}
    for (part, order, step), v in out.items():
        shapley[part, order[step - 1]] = shapley.get((part, order[step - 1]), 0) + v[1]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_of_odd_rows(spark):
    plain = " ".join(f"w{k}" for k in range(60))
    rows = [(1, plain, "a"), (2, plain, "b"), (2, plain, "b"), (None, plain, None), (3, None, ""), (4, "", "a"), (5, "A B # C", "a"), (6, "x " * 200, "b"), (7, plain + " ABCDEFGHIJKLMNOPQRSTUVWXYZ $", "a"), (1, plain, "b"), (None, "lone", "b"), (None, "lone", "b"), (8, "y" * 400_000, "a")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").select("*", F.lit(1).alias("mask"), F.lit("z").alias("digest"), F.lit(0).alias("part"))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (5, None, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.audit(d, labels).collect()}
    assert got == brute_audit(rows, {1, 2}, {2, 5})
    assert filter_audit.audit(d.limit(0), labels).count() == 0


def test_audit_of_other_filters(spark):
    d = spark.createDataFrame([(1, "a b", "s"), (2, "a", "s"), (3, "a", "s"), (4, "c d e", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(d, labels, {"short": lambda t, w: F.size(w) < 2}, "again", [("short", "again"), ("again", "short")]).collect()
    assert [(r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.shapley) for r in sorted(got, key=lambda r: (r.filter_order, r.step))] == [
        ("againshort", 1, 3, 1, 0, 0, 1, 1), ("againshort", 2, 2, 1, 1, 1, 0, 3), ("shortagain", 1, 2, 2, 0, 1, 1, 3), ("shortagain", 2, 2, 0, 1, 0, 0, 1)]
    with pytest.raises(ValueError):
        filter_audit.audit(d, labels, {"E": lambda t, w: F.lit(True)})


def test_zeta(spark):
    rng = random.Random(5)
    f = [rng.randrange(100) for _ in range(16)]
    got = spark.range(1).select(filter_audit.zeta(F.array(*[F.lit(x).cast("long") for x in f]), 4)).first()[0]
    assert got == [sum(f[s] for s in range(16) if s & ~m == 0) for m in range(16)]


# Merkle manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, lower=False):
    doc_id, source, lang, n_chars, text = row
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if lower and text is not None else text
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def brute_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def brute_manifest(rows):
    first = lambda x: (x is not None, x if x is not None else 0)
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([brute_leaf(r) for r in sorted(groups[s], key=lambda r: (first(r[0]), brute_leaf(r)))]) for s in names}
    top = brute_tree([trees[s][-1][0] for s in names])
    out = []
    for g, s in enumerate(names):
        for i, r in enumerate(sorted(groups[s], key=lambda r: (first(r[0]), brute_leaf(r)))):
            path = [(level[i // 16**v // 16 * 16 :][:16], i // 16**v % 16) for v, level in enumerate(trees[s][:-1])] + [(level[g // 16**v // 16 * 16 :][:16], g // 16**v % 16) for v, level in enumerate(top[:-1])]
            changed = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0
            node = brute_leaf(r, changed)
            for run, at in path:
                node = h(*run[:at], node, *run[at + 1 :])
            proof = h(*[x for run, at in path for k, x in enumerate(run) if k != at])
            out.append((r[0], brute_leaf(r), trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(map(str, out))


def manifest_rows(n, sources, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 3]), rng.choice(["Text é😀", "lower", None, ""]) if i % 3 else "Ab " * rng.randrange(9)) for i in rng.sample(range(10 * n), n)]


QUERY_SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def query_rows(spark, rows, tmp_path):
    spark.createDataFrame(rows, QUERY_SCHEMA).withColumns({"leaf": F.lit(1), "part": F.lit("p")}).write.parquet(str(tmp_path / "documents.parquet"))
    return sorted(str(tuple(r)) for r in merkle_manifest.query(spark, str(tmp_path)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


@pytest.mark.parametrize(("n", "sources"), [(1, ["a"]), (16, ["a"]), (17, [None, "a"]), (300, ["hot"] * 9 + ["é", "z", "", None, "Z"]), (900, [None, "hot", *map(str, range(300))]), (0, ["a"])])
def test_manifest_is_brute_force(spark, tmp_path, n, sources):
    rows = manifest_rows(n, sources)
    assert query_rows(spark, rows, tmp_path) == (brute_manifest(rows) if n else [])


def test_manifest_of_several_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "LEAST_LEVELS", 1)
    rows = manifest_rows(700, ["hot"] * 5 + ["a", None])
    assert query_rows(spark, rows, tmp_path) == brute_manifest(rows)
    monkeypatch.setattr(merkle_manifest, "MOST_NODES", 4)
    assert query_rows(spark, rows, tmp_path / "deeper") == brute_manifest(rows)


def test_manifest_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", 0, ""), (1, "", "en", 0, "B"), (1, "", "en", 0, "B"), (2, None, "en", 1, "x" * 300_000)]
    assert query_rows(spark, rows, tmp_path) == brute_manifest(rows)
    d = spark.createDataFrame(rows, QUERY_SCHEMA)
    a, b = (merkle_manifest.manifest(x).collect() for x in (d, d.withColumn("text", F.when(F.col("text") == "", "-").otherwise(F.col("text")))))
    assert len({r.root for r in a + b}) == 2 and sum(x.subroot == y.subroot for x in a for y in b if x.group == y.group) == 1


@pytest.mark.parametrize("n", [1, 15, 16, 17, 256, 257, 4097])
def test_forests_merge_in_any_order(n):
    leaves = [hashlib.sha256(str(k).encode()).digest() for k in range(n)]
    want = merkle_manifest.levels_of(leaves, None)[-1][0]
    for seed in range(3):
        rng = random.Random(seed)
        parts = [merkle_manifest.Forest() for _ in range(7)]
        for k in rng.sample(range(n), n):
            rng.choice(parts).add("t", n, 0, k, leaves[k])
        while len(parts) > 1:
            a, b = (parts.pop(rng.randrange(len(parts))) for _ in range(2))
            parts.append(a.merge(b))
        assert parts[0].root("t") == want
