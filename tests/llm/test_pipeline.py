"""Each stage of the pipeline against a brute-force version on its own input."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_free import brute_components, brute_word_simhash, check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    import corpus_pipeline

    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append((name, docs))
    return out


def test_shapes(stages):
    assert 4 <= len(stages) - 1 <= 5
    columns = stages[0][1].columns
    assert all(d.columns == columns for _, d in stages[:-1])


def test_filters_keep_the_clean(spark, stages):
    (_, before), (_, language), (_, quality) = stages[:3]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert language.count() == before.filter("text rlike '[A-Za-z]'").count()
    good = language.join(labels.filter("quality = 1"), "doc_id")
    assert quality.join(good.select("doc_id"), "doc_id").count() >= 0.9 * good.count()
    assert quality.subtract(language).count() == 0


def brute_languages(rows):
    """The table of a model that is learned in one process from all rows that are not held out."""
    from mentionforge.llm import language_mixture as m

    counts = {}
    for _, lang, text in {(r.doc_id, r.lang, r.text) for r in rows if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 5}:
        total = counts.setdefault(lang, np.zeros(m.BUCKETS))
        for grams, _ in m.trigrams(text):
            np.add.at(total, grams, 1)
    langs = sorted(counts)
    table = np.stack([np.log((counts[x] + 0.5) / (counts[x].sum() + 0.5 * m.BUCKETS)) for x in langs], 1)
    return langs, table.astype(np.float32)


def test_language_is_brute_force(stages):
    from mentionforge.llm.language_mixture import identify

    before = stages[0][1].collect()
    langs, table = brute_languages(before)
    found = {r.doc_id: identify(r.text, langs, table, 4.0) for r in before}
    assert {r.doc_id for r in stages[1][1].collect()} == {i for i, (name, score, names) in found.items() if name != "und" and (len(names) > 1 or score >= 0.5)}


def brute_quality(spark, rows, good):
    """The model that is fitted in one process on all rows (id, text) that are not held out, of which ``good`` are trusted."""
    from mentionforge.llm import pu_quality as m

    hashed = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", F.pmod(F.xxhash64(F.lit("web"), "doc_id", "text"), F.lit(1 << 60)).alias("at")).collect()
    at = {r.doc_id: r["at"] for r in hashed}
    sample = [(kind, m.half_of(t.encode()), at[i], t) for i, t in rows for kind in (1, 0) if kind == 0 or i in good]
    counts = {(k, h): {b: np.zeros(n, np.int64) for b, n in m.SIZES.items()} for k in (0, 1) for h in (0, 1)}
    for kind, half, _, t in sample:
        for b, places in m.buckets(t.encode().split()).items():
            for x in places.tolist():
                counts[kind, half][b][x] += 1
    tables = [m.word_tables(counts[1, 1 - h], counts[0, 1 - h]) for h in (0, 1)]
    x = [(kind, m.features(t, tables)) for kind, _, _, t in sample]
    x += [(2, m.features(m.in_other_order(t), tables, half)) for kind, half, a, t in sample if kind == 0 and a // 2 % m.SALAD == 0 and len(t.split()) >= m.ORDERED]
    kinds, values = np.array([k for k, _ in x]), np.array([v for _, v in x])
    order = np.lexsort([*values.T, kinds])
    order = order[np.random.default_rng(7).permutation(len(order))]
    kinds, values = kinds[order], values[order]
    return m.fit(*(values[kinds == k] for k in (1, 0, 2))), tables


def test_quality_is_brute_force(spark, stages):
    from mentionforge.llm import pu_quality as m

    before = [(r.doc_id, r.text) for r in stages[1][1].collect()]
    learned = [r for r in before if zlib.crc32(str(r[0]).encode()) % 5]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    model, tables = brute_quality(spark, learned, good)
    want = dict(zip([i for i, _ in before], m.scores(model, np.array([m.features(t, tables) for _, t in before])).tolist(), strict=True))
    got = {r.doc_id: r.score for r in m.score_documents(stages[1][1], labels).collect()}
    assert got == pytest.approx(want, abs=1e-9)
    assert {r.doc_id for r in stages[2][1].collect()} == {i for i, s in want.items() if s >= 0.3}


def test_one_of_each_group_stays(stages):
    before, after = stages[2][1], stages[3][1]
    fps = {r.doc_id: brute_word_simhash(r.text) for r in before.collect()}
    assert {r.doc_id for r in after.collect()} == set(brute_components(fps, 6).values())


def test_mixture(stages):
    from tests.llm.test_native import brute_targets

    before, after = stages[3][1].collect(), stages[4][1].collect()
    size = lambda r: len((r.text or "").split())
    sizes, taken, largest = {}, {}, {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + size(r)
        largest[r.source] = max(largest.get(r.source, 0), size(r))
    for r in after:
        taken[r.source] = taken.get(r.source, 0) + size(r)
    for s, target in brute_targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= largest[s]
    counts = {}
    for r in after:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert max(counts.values()) <= 2


def test_packing(stages):
    from tokenizers import Tokenizer

    from mentionforge.llm.slack_packing import default_tokenizer

    before, after = stages[4][1], stages[5][1].collect()
    t = Tokenizer.from_file(default_tokenizer())
    once = before.groupBy("doc_id").agg(F.count("*").alias("n"), F.first("text").alias("text")).collect()
    check_packing(after, [(r.doc_id, r.text) for r in once], t, 4096)
    pieces = {}
    for r in after:
        pieces[(r.doc_id, r.piece)] = pieces.get((r.doc_id, r.piece), 0) + 1
    assert all(pieces[(r.doc_id, 0)] == r.n for r in once)
    assert len({r.sequence_id for r in after}) <= math.ceil(sum(r.length for r in after) / 4096) + 1


def test_run_and_odd_tables(spark, stages, tmp_path):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, SF).count() == stages[-1][1].count()
    docs = spark.createDataFrame([(1, "", "en", None, 0), (1, "", None, "s", 0), (None, None, None, None, None), (4, "a b c. " * 40, "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for name, rows in (("odd", docs), ("empty", docs.limit(0))):
        rows.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
        n = corpus_pipeline.run(spark, str(tmp_path / name)).count()
        assert (n > 0) == (name == "odd")
