"""SimHash, packing, archive, license scan, classifiers and language model against brute force, round trips and held-out data."""

import base64
import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mentionforge.llm import language_mixture, license_scan, pitman_yor_lm, pu_quality, simhash_tiles, slack_packing, warc_archive

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


ODD = [(1, ""), (2, None), (3, "One"), (4, "one"), (5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (6, "é " * 3000), (7, " \t\n"), (8, "x\x1cy z w")]


def odd(spark, rows=ODD):
    d = spark.createDataFrame(rows, "doc_id long, text string")
    return d.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("fp"), F.lit(1).alias("label"), F.lit("x").alias("x"), F.lit(2).alias("rank"))


# SimHash

def brute_simhash(text):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components_of(nodes, links):
    parent = {i: i for i in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in links:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}


def brute_components(fps, radius=2):
    ids = list(fps)
    return components_of(ids, ((i, j) for n, i in enumerate(ids) for j in ids[n + 1 :] if (fps[i] ^ fps[j]).bit_count() <= radius))


def brute_word_simhash(text):
    """As keep_first takes them: of distinct words."""
    hs = [xxhash.xxh64_intdigest(w, 42) for w in set(WORD.findall((text or "").encode().lower()))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_matches_brute_force(spark):
    got = {r.doc_id: r for r in simhash_tiles.query(spark, SF).collect()}
    fps = {r.doc_id: brute_simhash(r.text) for r in docs(spark).collect()}
    want = brute_components(fps)
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == want


@pytest.mark.parametrize("tile", [4, 4096])
def test_tiles_find_all_links(spark, tile):
    rng = random.Random(3)
    fps = {}
    for i in range(60):
        base = rng.getrandbits(64)
        for j in range(rng.randint(1, 6)):
            base ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                base ^= 1 << rng.randrange(64)
            fps.setdefault(base, i * 10 + j)
    signed = {f - (1 << 64) if f >> 63 else f: f for f in fps}
    d = spark.createDataFrame([(f,) for f in signed], "fp long")
    for radius, parts in ((2, 4), (6, 2), (3, 1)):
        found = {r.node: r.label for r in simhash_tiles.components(simhash_tiles.links(d, radius=radius, tile=tile, parts=parts)).collect()}
        want = brute_components(signed, radius)
        assert {i: found.get(i, i) for i in want} == want


def test_forest_connects_all():
    rng = np.random.default_rng(4)
    for n, m in ((5, 3), (200, 150), (200, 2000), (3, 0)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        x, y = simhash_tiles.forest(a, b)
        of = lambda p, q: components_of(range(n), zip(p.tolist(), q.tolist()))
        assert of(a, b) == of(x, y) and len(x) == n - len(set(of(a, b).values()))


def test_long_chain_of_links(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)], "a long, b long")
    got = simhash_tiles.components(edges).collect()
    assert len(got) == n - 1 and {r.label for r in got} == {0}
    assert simhash_tiles.components(edges.limit(0)).count() == 0


def test_simhash_odd_rows(spark):
    got = simhash_tiles.classes(odd(spark)).collect()
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.fp, r.component_id))
    assert by[1] == by[2] == by[7] == [(0, 1)] and by[3][0][0] == by[4][0][0] and by[4][0][1] == 3 and by[None][0][1] == 5
    assert simhash_tiles.classes(odd(spark, [])).count() == 0
    kept = simhash_tiles.keep_first(odd(spark))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6, 8] and kept.columns == odd(spark).columns


def test_rows_without_id_are_linked(spark):
    """Seven texts, of which each differs from the next a little: all are linked through rows that have no id."""
    base = random.Random(8)
    words = [f"w{base.randrange(10**6)}" for _ in range(400)]
    chain = []
    for i in range(400):
        text = " ".join([*words[:i], f"x{i}", *words[i + 1 :]])
        chain.append((brute_simhash(text), text))
    start = brute_simhash(" ".join(words))
    near = [t for f, t in chain if (f ^ start).bit_count() <= 2]
    rows = [(7, " ".join(words)), *[(None, t) for t in near[:5]], (4, near[5]), (None, "quite another text than all"), (9, "quite another text than all but longer and so of another class")]
    fps = {n: brute_simhash(t) for n, (_, t) in enumerate(rows)}
    want = {}
    for n, c in brute_components(fps).items():
        want.setdefault(c, []).append(n)
    least = {n: min((rows[m][0] for m in ns if rows[m][0] is not None), default=None) for ns in want.values() for n in ns}
    d = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda c, f: (c is None, c or 0, f)
    got = sorted((key(r.component_id, r.fp % (1 << 64)) for r in simhash_tiles.classes(d).collect()))
    assert got == sorted(key(least[n], fps[n]) for n in fps)
    text_ids = simhash_tiles.classes(d.withColumn("a.b", F.concat(F.lit("k"), "doc_id")).drop("doc_id"), id_col="a.b").collect()
    assert sorted(r.component_id or "" for r in text_ids) == sorted(f"k{least[n]}" if least[n] is not None else "" for n in fps)


def test_one_row_of_each_class_stays(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "another text of the same id"), (None, "a b c"), (None, "no id here"), (None, "no id here"), (2, None), (2, "")]
    kept = simhash_tiles.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "no id here"), (1, "a b c"), (1, "another text of the same id"), (2, "")]


# Packing

def test_packing(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(slack_packing.default_tokenizer())
    rows = slack_packing.query(spark, SF).collect()
    texts = {r.doc_id: r.text for r in docs(spark).collect()}
    check_packing(rows, [(i, x) for i, x in texts.items()], t, 4096)
    n = len({r.sequence_id for r in rows})
    assert n <= math.ceil(sum(r.length for r in rows) / 4096) + 1


def check_packing(rows, texts, tokenizer, capacity):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want = [(k, a, len(ids[a : a + capacity]), zlib.crc32(ids[a : a + capacity].tobytes())) for k, a in enumerate(range(0, len(ids), capacity))]
        got = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i])
        assert got[:: max(1, len(got) // len(want))] == want
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity


def test_packing_odd_rows(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(slack_packing.default_tokenizer())
    rows = slack_packing.pack_documents(odd(spark), capacity=64).collect()
    check_packing(rows, [(1, ""), (2, None), (3, "One"), (6, "é " * 3000), (None, "a b c d"), (8, "x\x1cy z w")], t, 64)
    assert len([r for r in rows if r.doc_id == 5]) == 2
    special = odd(spark, [(1, "hello <|endoftext|> world"), (2, "x<|startoftext|>"), *[(3, "same text")] * 700, (4, "long " * 40000)])
    check_packing(slack_packing.pack_documents(special).collect(), [(1, "hello <|endoftext|> world"), (2, "x<|startoftext|>"), (3, "same text"), (4, "long " * 40000)], t, 4096)
    assert slack_packing.pack_documents(odd(spark, [])).count() == 0


def test_word_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(slack_packing.default_tokenizer())
    rng = random.Random(2)
    letters = [chr(c) for c in [*range(1, 0x250), *range(0x300, 0x320), *range(0x391, 0x3CA), 0x85, 0xA0, 0x2028, 0x3000, 0xAC00, 0x1F600]] + [" "] * 80 + ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "'s", "."] * 5
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 50))) for _ in range(3000)] + ["hello <|endoftext|> world", "a<|startoftext|><|endoftext|>b.", "<|endoftext|>"]
    own = slack_packing.WordIds(slack_packing.default_tokenizer())
    for _ in range(2):
        assert own.of(texts) == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_words_met_once_fill_no_memory():
    import random
    import tracemalloc

    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(500)) for _ in range(120)]
    own = slack_packing.WordIds(slack_packing.default_tokenizer())
    own.of(texts[:1])
    tracemalloc.start()
    try:
        for t in texts:
            own.of([t])
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 6e6  # before: 60,000 words and as many pieces, 13 MB and more


def test_only_distinct_pieces_of_words_take_calls():
    import sys
    from itertools import product

    letters = ["".join(x) for x in product("abcdef", repeat=3)]
    texts = [" ".join(w + m for w in letters) for m in ("", ".", ",", "!", "?", "...", "$", "#", ";;", "|")] * 30
    own, calls = slack_packing.WordIds(slack_packing.default_tokenizer()), []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        own.of(texts)
    finally:
        sys.setprofile(None)
    assert len(calls) < 3 * len(letters) + len(texts) + 300  # before: several calls for each of 2,160 words


def test_texts_are_encoded_in_steps_of_bounded_size(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(slack_packing, "STEP_BYTES", 10)
    monkeypatch.setattr(slack_packing, "STEP", 3)
    monkeypatch.setattr(slack_packing, "STEP_RUNS", 2)
    sizes = [0, 0, 0, 0, 4, 5, 1, 1, 30, 30, 2, 9]
    texts = pa.array(["x" * 7, *("a " * (n // 2) + "." * (n % 2) for n in sizes)])[1:]
    steps = list(slack_packing.steps(texts))
    assert steps == [(0, 3), (3, 3), (6, 2), (8, 1), (9, 1), (10, 1), (11, 1)]
    own = slack_packing.WordIds(slack_packing.default_tokenizer())
    want = own.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
    assert [x for at, n in steps for x in own.of(texts.slice(at, n))] == [np.array(e.ids, "<u4").tobytes() for e in want]
    assert list(slack_packing.steps(texts[:0])) == [] and own.of([]) == []


def test_each_sign_in_a_word_has_the_tokenizers_ids():
    from tokenizers import Tokenizer

    t, own = Tokenizer.from_file(slack_packing.default_tokenizer()), slack_packing.WordIds(slack_packing.default_tokenizer())
    for form in ("{}", "a{}", "{}b.", "Ab{}.,", "x{} y"):
        texts = [form.format(chr(c)) for c in [*range(0x3100), *range(0xFE00, 0x10000), *range(0x1F600, 0x1F610)]]
        want = t.encode_batch_fast(texts, add_special_tokens=False)
        assert [x for x, e, ids in zip(texts, want, own.of(texts), strict=True) if np.array(e.ids, "<u4").tobytes() != ids] == []


def test_word_ids_do_not_depend_on_what_is_remembered(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(slack_packing, "CACHE_WORDS", 3)
    monkeypatch.setattr(slack_packing, "CACHE_PIECES", 2)
    monkeypatch.setattr(slack_packing, "MOST_MARKS", 4)
    t, own = Tokenizer.from_file(slack_packing.default_tokenizer()), slack_packing.WordIds(slack_packing.default_tokenizer())
    texts = ["One word, two words.", "", "one Word, \u00c4rger <|endoftext|> two", "two two words? \u4f60\u597d", "One word, two words."]
    for _ in range(3):
        for at in range(0, len(texts), 2):
            some = texts[at : at + 2]
            assert own.of(some) == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in some]



@pytest.mark.parametrize("seed", range(4))
def test_fullest_is_exact(seed):
    rng = random.Random(seed)
    counts = {rng.randint(3, 40): rng.randint(1, 4) for _ in range(6)}
    room = rng.randint(20, 90)
    sums = {0}
    for n, k in counts.items():
        sums = {s + n * i for s in sums for i in range(k + 1) if s + n * i <= room}
    got = slack_packing.fullest(counts, room)
    assert sum(n * k for n, k in got) == max(sums) and all(k <= counts[n] for n, k in got)


def test_patterns_use_everything():
    histogram = {5: 3, 7: 11, 40: 2, 64: 1, 1: 9}
    used = {}
    for pattern, times in slack_packing.patterns(histogram, 64):
        assert sum(n * k for n, k in pattern.items()) <= 64
        for n, k in pattern.items():
            used[n] = used.get(n, 0) + k * times
    assert used == histogram


# Archive

def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(3, "http://a/x y\r\nEvil: 1", "same"), (1, "http://b", "same"), (2, None, None), (4, "http://d", ""), (9, "http://a/x y?q=%23tag+1@b%20é", "é😀" * 500), (None, "http://f", "same"), (7, "u", "x"), (7, "u", "x")], "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("digest", F.lit(2))
    warc_archive.write_archive(pages, str(tmp_path / "a"))
    back = warc_archive.record_bytes(warc_archive.read_archive(spark, str(tmp_path / "a"))).collect()
    assert sorted((r.page_id is None, r.page_id or 0, bytes(r.payload).decode()) for r in back) == sorted((p.page_id is None, p.page_id or 0, p.html or "") for p in pages.collect())
    assert spark.read.parquet(str(tmp_path / "a" / "payloads")).count() == 4
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in back}
    assert kinds == {(1, "response", None), (3, "revisit", 1), (2, "response", None), (4, "revisit", 2), (9, "response", None), (None, "revisit", 1), (7, "response", None)}
    for r in back:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert b"Evil" not in fields and len(rest) == int(fields[b"Content-Length"]) + 4
        assert fields[b"WARC-Payload-Digest"].decode() == "sha1:" + base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode()
        if r.record_type == "response":
            assert rest[:-4].partition(b"\r\n\r\n")[2] == bytes(r.payload)
    frame = warc_archive.record_bytes(warc_archive.read_archive(spark, str(tmp_path / "a")))
    full = {r.page_id: (p, u) for r, p, u in ((p, (p.html or "").encode(), p.url) for p in pages.collect())}
    for r in warc_archive.parsed(frame).collect():
        payload, url = full[r.page_id]
        assert (r.payload_bytes, r.payload_sha1) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()) and r.named_sha1 == r.payload_sha1
        assert r.url == (url or "about:blank").translate({c: f"%{c:02X}" for c in [*range(33), 127]}) and (r.refers_to_record is None) == (r.type == "response")
    record = bytes(back[0].record)
    for bad in (record[:-1], record + b"x", record.replace(b"Content-Length: ", b"Content-Length: 1", 1)):
        with pytest.raises(ValueError):
            warc_archive.parse_record(bad)
    small = tmp_path / "b"
    warc_archive.write_archive(pages, str(small), least=2)
    assert {r.record_type for r in warc_archive.read_archive(spark, str(small)).filter("payload_bytes < 2").collect()} == {"response"}


def test_archive_detects_damage(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string")
    warc_archive.write_archive(pages, str(tmp_path / "a"))
    payloads = spark.read.parquet(str(tmp_path / "a" / "payloads"))
    warc_archive.compressed(payloads.withColumn("payload", F.lit(b"abd"))).write.parquet(str(tmp_path / "b" / "payloads"))
    spark.read.parquet(str(tmp_path / "a" / "headers")).write.parquet(str(tmp_path / "b" / "headers"))
    with pytest.raises(Exception, match="not the payload"):
        warc_archive.read_archive(spark, str(tmp_path / "b")).collect()
    payloads.limit(0).write.mode("overwrite").parquet(str(tmp_path / "b" / "payloads"))
    with pytest.raises(Exception, match="no payload"):
        warc_archive.read_archive(spark, str(tmp_path / "b")).collect()
    warc_archive.write_archive(pages.limit(0), str(tmp_path / "e"))
    assert warc_archive.read_archive(spark, str(tmp_path / "e")).count() == 0


# License scan

def brute_scan(text, templates):
    """(name, first word, past the last word, containment) of all occurrences, by sets of tuples over the whole text."""
    words = license_scan.tokens(text)
    grams = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    found = []
    for name, t in templates.items():
        tw = license_scan.tokens(t.encode())
        own = {tuple(tw[i : i + 5]) for i in range(max(1, len(tw) - 4))}
        m, start = len(own), 0
        end = 0
        while end < len(grams):
            end += 1
            span = [x for x in grams[max(start, end - 2 * m) : end] if x in own]
            if grams[end - 1] not in own or len(set(span)) < 0.8 * m:
                continue
            begin = max(start, end - 2 * m)
            while grams[begin] not in own or grams[begin] in grams[begin + 1 : end]:
                begin += 1
            had, last = set(grams[begin:end]) & own, end
            for k in range(end, min(len(grams), begin + 2 * m)):
                if grams[k] in own:
                    if grams[k] in had:
                        break
                    had.add(grams[k])
                    last = k + 1
            found.append((name, begin, last + min(5, len(words)) - 1, len(had) / m))
            start = end = last
    return sorted(found, key=lambda x: (x[1], x[0]))


def test_license_scan_matches_brute_force(spark):
    got = {r.doc_id: [(m["license"], m["start_word"], m["end_word"], m["containment"]) for m in json.loads(r.matches)] for r in license_scan.query(spark, SF).collect()}
    assert got == {r.doc_id: brute_scan(r.text.encode(), license_scan.TEMPLATES) for r in docs(spark).collect()}
    assert any(got.values())


@pytest.mark.parametrize("between", [0, 1, 12, 20, 300])
def test_neighbouring_occurrences_are_apart(between):
    classes = license_scan.prepare(license_scan.TEMPLATES)
    rng = random.Random(between)
    filler = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    for name, notice in license_scan.TEMPLATES.items():
        text = f"{filler(9)} {notice} {filler(between)} {notice} {filler(between)} {notice}".encode()
        got = license_scan.scan_texts([text], classes)[0]
        assert got == brute_scan(text, license_scan.TEMPLATES)
        n = len(notice.split())
        assert [m[1:3] for m in got if m[0] == name] == [(9 + i * (n + between), 9 + i * (n + between) + n) for i in range(3)]


def test_planted_notices():
    rng = random.Random(5)
    classes = license_scan.prepare(license_scan.TEMPLATES)
    filler = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    texts, names = [], []
    for name, notice in list(license_scan.TEMPLATES.items()) * 20:
        words = notice.split()
        if len(words) > 25:  # each change takes five shingles at most
            for _ in range(max(1, len(words) // 50)):
                words[rng.randrange(5, len(words) - 5)] = "changed"
        texts.append(f"{filler(rng.randint(0, 200))} {' '.join(words).upper()} {filler(rng.randint(0, 200))}".encode())
        names.append(name)
    got = license_scan.scan_texts(texts, classes)
    want = [brute_scan(text, license_scan.TEMPLATES) for text in texts]
    found, wanted = ({(i, m) for i, ms in enumerate(x) for m in ms} for x in (got, want))
    assert len(wanted) >= len(names) and found <= wanted and len(found) >= 0.99 * len(wanted)  # recall of edited copies
    assert all(name in {m[0] for m in ms} or b"CHANGED" in text for name, ms, text in zip(names, want, texts))
    assert got == license_scan.scan_texts(texts, classes, piece=120)
    for ms, text in zip(got, texts):
        for _, a, z, share in ms:
            assert 0 <= a < z <= len(text.split()) and 0.8 <= share <= 1


def test_license_odd_rows(spark):
    got = license_scan.scan(odd(spark)).collect()
    assert len(got) == len(ODD) and not any(r.matches for r in got)
    assert license_scan.scan(odd(spark, [])).count() == 0
    twice = spark.createDataFrame([(1, "Released under the MIT License.\n" * 2)], "doc_id long, text string")
    assert [(m.license, m.start_word, m.end_word) for m in license_scan.scan(twice).first().matches] == [("MIT", 0, 5), ("MIT", 5, 10)]


# Languages

def test_language_held_out(spark):
    d = docs(spark)
    got = language_mixture.query(spark, SF).join(d.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == d.count() and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in got)


def test_language_mixtures(spark):
    langs, table = language_mixture.learn(docs(spark))
    by = {r.lang: r.text for r in docs(spark).filter("length(text) > 1500").collect()}
    mixed = " ".join(by["en"].split()[:150] + by["fr"].split()[:100])
    name, share, found = language_mixture.identify(mixed, langs, table, 4.0)
    assert name == "en" and set(found) == {"en", "fr"} and 0.45 < share < 0.75
    for text in ("123 !?", "½ ² _ 一"[:5], "\u0301"):
        assert language_mixture.identify(text, langs, table, 4.0) == ("und", 0.0, [])
    assert language_mixture.identify(by["de"] * 3, langs, table, 4.0)[0] == "de"


def test_pieces_of_long_texts(spark, monkeypatch):
    langs, table = language_mixture.learn(docs(spark))
    text = docs(spark).filter("length(text) > 3000").first().text
    whole = language_mixture.identify(text, langs, table, 4.0)
    monkeypatch.setattr(language_mixture, "PIECE", 500)
    again = language_mixture.identify(text, langs, table, 4.0)
    assert again[0] == whole[0] and again[1] == pytest.approx(whole[1], abs=0.01)


def test_language_odd_rows(spark):
    got = {(r.doc_id, r.lang_pred, r.score) for r in language_mixture.identify_documents(odd(spark).withColumn("lang", F.lit(None).cast("string"))).collect()}
    assert {g[1:] for g in got} == {("und", 0.0)}
    assert language_mixture.identify_documents(odd(spark, [])).count() == 0
    kept = language_mixture.keep_identified(odd(spark))
    assert kept.columns == odd(spark).columns and 1 not in {r.doc_id for r in kept.collect()}


# Quality

def auc(y, s):
    r = np.argsort(np.argsort(s))
    return (r[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / max(1, (y == 1).sum() * (y == 0).sum())


def test_quality_held_out(spark):
    sf = SF.replace("0.001", "0.01")
    got = pu_quality.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    y, s = np.array([r.quality for r in got]), np.array([r.score for r in got])
    assert auc(y, s) > 0.95 and np.mean([r.predicted for r in got if r.quality == 1]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_prior_and_risk():
    rng = np.random.default_rng(1)
    n_features = len(pu_quality.FEATURES)
    pos, neg = rng.normal(0, 1, (4000, n_features)), rng.normal(0, 1, (4000, n_features))
    neg[:, 0] += 6
    u = np.concatenate([rng.normal(0, 1, (2800, n_features)), neg[:1200]])
    model = pu_quality.fit(pos, u)
    assert 0.6 < model["prior"] < 0.8
    s = pu_quality.scores(model, np.concatenate([pos[:500], neg[2000:2500]]))
    assert auc(np.repeat([1, 0], 500), s) > 0.98 and (s[500:] < 0.3).mean() > 0.9 and (s[:500] >= 0.3).mean() > 0.9


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for rows in (ODD, []):
        got = pu_quality.score_documents(odd(spark, rows), labels).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = pu_quality.score_documents(odd(spark), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert pu_quality.keep_good(odd(spark), labels).columns == odd(spark).columns


@pytest.mark.parametrize("seed", range(3))
def test_proportions_and_sets_are_brute_force(seed):
    """EM against a grid over all shares; the chosen set against all sets."""
    rng = np.random.default_rng(seed)
    like = rng.random((60, 3)) ** 3
    like[:, 2] *= 0.2
    share, fit = language_mixture.proportions(like, rounds=2000)
    grid = [(a, b, 1 - a - b) for a in np.linspace(0, 1, 101) for b in np.linspace(0, 1 - a, 101)]
    values = [np.log(np.maximum(like @ np.array(g), 1e-300)).sum() for g in grid]
    assert fit >= max(values) - 0.05 and np.abs(share - grid[int(np.argmax(values))]).max() < 0.08
    langs, grams = ["aa", "bb", "cc"], rng.normal(-8, 2, (language_mixture.BUCKETS, 3)).astype(np.float32)
    words = [f"w{x}" for x in rng.integers(0, 10**6, 30)]
    text = " ".join(words)
    logs = np.concatenate([np.add.reduceat(grams[g], starts, axis=0) for g, starts in language_mixture.trigrams(text)]).astype(float)
    rel = np.exp(logs - logs.max(1, keepdims=True))
    best = {}
    for mask in range(1, 8):
        own = [i for i in range(3) if mask >> i & 1]
        grid = [g for g in np.ndindex(*[41] * len(own)) if sum(g) == 40]
        best[tuple(own)] = max(np.log(np.maximum(rel[:, own] @ (np.array(g) / 40), 1e-300)).sum() for g in grid) - 4.0 * math.log(len(logs) + 1) * (len(own) - 1)
    name, score, found = language_mixture.identify(text, langs, grams, 4.0)
    wanted = max(best.values())
    assert best[tuple(sorted(langs.index(x) for x in found))] >= wanted - 0.5 and name in found and 0 < score <= 1


def test_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language_mixture, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError, match="languages"):
        language_mixture.learn(docs(spark))


def test_risk_and_its_gradient():
    rng = np.random.default_rng(2)
    zp, zu = rng.normal(1, 1, 7), rng.normal(-1, 2, 9)
    loss = lambda z, y: np.log(1 + np.exp(-y * z)).mean()
    for prior in (0.3, 0.9):
        own, rest = pu_quality.pu_risks(zp, zu, prior)
        assert own == pytest.approx(prior * loss(zp, 1)) and rest == pytest.approx(loss(zu, -1) - prior * loss(zp, -1))
        sign = 1 if rest >= 0 else -1
        value = lambda p, u: sum(pu_quality.pu_risks(p, u, prior)) if sign > 0 else -pu_quality.pu_risks(p, u, prior)[1]  # noqa: E731, B023
        gp, gu = pu_quality.pu_gradient(zp, zu, prior)
        for i in range(7):
            e = np.eye(7)[i] * 1e-6
            assert gp[i] == pytest.approx((value(zp + e, zu) - value(zp - e, zu)) / 2e-6, abs=1e-6)
        for i in range(9):
            e = np.eye(9)[i] * 1e-6
            assert gu[i] == pytest.approx((value(zp, zu + e) - value(zp, zu - e)) / 2e-6, abs=1e-6)


def test_descent_finds_the_least_risk():
    """Two features of two bins each: the minimised risk against a grid of weights."""
    rng = np.random.default_rng(3)
    at_p, at_u = rng.integers(0, 2, (40, 1)), rng.integers(0, 2, (60, 1)) * (rng.random((60, 1)) < 0.5)
    prior = 0.4
    total = lambda w, b: (lambda r: r[0] + max(0.0, r[1]))(pu_quality.pu_risks(w[at_p].sum(1) + b, w[at_u].sum(1) + b, prior))
    w, b = pu_quality.descend(at_p, at_u, 2, lambda p, u: pu_quality.pu_gradient(p, u, prior), 2000, 0.05, 0.0)
    least = min(total(np.array([x, y]), 0.0) for x in np.linspace(-6, 6, 121) for y in np.linspace(-6, 6, 121))
    assert total(w, b) <= least + 0.01


def test_calibration_is_monotone_and_matches_densities():
    rng = np.random.default_rng(4)
    zp, zu = rng.normal(1, 1, 5000), np.concatenate([rng.normal(1, 1, 3000), rng.normal(-2, 1, 7000)])
    x, y = pu_quality.calibration(zp, zu, 0.3, bins=40)
    assert (np.diff(y) >= 0).all() and y.min() >= 0 and y.max() <= 1
    density = lambda z, m: np.exp(-((z - m) ** 2) / 2)
    for z in (-1.5, -0.5, 0.0, 1.0):
        assert np.interp(z, x, y) == pytest.approx(0.3 * density(z, 1) / (0.3 * density(z, 1) + 0.7 * density(z, -2)), abs=0.1)


def test_free_operators_take_columns_of_any_name(spark):
    d = odd(spark).withColumns({"a.b": F.lit(1), "row": F.lit(2)})
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    assert language_mixture.keep_identified(d).columns == d.columns and pu_quality.keep_good(d, labels).columns == d.columns
    assert simhash_tiles.keep_first(d).columns == d.columns
    named = d.withColumnsRenamed({"doc_id": "the.id", "text": "the.text"})
    assert license_scan.scan(named, id_col="the.id", text_col="the.text").count() == len(ODD)
    assert pitman_yor_lm.score_corpus(named, id_col="the.id", text_col="the.text").count() == len(ODD)


# Language model

def test_language_model_counts_and_gain(spark):
    rows = {r.doc_id: r for r in pitman_yor_lm.query(spark, SF).collect()}
    texts = {r.doc_id: [w.lower() for w in WORD.findall(r.text.encode())] + [None] for r in docs(spark).collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 5 == 1}
    counts = {}
    for i, ws in texts.items():
        if i not in held:
            for w in ws:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, ws in texts.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(ws), sum(w in counts for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
        assert r.score < 0
    total = lambda f, ids: sum(f(rows[i]) for i in ids)
    assert total(lambda r: r.score, held) > total(lambda r: r.base_score, held)
    assert total(lambda r: r.score, set(texts) - held) > 0.75 * total(lambda r: r.base_score, set(texts) - held)


def one_task(w, k, c, words, contexts, g, w_hash, k_hash, sweeps=4):
    """The sweeps of pitman_yor_lm.train with all pairs in one place: by sweep the tables of each pair, and the customers
    and tables of each word in the parent; and the sums after each."""
    t, root_t, out, steps = np.ones(len(c), np.int64), np.ones(words, np.int64), [], [g]
    for s in range(1, sweeps + 1):
        parent, tables = np.bincount(w, t, words).astype(np.int64), np.bincount(k, t, contexts).astype(np.int64)
        root_t = pitman_yor_lm.seat_parent(parent, root_t, steps[-1], w_hash, s)
        t = pitman_yor_lm.seat_pairs(c, t, tables[k], parent[w], root_t[w], steps[-1], pitman_yor_lm.both(w_hash[w], k_hash[k]), s)
        steps.append(pitman_yor_lm.Totals(g.tokens, g.words, g.discount, g.root_discount, float(t.sum()), float(root_t.sum())))
        out.append((t, parent, root_t))
    return out, steps


def counted_pairs(rng, contexts, words, n):
    word, context = rng.integers(0, words, n), rng.integers(0, contexts, n)
    keys, c = np.unique(word * contexts + context, return_counts=True)
    return keys // contexts, keys % contexts, c


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    contexts, words = 5, 40
    w, k, c = counted_pairs(rng, contexts, words, 300)
    known, w = np.unique(w, return_inverse=True)
    v = len(known)
    g = pitman_yor_lm.Totals(300, v, 0.6, 0.4, float(len(c)), float(v))
    kept, steps = one_task(w, k, c, v, contexts, g, rng.integers(0, 2**63, v).astype(np.uint64), rng.integers(0, 2**63, contexts).astype(np.uint64))
    for s, (t, parent, root_t) in enumerate(kept, 1):
        full_c, full_t = np.zeros((v + 1, contexts), int), np.zeros((v + 1, contexts), int)  # the last one is the unknown word
        full_c[w, k], full_t[w, k] = c, t
        at = np.arange((v + 1) * contexts)
        more = lambda x: np.append(x, 0)[at // contexts]
        p = pitman_yor_lm.probability(full_c.ravel(), full_t.ravel(), full_c.sum(0)[at % contexts], full_t.sum(0)[at % contexts], more(parent), more(root_t), steps[s - 1].n_root, steps[s].t_root, g)
        assert p.reshape(-1, contexts).sum(0) == pytest.approx(np.ones(contexts), abs=1e-12) and p.min() > 0
        assert (t >= 1).all() and (t <= c).all() and (root_t >= 1).all() and (root_t <= parent).all()


def test_seating_grows_like_the_process():
    keys = np.arange(2000, dtype=np.uint64)
    t = pitman_yor_lm.seat(np.full(2000, 400), lambda at, own: np.full(len(at), 2.0), 0.0, keys, 1)
    assert abs(t.mean() - (1 + sum(2 / (2 + i) for i in range(1, 400)))) < 0.3
    assert (pitman_yor_lm.seat(np.array([1, 2, 10**9]), lambda at, own: np.full(len(at), 5.0), 0.5, keys[:3], 1) <= [1, 2, 10**9]).all()


@pytest.mark.parametrize("n", [40, 120, 1500])
@pytest.mark.parametrize(("new", "discount", "more"), [(0.01, 0.8, 0.005), (3.0, 0.5, 0.4), (40.0, 0.0, 0.0), (0.5, 0.9, 0.9), (300.0, 0.6, 0.3)])
def test_runs_have_the_distribution_of_single_customers(n, new, discount, more):
    """Tables drawn by runs against the distribution of seating one by one, which is computed here."""
    p = np.zeros(n + 1)
    p[1] = 1.0
    at = np.arange(n + 1)
    for i in range(1, n):
        a = new + more * (at - 1)
        opens = np.where(at <= i, a / np.maximum(a + i - discount * at, 1e-9), 0)
        p = p * (1 - opens) + np.concatenate([[0], (p * opens)[:-1]])
    keys = np.random.default_rng(1).integers(0, 2**63, 20000).astype(np.uint64)
    got = np.bincount(pitman_yor_lm.seat(np.full(len(keys), n), lambda at, own: new + more * (own - 1), discount, keys, 3), minlength=n + 1) / len(keys)
    assert np.abs(np.cumsum(got) - np.cumsum(p)).max() < 0.02  # Kolmogorov's bound at 1e-4 is 0.016


@pytest.mark.parametrize(("n", "p"), [(1, 0.3), (7, 0.9), (40, 0.1), (40, 0.5), (500, 0.03), (2000, 0.6), (100000, 0.2)])
def test_binomial_by_hashes(n, p):
    keys = np.random.default_rng(2).integers(0, 2**63, 40000).astype(np.uint64)
    got = pitman_yor_lm.binomial(np.full(len(keys), n), np.full(len(keys), p), keys, 1, 5)
    k = np.arange(n + 1)
    mass = np.exp([math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) + x * math.log(p) + (n - x) * math.log1p(-p) for x in k])
    assert np.abs(np.cumsum(np.bincount(got, minlength=n + 1)) / len(keys) - np.cumsum(mass)).max() < 0.012 and got.max() <= n


def test_sweeps_against_the_enumerated_posterior():
    """All seatings of a tiny corpus, weighed exactly; seating side by side stays near."""
    strength, d, dr, v = 1.0, 0.6, 0.3, 3
    w, k, c = np.array([0, 0, 1, 2]), np.array([0, 1, 0, 1]), np.array([4, 3, 2, 5])

    def stirling(n, discount):
        s = np.zeros((n + 1, n + 1))
        s[1, 1] = 1.0
        for i in range(1, n):
            for j in range(1, i + 2):
                s[i + 1, j] = s[i, j - 1] + max(0.0, i - discount * j) * s[i, j]
        return s

    sd, sr = stirling(5, d), stirling(14, dr)
    rise = lambda n, step: np.prod([strength + step * j for j in range(n)]) if n else 1.0
    total = mean_t = mean_r = 0.0
    for t in np.ndindex(*c):
        t = np.array(t) + 1
        n = np.bincount(w, t, 3).astype(int)
        inner = np.prod([sd[x, y] for x, y in zip(c, t)]) * np.prod([rise(int(x), d) for x in np.bincount(k, t, 2)])
        for r in np.ndindex(*n):
            r = np.array(r) + 1
            weight = inner * np.prod([sr[x, y] for x, y in zip(n, r)]) * rise(int(r.sum()), dr) / rise(int(n.sum()), 1.0) * (1.0 / (v + 1)) ** int(r.sum())
            total, mean_t, mean_r = total + weight, mean_t + weight * t.sum(), mean_r + weight * r.sum()
    g = pitman_yor_lm.Totals(int(c.sum()), v, d, dr, 4.0, 3.0, strength)
    got_t, got_r = [], []
    for i in range(150):
        h = np.random.default_rng(i).integers(0, 2**63, 5).astype(np.uint64)
        for t, _, r in one_task(w, k, c, 3, 2, g, h[:3], h[3:], sweeps=24)[0][4:]:
            got_t.append(t.sum())
            got_r.append(r.sum())
    assert np.mean(got_t) == pytest.approx(mean_t / total, rel=0.1) and np.mean(got_r) == pytest.approx(mean_r / total, rel=0.1)


def brute_model(texts, train):
    """The scores of all texts by one_task and dictionaries: {id: log10 probability}."""
    pairs, of = {}, {}
    for i, ws in texts.items():
        of[i] = list(zip([*ws, None], ["", *ws], strict=True))
        if i in train:
            for pair in of[i]:
                pairs[pair] = pairs.get(pair, 0) + 1
    hash_of = lambda x: 1 if x is None else 0 if x == "" else xxhash.xxh64_intdigest(x)
    ws, ks = ({hash_of(pair[j]): None for pair in pairs} for j in (0, 1))
    w_at, k_at = ({h: n for n, h in enumerate(sorted(x))} for x in (ws, ks))
    order = sorted(pairs, key=lambda x: (hash_of(x[0]), hash_of(x[1])))
    w, k = np.array([w_at[hash_of(a)] for a, _ in order]), np.array([k_at[hash_of(b)] for _, b in order])
    c = np.array([pairs[x] for x in order])
    tokens = np.bincount(w, c)
    ratio = pitman_yor_lm.share_of_ones
    g = pitman_yor_lm.Totals(int(c.sum()), len(w_at), ratio((c == 1).sum(), (c == 2).sum()), ratio((tokens == 1).sum(), (tokens == 2).sum()), float(len(c)), float(len(w_at)))
    kept, steps = one_task(w, k, c, len(w_at), len(k_at), g, np.array(sorted(w_at), np.uint64), np.array(sorted(k_at), np.uint64))
    index = {x: n for n, x in enumerate(order)}
    out = {}
    for i, ps in of.items():
        total = 0.0
        for a, b in ps:
            p, j = 0.0, index.get((a, b))
            for s in range(2, 5):
                t, parent, root_t = kept[s - 1]
                at_w, at_k = w_at.get(hash_of(a)), k_at.get(hash_of(b))
                customers, tables = (0, 0) if at_k is None else (c[k == at_k].sum(), t[k == at_k].sum())
                p += pitman_yor_lm.probability(0 if j is None else c[j], 0 if j is None else t[j], customers, tables, 0 if at_w is None else parent[at_w], 0 if at_w is None else root_t[at_w], steps[s - 1].n_root, steps[s].t_root, g)
            total += math.log10(p / 3)
        out[i] = total
    return out, steps


@pytest.mark.parametrize("most", [4, 1 << 14])
def test_scores_are_those_of_one_task(spark, most):
    some = docs(spark).filter("length(text) < 900").limit(40)
    some = some.unionByName(some.limit(1).withColumn("doc_id", F.lit(10**6).cast("long")))
    texts = {r.doc_id: [x.decode() for x in WORD.findall(r.text.encode().lower())] for r in some.collect()}
    want, _ = brute_model(texts, {i for i in texts if zlib.crc32(str(i).encode()) % 5 != 1})
    got = {r.doc_id: r.score for r in pitman_yor_lm.score_corpus(some, most=most, holder_tokens=700).collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], rel=1e-8) for i in want)


def test_model_odd_rows_and_layout(spark):
    got = pitman_yor_lm.score_corpus(odd(spark)).collect()
    assert len(got) == len(ODD) and {r.doc_id: r.n_tokens for r in got}[1] == 1
    assert pitman_yor_lm.score_corpus(odd(spark, [])).count() == 0
    one = {r.doc_id: r for r in pitman_yor_lm.query(spark, SF).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        many = {r.doc_id: r for r in pitman_yor_lm.score_corpus(docs(spark).repartition(3), most=100, holder_tokens=4000).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for i, r in one.items():
        assert (r.base_score, r.score) == (pytest.approx(many[i].base_score, rel=1e-12), pytest.approx(many[i].score, rel=1e-12)) and r.n_known == many[i].n_known


def test_each_word_has_its_own_restaurant(spark):
    """Each of 3,000 words is always followed by its own word; what other words share must not show."""
    pairs = spark.createDataFrame([(i, f"a{i % 3000} b{i % 3000}") for i in range(18000)], "doc_id long, text string")
    held = [r.score for r in pitman_yor_lm.score_corpus(pairs, most=16).collect() if r.held_out]
    # log10 of 1 in 3,000 for the first word; the second and the end are nearly certain.
    assert len(held) > 2000 and sum(held) / len(held) > -3.9


def test_sums_pass_32_bits():
    """What holders send, owners add and reply, and states keep, beyond 2^32."""
    m = pitman_yor_lm
    keys, h = np.arange(3), np.sort(np.array([5, 1 << 63, 77, 123456789], np.uint64))
    big = np.array([5_000_000_000, 3, 1 << 40, 2**32], np.int64)
    rows = [r for sender in (0, 1) for r in m.ask(sender, m.ASK_WORDS, h, [big, big + 1], keys)]
    answered = [r for key in keys for r in m.answer_words(int(key), [(r[1], r[3], r[4]) for r in rows if r[0] == key])]
    for sender, first in ((0, 1), (1, 0)):
        customers, tokens, new = m.replies([(r[1], r[3], r[4]) for r in answered if r[0] == sender], h, 3, 3)
        assert customers.tolist() == (2 * big).tolist() and tokens.tolist() == (2 * big + 2).tolist() and set(new.tolist()) == {first}
    one = np.array([1, 1, 2], np.int64)
    holder = m.Holder(h, big, big, h[:2], np.array([3, 0, 0, 0]), np.array([0, 1, 0]), big[:3])
    again = m.Holder.of(holder.pack())
    assert again.c.tolist() == big[:3].tolist() and again.single.tolist() == again.tokens.tolist() == big.tolist()
    assert again.parent(one << 33).tolist() == (big + np.array([4 << 33, 0, 0, 0])).tolist()
    assert m.seats([(0, 1, m.squeeze(*(v.astype(m.SUM) for v in (big, big, big))))])[1][0].tolist() == big.tolist()


@pytest.mark.parametrize("n", [1000, 1024, 4096])
def test_batches_are_spread_over_holders(n):
    batches = np.array([part << 32 | k for part in range(4000) for k in range(20)], np.uint64)
    most = np.bincount(pitman_yor_lm.owner(batches, n), minlength=n).max()
    assert most <= 2 * len(batches) / n + 1 and pitman_yor_lm.place_of(int(batches[77]), n) == pitman_yor_lm.owner(batches, n)[77]


def test_word_salads_score_lower(spark):
    """Good texts with their words in another order, among texts that the model has not seen."""
    sf = SF.replace("0.001", "0.1")
    d, labels = (spark.read.parquet(f"{sf}/{t}.parquet").select(*c) for t, c in (("documents", ("doc_id", "text")), ("labels", ("doc_id", "quality"))))
    model = pu_quality.trained(d.filter(~pu_quality.held_out(F.col("doc_id"))), labels.filter(~pu_quality.held_out(F.col("doc_id"))))
    good = [r.text for r in d.join(labels.filter("quality = 1"), "doc_id").filter(pu_quality.held_out(F.col("doc_id"))).collect()]
    long = [t for t in good if len(t.split()) >= 50]
    rng = random.Random(4)
    salad = [" ".join(rng.sample(t.split(), len(t.split()))) for t in long]
    score = lambda texts: pu_quality.scores(model, np.array([pu_quality.features(t, model["tables"]) for t in texts]))
    own, mixed = score(long), score(salad)
    assert len(long) >= 500 and (score(good) >= 0.3).mean() > 0.99 and (mixed < own).mean() > 0.95 and (mixed >= 0.3).mean() < 0.2


def test_word_features_are_brute_force():
    texts = [b"The cat. A cat!", b"x y", b"the CAT"]
    h = lambda w: xxhash.xxh64_intdigest(w.lower())
    for t in texts:
        tokens = t.split()
        got = pu_quality.buckets(tokens)
        assert got["words"].tolist() == [h(w) >> 46 for w in tokens]
        assert got["pairs"].tolist() == [(h(a) * 0x9E3779B97F4A7C15 + h(b)) * 0xD6E8FEB86659FD93 % 2**64 >> 46 for a, b in zip(tokens, tokens[1:])]
        kind = lambda c: 0 if chr(c).islower() else 1 if chr(c).isupper() else 3 if chr(c) in ".!?" else 4
        shape = [6 * kind(w[0]) + kind(w[-1]) for w in tokens]
        assert got["shapes"].tolist() == [36 * a + b for a, b in zip(shape, shape[1:])]
    p = {k: np.bincount(np.concatenate([pu_quality.buckets(t.split())[k] for t in texts[:2]]), minlength=n) for k, n in pu_quality.SIZES.items()}
    u = {k: np.bincount(pu_quality.buckets(texts[2].split())[k], minlength=n) for k, n in pu_quality.SIZES.items()}
    tables = pu_quality.word_tables(p, u)
    share = lambda n, of, size: math.log((n + 1) / (of + size))
    want = [share(2, 6, 1 << 18) - share(1, 2, 1 << 18) if w == b"cat" else share(1, 6, 1 << 18) - share(1, 2, 1 << 18) for w in (b"the", b"cat")]
    assert pu_quality.word_features([b"the", b"cat"], tables)[0] == pytest.approx(20 + (share(1, 6, 1 << 18) + share(1, 6, 1 << 18) - 2 * share(1, 2, 1 << 18)) / 2, abs=0.5)
    assert len(want) == 2 and pu_quality.word_features([b"x", b"y"], tables)[3] == 0.0 and pu_quality.word_features([b"y", b"x"], tables)[3] == 1.0
    many = [b"The", b"cat."] * 30
    at = pu_quality.buckets(many)["shapes"].tolist()
    firsts, lasts = [a // 36 for a in at], [a % 36 for a in at]
    any_order = np.mean([tables["shapes"][36 * a + b] for a in firsts for b in lasts], dtype=float)
    assert pu_quality.word_features(many, tables)[4] == pytest.approx(1 + np.mean(tables["shapes"][at], dtype=float) - any_order)
    assert pu_quality.word_features(many[:30], tables)[4] == 0.0 and pu_quality.word_features([b"cat"] * 60, tables)[4] == pytest.approx(1.0)


def test_samples_do_not_depend_on_ids(spark):
    """Rows without ids, and rows that share one: samples are drawn by text as well, and stay bounded."""
    d = docs(spark)
    for odd_id in (F.lit(None).cast("long"), F.lit(7).cast("long")):
        langs, _ = language_mixture.learn(d.withColumn("doc_id", odd_id), 5)
        assert langs == ["de", "en", "es", "fr"]
    same = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 2000).cast("string")).alias("text"))
    labels = spark.createDataFrame([(7, 1)], "doc_id long, quality int")
    seen = []
    fit = pu_quality.fit
    try:
        pu_quality.fit = lambda p, u, s: seen.append((len(p), len(u))) or fit(p, u, s)
        pu_quality.trained(same, labels, 50, 100)
        pu_quality.trained(same.withColumn("doc_id", F.lit(None).cast("long")), labels, 50, 100)
    finally:
        pu_quality.fit = fit
    assert seen[0][0] == 50 and seen[1][0] == 0 and all(20 < u <= 100 for _, u in seen)


def test_repeated_rows_with_helpers_names(spark):
    names = ["__id", "__twin", "id", "twin", "row", "__first", "copies"]
    d = odd(spark, [(1, "a b c"), (1, "a b c"), (2, "a b c"), (None, "z"), (None, "z")]).withColumns({n: F.lit(1) for n in names})
    kept = simhash_tiles.keep_first(d)
    assert kept.columns == d.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "None"]


@pytest.mark.parametrize("tile", [4096, 8])
def test_tiles_of_agreeing_blocks_find_all_links(spark, tile):
    """Fingerprints around a few centres, many of which share most of their bits."""
    rng = random.Random(tile)
    centres = [rng.getrandbits(64) for _ in range(20)] + [0, (1 << 64) - 1]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 12))) for c in centres for _ in range(25)}
    fps |= {rng.getrandbits(64) & 0xFFFF00000000FFFF for _ in range(150)} | {rng.getrandbits(64) for _ in range(1500)}
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    d = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    seen = []
    found = simhash_tiles.block_links(d, 6, tile, compared=lambda t: seen.append(t) or t).collect()
    links = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in found]
    assert all((a ^ b).bit_count() <= 6 for a, b in links)
    every = sorted(fps)
    true = [(a, b) for i, a in enumerate(every) for b in every[i + 1 :] if (a ^ b).bit_count() <= 6]
    assert len(true) > 500 and components_of(every, links) == components_of(every, true)
    pairs = seen[0].selectExpr("sum(size(members) * (size(members) - 1) / 2) AS n").first().n
    assert tile < 4096 or pairs < len(every) ** 2 / 2 / 5


def test_any_two_within_the_radius_share_a_mask():
    rng = random.Random(8)
    for radius, agree in ((6, 2), (6, 3), (2, 1)):
        masks = simhash_tiles.agreeing_blocks(radius, agree)
        assert len(masks) == math.comb(radius + agree, agree) and sum(m.bit_count() for m in masks) == 64 * len(masks) * agree // (radius + agree)
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(radius + 1)))
            assert any(a & m == b & m for m in masks)
