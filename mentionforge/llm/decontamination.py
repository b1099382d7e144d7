"""Benchmark decontamination: a broadcast hash set of the test items' word windows, scanned over the corpus.

Words are runs of letters, digits and non-ASCII characters, with A-Z lower-cased. A test item's windows are its runs of
``window`` consecutive words (a shorter item is one window). The windows' 64-bit hashes are broadcast, with the windows'
own words; every text's windows are hashed by numpy, looked up in a bit table, then in the sorted hashes, and each hit is
verified word by word, so that no collision counts. Contaminated spans are cut out of texts, or contaminated texts dropped.

The broadcast is bounded: the (window, item) pairs are counted and dealt by hash to blocks of at most BLOCK_PAIRS pairs
and BLOCK_BYTES bytes on average, and the corpus is scanned once for each block (for one block, with no shuffle and no
intermediate files at all); what the blocks find in a text is united.

Edge cases: a null text has no words and is clean; a null, empty or wordless item has no windows; item ids are compared as
text, a null id as the empty text, and items that share an id are one item; a window of several items counts for each;
repeated rows are judged each for itself; texts are scanned whole, in overlapping pieces of CHUNK bytes, however long;
other columns may have any name and stay as they are; an empty table on either side gives a result without hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import re
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mentionforge.llm.common import cut, quoted, whole

WINDOW = 10
BLOCK_PAIRS = 200_000
BLOCK_BYTES = 32 << 20
CHUNK = 1 << 20
#: Bits of a hash by which the bit table is addressed: 4 MB.
FILTER_BITS = 22
NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Of each byte what words are made of: itself, or its lower-case letter, or a space.
FOLDED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())
FOUND = "struct<n_words:bigint,n_hit:bigint,spans:array<struct<first:bigint,last:bigint>>,items:array<string>>"
ARROW_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), ("items", pa.list_(pa.string()))])


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A polynomial of the words' hashes, modulo 2^64, for each window of ``length`` words."""
    n = len(hashes) - length + 1
    out = hashes[:n].copy()
    for j in range(1, length):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[j : j + n]
    return out


class WindowIndex:
    """The windows of one block: sorted hashes, their words, and their items."""

    def __init__(self, pairs: list[tuple[bytes, str]]):
        texts: dict[bytes, list[str]] = {}
        for window, item in pairs:
            texts.setdefault(window, []).append(item)
        self.names = sorted({item for _, item in pairs})
        number = {name: k for k, name in enumerate(self.names)}
        split = [t.split(b" ") for t in texts]
        self.lengths = sorted({len(w) for w in split})
        hashes = np.fromiter((int(window_hashes(word_hashes(w), len(w))[0]) for w in split), np.uint64, len(split))
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        in_order = [list(texts)[k] for k in order]
        self.texts = b"".join(in_order)
        self.ends = np.cumsum([0, *map(len, in_order)])
        self.items = np.array([number[i] for t in in_order for i in texts[t]], np.int32)
        self.item_ends = np.cumsum([0, *(len(texts[t]) for t in in_order)])
        self.bits = np.zeros(1 << FILTER_BITS, bool)
        self.bits[self.hashes >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """Verified occurrences: first word, words, number of the window."""
        hashes = word_hashes(words)
        for length in self.lengths:
            if length > len(words):
                return
            w = window_hashes(hashes, length)
            at = np.flatnonzero(self.bits[w >> np.uint64(64 - FILTER_BITS)])
            low, high = (np.searchsorted(self.hashes, w[at], side) for side in ("left", "right"))
            for p, a, b in zip(*(x[low < high].tolist() for x in (at, low, high)), strict=True):
                text = b" ".join(words[p : p + length])
                for g in range(a, b):
                    if self.texts[self.ends[g] : self.ends[g + 1]] == text:
                        yield p, length, g

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """The number of words, the spans of hit words (first, one after the last), the items."""
        folded, longest = text.translate(FOLDED), max(self.lengths, default=1)
        n, at, spans, windows = 0, 0, [], set()
        carried: list[bytes] = []
        while at < len(folded):
            end = folded.find(b" ", at + CHUNK)
            end = len(folded) if end < 0 else end
            words = carried + folded[at:end].split()
            before = n - len(carried)
            for p, length, g in self.hits(words):
                spans.append((before + p, before + p + length))
                windows.add(g)
            n, at = before + len(words), end
            carried = words[len(words) - longest + 1 :] if longest > 1 and len(words) >= longest else words if longest > 1 else []
        items = {int(i) for g in windows for i in self.items[self.item_ends[g] : self.item_ends[g + 1]]}
        return n, united(spans), {self.names[i] for i in items}


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without its hit words and what stands between words of one span."""
    if not spans:
        return text
    firsts, lasts = {a for a, _ in spans}, {b - 1 for _, b in spans}
    kept, at = [], 0
    for k, m in enumerate(WORD.finditer(text)):
        if k in firsts:
            kept.append(text[at : m.start()])
        if k in lasts:
            at = m.end()
    return b"".join([*kept, text[at:]])


def item_windows(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (window, item), with A-Z lower-cased and one space between words."""
    item = F.coalesce(benchmark[quoted(item_col)].cast("string"), F.lit(""))
    words = F.filter(F.split(F.translate(whole(benchmark[quoted(text_col)]), UPPER, LOWER), NO_WORD), lambda w: w != "")
    d = benchmark.select(item.alias("item"), words.alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return d.select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, window), " "))).alias("window")).distinct()


def blocks(benchmark: DataFrame, window: int, item_col: str, text_col: str, pairs: int) -> Iterator[WindowIndex]:
    """The test windows, a bounded number at a time."""
    found = cut(item_windows(benchmark, window, item_col, text_col))
    n, size = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("window") + F.octet_length("item") + 32), F.lit(0))).first()
    many = max(1, -(-n // pairs), -(-size // BLOCK_BYTES))
    for k in range(many):
        part = found.filter(F.pmod(F.xxhash64("window", "item"), F.lit(many)) == k).toArrow()
        yield WindowIndex([(w.encode(), i) for w, i in zip(part["window"].to_pylist(), part["item"].to_pylist(), strict=True)])


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", pairs: int = BLOCK_PAIRS) -> DataFrame:
    """row (a struct of docs' columns), found (a struct of n_words, n_hit, spans, items in ascending order)."""
    at = docs.columns.index(text_col)
    d = docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"), F.lit(None).cast(FOUND).alias("found"))
    schema = StructType().add("row", d.schema["row"].dataType).add("found", d.schema["found"].dataType)
    for k, block in enumerate(blocks(benchmark, window, item_col, item_text_col, pairs)):
        if k:
            d = cut(d)  # one block's scan at a time
        d = d.mapInArrow(scanner(docs.sparkSession.sparkContext.broadcast(block), at), schema)
    return d


def scanner(block, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: WindowIndex = block.value
        for b in batches:
            texts, out = pc.struct_field(b.column(0), [at]), []
            for text, before in zip(texts, b.column(1).to_pylist(), strict=True):
                n, spans, items = windows.scan(text.as_buffer().to_pybytes()) if text.is_valid else (0, [], set())
                if before:
                    spans = united(spans + [(s["first"], s["last"]) for s in before["spans"]])
                    items |= set(before["items"])
                out.append({"n_words": n, "n_hit": sum(y - x for x, y in spans), "spans": [{"first": x, "last": y} for x, y in spans], "items": sorted(items)})
            yield pa.record_batch([b.column(0), pa.array(out, ARROW_FOUND)], names=["row", "found"])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", text_col: str = "text", **options) -> DataFrame:
    """docs without what they share with the benchmark: ``remove`` names what goes, spans or whole documents."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be spans or documents, not {remove}")
    found = scan(docs, benchmark, text_col=text_col, **options)
    if remove == "documents":
        return found.filter("found.n_hit = 0").select("row.*")
    at, row = docs.columns.index(text_col), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns, found = b.column(0).flatten(), b.column(1).to_pylist()
            texts = [without_spans(t.as_buffer().to_pybytes(), [(s["first"], s["last"]) for s in f["spans"]]).decode() if t.is_valid else None for t, f in zip(columns[at], found, strict=True)]
            columns[at] = pa.array(texts, pa.string())
            yield pa.record_batch([pa.StructArray.from_arrays(columns, fields=list(b.column(0).type))], names=["row"])

    return found.mapInArrow(run, StructType().add("row", row)).select("row.*")


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(docs.select(docs[quoted(id_col)].alias("doc_id"), docs[quoted(text_col)].cast("string").alias("text")), benchmark, **options)
    names: Column = F.array_join("found.items", ",")
    return found.select("row.doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"), F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.col("found.n_hit") > 0).alias("contaminated"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return report(docs, benchmark)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
tests AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM starts),
lengths AS (SELECT DISTINCT n FROM tests),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths),
found AS (SELECT p.doc_id, p.i, p.n, t.item_id FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM places) p JOIN tests t USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
