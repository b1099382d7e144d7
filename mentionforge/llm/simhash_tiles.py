"""Near duplicates by SimHash: tiled exact comparison.

Every text gets a 64-bit fingerprint. Distinct fingerprints are cut into tiles by the population counts of their
``parts`` equal parts (four quarters by default): two fingerprints differ in at least as many bits as these counts
differ in sum, so tile pairs whose counts differ beyond the radius are skipped, and all others are compared exactly with
numpy's exclusive-or and bit counts. A tile has a bounded number of fingerprints; each tile pair gives only a spanning
forest of its links, which keeps all connections without listing all pairs of a group. Where the radius is so wide that
counts skip little (keep_first), the tiles are of fingerprints that agree in some blocks of bits, as all within the radius
do in one choice of blocks or more; so the compared pairs do not grow with the square of the corpus. Components follow by minimum
labels over the (few) links. Classes are named by fingerprints while they are found, and by ids only at the end.

Edge cases: null and empty texts have fingerprint zero and are linked like any other; texts are read whole, however long
(a text's hashes are held by one task); repeated rows keep their rows; rows with a null id connect others like any row
and are labelled by the smallest id they are linked to, or null where no id is; ids may be of any type that has an
order; only the id and the text are read, so other columns of any name do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionforge.llm.common import ROWS_A_FILE, cut, join_counted, partitions, quoted, whole

WIDTH = 3
SEED = 42
RADIUS = 2
#: Fingerprints in a tile at most, about.
TILE = 4096
PARTS = 4


def text_hashes(text: bytes, width: int, seed: int) -> np.ndarray:
    """XXH64 of the shingles of the words of a text whose A-Z are lower-cased, repeats included."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, "<u8")
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    n = max(1, len(tokens) - width + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    ends = ends[-n:].tolist()
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)]), ">u8").astype("<u8")


def simhash(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes."""
    if not len(hashes):
        return 0
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def twin(text: Column) -> Column:
    """What rows with equal texts share."""
    return F.xxhash64(whole(text))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, seed: int = SEED, distinct: bool = False) -> DataFrame:
    """doc_id, twin, fp (the fingerprint as a signed long) of every row; distinct: repeats of a shingle do not count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = (text_hashes(t.as_buffer().to_pybytes(), width, seed) for t in b.column(2))
            fps = [simhash(np.unique(h) if distinct else h) for h in hashes]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())], names=["doc_id", "twin", "fp"])

    text, id_of = docs[quoted(text_col)], docs[quoted(id_col)]
    return docs.select(id_of.alias("doc_id"), twin(text).alias("twin"), whole(text).cast("binary").alias("text")).mapInArrow(run, f"doc_id {dict(docs.dtypes)[id_col]}, twin long, fp long")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links (a[i], b[i]) those of a spanning forest: in rounds, each tree is hung on a smaller neighbour."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, x, y, kept = np.arange(len(nodes)), *np.split(ends, 2), []
    links = np.arange(len(a))
    while len(links):
        high, low = np.maximum(root[x[links]], root[y[links]]), np.minimum(root[x[links]], root[y[links]])
        apart = high != low
        links, high, low = links[apart], high[apart], low[apart]
        high, first = np.unique(high, return_index=True)
        kept.append(links[first])
        root[high] = low[first]
        while (root != root[root]).any():
            root = root[root]
    at = np.concatenate(kept) if kept else links
    return a[at], b[at]


def tile_links(fa: np.ndarray, ia: np.ndarray, fb: np.ndarray, ib: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles, or within one."""
    left, right, step = [], [], max(1, (1 << 20) // max(1, len(fb)))
    for at in range(0, len(fa), step):
        near = np.bitwise_count(fa[at : at + step, None] ^ fb[None, :]) <= radius
        x, y = np.nonzero(near)
        if same:
            up = x + at < y
            x, y = x[up], y[up]
        if len(x):
            x, y = forest(ia[x + at], ib[y])
            left.append(x)
            right.append(y)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(np.concatenate(left), np.concatenate(right))


def offsets(radius: int, parts: int = PARTS) -> list[list[int]]:
    """Differences of the parts' counts that are at most the radius in sum; one of each and its opposite."""
    found = [()]
    for _ in range(parts):
        found = [(*o, d) for o in found for d in range(-radius, radius + 1) if sum(map(abs, (*o, d))) <= radius]
    return [list(o) for o in found if o >= (0,) * parts]


def links(reps: DataFrame, radius: int = RADIUS, tile: int = TILE, rows: int | None = None, parts: int = PARTS) -> DataFrame:
    """reps (fp), distinct, to a, b: enough links between fingerprints to connect all that is linked."""
    width = 64 // parts
    mask = F.lit((1 << width) - 1 if parts > 1 else -1).cast("long")
    counts = [F.bit_count(F.shiftrightunsigned("fp", width * q).bitwiseAND(mask)).cast("int") for q in range(parts)]
    code = lambda c: sum((x * (width + 1) ** q for q, x in enumerate(c)), F.lit(0))
    own = [F.col(f"c{q}") for q in range(parts)]
    d = reps.withColumns({f"c{q}": c for q, c in enumerate(counts)}).withColumn("cell", code(own))
    # At most (64 / parts + 1) ^ parts cells (83,521 of quarters), so their counts are bounded.
    cells = cut(d.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("blocks")), few=True)
    d = d.join(F.broadcast(cells), "cell").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    tiles = cut(d.groupBy("cell", "block").agg(*[F.first(f"c{q}").alias(f"c{q}") for q in range(parts)], F.collect_list("fp").alias("members")), rows)
    moves = F.array(*[F.array(*[F.lit(x) for x in o]) for o in offsets(radius, parts)])
    target = [F.col(f"c{q}") + F.get("m", F.lit(q)) for q in range(parts)]
    inside = F.lit(True)
    for t in target:
        inside = inside & t.between(0, width)
    # A tile goes, as a guest, to each block of each cell near enough, so a full cell's tiles meet all over the cluster.
    guest = tiles.select("cell", "block", "members", *own, F.explode(moves).alias("m")).filter(inside)
    guest = guest.select(code(target).alias("host"), F.col("cell").alias("cell_b"), F.col("block").alias("block_b"), F.col("members").alias("fb"))
    guest = guest.join(F.broadcast(cells.withColumnRenamed("cell", "host")), "host")
    guest = guest.withColumn("host_block", F.explode(F.sequence(F.lit(0), F.when(F.col("host") == F.col("cell_b"), F.col("block_b")).otherwise(F.col("blocks") - 1)))).drop("blocks")
    pairs = tiles.join(guest, (tiles["cell"] == guest["host"]) & (tiles["block"] == guest["host_block"]))
    pairs = pairs.select(((F.col("cell") == F.col("cell_b")) & (F.col("block") == F.col("block_b"))).alias("same"), F.col("members").alias("fa"), "fb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[np.ndarray, np.ndarray]] = []
            for same, fa, fb in zip(*(b.column(i) for i in range(3)), strict=True):
                fa, fb = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (fa, fb))
                out.append(tile_links(fa, fa.view(np.int64), fb, fb.view(np.int64), same.as_py(), radius))
            left, right = (np.concatenate([o[i] for o in out]) if out else np.empty(0, np.int64) for i in (0, 1))
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def agreeing_blocks(radius: int, agree: int) -> list[int]:
    """Masks of 64 bits: of radius + agree blocks all choices of ``agree``. Of two fingerprints that differ in ``radius`` bits
    at most, that many blocks at most differ, so they agree under one mask or more."""
    parts = radius + agree
    ends = [64 * i // parts for i in range(parts + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(ends, ends[1:])]
    return [sum(chosen) for chosen in combinations(block, agree)]


def block_links(reps: DataFrame, radius: int, tile: int = TILE, agree: int = 2, compared: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """As links(), for radii at which population counts skip little: tiles hold the fingerprints that agree in some blocks
    of bits. A value under a mask that more than ``tile`` fingerprints share is cut into blocks by hash, of which each pair is
    a tile. ``compared`` sees the tiles (members, a, b)."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("value")) for i, m in enumerate(agreeing_blocks(radius, agree))])
    d = reps.select("fp", F.explode(keys).alias("k")).select("fp", "k.mask", "k.value")
    many = cut(d.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile).select("mask", "value", F.ceil(F.col("n") / tile).alias("blocks")))
    d = join_counted(d, many, ["mask", "value"]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    d = d.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    d = d.groupBy("mask", "value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")).agg(F.collect_list(F.struct("fp", "own")).alias("members"))
    tiles = compared(d.filter(F.size("members") > 1).select("members", "a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, np.ndarray]] = []
            for members, a, b in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                fps, own = (members.values.field(c).to_numpy() for c in ("fp", "own"))
                left, right = fps[own == a], fps[own == b]
                out.append(tile_links(left.view(np.uint64), left, right.view(np.uint64), right, a == b, radius))
            left, right = (np.concatenate([o[i] for o in out]) if out else np.empty(0, np.int64) for i in (0, 1))
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return tiles.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """Links a, b to node, label: the smallest node that each node of a link is connected with.

    Rounds of alternating big and small stars (each node's larger neighbours, then the others, are hung on its
    smallest neighbour) until nothing changes; each round's links are checkpointed. A hub's links are not dealt by the
    hub: its smallest neighbour is sent to them where they lie, or to salts.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), rows)
    n, sign = sum_of(e)
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), 2 * n)
        big = join_counted(both, least, ["u"], "inner").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        e = cut(big.union(least.filter("m < u").select("u", F.col("m").alias("v"))).distinct(), n)
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        small = join_counted(e, least, ["u"], "inner").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        # Links are never more than before; a few of them need not lie in as many files as the whole corpus.
        e = cut(e, n)
        was, (n, sign) = (n, sign), sum_of(e)
        if was == (n, sign):
            return e.select(F.col("u").alias("node"), F.col("v").alias("label"))


def sum_of(links: DataFrame) -> tuple[int, int]:
    """How many links there are, and the sum of their hashes."""
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def named(sigs: DataFrame, n: int, radius: int, tile: int, parts: int, agree: int = 0) -> DataFrame:
    """One row a fingerprint: of, first (struct of is_null, doc_id, twin: the first row of its class by these)."""
    own = F.struct(F.col("doc_id").isNull().alias("is_null"), "doc_id", "twin")
    reps = cut(sigs.groupBy("fp").agg(F.min(own).alias("first")), n)
    found = block_links(reps.select("fp"), radius, tile, agree) if agree else links(reps.select("fp"), radius, tile, n, parts)
    found = components(found, n)
    found = found.union(found.select(F.col("label").alias("node"), "label").distinct())
    linked = cut(found.join(reps, found["node"] == reps["fp"]).select("node", "label", "first"), n)
    labels = linked.groupBy("label").agg(F.min("first").alias("least"))
    linked = join_counted(linked.select("node", "label"), labels, ["label"], "inner").select("node", "least")
    return reps.join(linked, reps["fp"] == linked["node"], "left").select(F.col("fp").alias("of"), F.coalesce("least", "first").alias("first"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, width: int = WIDTH, seed: int = SEED, tile: int = TILE, parts: int = PARTS, distinct: bool = False) -> DataFrame:
    """Per row: doc_id, fp, component_id (the smallest id among all that it is linked with)."""
    sigs = cut(signatures(docs, id_col, text_col, width, seed, distinct))
    n = sigs.count()
    names = named(sigs, n, radius, tile, parts).select("of", F.col("first.doc_id").alias("component_id"))
    names = cut(names.repartition(max(1, min(partitions(docs), n // ROWS_A_FILE))))
    # Both sides are read as they lie and dealt by fingerprint; a hot fingerprint's rows can be split.
    return sigs.join(names, sigs["fp"] == names["of"], "left").select("doc_id", "fp", "component_id")


#: Fixed by measurement, for keep_first: fingerprints of distinct words, of which near copies (a similarity of 0.8 of
#: five-word shingles) differ in at most six bits in 96 of 100 cases, and unrelated texts in about thirty. At this radius
#: tiles are of fingerprints that agree in two of eight blocks.
LOOSE = {"radius": 6, "width": 1, "distinct": True, "agree": 2}


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class of docs: that with the smallest id, of several that with the least hash of its text, and of
    rows that are equal in both one. Options as of classes(), from LOOSE on."""
    o = {"seed": SEED, "tile": TILE, "parts": PARTS} | LOOSE | options
    sigs = cut(signatures(docs, id_col, text_col, o["width"], o["seed"], o["distinct"]))
    n = sigs.count()
    first = named(sigs, n, o["radius"], o["tile"], o["parts"], o["agree"]).select("first.doc_id", "first.twin").distinct()
    copies = sigs.groupBy("doc_id", "twin").agg(F.count("*").alias("copies"))
    kept = cut(first.join(copies, first["doc_id"].eqNullSafe(copies["doc_id"]) & (first["twin"] == copies["twin"])).select(first["doc_id"].alias("__first"), first["twin"].alias("__first_twin"), "copies"), n)
    # The rows go as one struct, whose fields may have any names.
    keyed = docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"), docs[quoted(id_col)].alias("id"), twin(docs[quoted(text_col)]).alias("twin"))
    chosen = lambda some: keyed.join(some, keyed["id"].eqNullSafe(some["__first"]) & (keyed["twin"] == some["__first_twin"]), "left_semi")
    once = chosen(kept.filter("copies = 1")).select("row.*")
    if kept.filter("copies > 1").isEmpty():
        return once
    # Only rows that occur more than once are gathered to pick one of them.
    return once.union(chosen(kept.filter("copies > 1")).dropDuplicates(["id", "twin"]).select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
