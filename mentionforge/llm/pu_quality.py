"""A quality classifier by positive-unlabelled learning.

Trusted positives are texts labelled good; everything else is unlabelled web text, bad labels are not used. The share
of positives among the unlabelled (class prior) is estimated by the best-bin rule: the smallest ratio of the
unlabelled's to the positives' mass above a score, with the bins' confidence bounds added. With it the non-negative
unbiased risk, prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)), is minimised by a logistic
model over binned features of the whole text; its scores are made probabilities by the monotone ratio of the
positives' density, times the prior, to the unlabelled's.

Features are surface counts, and five of the words: by hash, how much commoner a text's words, and its pairs of words,
are among the positives than among the unlabelled; how likely the pairs of its words' shapes are among the positives
(a shape is how a word begins and ends), how much likelier than in any other order; and how many of its pairs no positive
has. Texts are in two halves, by a hash of the text, and each is measured against the counts of the half that it is not
in, so that no text is judged by its own words. Some unlabelled
texts are shown to the fit once more with their words in another order, so that it learns what order is worth.

Fitted on a bounded sample (``positives`` and ``unlabelled`` texts at most, by hash of id and text, equal rows being one)
on the driver, which gets 21 numbers a text and the tables of counts; every text is scored in its partition.

Edge cases: null and empty texts have the features of the empty text and a score; texts are measured whole, however
long; without trusted positives every score is the default prior; of several labels of a document the best counts;
repeated rows are scored each for itself; other columns may have any name and stay as they are; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionforge.llm.common import cut, fold, join_counted, quoted

POSITIVES = 10_000
UNLABELLED = 30_000
BINS = 12
DEFAULT_PRIOR = 0.5
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = bytes([*range(65, 91), *range(97, 123)])
DIGITS = b"0123456789"
MARKS = b"!?\"'();:,.-_/\\[]{}=+~^`@"

#: Buckets of words, and of pairs of words; classes of a word's first and last byte, and pairs of shapes.
WORD_BITS = 18
CLASSES = 6
SHAPES = CLASSES**2
SIZES = {"words": 1 << WORD_BITS, "pairs": 1 << WORD_BITS, "shapes": SHAPES**2}
BYTE_CLASS = np.array([5 if c > 127 else 0 if chr(c).islower() else 1 if chr(c).isupper() else 2 if chr(c).isdigit() else 3 if chr(c) in ".!?" else 4 for c in range(256)])
WORD_FEATURES = ("word_ratio", "pair_ratio", "shape_pairs", "new_pairs", "order")
#: Of the unlabelled texts one in so many is also shown to the fit with its words in another order, if it has so many words;
#: in fewer an order cannot be told.
SALAD = 8
ORDERED = 40
FEATURES = ("words", "word_length", "symbols", "capitals", "digits", "marks", "shouts", "bars", "distinct", "top_word", "neighbours", "same_lines", "line_words", "repeats", "wide", "odd_ends", *WORD_FEATURES)


def buckets(tokens: list[bytes]) -> dict[str, np.ndarray]:
    """The buckets of a text's words and pairs, A-Z lower-cased, and of its pairs of shapes."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, b" ".join(tokens).lower().split()), np.uint64, len(tokens))
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xD6E8FEB86659FD93)
    shape = CLASSES * BYTE_CLASS[list(map(itemgetter(0), tokens))] + BYTE_CLASS[list(map(itemgetter(-1), tokens))]
    shift = np.uint64(64 - WORD_BITS)
    return {"words": (h >> shift).astype(np.int64), "pairs": (pairs >> shift).astype(np.int64), "shapes": SHAPES * shape[:-1] + shape[1:]}


def word_tables(p: dict[str, np.ndarray], u: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Counts by bucket among positives and unlabelled to the logarithms that features add up, and which pairs are new."""
    share = lambda n: np.log((n + 1.0) / (n.sum() + len(n)))
    return {
        "words": (share(p["words"]) - share(u["words"])).astype(np.float32), "pairs": (share(p["pairs"]) - share(u["pairs"])).astype(np.float32),
        "shapes": share(p["shapes"]).astype(np.float32), "new": p["pairs"] == 0,
    }


def half_of(raw: bytes) -> int:
    """By the text alone, so that equal texts are in one half."""
    return xxhash.xxh64_intdigest(raw, 1) & 1


def word_features(tokens: list[bytes], tables: dict[str, np.ndarray] | None) -> tuple[float, ...]:
    """As WORD_FEATURES names them; mean logarithms are raised by 20, so that none is below 0. order is what the pairs of
    shapes are likelier than those of the same words in any order would be on average."""
    if tables is None or len(tokens) < 2:
        return (0.0,) * len(WORD_FEATURES)
    b = buckets(tokens)
    mean = lambda name: max(1e-6, 20.0 + float(tables[name][b[name]].mean(dtype=np.float64)))
    first, last = (np.bincount(x, minlength=SHAPES) / len(b["shapes"]) for x in np.divmod(b["shapes"], SHAPES))
    any_order = 20.0 + float(first @ tables["shapes"].reshape(SHAPES, SHAPES).astype(np.float64) @ last)
    shapes = mean("shapes")
    return mean("words"), mean("pairs"), shapes, float(tables["new"][b["pairs"]].mean()), max(1e-6, 1.0 + shapes - any_order) if len(tokens) >= ORDERED else 0.0


def in_other_order(text: str) -> str:
    """The words of a text in the order of their hashes."""
    tokens = text.split()
    return " ".join(tokens[i] for i in np.argsort([xxhash.xxh64_intdigest(f"{i}:{w}") for i, w in enumerate(tokens)], kind="stable"))


def features(text: str | None, tables: list[dict[str, np.ndarray]] | None = None, half: int | None = None) -> tuple[float, ...]:
    """Features of the whole text, as FEATURES names them. tables has for each half those that are counted on the other."""
    raw = (text or "").encode("utf-8", "replace")
    tokens = raw.split()
    n, size = len(tokens), max(1, len(raw))
    if not n:
        return (0.0,) * len(FEATURES)
    without = lambda chars: size - len(raw.translate(None, chars))
    counts = Counter(tokens)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = set(zip(tokens, tokens[1:], tokens[2:], strict=False))
    letters = max(1, without(LETTERS))
    return (
        np.log1p(n), (size - n) / n, without(SYMBOLS) / n, without(UPPER) / letters, without(DIGITS) / n, without(MARKS) / n, raw.count(b"!") / n, raw.count(b"|") / n,
        len(counts) / n**0.9, max(counts.values()) / n, sum(map(bytes.__eq__, tokens, tokens[1:])) / n, 1 - len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)),
        1 - len(windows) / max(1, n - 2), 1 - len(raw.decode("utf-8", "replace")) / size, sum(t[-1] in SYMBOLS for t in tokens) / n,
        *word_features(tokens, tables and tables[half_of(raw) if half is None else half]),
    )


def counted_words(sample: DataFrame) -> dict[tuple[int, int], dict[str, np.ndarray]]:
    """sample (trusted, text) to counts by bucket of each (trusted, half). The driver gets one row of at most
    2^WORD_BITS numbers for each of them and kind of bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, str], np.ndarray] = {}
        for b in batches:
            for trusted, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "replace")
                for kind, at in buckets(raw.split()).items():
                    total = sums.setdefault((trusted, half_of(raw), kind), np.zeros(SIZES[kind], np.int64))
                    np.add.at(total, at, 1)
        for (trusted, half, kind), total in sums.items():
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.repeat(pa.scalar(x, t), len(at)) for x, t in ((trusted, pa.int32()), (half, pa.int32()), (kind, pa.string()))] + [pa.array(at), pa.array(total[at])], names=["trusted", "half", "kind", "bucket", "n"])

    def one_row(key, table):
        n = np.zeros(SIZES[key[2].as_py()], "<i8")
        n[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
        return pa.table({"trusted": pa.array([key[0].as_py()], pa.int32()), "half": pa.array([key[1].as_py()], pa.int32()), "kind": [key[2].as_py()], "n": pa.array([n.tobytes()], pa.binary())})

    keys = ["trusted", "half", "kind"]
    found = sample.select("trusted", "text").mapInArrow(count, "trusted int, half int, kind string, bucket long, n long").groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    rows = found.groupBy(*keys).applyInArrow(one_row, "trusted int, half int, kind string, n binary").collect()
    out = {(t, h): {kind: np.zeros(size, np.int64) for kind, size in SIZES.items()} for t in (0, 1) for h in (0, 1)}
    for r in rows:
        out[r["trusted"], r["half"]][r["kind"]] = np.frombuffer(bytes(r["n"]), "<i8")
    return out


def feature_rows(sample: DataFrame, tables: list[dict[str, np.ndarray]]) -> DataFrame:
    """sample (trusted, text, at) to trusted, x, its features. Of one in SALAD of the unlabelled texts there is a second row,
    with trusted 2, of its words in another order."""
    shared = sample.sparkSession.sparkContext.broadcast(tables)  # two tables of 2^WORD_BITS entries, of words and pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for trusted, text, at in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                t = text.as_py() or ""
                rows.append((trusted, features(t, shared.value)))
                if trusted == 0 and at // 2 % SALAD == 0 and len(t.split()) >= ORDERED:
                    rows.append((2, features(in_other_order(t), shared.value, half_of(t.encode("utf-8", "replace")))))
            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int32(), pa.list_(pa.float64())))], names=["trusted", "x"])

    return sample.select("trusted", "text", "at").mapInArrow(run, "trusted int, x array<double>")


def spans(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Bin edges of each feature: quantiles, and of the non-zero values where most are zero."""
    edges = []
    for column in x.T:
        some = column[column > 0] if (column > 0).any() else column
        edges.append(np.unique(np.concatenate([[1e-12], np.quantile(some, np.linspace(0, 1, bins + 1)[1:-1])])))
    return edges


def one_hot(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The weight index of each feature's bin (rows x features)."""
    out, base = np.empty(x.shape, np.int64), 0
    for j, e in enumerate(edges):
        out[:, j] = base + np.searchsorted(e, x[:, j], "right")
        base += len(e) + 1
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def descend(at_p: np.ndarray, at_u: np.ndarray, width: int, gradient, rounds: int, rate: float, decay: float) -> tuple[np.ndarray, float]:
    """Adam on the weights of bins and a bias; gradient(z_p, z_u) gives the risk's derivatives by the scores."""
    w = np.zeros(width + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        gp, gu = gradient(w[at_p].sum(1) + w[-1], w[at_u].sum(1) + w[-1])
        g = decay * w
        for at, d in ((at_p, gp), (at_u, gu)):
            g[:-1] += np.bincount(at.ravel(), np.repeat(d, at.shape[1]), width)
            g[-1] += d.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w[:-1], float(w[-1])


def estimate_prior(z_p: np.ndarray, z_u: np.ndarray, delta: float = 0.1) -> float:
    """Best bin: over cuts of the score, the least (U mass above) / (P mass above) plus its confidence width."""
    cuts = np.quantile(z_p, np.linspace(0.0, 0.95, 200))
    q_p = 1 - np.searchsorted(np.sort(z_p), cuts, "left") / len(z_p)
    q_u = 1 - np.searchsorted(np.sort(z_u), cuts, "left") / len(z_u)
    width = np.sqrt(np.log(4 / delta) / 2 / len(z_u)) + np.sqrt(np.log(4 / delta) / 2 / len(z_p))
    best = int(np.argmin(q_u / q_p + width / q_p))
    return float(np.clip(q_u[best] / q_p[best], 0.01, 0.99))


def calibration(z_p: np.ndarray, z_u: np.ndarray, prior: float, bins: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing function prior * density of P / density of U of the score, at most 1: neighbouring
    bins whose ratios fall are pooled."""
    edges = np.unique(np.quantile(np.concatenate([z_p, z_u]), np.linspace(0, 1, bins + 1)))
    at_p, at_u = (np.bincount(np.searchsorted(edges[1:-1], z, "right"), minlength=max(1, len(edges) - 1)) for z in (z_p, z_u))
    pools: list[list[float]] = []
    for j, (a, b) in enumerate(zip(prior * at_p / len(z_p), at_u / len(z_u), strict=True)):
        pools.append([a, b, j, j])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            a, b, _, end = pools.pop()
            pools[-1] = [pools[-1][0] + a, pools[-1][1] + b, pools[-1][2], end]
    x, y = [], []
    for a, b, j, k in pools:
        x += [edges[j], edges[min(k + 1, len(edges) - 1)]]
        y += [min(1.0, a / b) if b else 1.0] * 2
    return np.array(x), np.array(y)


def pu_risks(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the unbiased risk with the logistic loss: of the positives, and of the negatives, which is
    estimated as that of all less the positives' share and may come out below zero."""
    return prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()


def pu_gradient(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """The non-negative risk's derivatives by the scores; where the negatives' part is below zero, the way back up."""
    if pu_risks(zp, zu, prior)[1] < 0:
        return prior * sigmoid(zp) / len(zp), -sigmoid(zu) / len(zu)
    return prior * (sigmoid(zp) - 1) / len(zp) - prior * sigmoid(zp) / len(zp), sigmoid(zu) / len(zu)


def fit(x_p: np.ndarray, x_u: np.ndarray, x_salad: np.ndarray | None = None, bins: int = BINS, rounds: int = 500, rate: float = 0.05, decay: float = 1e-4) -> dict:
    """The model: edges, weights, bias, prior. x_salad, features of texts without an order, count among the unlabelled
    while the risk is minimised and scores are calibrated; the prior is that of x_u."""
    if not len(x_p) or not len(x_u):
        return {"edges": [], "weights": np.zeros(0), "bias": float(np.log(DEFAULT_PRIOR / (1 - DEFAULT_PRIOR))), "prior": DEFAULT_PRIOR}
    salad = x_u[:0] if x_salad is None else x_salad
    edges = spans(np.concatenate([x_p, x_u, salad]), bins)
    width = sum(len(e) + 1 for e in edges)
    at_p, at_u, at_all = one_hot(x_p, edges), one_hot(x_u, edges), one_hot(np.concatenate([x_u, salad]), edges)
    # Positives against unlabelled, on halves: the other halves estimate the prior.
    w, b = descend(at_p[::2], at_u[::2], width, lambda zp, zu: ((sigmoid(zp) - 1) / len(zp), sigmoid(zu) / len(zu)), rounds // 2, rate, decay)
    score = lambda at: w[at].sum(1) + b
    prior = estimate_prior(score(at_p[1::2]), score(at_u[1::2])) if len(x_p) > 1 and len(x_u) > 1 else DEFAULT_PRIOR

    share = prior * len(at_u) / len(at_all)
    w, b = descend(at_p, at_all, width, lambda zp, zu: pu_gradient(zp, zu, share), rounds, rate, decay)
    return {"edges": edges, "weights": w, "bias": b, "prior": prior, "points": calibration(score(at_p), score(at_all), share)}


def scores(model: dict, x: np.ndarray) -> np.ndarray:
    z = np.full(len(x), model["bias"])
    if model["edges"]:
        z += model["weights"][one_hot(x, model["edges"])].sum(1)
        return 0.99 * np.interp(z, *model["points"]) + 0.01 * sigmoid(z)  # the second part keeps the order within a pool
    return sigmoid(z)


def trained(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> dict:
    """Learns from docs (doc_id, text) and labels (doc_id, quality)."""
    below = lambda wanted, n: F.lit(min(1.0, wanted / max(1, n)) * (1 << 60))
    good = labels.groupBy(F.col("doc_id").alias("of")).agg(F.max("quality").alias("q")).filter("q = 1 AND of IS NOT NULL").select("of")
    at_id = F.pmod(F.xxhash64(F.lit("good"), "of"), F.lit(1 << 60))
    some = cut(good.filter(at_id < below(positives, good.count())).select(F.col("of").alias("doc_id"), F.lit(True).alias("good")), few=True)
    d = docs.select("doc_id", "text").withColumn("at", F.pmod(F.xxhash64(F.lit("web"), "doc_id", "text"), F.lit(1 << 60)))
    d = join_counted(d, some, ["doc_id"]).withColumn("web", F.col("at") < below(unlabelled, docs.count())).filter("good OR web")
    # A text may be in both samples. Rows that repeat an id and a text are one.
    both = F.filter(F.array(F.when(F.col("good"), 1), F.when(F.col("web"), 0)), lambda x: x.isNotNull())
    sample = d.select(F.explode(both).alias("trusted"), "at", "text").dropDuplicates(["trusted", "at"])
    sample = cut(sample)
    # An id's rows that have many texts may all be good: the bound holds for them, too. Only numbers meet in one task.
    inside = F.lit(False)
    for kind, n in ((1, positives), (0, unlabelled)):
        last = sample.filter(F.col("trusted") == kind).select("at").orderBy("at").limit(n).agg(F.max("at")).first()[0]
        inside = inside | ((F.col("trusted") == kind) & (F.col("at") <= F.lit(last)))
    sample = sample.filter(inside)
    counts = counted_words(sample)
    tables = [word_tables(counts[1, 1 - half], counts[0, 1 - half]) for half in (0, 1)]
    x = feature_rows(sample, tables).toArrow()  # len(FEATURES) numbers a row, as numbers all the way
    rows, kind = x.column("x").combine_chunks().flatten().to_numpy().reshape(len(x), len(FEATURES)), x.column("trusted").to_numpy()
    order = np.lexsort([*rows.T, kind])  # the same order in every run
    rows, kind = rows[order], kind[order]
    shuffle = np.random.default_rng(7).permutation(len(rows))
    rows, kind = rows[shuffle], kind[shuffle]
    return fit(*(rows[kind == k] for k in (1, 0, 2))) | {"tables": tables}


#: Rows of a batch that are worked on, and sent back, at a time.
STEP = 512


def score_texts(rows: DataFrame, model: dict, text: tuple[str, ...], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of rows with quality_score; text is the path to a string column."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers, and tables of 2^WORD_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), STEP):
                b = batch.slice(at, STEP)
                texts = b.column(text[0])
                for field in text[1:]:
                    texts = pc.struct_field(texts, field)
                x = np.array([features(t.as_py(), shared.value["tables"]) for t in texts], np.float64).reshape(len(b), len(FEATURES))
                yield pa.record_batch([*(b.column(c) for c in keep), pa.array(scores(shared.value, x))], names=[*keep, "quality_score"])

    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in keep), T.StructField("quality_score", T.DoubleType())]))


def held_out(doc_id):
    return fold(doc_id) == 0


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the rows that are not held out."""
    d = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    model = trained(d.filter(~held_out(F.col("doc_id"))), labels.filter(~held_out(F.col("doc_id"))))
    found = score_texts(d.withColumn("held_out", held_out(F.col("doc_id"))), model, ("text",), ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", F.col("quality_score").alias("score"), (F.col("quality_score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs whose score reaches the threshold."""
    model = trained(docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(~held_out(F.col("doc_id"))), labels.filter(~held_out(F.col("doc_id"))))
    keyed = docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"))
    return score_texts(keyed, model, ("row", "text"), ["row"]).filter(F.col("quality_score") >= threshold).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score_documents(docs, labels)
