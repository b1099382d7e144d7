"""A hierarchical Pitman-Yor language model over the words of a corpus.

Each context (the word before, or the start of a text) is a restaurant of its own; contexts share one parent restaurant
over words, whose base is uniform over the learned words and one unknown. Customers are the training tokens; seating is
sampled by Gibbs: in each sweep the customers of a dish leave their restaurant and are seated anew, one after the other,
by the Chinese-restaurant rule. A new table sends a customer to the parent. Within a sweep all dishes are seated side by
side: what they share (a context's tables, a word's customers in the parent, the parent's sums) is as the sweep before
left it, less the dish's own. Customers are seated by runs of one RUN-th of those that sit already (the first 2 RUN of
them one by one): how many of a run open tables is one binomial draw at the probability of the run's middle, so a dish of
any size takes a number of draws that grows with the logarithm of its customers. The predictive probabilities of the kept sweeps are averaged, and a text's score is the sum of their logarithms.

Nothing depends on how rows lie: counts and tables are whole numbers, every draw is a hash of the word, its context, the
sweep and the customer, and logarithms are added as fixed-point numbers.

How it is laid out: pairs (word, context) are dealt to holders, of which there are as many as the tokens ask for
(HOLDER_TOKENS), by the word; pairs of the HOT most frequent words by the context, and where that is hot as well by the
pair, so no word's or context's pairs are gathered in one task. Sums that pairs in several places share (tables of a
context, customers of a hot word) belong to owners, dealt by hash: holders send them what they have seated and get the
totals back, one exchange by shuffle each way a sweep. Pairs of one customer have one table and are left out of the
sweeps. For scoring, each text's pairs are sent to the holders once more, which reply with sums by text. Messages are
compressed arrays, since rows of their own would be many times as large.

Edge cases: a null text counts as empty and is one end token; texts are read whole, however long; a null id counts as
the empty text for the fold; repeated rows are learned from and scored each for itself; without training texts all words
share one unknown word's probability, 1; only the id and the text are read, so other columns of any name do no harm; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionforge.llm.common import cut, fold, partitions, quoted, whole

#: Words with about this share of the tokens, one in HOT, are dealt by context.
HOT = 1 << 14
HOLDER_TOKENS = 1 << 21
LEAST_HOLDERS = 8
GROUP_DOCS = 1024
GROUP_WORDS = 1 << 20
SWEEPS = 4
BURN_IN = 1
STRENGTH = 1.0
#: Customers that are seated at a time, as a part of those that sit.
RUN = 16
#: Logarithms are added in units of 2^-32.
UNIT = float(1 << 32)
START_HASH, END_HASH = 0, 1
#: Kinds of messages. A batch's pairs, and its texts; a holder's fixed part and its seating; what it asks of the owners
#: of all its contexts, of those that sweeps change, and of hot words; what owners keep and reply; sums by text; totals.
PAIRS, DOCS, FIXED, SEATS, ASK_ALL, ASK, ASK_WORDS, OWN, REPLY, REPLY_WORDS, SCORES, TOTALS = range(12)
SCHEMA = "to int, sender long, kind int, at long, data binary, x double"
#: Sums over the corpus, which pass 2^32; their high bytes are planes of zeros, which compress to nothing.
SUM = "<i8"
RARE = 0xFFFF


# Arrays as bytes

def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, each by planes of its bytes (the high bytes of hashes in order hardly differ)."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], "<i8").tobytes()
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def unsqueeze(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = len(kinds)
    at, out = 8 * (n + 1), []
    for kind, size in zip(kinds, np.frombuffer(raw, "<i8", n, 8).tolist(), strict=True):
        wide = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(wide, -1)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += size
    return out


def message(to: int, sender: int, kind: int, at: int, data: bytes | None, x: float | None = None) -> tuple:
    return to, sender, kind, at, data, x


def record(rows: list[tuple]) -> pa.RecordBatch:
    names = ("to", "sender", "kind", "at", "data", "x")
    types = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.float64())
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


# Hashes and places

def hashes(flat: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(w) for w in flat]), ">u8").astype("<u8")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers with good avalanche (splitmix64's last step)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def both(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    return mix(mix(words) * np.uint64(0x9E3779B97F4A7C15) + contexts)


def uniform(key: np.ndarray, sweep: int, i: np.ndarray | int) -> np.ndarray:
    """A number over 0 and at most 1 for each key, sweep and customer."""
    n = np.atleast_1d(np.asarray(i, np.uint64)) * np.uint64(0xD1B54A32D192ED03) + np.uint64((sweep + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return ((mix(mix(key) ^ n) >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def owner(h: np.ndarray, n: int) -> np.ndarray:
    return ((mix(h) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def place_of(batch: int, n: int) -> int:
    """Which holder keeps a batch's texts: by a hash, since batch numbers of all partitions begin alike."""
    return int(owner(np.array([batch], np.uint64), n)[0])


def find(sorted_hashes: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The place of each hash among those in order, or -1."""
    if not len(sorted_hashes):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(sorted_hashes, h), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == h, at, -1)


def even_keys(spark: SparkSession, parts: int, tokens: int, holder_tokens: int) -> np.ndarray:
    """Keys of the holders, spread evenly over the hash partitions. Each has about holder_tokens; how many there are
    follows from the tokens, not from the partitions, since every holder may write to every other."""
    wanted = -(-tokens // holder_tokens)
    rounds = max(1, round(wanted / parts))
    n = parts * rounds if wanted >= parts else max(wanted, min(parts, LEAST_HOLDERS))
    many = spark.range(int(parts * (math.log(parts + 1) + 12) * (rounds + 3))).select(F.col("id").cast("int").alias("key"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("to"))
    found = many.groupBy("to").agg(F.slice(F.sort_array(F.collect_list("key")), 1, rounds).alias("keys")).orderBy("to").collect()
    keys = [r["keys"][i] for i in range(rounds) for r in found]
    return np.array(keys[:n], np.int32)


# Seating

def log_factorial(n: np.ndarray) -> np.ndarray:
    z = n + 5.0
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) - np.log((n + 1.0) * (n + 2.0) * (n + 3.0) * (n + 4.0))


def binomial(n: np.ndarray, p: np.ndarray, key: np.ndarray, sweep: int, i: int) -> np.ndarray:
    """Binomial numbers, drawn by hashes: where few are expected by inversion, else by transformed rejection with squeeze
    (Hoermann's BTRS), which takes a bounded number of tries on average whatever the size."""
    q = np.minimum(p, 1 - p)
    out = np.zeros(len(n), np.int64)
    few = np.flatnonzero(n * q < 10)
    u, m, odds = uniform(key[few], sweep, i), n[few], q[few] / (1 - q[few])
    mass = (1 - q[few]) ** m
    below, k, on = mass.copy(), 0, np.arange(len(few))
    while len(on := on[(u[on] > below[on]) & (m[on] > k)]):
        k += 1
        mass[on] *= (m[on] - k + 1) / k * odds[on]
        below[on] += mass[on]
        out[few[on]] = k
    on = np.flatnonzero(n * q >= 10)
    tries = 0
    while len(on):
        m, x = n[on], q[on]
        sd = np.sqrt(m * x * (1 - x))
        wide = 1.15 + 2.53 * sd
        slope = -0.0873 + 0.0248 * wide + 0.01 * x
        u, v = (uniform(key[on] ^ np.uint64(salt), sweep, i + (tries << 32)) for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
        u = u - 0.5
        edge = np.maximum(0.5 - np.abs(u), 1e-300)
        k = np.floor((2 * slope / edge + wide) * u + m * x + 0.5)
        inside = (k >= 0) & (k <= m)
        k = np.clip(k, 0, m)
        mode = np.floor((m + 1) * x)
        height = log_factorial(mode) + log_factorial(m - mode) - log_factorial(k) - log_factorial(m - k) + (k - mode) * np.log(x / (1 - x))
        taken = inside & (((edge >= 0.07) & (v <= 0.92 - 4.2 / wide)) | (np.log(v * (2.83 + 5.1 / wide) * sd / (slope / edge**2 + wide)) <= height))
        out[on[taken]] = k[taken].astype(np.int64)
        on = on[~taken]
        tries += 1
    return np.where(p > 0.5, n - out, out)


def seat(c: np.ndarray, weight: Callable[[np.ndarray, np.ndarray], np.ndarray], discount: float, key: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of dishes with c customers. With i customers at t tables the next one opens a table with probability
    w / (w + i - discount * t), where w is weight(dishes, t). As many as a RUN-th of those seated are seated at a time, at
    their middle one's probability."""
    t = np.minimum(c, 1).astype(np.int64)
    i = 1
    order = np.argsort(-c, kind="stable")
    least = -c[order]
    while len(on := order[: np.searchsorted(least, -i, "left")]):  # those with more than i customers
        run = max(1, i // RUN)
        a = weight(on, t[on])
        p = a / (a + i - discount * t[on])
        if run == 1:
            t[on] += uniform(key[on], sweep, i) <= p
        else:
            n = np.minimum(run, c[on] - i)
            half = t[on] + p * (n - 1) / 2
            a = weight(on, half)
            t[on] += binomial(n, np.clip(a / (a + i + (n - 1) / 2 - discount * half), 0.0, 1.0), key[on], sweep, i)
        i += run
    return t


@dataclass
class Totals:
    """What all tasks share: settings, and sums over the whole seating."""

    tokens: int
    words: int
    discount: float
    root_discount: float
    n_root: float
    t_root: float
    strength: float = STRENGTH


def seat_pairs(c: np.ndarray, t: np.ndarray, tables: np.ndarray, parent: np.ndarray, root_t: np.ndarray, g: Totals, key: np.ndarray, sweep: int) -> np.ndarray:
    """New tables of pairs with c customers at t tables; by pair, the context's tables and the word's state in the
    parent. The pair's own customers have left, and with them its tables and their customers in the parent; each new
    table adds to both again."""
    tables, parent, n_root = tables - t, np.maximum(parent - t, 0), g.n_root - t
    base = (g.strength + g.root_discount * g.t_root) / (g.words + 1)
    root_t = np.maximum(root_t, 1)

    def weight(at: np.ndarray, own: np.ndarray) -> np.ndarray:
        n = parent[at] + own
        p0 = (n - g.root_discount * np.minimum(root_t[at], n) + base) / (g.strength + n_root[at] + own)
        return (g.strength + g.discount * (tables[at] + own)) * p0

    return seat(c, weight, g.discount, key, sweep)


def seat_parent(parent: np.ndarray, root_t: np.ndarray, g: Totals, key: np.ndarray, sweep: int) -> np.ndarray:
    """New tables of words in the parent, where a new table is a draw from the uniform base."""
    others = g.t_root - root_t
    weight = lambda at, own: (g.strength + g.root_discount * (others[at] + own)) / (g.words + 1)
    return seat(parent, weight, g.root_discount, key ^ np.uint64(0x5851F42D4C957F2D), sweep)


def probability(c: np.ndarray, t: np.ndarray, customers: np.ndarray, tables: np.ndarray, parent: np.ndarray, root_t: np.ndarray, n_root: float, t_root: float, g: Totals) -> np.ndarray:
    """By pair, the predictive probability in one state of the seating; c and t are 0 where it was not seen."""
    p0 = (parent - g.root_discount * root_t + (g.strength + g.root_discount * t_root) / (g.words + 1)) / (g.strength + n_root)
    return (c - g.discount * t + (g.strength + g.discount * tables) * p0) / (g.strength + customers)


def share_of_ones(ones: float, twos: float) -> float:
    """The usual estimate of a discount from how many counts are one and two."""
    return float(np.clip(ones / max(1.0, ones + 2 * twos), 0.1, 0.9))


# Texts to pairs

def groups(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """Consecutive rows (column text, binary) with a bounded number of words, unless one text alone has more."""
    start, lists, held = 0, [], 0
    for i, text in enumerate(batch.column("text")):
        lists.append(text.as_py().lower().split())
        held += len(lists[-1]) + 1
        if len(lists) == GROUP_DOCS or held >= GROUP_WORDS:
            yield start, i + 1, lists
            start, lists, held = i + 1, [], 0
    if lists:
        yield start, len(batch), lists


def frequent_words(docs: DataFrame, most: int) -> tuple[np.ndarray, int]:
    """Hashes of up to ``most`` of the most frequent words, in order, and the number of tokens. Each group of texts names
    the words with a share of at least 1 / most in it; a word with such a share of all tokens is named by some group. Which
    are named decides only where pairs lie."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, lists in groups(b):
                counts = Counter(w for ws in lists for w in ws)
                least = max(2, sum(counts.values()) / most)
                top = [(w, n) for w, n in counts.items() if n >= least]
                word = pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(hashes([w for w, _ in top]).view(np.int64))])
                yield pa.record_batch([word, pa.array([sum(map(len, lists)) + len(lists), *(n for _, n in top)], pa.int64())], names=["word", "n"])

    named = cut(docs.select("text").mapInArrow(name, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    rows = named.filter("word IS NOT NULL").orderBy(F.desc("n"), "word").limit(most).collect()
    tokens = named.filter("word IS NULL").agg(F.sum("n")).first()[0] or 0
    return np.unique(np.array([START_HASH, END_HASH, *(r["word"] & 0xFFFFFFFFFFFFFFFF for r in rows)], np.uint64)), tokens


def code(h: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places among hot hashes (RARE for others), and the others themselves."""
    at = find(hot, h)
    return np.where(at < 0, RARE, at).astype("<u2"), h[at < 0]


def decode(coded: np.ndarray, rare: np.ndarray, hot: np.ndarray) -> np.ndarray:
    out = hot[np.minimum(coded, len(hot) - 1)]
    out[coded == RARE] = rare
    return out


def encode(docs: DataFrame, hot: np.ndarray, keys: np.ndarray, by_text: bool) -> DataFrame:
    """Messages of PAIRS to the holders: a batch's distinct pairs with their training counts, or (by_text) with the texts
    that they occur in; then also DOCS. docs: doc_id, text (binary), train, held_out."""
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        for b in batches:
            for start, end, lists in groups(b):
                batch = part << 32 | count
                count += 1
                sizes = np.array([len(ws) + 1 for ws in lists])
                ends = np.cumsum(sizes) - 1
                h = np.empty(int(sizes.sum()), np.uint64)
                is_word = np.ones(len(h), bool)
                is_word[ends] = False
                h[is_word] = np.maximum(hashes([w for ws in lists for w in ws]), np.uint64(2))
                h[ends] = END_HASH
                words, w = np.unique(np.append(h, np.uint64(START_HASH)), return_inverse=True)
                w = w[:-1]
                before = np.concatenate([[0], w[:-1]])
                before[ends[:-1] + 1] = 0  # the start is the least hash
                train = np.asarray(b.column("train").slice(start, end - start).to_numpy(zero_copy_only=False), bool)
                pairs, at = np.unique(w * len(words) + before, return_inverse=True)
                hs, ks = words[pairs // len(words)], words[pairs % len(words)]
                to = owner(np.where(find(hot, hs) < 0, hs, np.where(find(hot, ks) < 0, ks, both(hs, ks))), n_keys)
                order = np.argsort(to, kind="stable")  # by holder, word and context
                cuts = np.searchsorted(to[order], np.arange(n_keys + 1))
                hs, ks = hs[order], ks[order]
                if by_text:
                    place = np.empty(len(order), np.int64)
                    place[order] = np.arange(len(order))
                    entries, times = np.unique(place[at] * len(lists) + np.repeat(np.arange(len(lists)), sizes), return_counts=True)
                    pair_of, text_of = entries // len(lists), (entries % len(lists)).astype("<u2")
                    entry_cuts = np.searchsorted(pair_of, cuts)
                    texts = np.bincount(pair_of, minlength=len(order)).astype("<u4")
                else:
                    n = np.bincount(at, np.repeat(train, sizes), len(pairs)).astype("<u4")[order]
                rows = []
                for p in np.flatnonzero(np.diff(cuts)).tolist():
                    x, y = cuts[p], cuts[p + 1]
                    first = np.flatnonzero(np.concatenate([[True], hs[x + 1 : y] != hs[x : y - 1]]))
                    arrays = [*code(hs[x:y][first], hot), np.diff(np.append(first, y - x)).astype("<u4"), *code(ks[x:y], hot)]
                    if by_text:
                        e = slice(entry_cuts[p], entry_cuts[p + 1])
                        arrays += [texts[x:y], text_of[e], times[e].astype("<u4"), train.astype("u1")]
                    else:
                        arrays.append(n[x:y])
                    rows.append(message(int(keys[p]), batch, PAIRS, p, squeeze(*arrays)))
                if by_text:
                    info = pa.record_batch([b.column("doc_id").slice(start, end - start), b.column("held_out").slice(start, end - start), pa.array(sizes)], names=["doc_id", "held_out", "n_tokens"])
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, info.schema) as out:
                        out.write_batch(info)
                    rows.append(message(int(keys[place_of(batch, n_keys)]), batch, DOCS, 0, sink.getvalue().to_pybytes()))
                yield record(rows)

    return docs.mapInArrow(run, SCHEMA)


@dataclass
class Pairs:
    """The distinct pairs of a holder, in order of word and context."""

    words: np.ndarray  # hashes
    contexts: np.ndarray  # hashes
    word: np.ndarray  # by pair
    context: np.ndarray
    c: np.ndarray  # training customers

    def key(self) -> np.ndarray:
        return both(self.words[self.word], self.contexts[self.context])


def joined(coded: list[tuple[np.ndarray, ...]], hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words and contexts of batches' pairs, the pairs (word, context), and which each of the batches' is."""
    words, number = np.unique(np.concatenate([decode(m[0], m[1], hot) for m in coded]), return_inverse=True)
    word = np.repeat(number, np.concatenate([m[2] for m in coded]).astype(np.int64))
    contexts, context = np.unique(np.concatenate([decode(m[3], m[4], hot) for m in coded]), return_inverse=True)
    pairs, at = np.unique(word * len(contexts) + context, return_inverse=True)
    return words, contexts, pairs // len(contexts), pairs % len(contexts), at


# Exchanges

Rows = dict[int, list[tuple]]


def exchange(rows: DataFrame, run: Callable[[int, Rows], Iterator[tuple]]) -> DataFrame:
    """Messages go to their receivers (run: key and rows by kind), one receiver's at a time; theirs are the result."""

    def over(key, table):
        held: Rows = {}
        columns = (table.column(c).to_pylist() for c in ("sender", "kind", "at", "data"))
        for sender, kind, at, data in sorted(zip(*columns, strict=True), key=lambda r: r[:3]):
            held.setdefault(kind, []).append((sender, at, data))
        return pa.Table.from_batches([record(list(run(key[0].as_py(), held)))])

    return rows.repartition(partitions(rows), "to").groupBy("to").applyInArrow(over, SCHEMA)


def ask(key: int, kind: int, h: np.ndarray, values: list[np.ndarray], keys: np.ndarray) -> Iterator[tuple]:
    """Messages to the owners of hashes: the hashes in order, and the holder's sums for them."""
    to = owner(h, len(keys))
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(len(keys) + 1))
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        at = order[cuts[p] : cuts[p + 1]]
        yield message(int(keys[p]), key, kind, p, squeeze(h[at], *(v[at].astype(SUM) for v in values)))


def replies(rows: list[tuple], h: np.ndarray, n: int, n_keys: int) -> list[np.ndarray]:
    """What owners replied about hashes that were asked with ask()."""
    out = [np.zeros(len(h), np.int64) for _ in range(n)]
    to = owner(h, n_keys)
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(n_keys + 1))
    for _, p, data in rows:
        for o, v in zip(out, unsqueeze(data, *[SUM] * n), strict=True):
            o[order[cuts[p] : cuts[p + 1]]] = v
    return out


def added(h: np.ndarray, asked: list[list[np.ndarray]]) -> list[np.ndarray]:
    """The asked sums by hash, of hashes in h (in order)."""
    out = [np.zeros(len(h), np.int64) for _ in asked[0][1:]] if asked else []
    for a, *values in asked:
        at = find(h, a)
        for o, v in zip(out, values, strict=True):
            o[at[at >= 0]] += v[at >= 0]  # a message has a hash once
    return out


def asked_in(rows: list[tuple], n: int) -> list[list[np.ndarray]]:
    return [unsqueeze(data, "<u8", *[SUM] * n) for _, _, data in rows]


def distinct(asked: list[list[np.ndarray]]) -> np.ndarray:
    return np.unique(np.concatenate([a[0] for a in asked])) if asked else np.empty(0, np.uint64)


def answer_words(key: int, rows: list[tuple]) -> Iterator[tuple]:
    """Of hot words, to all that asked: customers in the parent, tokens, and 1 for the first that asked."""
    asked = asked_in(rows, 2)
    h = distinct(asked)
    total = added(h, asked)
    new = np.ones(len(h), np.int64)
    for (sender, at, _), (a, *_rest) in zip(rows, asked, strict=True):
        place = np.searchsorted(h, a)
        yield message(sender, key, REPLY_WORDS, at, squeeze(*(v[place].astype(SUM) for v in (*total, new))))
        new[place] = 0


@dataclass
class Holder:
    """The part of a holder's state that no sweep changes: its words, and its pairs of several customers."""

    words: np.ndarray  # hashes of the words with training pairs, and of hot ones
    single: np.ndarray  # by word: pairs of one customer
    tokens: np.ndarray  # by word, here
    contexts: np.ndarray  # hashes of the contexts of pairs of several customers
    runs: np.ndarray  # by word: pairs of several customers
    context: np.ndarray  # by such a pair
    c: np.ndarray

    KINDS = ("<u8", SUM, SUM, "<u8", SUM, "<u4", SUM)

    def pack(self) -> bytes:
        arrays = (self.words, self.single, self.tokens, self.contexts, self.runs, self.context, self.c)
        return squeeze(*(np.asarray(a).astype(k) for a, k in zip(arrays, self.KINDS, strict=True)))

    @classmethod
    def of(cls, data: bytes) -> Holder:
        return cls(*(a if k == "<u8" else a.astype(np.int64) for a, k in zip(unsqueeze(data, *cls.KINDS), cls.KINDS, strict=True)))

    @property
    def word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.words)), self.runs)

    def parent(self, t: np.ndarray) -> np.ndarray:
        """Customers that the pairs here send to the parent, by word."""
        return self.single + np.bincount(self.word, t, len(self.words)).astype(np.int64)

    def out(self, key: int, t: np.ndarray, hot: np.ndarray, keys: np.ndarray) -> Iterator[tuple]:
        """What the seating adds to sums elsewhere."""
        yield from ask(key, ASK, self.contexts, [np.bincount(self.context, t, len(self.contexts))], keys)
        is_hot, parent = find(hot, self.words) >= 0, self.parent(t)
        yield from ask(key, ASK_WORDS, self.words[is_hot], [parent[is_hot], self.tokens[is_hot]], keys)
        yield message(0, key, TOTALS, 0, None, float(parent.sum()))


def sums(rows: DataFrame) -> dict[int, float]:
    return {r["at"]: r["x"] for r in rows.filter(F.col("kind") == TOTALS).groupBy("at").agg(F.sum("x").alias("x")).collect()}


def seats(rows: list[tuple]) -> dict[int, tuple[np.ndarray, ...]]:
    """Seatings by sweep: tables by pair, and by word its customers and tables in the parent."""
    return {at: tuple(a.astype(np.int64) for a in unsqueeze(data, SUM, SUM, SUM)) for _, at, data in rows}


def train(docs: DataFrame, hot: np.ndarray, keys: np.ndarray, sweeps: int = SWEEPS, burn_in: int = BURN_IN) -> tuple[list[Totals], DataFrame, DataFrame]:
    """Counts, then a pass a Gibbs sweep: the sums of the start and after each sweep; the kept seatings with what they
    asked (ASK, with the sweep as ``at``); and what is fixed (FIXED, ASK_ALL, OWN)."""
    kind, n_keys = F.col("kind"), len(keys)

    def count(key: int, rows: Rows) -> Iterator[tuple]:
        coded = [tuple(unsqueeze(d, "<u2", "<u8", "<u4", "<u2", "<u8", "<u4")) for _, _, d in rows[PAIRS]]
        words, contexts, word, context, at = joined(coded, hot)
        c = np.bincount(at, np.concatenate([m[5] for m in coded]), len(word)).astype(np.int64)
        one, many = c == 1, c > 1
        tokens, single = np.bincount(word, c, len(words)).astype(np.int64), np.bincount(context, one, len(contexts))
        seen = (tokens > 0) | (find(hot, words) >= 0)  # a hot word's training tokens may all lie elsewhere
        changing, of = np.unique(context[many], return_inverse=True)
        s = Holder(words[seen], np.bincount(word, one, len(words)).astype(np.int64)[seen], tokens[seen], contexts[changing], np.bincount(word, many, len(words)).astype(np.int64)[seen], of, c[many])
        yield message(key, key, FIXED, 0, s.pack())
        yield from s.out(key, np.ones(len(s.c), np.int64), hot, keys)
        yield from ask(key, ASK_ALL, contexts, [np.bincount(context, c, len(contexts)), single], keys)
        rare = s.tokens[find(hot, s.words) < 0]
        for i, x in enumerate((c.sum(), one.sum(), (c == 2).sum(), len(rare), (rare == 1).sum(), (rare == 2).sum()), 1):
            yield message(0, key, TOTALS, i, None, float(x))

    def own(key: int, rows: Rows) -> Iterator[tuple]:
        """Pairs of one customer by context that sweeps change; sums over hot words."""
        h = distinct(asked_in(rows.get(ASK, []), 1))
        single = added(h, [a[:1] + a[2:] for a in asked_in(rows.get(ASK_ALL, []), 2)] or [[h, np.zeros(len(h), np.int64)]])[0]
        yield message(key, key, OWN, 0, squeeze(h, single.astype(SUM)))
        asked = asked_in(rows.get(ASK_WORDS, []), 2)
        tokens = added(distinct(asked), asked)[1] if asked else np.empty(0)
        for i, x in enumerate((np.count_nonzero(tokens), (tokens == 1).sum(), (tokens == 2).sum()), 4):
            yield message(0, key, TOTALS, i, None, float(x))

    def answer(key: int, rows: Rows) -> Iterator[tuple]:
        if ASK in rows:
            h, single = unsqueeze(rows[OWN][0][2], "<u8", SUM)
            asked = asked_in(rows[ASK], 1)
            total = single + added(h, asked)[0]
            for (sender, at, _), (a, _values) in zip(rows[ASK], asked, strict=True):
                yield message(sender, key, REPLY, at, squeeze(total[np.searchsorted(h, a)].astype(SUM)))
        yield from answer_words(key, rows.get(ASK_WORDS, []))

    # The holders' messages of all sorts lie in one checkpoint; what each step reads of it is filtered by kind.
    first = cut(exchange(encode(docs, hot, keys, by_text=False), count))
    owned = cut(exchange(first.filter(kind.isin(ASK, ASK_ALL, ASK_WORDS)), own))
    a, b = sums(first), sums(owned)
    x = [a.get(i, 0.0) + b.get(i, 0.0) for i in range(7)]
    steps = [Totals(int(x[1]), int(x[4]), share_of_ones(x[2], x[3]), share_of_ones(x[5], x[6]), x[0], x[4])]
    fixed, state, kept = first.filter(kind == FIXED), first, None
    for sweep in range(1, sweeps + 1):
        g = steps[-1]

        def seated(key: int, rows: Rows, g=g, sweep=sweep) -> Iterator[tuple]:
            s = Holder.of(rows[FIXED][0][2])
            before = seats(rows.get(SEATS, [])).get(sweep - 1)
            t, root_t = (np.ones(len(s.c), np.int64), np.ones(len(s.words), np.int64)) if before is None else (before[0], before[2])
            word, is_hot = s.word, find(hot, s.words) >= 0
            parent = s.parent(t)
            parent[is_hot], _, mine = replies(rows.get(REPLY_WORDS, []), s.words[is_hot], 3, n_keys)
            tables = replies(rows.get(REPLY, []), s.contexts, 1, n_keys)[0]
            root_t = seat_parent(parent, root_t, g, s.words, sweep)
            t = seat_pairs(s.c, t, tables[s.context], parent[word], root_t[word], g, both(s.words[word], s.contexts[s.context]), sweep)
            yield message(key, key, SEATS, sweep, squeeze(*(v.astype(SUM) for v in (t, parent, root_t))))
            yield from s.out(key, t, hot, keys)
            yield message(0, key, TOTALS, 1, None, float(root_t[~is_hot].sum() + root_t[is_hot] @ mine))

        answers = exchange(state.filter(kind.isin(ASK, ASK_WORDS)).unionAll(owned.filter(kind == OWN)), answer)
        state = cut(exchange(fixed.unionAll(state.filter(kind == SEATS)).unionAll(answers), seated))
        x = sums(state)
        steps.append(Totals(g.tokens, g.words, g.discount, g.root_discount, x.get(0, 0.0), x.get(1, 0.0)))
        if sweep > burn_in:
            own_part = state.filter(kind.isin(SEATS, ASK)).withColumn("at", F.when(kind == ASK, F.col("at") + sweep * n_keys).otherwise(F.col("at")))
            kept = own_part if kept is None else kept.unionAll(own_part)
    return steps, kept, first.filter(kind.isin(FIXED, ASK_ALL, ASK_WORDS)).unionAll(owned.filter(kind == OWN))


def score(docs: DataFrame, steps: list[Totals], kept: DataFrame, fixed: DataFrame, hot: np.ndarray, keys: np.ndarray, id_type: str, burn_in: int = BURN_IN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, log_base (sum of log10(c + 0.5)), log_model of every text."""
    kind, n_keys, sweeps = F.col("kind"), len(keys), range(burn_in + 1, len(steps))

    def answer(key: int, rows: Rows) -> Iterator[tuple]:
        """Customers and, by kept sweep, tables of all contexts."""
        asked = asked_in(rows.get(ASK_ALL, []), 2)
        h = distinct(asked)
        if len(h):
            customers, single = added(h, asked)
            tables = [single + (added(h, found)[0] if (found := asked_in([r for r in rows.get(ASK, []) if r[1] // n_keys == s], 1)) else 0) for s in sweeps]
            for (sender, at, _), (a, *_values) in zip(rows[ASK_ALL], asked, strict=True):
                place = np.searchsorted(h, a)
                yield message(sender, key, REPLY, at, squeeze(*(v[place].astype(SUM) for v in (customers, *tables))))
        yield from answer_words(key, rows.get(ASK_WORDS, []))

    def run(key: int, rows: Rows) -> Iterator[tuple]:
        for batch, at, data in rows.get(DOCS, []):  # kept where the sums of their texts will come
            yield message(key, batch, DOCS, at, data)
        if PAIRS not in rows:
            return
        s, state = Holder.of(rows[FIXED][0][2]), seats(rows[SEATS])
        coded = [tuple(unsqueeze(d, "<u2", "<u8", "<u4", "<u2", "<u8", "<u4", "<u2", "<u4", "u1")) for _, _, d in rows[PAIRS]]
        words, contexts, word, context, at = joined(coded, hot)
        # Which pair each (pair, text) of a batch is; customers are those of training texts.
        entry = np.repeat(at, np.concatenate([m[5] for m in coded]).astype(np.int64))
        times = np.concatenate([m[7] for m in coded]).astype(np.int64)
        learned = np.concatenate([m[8][m[6]] for m in coded])
        c = np.bincount(entry, times * learned, len(word)).astype(np.int64)
        place = find(s.words, words)
        seen, many = place >= 0, c > 1
        tokens = np.zeros(len(words), np.int64)
        tokens[seen] = s.tokens[place[seen]]
        is_hot = find(hot, s.words) >= 0
        all_tokens = s.tokens.copy()
        all_tokens[is_hot] = replies(rows.get(REPLY_WORDS, []), s.words[is_hot], 3, n_keys)[1]
        tokens[seen] = all_tokens[place[seen]]
        customers, *tables = replies(rows.get(REPLY, []), contexts, 1 + len(sweeps), n_keys)
        total, t, parent, root_t = np.zeros(len(word)), np.minimum(c, 1), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for x, sweep in zip(tables, sweeps, strict=True):
            t[many], before, root = state[sweep]
            parent[seen], root_t[seen] = before[place[seen]], root[place[seen]]
            total += probability(c, t, customers[context], x[context], parent[word], root_t[word], steps[sweep - 1].n_root, steps[sweep].t_root, steps[0])
        model = np.rint(np.log10(total / len(sweeps)) * UNIT).astype(np.int64)
        base = np.rint(np.log10(tokens + 0.5) * UNIT).astype(np.int64)[word]
        known = (tokens > 0)[word]
        end = np.cumsum([len(m[6]) for m in coded])
        for (batch, _, _), m, z in zip(rows[PAIRS], coded, end, strict=True):
            e, n = entry[z - len(m[6]) : z], times[z - len(m[6]) : z]
            texts, of = np.unique(m[6], return_inverse=True)
            out = [np.zeros(len(texts), np.int64) for _ in range(4)]
            for o, v in zip(out, (n * model[e], n * base[e], n * known[e], n), strict=True):
                np.add.at(o, of, v)
            yield message(int(keys[place_of(batch, n_keys)]), batch, SCORES, key, squeeze(texts, *(o.astype("<i8") for o in out[:2]), *(o.astype("<u4") for o in out[2:])))

    def gather(key, table):
        texts: dict[int, pa.RecordBatch] = {}
        totals: dict[int, np.ndarray] = {}
        columns = [table.column(c) for c in ("sender", "kind", "data")]
        for sender, what, data in zip(*columns, strict=True):
            if what.as_py() == DOCS:
                texts[sender.as_py()] = pa.ipc.open_stream(data.as_py()).read_next_batch()
        for sender, what, data in zip(*columns, strict=True):
            if what.as_py() == SCORES:
                at, *values = unsqueeze(data.as_py(), "<u2", "<i8", "<i8", "<u4", "<u4")
                total = totals.setdefault(sender.as_py(), np.zeros((4, len(texts[sender.as_py()])), np.int64))
                total[:, at] += np.array([v.astype(np.int64) for v in values])
        out = []
        for batch, info in texts.items():
            model, base, known, tokens = totals[batch]
            if not np.array_equal(tokens, info.column("n_tokens").to_numpy()):
                raise ValueError("a batch of texts was read anew in another order")
            out.append(pa.record_batch([*info.columns, pa.array(known), pa.array(base / UNIT), pa.array(model / UNIT)], names=["doc_id", "held_out", "n_tokens", "n_known", "log_base", "log_model"]))
        return pa.Table.from_batches(out)

    answers = exchange(kept.filter(kind == ASK).unionAll(fixed.filter(kind.isin(ASK_ALL, ASK_WORDS))), answer)
    scored = exchange(encode(docs, hot, keys, by_text=True).unionAll(fixed.filter(kind == FIXED)).unionAll(kept.filter(kind == SEATS)).unionAll(answers), run)
    return scored.repartition(partitions(docs), "to").groupBy("to").applyInArrow(gather, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, log_base double, log_model double")


def score_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = HOT, holder_tokens: int = HOLDER_TOKENS) -> DataFrame:
    """Learns from the rows that are not held out (crc32 of the id modulo 5 is 1: held out) and scores all."""
    id_of = docs[quoted(id_col)]
    held = fold(id_of) == 1
    d = docs.select(id_of.alias("doc_id"), whole(docs[quoted(text_col)]).cast("binary").alias("text"), (~held).alias("train"), held.alias("held_out"))
    hot, tokens = frequent_words(d, most)
    keys = even_keys(docs.sparkSession, partitions(docs), tokens, holder_tokens)
    steps, kept, fixed = train(d, hot, keys)
    g = steps[0]
    each = math.log10(g.tokens + 0.5 * (g.words + 1))
    found = score(d, steps, kept, fixed, hot, keys, dict(docs.dtypes)[id_col])
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(g.tokens).cast("long").alias("train_tokens"),
        (F.col("log_base") - F.col("n_tokens") * F.lit(each)).alias("base_score"), F.col("log_model").alias("score"),
        F.pow(F.lit(10.0), -F.col("log_model") / F.col("n_tokens")).alias("perplexity"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return score_corpus(spark.read.parquet(f"{sf_dir}/documents.parquet"))
