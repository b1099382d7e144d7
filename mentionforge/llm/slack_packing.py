"""Best-fit packing of tokenised documents by minimum bin slack.

Documents are tokenised where they lie: Arrow finds the distinct pieces of their words, whose ids come from the tokenizer
through a bounded cache. What is packed is only the histogram of piece lengths (at most ``capacity`` rows, whatever the
corpus): for each sequence the longest remaining length is placed, and a bitset subset-sum dynamic programme over the
available lengths finds the fullest feasible completion, which is removed as often as its lengths last. The patterns, at
most one more than there are lengths, are then dealt to the pieces: a piece's rank among those of its length gives its
pattern, sequence and place. Ranks come from counts by length and salt, so that a hot length is not gathered in one task.

Edge cases: a null or empty text is a piece of one end token; texts are tokenised whole, however long, and only those
longer than a sequence are cut; a special token's string in a text has that token's id, as the tokenizer gives it;
repeated rows are packed each for itself; only the id and the text are read, so other columns of any name do no harm;
an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentionforge.llm.common import cut, quoted, whole

CAPACITY = 4096
END = 1
#: Words that are encoded whole, and other pieces of words, whose ids are kept by a worker at most, besides those of the
#: texts at hand.
CACHE_WORDS = 150_000
CACHE_PIECES = 300_000
#: Marks of what was met once (a byte each), and how many of them are set at most.
MARKS_BITS = 21
MOST_MARKS = 1 << 20
#: Texts, and bytes of texts (but one text at least), that are encoded, and sent back, at a time.
STEP = 4096
STEP_BYTES = 4 << 20
#: Runs of ids that are put in order at a time.
STEP_RUNS = 1 << 18
#: Latin letters, each composed and lowered by itself, and marks that the tokenizer parts from letters before them (no
#: apostrophe, which can open a part of its own). A word of letters with marks behind it is two pieces; any other is one.
LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x130), *range(0x131, 0x250)]))
MARKS = ".,;:!?|$%&*#"
#: The signs by which byte-level models name bytes: printable ones name themselves, the others follow from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}
#: The sign of each byte; a line feed, which no word has, parts words.
BYTE_SIGN_CODES = np.array([10 if b == 10 else BYTE_SIGNS.get(b, b) for b in range(256)], "<u2")
#: Rows that share a length and a salt are ranked in one group; there are about this many.
GROUP_ROWS = 500


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Repeated:
    """Ids of what was met more than once, ``most`` at most; most words of a corpus are met once, and would only fill it.
    Marks are by hash, so that now and then something is kept at once."""

    def __init__(self, most: int):
        self.most, self.ids, self.marks, self.marked = most, {}, np.zeros(1 << MARKS_BITS, bool), 0

    def missing(self, wanted: set) -> set:
        """Those without ids, which the caller adds to ``ids``."""
        new = wanted.difference(self.ids)
        if len(self.ids) > self.most:  # those at hand stay, and so do the frequent ones
            self.ids = {x: self.ids[x] for x in wanted.difference(new)}
        return new

    def forget(self, new: list) -> None:
        """Of those that were added, what was met for the first time goes again."""
        if self.marked > MOST_MARKS:
            self.marks, self.marked = np.zeros(1 << MARKS_BITS, bool), 0
        at = np.fromiter(map(hash, new), np.int64, len(new)) & ((1 << MARKS_BITS) - 1)
        first = ~self.marks[at]
        self.marks[at] = True
        self.marked += int(first.sum())
        for x in compress(new, first.tolist()):
            del self.ids[x]


def joined(ids: np.ndarray, counts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` (the k-th has counts[k] of them) in the given order, one behind the other, and their counts."""
    starts, out = np.cumsum(counts) - counts, [ids[:0]]
    for a in range(0, len(order), STEP_RUNS):
        some = order[a : a + STEP_RUNS]
        n = counts[some]
        out.append(ids[np.repeat(starts[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
    return np.concatenate(out), counts[order]


class WordIds:
    """Token ids (little-endian unsigned 32-bit) of whole texts. The tokenizer splits at white space and drops it,
    so a text's ids are those of the parts between its ASCII white space. It also lowers case and parts letters from
    marks, so a word of Latin letters with marks behind it has the ids of its lower-case letters and then those of the
    marks. Every other word, so one that holds a special token's string, is encoded by the unmodified tokenizer. Arrow
    finds the distinct words of some texts and their distinct pieces; only pieces that are not remembered are encoded,
    and the texts' ids are gathered from those of the pieces."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.known_pieces = Repeated(CACHE_WORDS), Repeated(CACHE_PIECES)

    def of(self, texts: list[str] | pa.StringArray) -> list[bytes]:
        split = pc.ascii_split_whitespace(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        words = split.flatten().dictionary_encode()
        ids, counts = self.of_words(words.dictionary)
        ids, counts = joined(ids, counts, words.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(counts)])[split.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]

    def of_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, one behind the other, and how many each has."""
        marks = pc.utf8_ltrim(words, characters=LETTERS)
        lettered = pc.and_(pc.less(pc.binary_length(marks), pc.binary_length(words)), pc.equal(pc.ascii_ltrim(marks, characters=MARKS), ""))
        first = pc.if_else(lettered, pc.utf8_lower(pc.ascii_rtrim(words, characters=MARKS)), words)
        pieces = pa.concat_arrays([first, pc.if_else(lettered, marks, "")]).dictionary_encode()
        found = self.of_pieces(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, n = joined(np.frombuffer(b"".join(found), "<u4"), counts, pieces.indices.to_numpy().reshape(2, -1).T.ravel())
        return ids, n.reshape(-1, 2).sum(axis=1)

    def of_pieces(self, pieces: list[str]) -> list[bytes]:
        wanted = set(pieces)
        old = self.known.ids.keys() & wanted
        new = list(self.known_pieces.missing(wanted - old))
        texts = pa.array(new, pa.string())
        unit = pc.or_(*(pc.equal(pc.utf8_ltrim(texts, characters=x), "") for x in (LETTERS, MARKS)))
        units = texts.filter(unit).to_numpy(zero_copy_only=False).tolist()
        others = self.known.missing(old.union(texts.filter(pc.invert(unit)).to_pylist()))
        known, kept = self.known_pieces.ids, self.known.ids
        known.update(zip(units, self.of_units(units), strict=True))
        words = list(others)
        for p, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False) if words else [], strict=True):
            kept[p] = np.array(e.ids, "<u4").tobytes()
        found = [kept[p] if x is None else x for p, x in zip(pieces, map(known.get, pieces), strict=True)]
        self.known_pieces.forget(units)
        self.known.forget(words)
        return found

    def of_units(self, units: list[str]) -> list[bytes]:
        """A run of letters, or of marks, is one unit of the model, whose characters stand for bytes."""
        signs = BYTE_SIGN_CODES[np.frombuffer("\n".join(units).encode(), np.uint8)].tobytes().decode("utf-16-le").split("\n") if units else []
        tokenize, ids, ends = self.tokenizer.model.tokenize, [], [0]
        for x in signs:
            ids += [t.id for t in tokenize(x)]
            ends.append(4 * len(ids))
        data = np.array(ids, "<u4").tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


#: One for each tokenizer and worker process, so that what one task has learned serves the next.
WORKERS_OWN: dict[str, WordIds] = {}


def word_ids_of(path: str) -> WordIds:
    if path not in WORKERS_OWN:
        WORKERS_OWN[path] = WordIds(path)
    return WORKERS_OWN[path]


def steps(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, how many) of consecutive texts that are encoded at a time."""
    at, ends = 0, np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    while at < len(ends):
        room = STEP_BYTES + (ends[at - 1] if at else 0)
        n = max(1, min(STEP, int(np.searchsorted(ends, room, "right")) - at))
        yield at, n
        at += n


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    path = tokenizer or default_tokenizer()
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        word_ids, last = word_ids_of(path), np.array([end], "<u4").tobytes()
        gc.disable()  # millions of small objects and no cycles
        try:
            yield from cut_texts(batches, word_ids, last)
        finally:
            gc.enable()

    def cut_texts(batches: Iterator[pa.RecordBatch], word_ids: WordIds, last: bytes) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in steps(batch.column(1)):
                b = batch.slice(at, n)
                rows, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(word_ids.of(b.column(1))):
                    ids += last
                    for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[a : a + 4 * capacity]
                        rows.append(i)
                        piece.append(k)
                        start.append(a // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                cols = [b.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                yield pa.record_batch(cols, names=["doc_id", "piece", "start", "length", "ids_crc32"])
            batch = b = None  # before the next one is read

    texts = docs.select(docs[quoted(id_col)].alias("doc_id"), whole(docs[quoted(text_col)]).alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, times) of a combination of the lengths, each as often as it is there at most, whose sum is as near
    to ``room`` as can be; longer lengths come first."""
    reach, full, steps = 1, 1 << room, []
    mask = (full << 1) - 1
    for n in sorted((x for x in counts if x <= room), reverse=True):
        times, power = min(counts[n], room // n), 1
        while times > 0:
            k = min(power, times)
            steps.append((n, k, reach))
            reach |= (reach << (n * k)) & mask
            times, power = times - k, power * 2
            if reach & full:
                break
        if reach & full:
            break
    left, out = reach.bit_length() - 1, {}
    for n, k, before in reversed(steps):
        if not before >> left & 1:
            out[n] = out.get(n, 0) + k
            left -= n * k
    return list(out.items())


def patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Minimum bin slack on a histogram of lengths: ({length: times}, how many sequences are filled so)."""
    counts, out = {n: c for n, c in histogram.items() if c}, []
    while counts:
        longest = max(counts)
        pattern = {longest: 1}
        rest = counts | {longest: counts[longest] - 1}
        for n, k in fullest({n: c for n, c in rest.items() if c}, capacity - longest):
            pattern[n] = pattern.get(n, 0) + k
        times = min(counts[n] // k for n, k in pattern.items())
        out.append((pattern, times))
        for n, k in pattern.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
    return out


def slots(found: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each pattern and length the ranks that it takes: at length, from rank; times a sequence, first sequence
    and place in it. In order of length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in found:
        place = 0
        for n, k in pattern.items():
            rows.append((n, used.get(n, 0), k, sequence, place))
            used[n] = used.get(n, 0) + k * times
            place += n * k
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "times", "sequence", "place"), table.T, strict=True))


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (column length, 1 to capacity)."""
    parts = cut(parts)
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    table = slots(patterns(histogram, capacity))
    # Rows are ranked by length and salt; a salt's first rank is the count of those before it. A length has as many
    # salts as its count asks for.
    per_length = parts.groupBy("length").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("salts"))
    # Where a row lies in the checkpoint is part of its salt, so that a row that is repeated often is dealt, too.
    d = parts.withColumn("__at", F.monotonically_increasing_id()).join(F.broadcast(per_length), "length")  # at most capacity rows
    d = d.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "__at"), F.col("salts")).cast("int")).drop("salts", "__at")
    by_salt = d.groupBy("length", "salt").agg(F.count("*").alias("n"))
    base = by_salt.select("length", "salt", (F.sum("n").over(W.partitionBy("length").orderBy("salt")) - F.col("n")).alias("base"))
    ranked = d.withColumn("rank", F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "start")) - 1)
    ranked = ranked.join(base, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("base")).drop("salt", "base")

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wide = np.int64(1) << 40
        keys = table["length"] * wide + table["rank"]
        for f in frames:
            n, rank = f["length"].to_numpy(), f["rank"].to_numpy()
            at = np.searchsorted(keys, n * wide + rank, "right") - 1
            over = rank - table["rank"][at]
            times = table["times"][at]
            yield f.drop(columns="rank").assign(sequence_id=table["sequence"][at] + over // times, offset=table["place"][at] + over % times * n)

    kept = [c for c in parts.columns]
    schema = ", ".join(f"`{c}` {t}" for c, t in parts.dtypes) + ", sequence_id long, offset long"
    return ranked.select(*kept, "rank").mapInPandas(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, **columns) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every text."""
    return pack(pieces(docs, tokenizer, capacity, **columns), capacity)


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
