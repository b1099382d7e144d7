"""Language identification by multilingual mixtures.

Each learned language has a likelihood for hashed letter trigrams. A text is a mixture of languages, word by word:
expectation-maximisation estimates its proportions, first over all languages, then over the sets of its 1, 2, ...
likeliest ones; the set with the best penalised likelihood is taken, and of it the language with the largest share.

Learned from a bounded sample of labelled texts (about ``per_language`` whole texts of each language, by hash of id and
text; rows that are equal in both are one). The table that is collected and broadcast has BUCKETS numbers a language; more than MOST_LANGUAGES languages are an
error, so that its size is bounded (64 MB).

Edge cases: null, empty and letterless texts are ``und`` with score 0, and so is all if nothing could be learned;
texts with a null language are not learned from; very long texts are scored whole, piece by piece; ties go to the
language that comes first; repeated rows are judged each for itself; other columns may have any name and stay as they
are; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionforge.llm.common import cut, fold, join_counted, quoted

BUCKETS = 1 << 16
PER_LANGUAGE = 2000
MOST_LANGUAGES = 256
PIECE = 1 << 20
#: Characters of ASCII that are not letters count as white space.
PLAIN = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


def trigrams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the trigrams of a text's UTF-8 bytes around each byte of a word, and where words start among them;
    piece by piece."""
    raw = text.lower().encode("utf-8", "replace").translate(PLAIN)
    at = 0
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        if end < len(raw) and (space := raw.rfind(b" ", at, end)) > at:
            end = space
        b = np.frombuffer(b" " + raw[at:end] + b" ", np.uint8).astype(np.uint32)
        at = end
        inside = b[1:-1] != 32
        if not inside.any():
            continue
        mixed = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        yield (mixed >> np.uint32(16))[inside], np.flatnonzero(first[inside])


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages and the logarithms of their trigram probabilities (BUCKETS x languages)."""
    d = docs.select(docs[quoted(lang_col)].cast("string").alias("lang"), docs[quoted(text_col)].cast("string").alias("text"), F.pmod(F.xxhash64(F.lit("sample"), docs[quoted(id_col)], docs[quoted(text_col)].cast("string")), F.lit(1 << 60)).alias("at")).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = cut(d.groupBy("lang").agg((F.lit(float(per_language)) / F.count("*") * (1 << 60)).alias("below")), few=True)
    if (n := counts.count()) > MOST_LANGUAGES:
        raise ValueError(f"{n} languages; at most {MOST_LANGUAGES} can be learned")
    # Rows that repeat an id and a text are one here, so no number of them can swell the sample.
    sample = join_counted(d, counts, ["lang"], "inner").filter("at < below").dropDuplicates(["lang", "at"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for grams, _ in trigrams(text.as_py()):
                    total += np.bincount(grams, minlength=BUCKETS)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(total[at])], names=["lang", "bucket", "n"])

    def column(key, table):
        n = np.zeros(BUCKETS, np.float64)
        n[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
        logs = np.log((n + 0.5) / (n.sum() + 0.5 * BUCKETS)).astype("<f4")
        return pa.table({"lang": [key[0].as_py()], "logs": pa.array([logs.tobytes()], pa.binary())})

    # The driver gets one row of 4 BUCKETS bytes a language.
    seen = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sorted((r["lang"], bytes(r["logs"])) for r in seen.groupBy("lang").applyInArrow(column, "lang string, logs binary").collect())
    table = np.stack([np.frombuffer(logs, "<f4") for _, logs in found], 1) if found else np.zeros((BUCKETS, 0), np.float32)
    return [lang for lang, _ in found], np.ascontiguousarray(table)


def proportions(like: np.ndarray, rounds: int = 20) -> tuple[np.ndarray, float]:
    """EM: like holds each word's likelihoods relative to its best, to the shares of the columns and the log likelihood."""
    share = np.full(like.shape[1], 1.0 / like.shape[1])
    for _ in range(rounds):
        mix = like @ share
        new = share * (like.T @ (1.0 / mix)) / len(like)
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(np.log(like @ share).sum())


def identify(text: str | None, langs: list[str], table: np.ndarray, cost: float) -> tuple[str, float, list[str]]:
    """The language, its score and the set of languages found."""
    if text is None or not langs or not any(map(str.isalpha, text)):
        return "und", 0.0, []
    parts = [np.add.reduceat(table[grams], starts, axis=0) for grams, starts in trigrams(text)]
    if not parts:
        return "und", 0.0, []
    logs = np.concatenate(parts).astype(np.float64)
    total = logs.sum(0)
    like = np.exp(np.maximum(logs - logs.max(1, keepdims=True), -60.0))
    share, _ = proportions(like)
    order = np.argsort(-share, kind="stable")
    alone = int(np.argmax(total))
    best, fit, shares = [alone], float(np.log(like[:, alone]).sum()), np.ones(1)
    penalty = cost * math.log(len(logs) + 1)
    for m in range(2, len(langs) + 1):
        if share[order[m - 1]] * len(logs) < 1.0:
            break  # less than a word
        own, value = proportions(like[:, order[:m]])
        if value - penalty * (m - 1) > fit:
            best, fit, shares = order[:m].tolist(), value - penalty * (m - 1), own
    if len(best) == 1:
        posterior = np.exp(total - total.max())
        return langs[alone], float(posterior[alone] / posterior.sum()), [langs[alone]]
    top = int(np.argmax(shares))
    return langs[best[top]], float(min(1.0, shares[top])), [langs[i] for i in best]


#: Rows of a batch that are worked on, and sent back, at a time.
STEP = 512


def predict(rows: DataFrame, langs: list[str], table: np.ndarray, cost: float, text: tuple[str, ...], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of rows with lang_pred, lang_score and lang_set; text is the path to a string column."""
    model = rows.sparkSession.sparkContext.broadcast((langs, table))  # BUCKETS x languages floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs = model.value
        for batch in batches:
            for at in range(0, len(batch), STEP):
                b = batch.slice(at, STEP)
                texts = b.column(text[0])
                for field in text[1:]:
                    texts = pc.struct_field(texts, field)
                found = [identify(t.as_py(), names, logs, cost) for t in texts]
                cols = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.list_(pa.string()))]
                yield pa.record_batch([*(b.column(c) for c in keep), *cols], names=[*keep, "lang_pred", "lang_score", "lang_set"])

    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()), T.StructField("lang_set", T.ArrayType(T.StringType()))])
    return rows.mapInArrow(run, schema)


def held_out(doc_id):
    return fold(doc_id) == 0


def identify_documents(docs: DataFrame, per_language: int = PER_LANGUAGE, cost: float = 4.0) -> DataFrame:
    """doc_id, held_out, lang_pred, score, lang_set; learned from the rows that are not held out."""
    langs, table = learn(docs.filter(~held_out(docs["doc_id"])), per_language)
    d = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), docs["text"].cast("string").alias("text"))
    found = predict(d, langs, table, cost, ("text",), ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.array_join("lang_set", ",").alias("lang_set"))


def keep_identified(docs: DataFrame, least: float = 0.5, per_language: int = PER_LANGUAGE, cost: float = 4.0) -> DataFrame:
    """The rows of docs with an identified language: ``und`` goes, and so does a text of one language whose posterior is
    under ``least``. A text that is found to mix languages stays, whatever the largest share."""
    langs, table = learn(docs.filter(~held_out(docs["doc_id"])), per_language)
    found = predict(docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row")), langs, table, cost, ("row", "text"), ["row"])
    return found.filter((F.col("lang_pred") != "und") & ((F.size("lang_set") > 1) | (F.col("lang_score") >= least))).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return identify_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
