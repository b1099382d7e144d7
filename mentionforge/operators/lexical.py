"""The lexical index: postings with their document frequencies, and BM25 search over them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentionforge.functions.text import normalize_text, tokens
from mentionforge.operators.rows import materialized, spread

K1 = 1.5
B = 0.75
TOP_K = 30
#: Rows of the queries' side (query, token) up to which it is sent to the postings where they lie.
BROADCAST_ROWS = 500_000
#: Products of a posting and a query, or cells of document and query, that a task holds at once, about.
CELLS = 1 << 21


@dataclass
class LexicalIndex:
    """Postings (doc_id, tok, tf, doc_len), frequencies (tok, df), and how many documents there are and how long they
    are in sum. Documents without tokens count in both. lengths (doc_id, doc_len) has all documents, where it is known."""

    postings: DataFrame
    frequencies: DataFrame
    n_docs: int
    length: int
    lengths: DataFrame | None = None

    @property
    def mean_length(self) -> float:
        return max(self.length / self.n_docs if self.n_docs else 0.0, 1e-9)


def counted_tokens(d: DataFrame, known: frozenset | None = None) -> DataFrame:
    """d (doc_id, t: a normalized text in lower case) to doc_id, doc_len, t (the distinct tokens, or those that are known,
    with their counts tf). A text is counted before it is dealt, so a row is a distinct token and not an occurrence."""
    sent = d.sparkSession.sparkContext.broadcast(known)
    entry = pa.list_(pa.struct([("tok", pa.string()), ("tf", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for b in batches:
            toks, tfs, lens, ends = [], [], [], [0]
            for t in b.column(1).to_pylist():
                words = [w for w in (t or "").split(" ") if w]
                tf = Counter(words if known is None else [w for w in words if w in known])
                toks.extend(tf)
                tfs.extend(tf.values())
                lens.append(len(words))
                ends.append(len(toks))
            pairs = pa.StructArray.from_arrays([pa.array(toks, pa.string()), pa.array(tfs, pa.int64())], names=["tok", "tf"])
            yield pa.record_batch([b.column(0), pa.array(lens, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs).cast(entry)], names=["doc_id", "doc_len", "t"])

    return d.mapInArrow(run, f"doc_id {dict(d.dtypes)['doc_id']}, doc_len int, t array<struct<tok:string,tf:long>>")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: DataFrame | None = None) -> LexicalIndex:
    """The index of a whole corpus, or of its tokens that are among ``vocabulary`` (tok), which are those of the queries
    where an index serves one search. Texts are tokenised once: a row without token carries each document's length."""
    d = spread(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))).select("doc_id", F.lower(normalize_text(F.col("text"))).alias("t"))
    known = None if vocabulary is None else materialized(vocabulary.select(F.col("tok").alias("known")).distinct())
    few = known is not None and known.count() <= BROADCAST_ROWS
    counted = counted_tokens(d, frozenset(known.toArrow()["known"].to_pylist()) if few else None)
    d = counted.select("doc_id", "doc_len", F.explode(F.concat(F.array(F.struct(F.lit(None).cast("string").alias("tok"), F.lit(1).cast("long").alias("tf"))), "t")).alias("t")).select("doc_id", "doc_len", "t.*")
    if known is not None and not few:
        d = d.join(known, F.col("tok") == F.col("known"), "left").filter("tok IS NULL OR known IS NOT NULL").drop("known")
    rows = materialized(d.groupBy("doc_id", "tok", "doc_len").agg(F.sum("tf").alias("tf")))
    # A row without token counts its document as often as the corpus has it.
    whole = rows.filter("tok IS NULL").agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("tf") * F.col("doc_len")), F.lit(0)).alias("length")).first()
    posts = rows.filter("tok IS NOT NULL").select("doc_id", "tok", "tf", "doc_len")
    return LexicalIndex(posts, posts.groupBy("tok").agg(F.count("*").alias("df")), whole["n"], whole["length"], rows.filter("tok IS NULL").select("doc_id", "doc_len"))


def extended(index: LexicalIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LexicalIndex:
    """The index with further documents, whose ids must be new; what it has is not tokenised again."""
    more = build_index(docs, id_col, text_col)
    both = index.frequencies.unionByName(more.frequencies).groupBy("tok").agg(F.sum("df").alias("df"))
    return LexicalIndex(index.postings.unionByName(more.postings), both, index.n_docs + more.n_docs, index.length + more.length)


def weight(index: LexicalIndex, k1: float = K1, b: float = B):
    """A posting's BM25 weight (the Lucene variant, idf = ln(1 + (N - df + 0.5) / (df + 0.5)))."""
    idf = F.log(1 + (F.lit(index.n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return idf * F.col("tf") / (F.col("tf") + k1 * (1 - b + b * F.col("doc_len") / F.lit(index.mean_length)))


def query_tokens(queries: DataFrame, id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """query_id, tok, times."""
    return queries.select(queries[id_col].alias("query_id"), F.explode(tokens(queries[text_col])).alias("tok")).groupBy("query_id", "tok").agg(F.count("*").alias("times"))


def document_scores(posts: pa.Table, offsets: np.ndarray, query: np.ndarray, times: np.ndarray, n_queries: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """posts (doc_id, in runs; tok, its number; weight) to blocks of documents with their scores, one column a query. The
    token of number t is in the queries query[offsets[t] : offsets[t + 1]], so many times."""
    tok, weight = posts["tok"].to_numpy(), posts["weight"].to_numpy()
    ids = posts["doc_id"].combine_chunks()
    ends = pc.run_end_encode(ids).run_ends.to_numpy().astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    many = offsets[tok + 1] - offsets[tok]
    cost = np.add.reduceat(many, starts) + n_queries
    block = (np.cumsum(cost) - cost) // CELLS
    for x, z in zip(*(np.searchsorted(block, np.unique(block), side) for side in ("left", "right")), strict=True):
        rows = slice(starts[x], ends[z - 1])
        n, doc = many[rows], np.repeat(np.arange(z - x), ends[x:z] - starts[x:z])
        at = np.repeat(offsets[tok[rows]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        cell = np.repeat(doc * n_queries, n) + query[at]
        yield ids.take(pa.array(starts[x:z])), np.bincount(cell, np.repeat(weight[rows], n) * times[at], (z - x) * n_queries).reshape(z - x, n_queries)


def _scored_in_place(index: LexicalIndex, wanted: DataFrame, k: int, digits: int) -> tuple[DataFrame, DataFrame]:
    """no, doc_id, score of the k best documents of each query and task, and of some that no longer are; and the queries'
    numbers (query_id, no), so that a query may have its text for an id.

    Postings are dealt by document, with their tokens' numbers for their names, and meet the queries as a sparse matrix in
    their task; a pair of document and query that cannot be among the task's k best is never a row."""
    spark = wanted.sparkSession
    numbered = lambda d: materialized(d.distinct().withColumn("no", F.monotonically_increasing_id()))
    toks, own = numbered(wanted.select("tok", "df")), numbered(wanted.select("query_id"))
    pairs = wanted.join(toks.select("tok", F.col("no").alias("t")), "tok").join(own.select(F.col("query_id").alias("of"), F.col("no").alias("q")), F.col("query_id").eqNullSafe(F.col("of")))
    t, q, times = (c.to_numpy() for c in pairs.select("t", "q", "times").orderBy("t").toArrow().columns)  # BROADCAST_ROWS at most
    names, tok = np.unique(t, return_inverse=True)
    queries, query = np.unique(q, return_inverse=True)
    sent = spark.sparkContext.broadcast((names, np.searchsorted(tok, np.arange(len(names) + 1)), queries, query, times.astype(np.float64)))
    posts = index.postings.join(F.broadcast(toks), "tok").select("doc_id", F.col("no").alias("tok"), weight(index).cast("double").alias("weight"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, offsets, queries, query, times = sent.value
        best, rest = np.zeros((k, len(queries))), None

        def hits(posts: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal best
            posts = posts.set_column(1, "tok", pa.array(np.searchsorted(names, posts["tok"].to_numpy())))
            for ids, scores in document_scores(posts, offsets, query, times, len(queries)):
                best = -np.partition(-np.concatenate([best, scores]), k - 1, axis=0)[:k]
                doc, column = np.nonzero((scores > 0) & (scores >= np.round(best.min(axis=0), digits) - 10.0**-digits))
                yield pa.record_batch([pa.array(queries[column]), ids.take(pa.array(doc)), pa.array(scores[doc, column])], names=["no", "doc_id", "score"])

        for b in batches:
            held = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            if len(held):
                ends = pc.run_end_encode(held["doc_id"].combine_chunks()).run_ends
                whole = ends[-2].as_py() if len(ends) > 1 else 0  # the last document may go on in the next batch
                rest = held.slice(whole)
                if whole:
                    yield from hits(held.slice(0, whole))
        if rest is not None:
            yield from hits(rest)

    schema = f"no long, doc_id {dict(posts.dtypes)['doc_id']}, score double"
    return posts.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(run, schema), own


def search(index: LexicalIndex, queries: DataFrame, k: int | None = TOP_K, id_col: str = "query_id", text_col: str = "text", digits: int = 6) -> DataFrame:
    """query_id, doc_id, score, bm25_rank: the k best with a positive score, ties by doc_id; k of 0 or None means the
    default. A query's token counts as often as it occurs.

    The queries' tokens, with their frequencies, go to the postings where they lie, and their counts to the tasks that
    gather a document's postings; beyond BROADCAST_ROWS both sides are dealt by token as plain inputs, of which a hot token's
    rows can be split."""
    wanted = materialized(query_tokens(queries, id_col, text_col).join(index.frequencies, "tok"))
    k = k or TOP_K
    ranked = lambda d, key: d.withColumn("bm25_rank", F.row_number().over(W.partitionBy(key).orderBy(F.round("score", digits).desc(), "doc_id"))).filter(F.col("bm25_rank") <= k)
    if 0 < wanted.count() <= BROADCAST_ROWS:
        scored, own = _scored_in_place(index, wanted, k, digits)
        return ranked(scored, "no").join(F.broadcast(own), "no").select("query_id", "doc_id", "score", "bm25_rank")
    scored = index.postings.join(wanted, "tok").groupBy("query_id", "doc_id").agg(F.sum(F.col("times") * weight(index)).alias("score"))
    return ranked(scored.filter("score > 0"), "query_id")


def search_texts(docs: DataFrame, queries: DataFrame, k: int | None = TOP_K, doc_id: str = "doc_id", query_id: str = "query_id", text_col: str = "text") -> DataFrame:
    """search() over a corpus without an index: only postings of the queries' tokens are made."""
    index = build_index(docs, doc_id, text_col, query_tokens(queries, query_id, text_col))
    return search(index, queries, k, query_id, text_col)


def save_index(index: LexicalIndex, path: str) -> None:
    """Postings by token, document frequencies, and the corpus's sums, so that a saved index can be extended."""
    index.postings.repartition("tok").sortWithinPartitions("tok").write.mode("overwrite").parquet(f"{path}/postings")
    index.frequencies.write.mode("overwrite").parquet(f"{path}/frequencies")
    index.postings.sparkSession.range(1).select(F.lit(index.n_docs).cast("long").alias("n_docs"), F.lit(index.length).cast("long").alias("length")).write.mode("overwrite").parquet(f"{path}/sums")


def open_index(spark: SparkSession, path: str) -> LexicalIndex:
    posts, frequencies, sums = (spark.read.parquet(f"{path}/{t}") for t in ("postings", "frequencies", "sums"))
    if posts.isEmpty():
        raise ValueError(f"the index in {path} is empty")
    whole = sums.first()
    return LexicalIndex(posts, frequencies, whole["n_docs"], whole["length"])
