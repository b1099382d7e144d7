"""The vector index: exact nearest neighbours by blocks of matrix products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

TOP_K = 30
#: Query vectors of a block, the tiles in which a task compares, and the query vectors up to which all are sent to the corpus.
QUERY_BLOCK = 16_384
BROADCAST_VECTORS = 100_000
QUERY_TILE = 512
ROW_TILE = 8192


def unit_vectors(df: DataFrame, vector: str) -> DataFrame:
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    return df.withColumn(vector, F.transform(vector, lambda x: x / norm))


def check_unit(df: DataFrame, vector: str, tolerance: float = 1e-2) -> DataFrame:
    """Fails, when rows are read, on a vector whose norm is not about 1."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    ok = F.assert_true(F.abs(norm - 1) <= tolerance, F.lit("a vector is not of unit length"))
    return df.filter(F.coalesce(ok.cast("string"), F.lit("")) == "")


def as_matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def best_of_tile(vectors: np.ndarray, rows: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query, row and score of the k best rows of each query, and of all that tie with the k-th to the last digit."""
    scores = np.round(vectors @ rows.T, digits + 3)
    m = min(k, len(rows))
    least = -np.partition(-scores, m - 1, axis=1)[:, m - 1 : m]
    q, d = np.nonzero(scores >= np.round(least, digits) - 10.0**-digits)
    return q, d, scores[q, d]


def best_of_pairs(pairs: DataFrame, k: int, digits: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (ids, vectors, query_ids, query_vectors, and ``keep``; vectors one after the other) to the k best of each query
    in each row: query_id, doc_id, score, and ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(len(b)):
                ids, vectors, query_ids, query_vectors = (c[row].values for c in b.columns[:4])
                m, q = (v.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(i), -1) for i, v in ((ids, vectors), (query_ids, query_vectors)))
                for y in range(0, len(q), QUERY_TILE):
                    at, doc, score = best_of_tile(q[y : y + QUERY_TILE], m, k, digits)
                    kept = [pa.repeat(c[row], len(at)) for c in b.columns[4:]]
                    yield pa.record_batch([query_ids.take(pa.array(y + at)), ids.take(pa.array(doc)), pa.array(score), *kept], names=["query_id", "doc_id", "score", *keep])

    element = lambda c: pairs.schema[c].dataType.elementType
    schema = StructType().add("query_id", element("query_ids")).add("doc_id", element("ids")).add("score", "double")
    for c in keep:
        schema = schema.add(pairs.schema[c])
    return pairs.select("ids", "vectors", "query_ids", "query_vectors", *keep).mapInArrow(run, schema)


def query_blocks(queries: DataFrame, keys: list[str], blocks: Column) -> DataFrame:
    """queries (query_id, v, keys) to keys, block, query_ids, query_vectors: dealt by hash to ``blocks`` blocks a key."""
    d = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), blocks))
    d = d.groupBy(*keys, "block").agg(F.collect_list(F.struct("query_id", "v")).alias("q"))
    return d.select(*keys, "block", F.col("q.query_id").alias("query_ids"), F.flatten("q.v").alias("query_vectors"))


def search(docs: DataFrame, queries: DataFrame, k: int = TOP_K, doc_id: str = "vec_id", query_id: str = "query_id", vector: str = "embedding", digits: int = 6, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, doc_id, score, dense_rank: the k documents with the greatest dot product, ties by id.

    Queries are dealt to blocks of about ``block`` vectors, and the corpus is cut, where it lies, to tiles of ROW_TILE.
    Each tile meets each block by a join on the block's number: the blocks are sent to the tiles where there are few of
    them, else both are shuffled. Of each pair the k best of a query are kept, so what is ranked is k rows a query and tile."""
    q = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("v")).filter("v IS NOT NULL")
    n = q.count()
    parts = max(1, -(-n // block))
    blocks = query_blocks(q, [], F.lit(parts))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(vector).alias("v")).filter("v IS NOT NULL")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in range(0, len(b), ROW_TILE):
                tile = b.slice(x, ROW_TILE)
                ids, vectors = tile.column(0), tile.column(1).flatten()
                yield pa.record_batch([pa.ListArray.from_arrays([0, len(ids)], ids), pa.ListArray.from_arrays([0, len(vectors)], vectors)], names=["ids", "vectors"])

    packed = rows.mapInArrow(tiles, StructType().add("ids", ArrayType(rows.schema["id"].dataType)).add("vectors", rows.schema["v"].dataType))
    packed = packed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    pairs = packed.join(F.broadcast(blocks) if n <= BROADCAST_VECTORS else blocks, "block")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.round("score", digits).desc(), "doc_id"))
    return best_of_pairs(pairs, k, digits).withColumn("dense_rank", rank).filter(F.col("dense_rank") <= k)


def check_asymmetric(spark: SparkSession, embed, prompts: tuple[str, str], sample: list[str], tolerance: float = 1e-3) -> None:
    """Fails where a model gives queries and documents the same vectors, that is, ignores its prompts. embed: a text
    column and a prompt to a vector column."""
    d = spark.createDataFrame([(t,) for t in sample], "text string").select(*[embed(F.col("text"), p).alias(n) for n, p in zip("qd", prompts, strict=True)])
    apart = F.array_max(F.zip_with("q", "d", lambda x, y: F.abs(x - y)))
    if d.select(F.max(apart).alias("m")).first()["m"] <= tolerance:
        raise ValueError("queries and documents have the same vectors: the prompts are not used")


def save_index(docs: DataFrame, path: str, expected: int | None = None) -> None:
    """Writes vectors anew and checks that all arrived."""
    docs.write.mode("overwrite").parquet(path)
    n = docs.sparkSession.read.parquet(path).count()
    if n != (docs.count() if expected is None else expected):
        raise ValueError(f"{path} holds {n} vectors, not {expected}")


def open_index(spark: SparkSession, path: str) -> DataFrame:
    index = spark.read.parquet(path)
    if index.isEmpty():
        raise ValueError(f"the index in {path} is empty")
    return index
