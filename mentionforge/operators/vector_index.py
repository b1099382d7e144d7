"""An approximate vector index: an inverted file under a trained coarse quantiser, and search of its nearest cells.

Centroids come from k-means, each round one aggregation in Spark over a bounded sample; every vector is then put
into its nearest centroid's cell. The index is stored by cell, each cell in tiles of about ``TILE`` vectors, so a search
reads only the folders of the cells that it probes, and a full cell is many rows. A search compares each tile with
blocks of the queries that probe its cell, by matrix products, and rescores nothing: stored vectors are whole. How many
cells a search probes is measured when the index is built: on a sample of its own vectors as queries, the fewest with
which the exact hits are found to a wanted share.

``exact=True`` goes on where the probed cells leave doubt: a cell with centroid c and radius r holds no score above
q.c + |q| r, so only cells whose bound reaches the k-th best score found so far are searched as well; the result is that
of the exact search.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentionforge.operators.dense import BROADCAST_VECTORS, QUERY_TILE, TOP_K, as_matrix, best_of_pairs, query_blocks
from mentionforge.operators.rows import materialized

TILE = 4096
#: Vectors that centroids are fitted on at most, about; and centroids at most, which every task holds.
SAMPLE = 200_000
MOST_CELLS = 16_384
ROUNDS = 5
#: The share of exact hits that probes are chosen for, and queries on which it is measured, about.
RECALL = 0.96
TUNING = 256

@dataclass
class VectorIndex:
    """A saved index: its folder, each cell's number, centroid and radius, and how many cells a search probes."""

    spark: SparkSession
    path: str
    cells: np.ndarray
    centroids: np.ndarray
    radii: np.ndarray
    probes: int

    @property
    def tiles(self) -> DataFrame:
        """cell, tile, ids, vectors (of all ids, one after the other), stored by cell."""
        return self.spark.read.parquet(f"{self.path}/vectors")


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each vector the nearest centroid and the distance to it."""
    square = (vectors**2).sum(1)[:, None] - 2 * (vectors @ centroids.T) + (centroids**2).sum(1)
    at = square.argmin(1)
    return at, np.linalg.norm(vectors - centroids[at], axis=1)


#: Vectors that a task compares with all centroids at a time: a matrix of 128 MB at most.
ROWS_AT_ONCE = 1024


def vectors_of(docs: DataFrame, vector: str, ids: list[Column] = ()) -> DataFrame:
    return docs.select(*ids, F.col(vector).alias("v")).filter("v IS NOT NULL")


def train(docs: DataFrame, n_cells: int, n: int, vector: str = "embedding", rounds: int = ROUNDS, sample: int = SAMPLE, seed: int = 7) -> np.ndarray:
    """n_cells centroids at most, fitted on about ``sample`` of the n vectors (by a hash of the vector; equal ones are one)."""
    d = vectors_of(docs, vector).distinct().withColumn("at", F.pmod(F.xxhash64(F.lit(seed), "v"), F.lit(1 << 30)))
    d = materialized(d.filter(F.col("at") < math.ceil(sample / max(n, 1) * (1 << 30))).select("v", "at"))
    centroids = as_matrix(d.orderBy("at").select("v").limit(n_cells).toArrow().column(0).combine_chunks())
    for _ in range(rounds if len(centroids) else 0):
        shared = d.sparkSession.sparkContext.broadcast(centroids)

        def add(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            c = shared.value
            n, sums = np.zeros(len(c)), np.zeros(c.shape)
            for b in batches:
                for at in range(0, len(b), ROWS_AT_ONCE):
                    m = as_matrix(b.column(0).slice(at, ROWS_AT_ONCE))
                    cell, _ = nearest(m, c)
                    n += np.bincount(cell, minlength=len(c))
                    np.add.at(sums, cell, m)
            met = np.flatnonzero(n)
            yield pa.record_batch([pa.array(met), pa.array(n[met]), pa.array(list(sums[met]), pa.list_(pa.float64()))], names=["cell", "n", "sums"])

        def total(key, table):
            sums = as_matrix(table.column("sums").combine_chunks()).sum(0) / sum(table.column("n").to_pylist())
            return pa.table({"cell": [key[0].as_py()], "mean": pa.array([sums], pa.list_(pa.float64()))})

        means = d.select("v").mapInArrow(add, "cell long, n double, sums array<double>").groupBy("cell").applyInArrow(total, "cell long, mean array<double>")
        found = means.toArrow()  # a row a cell
        moved = centroids.copy()  # a cell without vectors stays where it is
        moved[found.column("cell").to_numpy()] = as_matrix(found.column("mean").combine_chunks())
        shared.unpersist()
        if np.allclose(moved, centroids, atol=1e-6):
            break
        centroids = moved
    return centroids


def build(docs: DataFrame, path: str, n_cells: int | None = None, doc_id: str = "vec_id", vector: str = "embedding", tile: int = TILE, recall: float = RECALL, **training) -> VectorIndex:
    """Writes the index of all of docs' vectors: about the square root of their number as cells, or ``n_cells``.

    It is written to a folder of its own, and ``path``/current names it once all vectors have been counted, so a reader
    never sees half an index, and a failed build leaves the index before in place."""
    spark = docs.sparkSession
    rows = vectors_of(docs, vector, [F.col(doc_id).alias("id")])
    n = rows.count()
    centroids = train(docs, min(MOST_CELLS, n_cells or max(1, round(math.sqrt(n)))), n, vector, **training)
    shared = spark.sparkContext.broadcast(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), ROWS_AT_ONCE):
                some = b.slice(at, ROWS_AT_ONCE)
                cell, distance = nearest(as_matrix(some.column(1)), shared.value)
                yield pa.record_batch([some.column(0), some.column(1), pa.array(cell.astype(np.int32)), pa.array(distance)], names=["id", "v", "cell", "distance"])

    kinds = dict(rows.dtypes)
    placed = materialized(rows.mapInArrow(place, f"id {kinds['id']}, v {kinds['v']}, cell int, distance double"))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius")).toPandas().sort_values("cell")
    tiles = spark.createDataFrame([(int(c), -(-int(m) // tile)) for c, m in zip(sizes["cell"], sizes["n"])], "cell int, tiles long")
    dealt = placed.join(F.broadcast(tiles), "cell").withColumn("tile", F.pmod(F.xxhash64("id", "v"), F.col("tiles")))
    packed = dealt.groupBy("cell", "tile").agg(F.collect_list(F.struct("id", "v")).alias("rows"))
    packed = packed.select("cell", "tile", F.col("rows.id").alias("ids"), F.flatten("rows.v").alias("vectors"))
    version = f"v-{uuid.uuid4().hex}"
    packed.repartition("cell").write.partitionBy("cell").parquet(f"{path}/{version}/vectors")
    cells = [(int(c), int(m), float(r), centroids[int(c)].tolist()) for c, m, r in zip(sizes["cell"], sizes["n"], sizes["radius"])]
    spark.createDataFrame(cells, "cell int, n long, radius double, centroid array<double>").coalesce(1).write.parquet(f"{path}/{version}/cells")
    arrived = spark.read.parquet(f"{path}/{version}/vectors").agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    if arrived != n:
        raise ValueError(f"{path} holds {arrived} vectors, not {n}")
    index = read_index(spark, f"{path}/{version}", 1)
    sample = placed.filter(F.pmod(F.xxhash64(F.lit(3), "v"), F.lit(max(1, n // TUNING))) == 0).select(F.col("id").alias("query_id"), F.col("v").alias("embedding"))
    index.probes = probes_for(index, sample, recall)
    spark.createDataFrame([(json.dumps({"version": version, "probes": index.probes}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/current")
    return index


def probes_for(index: VectorIndex, queries: DataFrame, recall: float, k: int = TOP_K) -> int:
    """With how many probes these queries (a few hundred) find the share ``recall`` of their exact hits."""
    queries = materialized(queries.dropDuplicates(["query_id"]))
    rows = queries.toArrow()
    order = cell_order(as_matrix(rows.column("embedding").combine_chunks()), index.centroids)
    place = np.argsort(order, axis=1)  # of each query, when each cell's turn comes
    number = {q: i for i, q in enumerate(rows.column("query_id").to_pylist())}
    column = {int(c): i for i, c in enumerate(index.cells)}
    found = search(index, queries, k, 1, exact=True, with_cell=True).select("query_id", "cell").collect()
    turns = np.sort([place[number[r["query_id"]], column[r["cell"]]] for r in found])
    return int(turns[min(len(turns) - 1, math.ceil(recall * len(turns)))]) + 1 if len(turns) else 1


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    now = json.loads(spark.read.text(f"{path}/current").first()["value"])
    return read_index(spark, f"{path}/{now['version']}", now["probes"])


def read_index(spark: SparkSession, path: str, probes: int) -> VectorIndex:
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").toArrow()  # MOST_CELLS rows at most
    if not len(cells):
        raise ValueError(f"the index in {path} is empty")
    number, radius = (cells.column(c).to_numpy() for c in ("cell", "radius"))
    return VectorIndex(spark, path, number, as_matrix(cells.column("centroid").combine_chunks()), radius, probes)


def cell_order(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Of each vector the cells by distance, as vectors are placed."""
    return np.argsort((centroids**2).sum(1) / 2 - vectors @ centroids.T, axis=1, kind="stable")


def probed(index: VectorIndex, queries: DataFrame, probes: int, beyond: bool) -> DataFrame:
    """query_id, v, cell: the ``probes`` cells whose centroids are nearest to each query; with ``beyond``
    the others whose bound reaches the query's ``least`` (a column)."""
    shared = index.spark.sparkContext.broadcast((index.cells, index.centroids, index.radii))
    kinds = dict(queries.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, centroids, radii = shared.value
        for b in batches:
            for at in range(0, len(b), ROWS_AT_ONCE):
                some = b.slice(at, ROWS_AT_ONCE)
                m = as_matrix(some.column(1))
                chosen = np.zeros((len(m), len(cells)), bool)
                np.put_along_axis(chosen, cell_order(m, centroids)[:, :probes], True, 1)
                if beyond:
                    least = some.column(2).to_numpy(zero_copy_only=False)
                    chosen = ~chosen & (m @ centroids.T + np.linalg.norm(m, axis=1)[:, None] * radii >= least[:, None] - 1e-6)
                q, c = np.nonzero(chosen)
                yield pa.record_batch([some.column(0).take(pa.array(q)), some.column(1).take(pa.array(q)), pa.array(cells[c].astype(np.int32))], names=["query_id", "v", "cell"])

    return queries.mapInArrow(run, f"query_id {kinds['query_id']}, v {kinds['v']}, cell int")


def hits(index: VectorIndex, pairs: DataFrame, k: int, digits: int) -> DataFrame:
    """Of the queries' vectors by cell (query_id, v, cell) the k best of each tile: query_id, doc_id, score, cell."""
    pairs = materialized(pairs)
    sizes = pairs.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_TILE).alias("blocks"), F.count(F.lit(1)).alias("n"))
    sizes = materialized(sizes)  # a row a probed cell
    known = sizes.select("cell", "n").collect()
    blocks = query_blocks(pairs.join(F.broadcast(sizes.select("cell", "blocks")), "cell"), ["cell"], F.col("blocks"))
    if sum(r["n"] for r in known) <= BROADCAST_VECTORS:
        blocks = F.broadcast(blocks)
    tiles = index.tiles.filter(F.col("cell").isin([r["cell"] for r in known]))  # only these folders are listed and read
    return best_of_pairs(tiles.join(blocks, "cell"), k, digits, ("cell",))


def search(index: VectorIndex, queries: DataFrame, k: int = TOP_K, probes: int | None = None, query_id: str = "query_id", vector: str = "embedding", digits: int = 6, exact: bool = False, with_cell: bool = False) -> DataFrame:
    """query_id, doc_id, score, dense_rank: the k greatest dot products in the ``probes`` cells nearest each query (by
    default as many as the index was measured to need), or with ``exact`` in all cells, ties by id."""
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.round("score", digits).desc(), "doc_id"))
    columns = ["query_id", "doc_id", "score", *(["cell"] if with_cell else [])]
    best = lambda d: d.select(columns).withColumn("dense_rank", rank).filter(F.col("dense_rank") <= k)
    q, probes = vectors_of(queries, vector, [F.col(query_id).alias("query_id")]), probes or index.probes
    found = best(hits(index, probed(index, q, probes, beyond=False), k, digits))
    if not exact:
        return found
    found = materialized(found)
    least = found.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least")).withColumnRenamed("query_id", "of")
    open_ = q.join(least, F.col("query_id") == F.col("of"), "left").select("query_id", "v", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
    more = hits(index, probed(index, open_, probes, beyond=True), k, digits)
    return best(found.select(columns).unionAll(more.select(columns)))
