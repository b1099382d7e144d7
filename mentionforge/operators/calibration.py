"""Choosing floor and margin: axes, grid, best pair, bootstrap, splits by cluster."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionforge.functions.arrays import at_share, gold_weight, jaccard
from mentionforge.operators.measures import all_codes, by_score, candidates_score, leak_rate, predicted
from mentionforge.operators.ranks import before, index, order_values
from mentionforge.operators.rows import keep_first, materialized

GRID_STEPS = 41
CLIP = 0.99
RESAMPLES = 300
DEV_RATIO = 0.25
GAP_WARNING = 0.05
#: Ties between sums of floats are decided on this many decimals.
DIGITS = 12


def score_axes(dump: DataFrame, steps: int = GRID_STEPS, clip: float = CLIP) -> DataFrame:
    """i, floor, margin: steps values of each, over the scores from the least to the clipped greatest."""
    if steps < 2:
        raise ValueError("an axis needs two steps or more")
    scores = dump.select(F.explode("candidates.rerank_score").alias("s"))
    ends = order_values(scores, [], "s", {"hi": (clip, index(clip))}).select(F.col("min").alias("lo"), "hi")
    span = F.when(F.col("hi") == F.col("lo"), F.lit(1.0)).otherwise(F.col("hi") - F.col("lo"))
    part = span * F.col("i") / (steps - 1)
    return ends.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("i")).select("i", (F.col("lo") + part).alias("floor"), part.alias("margin"))


def slices(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Of a heat map the row and the column through the best cell: keys, axis (floor, margin: what varies),
    value, score."""
    scores = materialized(scores)
    best = best_pair(scores, keys).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("floor").alias("__floor"), F.col("margin").alias("__margin"))
    d = scores.join(F.broadcast(best), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])  # one row a knowledge base
    cut = lambda varies, stays: d.filter(F.col(stays) == F.col(f"__{stays}")).select(*keys, F.lit(varies).alias("axis"), F.col(varies).alias("value"), "score")
    return cut("floor", "margin").union(cut("margin", "floor"))


def best_pair(scores: DataFrame, keys: list[str]) -> DataFrame:
    """floor, margin, score of the best cell; ties: the smaller margin, then the larger floor."""
    best = F.max_by(F.struct("floor", "margin", "score"), F.struct(F.col("score"), -F.col("margin"), F.col("floor")))
    return scores.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def prefix_scores(dump: DataFrame) -> DataFrame:
    """record_id, kb, w, scores (descending) and j, where j[n] is the similarity with the n best candidates predicted.
    A cell keeps the candidates from max(floor, best - margin) on, so its similarity is that of the shorter of two
    prefixes: those that the floor and the margin keep."""
    d = dump.withColumn("c", by_score(F.col("candidates")))
    j = F.transform(F.sequence(F.lit(0), F.size("c")), lambda n: jaccard(F.col("gold"), all_codes(F.slice("c", 1, n))))
    return d.select("record_id", "kb", gold_weight(F.col("gold")).cast("double").alias("w"), F.transform("c", lambda c: c["rerank_score"].cast("double")).alias("scores"), j.alias("j"))


def padded(lists: pa.Array, fill: float) -> np.ndarray:
    """Lists as rows of a matrix of the longest one's width."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    out = np.full((len(lists), int(sizes.max(initial=0))), fill)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def cell_matrix(scores: np.ndarray, j: np.ndarray, floors: np.ndarray, margins: np.ndarray) -> np.ndarray:
    """The similarity of each record (row) in each cell, floor by floor."""
    if not scores.shape[1]:
        return np.repeat(j[:, :1], len(floors) * len(margins), 1)
    by_floor = (scores[:, :, None] >= floors).sum(1)
    by_margin = (scores[:, :, None] >= (scores[:, :1] - margins)[:, None, :]).sum(1)
    kept = np.minimum(by_floor[:, :, None], by_margin[:, None, :]).reshape(len(scores), -1)
    return np.take_along_axis(j, kept, 1)


def bucket_share(total: int, before: np.ndarray, bucket: int, samples: int, seed: list[int]) -> np.ndarray:
    """How many of each sample's ``total`` draws fall to a bucket; before[b] records lie in the buckets before b. Buckets
    are halved again and again, and each half's draws are a binomial with a seed of its own, so every task that asks for a
    bucket computes the same tree, of which it needs one path."""
    low, high, n = 0, len(before) - 1, np.full(samples, total, np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        drawn = np.random.default_rng([*seed, low, high]).binomial(n, (before[middle] - before[low]) / max(1, before[high] - before[low]))
        low, high, n = (low, middle, drawn) if bucket < middle else (middle, high, n - drawn)
    return n


def drawn_times(n: np.ndarray, size: int, seed: int, bucket: int) -> np.ndarray:
    """How often each of a bucket's records is drawn in each sample, where the bucket is drawn n times."""
    return np.random.default_rng([seed, bucket]).multinomial(n, np.full(size, 1.0 / size))


#: Records that are resampled in one piece, about.
BUCKET_RECORDS = 4096
ROWS_AT_ONCE = 512
#: Counts of samples: of records' ids, in order, a matrix of how often each sample (row) has each record (column).
Times = Callable[[pa.Array], np.ndarray]


def cell_sums(dump: DataFrame, points: list, resamples: int | None = None, seed: int = 20260728, times: Times | None = None) -> DataFrame:
    """kb, sample, sums: of each task, weighted similarities by cell of the axes' points, and the weights' sum behind them;
    once with every record counted once, or for each of a number of samples with replacement, as many records as there are,
    or with the counts that ``times`` gives.

    A sample is drawn in two steps: how many of its draws fall to each bucket of records (by hash), and which records they
    are, both where the bucket lies. Sums by sample and cell are products of matrices in the tasks, which send one row a
    sample. The dump is computed once."""
    floors, margins = (np.array([p[c] for p in points]) for c in ("floor", "margin"))
    rows = materialized(prefix_scores(dump))
    n = rows.count()
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "record_id"), F.lit(max(1, n // BUCKET_RECORDS))).cast("int"))
    sizes: dict = {}
    if resamples and not times:
        for r in rows.groupBy("kb", "bucket").agg(F.count("*").alias("n")).collect():  # a number for BUCKET_RECORDS records
            sizes.setdefault(r["kb"], np.zeros(max(1, n // BUCKET_RECORDS) + 1, np.int64))[r["bucket"] + 1] = r["n"]
    before = {kb: np.cumsum(of) for kb, of in sizes.items()}
    number = {kb: i for i, kb in enumerate(sorted(before, key=lambda kb: (kb is not None, kb)))}

    def counts(kb, bucket: int, ids: pa.Array) -> np.ndarray:
        if times:
            return times(ids)
        if not resamples:
            return np.ones((1, len(ids)))
        share = bucket_share(int(before[kb][-1]), before[kb], bucket, resamples, [seed, number[kb]])
        return drawn_times(share, len(ids), seed + number[kb], bucket)

    def add(batches):
        totals: dict = {}
        held: list[pa.RecordBatch] = []

        def close() -> None:
            part = pa.Table.from_batches(held).sort_by("record_id").combine_chunks()
            kb, bucket = part.column("kb")[0].as_py(), part.column("bucket")[0].as_py()
            often = counts(kb, bucket, part.column("record_id").combine_chunks())
            sums = totals.setdefault(kb, np.zeros((len(often), len(floors) * len(margins) + 1)))
            for at in range(0, len(part), ROWS_AT_ONCE):
                some = part.slice(at, ROWS_AT_ONCE)
                scores, j = (padded(some.column(c).combine_chunks(), x) for c, x in (("scores", -np.inf), ("j", 0.0)))
                weights = often[:, at : at + len(some)] * some.column("w").to_numpy()
                sums[:, :-1] += weights @ cell_matrix(scores, j, floors, margins)
                sums[:, -1] += weights.sum(1)
            held.clear()

        for b in batches:
            kbs, buckets = b.column("kb").to_pylist(), b.column("bucket").to_numpy()
            cuts = [0, *(i for i in range(1, len(b)) if (kbs[i], buckets[i]) != (kbs[i - 1], buckets[i - 1])), len(b)]
            for x, y in zip(cuts, cuts[1:]):
                if held and (held[-1].column("kb")[0].as_py(), held[-1].column("bucket")[0].as_py()) != (kbs[x], buckets[x]):
                    close()
                if y > x:
                    held.append(b.slice(x, y - x))
        if held:
            close()
        for kb, sums in totals.items():
            yield pa.record_batch([pa.array([kb] * len(sums), pa.string()), pa.array(np.arange(len(sums))), pa.array(list(sums), pa.list_(pa.float64()))], names=["kb", "sample", "sums"])

    dealt = rows.repartition("kb", "bucket").sortWithinPartitions("kb", "bucket")
    return dealt.select("record_id", "kb", "bucket", "w", "scores", "j").mapInArrow(add, "kb string, sample long, sums array<double>")


def cell_table(key, table, points: list) -> pa.Table:
    """kb, sample, floor, margin, score of all cells, from a knowledge base's and sample's sums."""
    floors, margins = (np.array([p[c] for p in points]) for c in ("floor", "margin"))
    sums = np.sum(padded(table.column("sums").combine_chunks(), 0.0), 0)
    score = np.round(sums[:-1] / sums[-1] if sums[-1] else 0 * sums[:-1], DIGITS)
    f, m = np.divmod(np.arange(len(score)), len(margins))
    n = len(score)
    return pa.table({"kb": pa.array([key[0].as_py()] * n, pa.string()), "sample": [key[1].as_py()] * n, "floor": floors[f], "margin": margins[m], "score": score})


CELL = "kb string, sample long, floor double, margin double, score double"


def heat_map(dump: DataFrame, axes: DataFrame) -> DataFrame:
    """kb, floor, margin, score of every cell."""
    points = axes.orderBy("i").collect()
    cells = cell_sums(dump, points).groupBy("kb", "sample").applyInArrow(lambda key, table: cell_table(key, table, points), CELL)
    return cells.drop("sample")


def best_cells(dump: DataFrame, axes: DataFrame, resamples: int | None = None, seed: int = 20260728, times: Times | None = None) -> DataFrame:
    """kb, sample, floor, margin, score: the best cell (best_pair) of each knowledge base, or of each of its samples."""
    points = axes.orderBy("i").collect()

    def choose(key, table):
        cells = cell_table(key, table, points)
        score, floor, margin = (cells.column(c).to_numpy() for c in ("score", "floor", "margin"))
        return cells.slice(int(np.lexsort((-floor, margin, -score))[0]), 1)

    return cell_sums(dump, points, resamples, seed, times).groupBy("kb", "sample").applyInArrow(choose, CELL)


def spread(winners: DataFrame, keys: list[str]) -> DataFrame:
    """The values at 5 and 95 percent (by index) of the winners' floors and margins, and how many pairs won."""
    at = lambda c, p: at_share(F.array_sort(F.collect_list(c)), p)
    return winners.groupBy(*keys).agg(
        at("floor", 0.05).alias("floor_p05"), at("floor", 0.95).alias("floor_p95"), at("margin", 0.05).alias("margin_p05"), at("margin", 0.95).alias("margin_p95"),
        F.countDistinct(F.struct("floor", "margin")).alias("n_pairs"),
    )


def split(rows: DataFrame, dev_ratio: float = DEV_RATIO, seed: str = "20260728") -> DataFrame:
    """rows (row_no, mention, kb, noise, gold_kind, cluster_name) with is_dev.

    Rows of a cluster are one unit and stay together; a unit belongs to its commonest stratum (noise, gold_kind; ties:
    the one seen first). In each stratum units come in order of a seeded hash and go to dev while it has fewer rows than
    its share."""
    name = lambda c: F.coalesce(c, F.lit("None"))
    clustered = F.coalesce(F.col("cluster_name"), F.lit("")) != ""
    unit = F.when(clustered, F.concat_ws("::", F.lit("cluster"), name(F.col("kb")), "cluster_name")).otherwise(F.concat_ws("::", F.lit("row"), name(F.col("kb")), name(F.col("mention"))))
    d = rows.withColumn("unit", unit)
    strata = d.groupBy("unit", "noise", "gold_kind").agg(F.count("*").alias("c"), F.min("row_no").alias("first"))
    units = strata.groupBy("unit").agg(F.min_by(F.struct("noise", "gold_kind"), F.struct(-F.col("c"), F.col("first"))).alias("stratum"), F.sum("c").alias("n"))
    units = units.withColumn("md5", F.md5(F.concat_ws("|", F.lit(seed), "unit").cast("binary")))
    placed = before(units, ["stratum"], F.substring("md5", 1, 3), ["md5", "unit"], F.col("n"))
    return d.join(placed.select("unit", (F.col("before") < F.bround(F.col("total") * F.lit(dev_ratio))).alias("is_dev")), "unit")


def sweep(dump: DataFrame, is_dev: DataFrame, steps: int = GRID_STEPS, resamples: int = RESAMPLES, seed: int = 20260728) -> dict:
    """The report of one knowledge base: the chosen pair, its scores on both sides, bootstrap ranges, leaks. is_dev:
    record_id, is_dev."""
    rows = dump.join(is_dev.select("record_id", "is_dev"), "record_id")
    axes = score_axes(dump, steps)
    chosen = best_cells(rows.filter("NOT is_dev"), axes).first()
    ranges = spread(best_cells(rows.filter("NOT is_dev"), axes, resamples, seed), []).first().asDict()
    dev = rows.filter("is_dev").withColumn("predicted", predicted(F.col("candidates"), F.lit(chosen["floor"]), F.lit(chosen["margin"])))
    dev_score = candidates_score(dev).first()
    gap = chosen["score"] - dev_score["score"]
    return {
        "floor": chosen["floor"], "margin": chosen["margin"], "sweep_score": chosen["score"], "dev_score": dev_score["score"], "n_dev": dev_score["n"], "n_sweep": rows.count() - dev_score["n"],
        "warn": abs(gap) > GAP_WARNING, **ranges, "leaks": [r.asDict() for r in leak_rate(dump, chosen["floor"], chosen["margin"]).collect()],
    }


def without_repeats(dump: DataFrame) -> DataFrame:
    """Of rows with the same mention and knowledge base the first: a row that is evaluated twice counts once."""
    return keep_first(dump, ["mention", "kb"], ["row_no"])


def sweep_all(dump: DataFrame, variant: str, instructions: str, today: str, steps: int = GRID_STEPS, resamples: int = RESAMPLES, dev_ratio: float = DEV_RATIO, seed: int = 20260728) -> tuple[dict, dict]:
    """Thresholds by knowledge base with metadata, and the split, both as JSON-able objects. Repeated rows are removed
    first; the split is made over all knowledge bases together. dump has row_no and record_id; evaluation sets are small."""
    once = materialized(without_repeats(dump))
    repeats = dump.count() - once.count()
    parts = materialized(split(once, dev_ratio, str(seed)))
    thresholds = {r["kb"]: sweep(once.filter(F.col("kb") == r["kb"]), parts, steps, resamples, seed) for r in once.select("kb").distinct().orderBy("kb").collect()}
    sides = {side: [r["mention"] for r in parts.filter(F.col("is_dev") == dev).orderBy("row_no").select("mention").collect()] for side, dev in (("sweep", False), ("dev", True))}
    thresholds["metadata"] = {"variant": variant, "seed": seed, "date": today, "grid_steps": steps, "bootstrap_resamples": resamples, "reranker_instruction": instructions, "repeats_removed": repeats}
    return thresholds, {"seed": seed, "dev_ratio": dev_ratio, "variant": variant, "deduped": True, **sides}


def save_json(value: dict, path: str) -> None:
    """A small result as one file on the driver's side."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")
