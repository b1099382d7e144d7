"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's sketch is the ``k`` smallest distinct 64-bit hashes of its five-word shingles (fewer words: the one shingle
of all), in ascending order. Sketches of parts merge into the sketch of the whole, and estimate how many distinct
shingles a text has, how alike two texts are and how much of one is in the other. DataFrame operations only.

Edge cases: a null text counts as empty and has the empty sketch; texts are hashed whole, however long (one is held by
one task); two empty sketches have likeness 1, an empty and another one 0; equal texts have equal sketches; rows that
share an id follow each other in order of their text, in one task; a null id comes first; ids are whole numbers where
successors are asked for, of any type else; a single row is its own successor; only the id and the text are read, so
other columns of any name do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentionforge.llm.common import partitions, quoted, whole, words

WIDTH = 5
#: The standard error of a likeness is at most 0.5 / sqrt(K).
K = 128
#: Blocks of ids in which successors are found, at most; their bounds go through the driver.
MOST_BLOCKS = 65_536


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def sketch_of(hashes: Column, k: int = K, width: int = WIDTH) -> Column:
    """The sketch of a column of word hashes (as ``word_hashes`` makes them)."""
    n = F.size(hashes)
    every = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(width)]))
    few = F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(hashes)))
    return F.slice(F.sort_array(F.array_distinct(F.when(n < width, few).otherwise(every))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def unit(h: Column) -> Column:
    """A hash as a number in 0..1."""
    return (h.cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / unit(F.get(sketch, F.lit(k - 1))))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of the two texts' distinct shingles that both have."""
    both = F.size(F.array_intersect(merged(a, b, k), F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / F.greatest(F.size(merged(a, b, k)), F.lit(1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of a's distinct shingles that b has, between 0 and 1; 1 for an empty a."""
    union = distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), resemblance(a, b, k) * union / distinct_shingles(a, k)))


def as_text(sketch: Column) -> Column:
    """16 hexadecimal digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """doc_id, sketch of each row."""
    hashed = docs.select(docs[quoted(id_col)].alias("doc_id"), word_hashes(docs[quoted(text_col)]).alias("h"))
    return hashed.select("doc_id", sketch_of(F.col("h"), k).alias("sketch"))


def merge_parts(parts: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """Merges sketches (column sketch) by keys. Hashes are deduplicated by key before they are put in order, so
    that a key's parts need not fit into one task; only its k smallest hashes are gathered."""
    hashes = parts.select(*keys, F.explode_outer("sketch").alias("h")).distinct()
    ranked = hashes.withColumn("r", F.row_number().over(W.partitionBy(*keys).orderBy(F.col("h").asc_nulls_last()))).filter(F.col("r") <= k)
    return ranked.groupBy(*keys).agg(F.sort_array(F.collect_list("h")).alias("sketch"))


def with_next(docs: DataFrame, blocks: int) -> tuple[DataFrame, W]:
    """Columns key, text and a window in which the next row is the next document.

    Ids are cut into blocks at quantiles that are ids themselves. A block's first row also goes, as a guard, to the
    end of the block before, and the first of all to the last block, so each block has all successors of its rows
    and no task sees more than its blocks. Guards are dropped after use.
    """
    low = -(2**63)
    d = docs.withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(low)))
    at = [i / blocks for i in range(blocks)]
    found = d.agg(F.min("key").alias("first"), F.percentile_approx("key", at, 20 * blocks).alias("at")).first()
    bounds = sorted({found["first"], *(found["at"] or [])} - {None}) or [low]
    # A key's block in two steps: its chunk by the chunks' first bounds, then its place in the chunk.
    step = math.isqrt(len(bounds) - 1) + 1
    chunks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    array = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")  # noqa: E731  a constant
    upto = lambda xs: F.size(F.filter(xs, lambda x: x <= F.col("key"))) - 1
    d = d.withColumn("chunk", upto(array([c[0] for c in chunks])))
    d = d.withColumn("starts", F.get(F.array(*[array(c) for c in chunks]), F.col("chunk")))
    is_start = F.array_contains("starts", F.col("key"))
    previous = F.when(F.col("block") == 0, len(bounds) - 1).otherwise(F.col("block") - 1)
    copies = F.when(F.col("is_start"), F.array(F.struct(F.col("block"), F.lit(False).alias("guard")), F.struct(previous.alias("block"), F.lit(True).alias("guard")))).otherwise(F.array(F.struct(F.col("block"), F.lit(False).alias("guard"))))
    d = d.withColumns({"block": F.col("chunk") * step + upto(F.col("starts")), "is_start": is_start}).drop("chunk", "starts")
    d = d.withColumn("c", F.explode(copies)).withColumns({"block": F.col("c.block"), "guard": F.col("c.guard")}).drop("c", "is_start")
    return d, W.partitionBy("block").orderBy("guard", "key", "text")


def edited_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Per row its fingerprint, and that of its text with the second half replaced by the next row's beginning."""
    blocks = min(4 * partitions(docs), MOST_BLOCKS)
    if dict(docs.dtypes)[id_col] not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"the successor of a document is that with the next whole number; {id_col} is none")
    plain = docs.select(docs[quoted(id_col)].alias("doc_id"), whole(docs[quoted(text_col)]).alias("text"))
    d, order = with_next(plain, blocks)
    d = d.withColumn("n_chars", F.length("text").cast("long")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    d = d.withColumn("next_text", F.coalesce(F.lead("text").over(order), F.lit("")))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - F.col("half")), F.substring("next_text", F.lit(1), F.col("half")))
    d = d.withColumn("edited", edited).drop("next_text")
    d = d.withColumns({"h": word_hashes(F.col("text")), "eh": word_hashes(F.col("edited"))})
    d = d.withColumns({"sketch": sketch_of(F.col("h"), k), "edited_sketch": sketch_of(F.col("eh"), k), "edited_sha256": F.sha2("edited", 256)}).drop("h", "eh", "edited")
    d = d.withColumn("next_sketch", F.lead("sketch").over(order)).filter("NOT guard")
    mine, other, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return d.select(
        "doc_id", "n_chars", "edited_sha256", as_text(mine).alias("fingerprint"), as_text(other).alias("edited_fingerprint"),
        resemblance(mine, other, k).alias("near_edited"), resemblance(mine, after, k).alias("near_next"),
        containment(mine, other, k).alias("contained_in_edited"), distinct_shingles(mine, k).alias("n_shingles"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return edited_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
