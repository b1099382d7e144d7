"""Building a code table from parsed lines: column split, code streams, the join of two languages, the hierarchy."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mentionforge.functions.text import CODE_LINE, SPACE_CLASS, has_glyph_drop, split_head_tail

#: Bucket width in points, and the share of the fullest bucket up to which one counts as blank.
BUCKET_WIDTH = 10.0
BLANK_SHARE = 0.05
FOOTER_MARGIN = 45.0
#: Words of one line differ in height by less than this, in points.
LINE_TOLERANCE = 3.0


def column_split(words: DataFrame, width: float = BUCKET_WIDTH, blank: float = BLANK_SHARE) -> DataFrame:
    """words (page, x0, page_width) to page, split_x: the right edge, nearest to the page's middle, of a run of blank
    buckets between two dense ones (ties: the leftmost); the middle where there is none."""
    counts = words.groupBy("page", F.floor(F.col("x0") / width).alias("bucket")).agg(F.count("*").alias("n"), F.max("page_width").alias("page_width"))
    page = W.partitionBy("page")
    dense = counts.withColumn("most", F.max("n").over(page)).filter(F.col("n") > F.col("most") * blank)
    after = F.col("bucket") - F.lag("bucket").over(page.orderBy("bucket")) > 1
    edges = dense.withColumn("edge", F.when(after, F.col("bucket") * width))
    key = F.struct(F.abs(F.col("edge") - F.col("page_width") / 2), F.col("bucket"))
    middle = F.max("page_width") / 2
    return edges.groupBy("page").agg(F.coalesce(F.min_by("edge", F.when(F.col("edge").isNotNull(), key)), middle).cast("double").alias("split_x"))


def page_lines(words: DataFrame, splits: DataFrame | None = None, footer: float = FOOTER_MARGIN, tolerance: float = LINE_TOLERANCE) -> DataFrame:
    """words (page, x0, top, text, page_width, page_height) to page, side (left, right of the page's split), line_no, text.

    Words in the footer are cut off. In each half a word that stands lower than the one before by ``tolerance`` or more
    opens a line; a line's words are in order of x0. splits (page, split_x) defaults to column_split(words). A page is
    the unit of work."""
    body = words.filter(F.col("top") < F.col("page_height") - footer)
    splits = column_split(body) if splits is None else splits
    d = body.join(splits.select("page", "split_x"), "page").withColumn("side", F.when(F.col("x0") < F.col("split_x"), "left").otherwise("right"))
    down = W.partitionBy("page", "side").orderBy("top", "x0", "text")
    opens = F.coalesce((F.col("top") - F.lag("top").over(down) >= tolerance).cast("int"), F.lit(1))
    d = d.withColumn("__opens", opens).withColumn("line_no", F.sum("__opens").over(down.rowsBetween(W.unboundedPreceding, 0)))
    inside = F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda w: w["text"])
    return d.groupBy("page", "side", "line_no").agg(F.array_join(inside, " ").alias("text"))


def code_entries(lines: DataFrame, keys: list[str], line: str = "line_no", text: str = "text") -> DataFrame:
    """lines to one row per keys and code: code, description.

    A line that starts with a code opens its entry, other lines belong to the entry above, lines before the first code
    to none; entries of one code (marks † and * dropped) are joined in order."""
    stripped = F.regexp_replace(F.col(text), f"(?U)^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")
    d = lines.withColumn("__t", stripped).filter("__t <> ''")
    own = F.nullif(F.regexp_extract("__t", f"(?U){CODE_LINE}", 1), F.lit(""))
    d = d.withColumns({"__own": F.rtrim(own, F.lit("†*")), "__part": F.when(own.isNotNull(), F.regexp_extract("__t", f"(?U){CODE_LINE}", 2)).otherwise(F.col("__t"))})
    above = W.partitionBy(*keys).orderBy(line).rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("code", F.last("__own", ignorenulls=True).over(above)).filter("code IS NOT NULL")
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(line).alias("i"), F.col("__part").alias("t")))), lambda s: s["t"])
    return d.groupBy(*keys, "code").agg(F.trim(F.array_join(parts, " ")).alias("description"))


def join_languages(en: DataFrame, vi: DataFrame) -> DataFrame:
    """Two tables (code, description) to code, name_en, name_vi; a missing side is null."""
    return en.select("code", F.col("description").alias("name_en")).join(vi.select("code", F.col("description").alias("name_vi")), "code", "full_outer")


def hierarchy(spark: SparkSession, blocks: Iterable[tuple[str, str]]) -> DataFrame:
    """(chapter, block such as A00-A09 or V01-X59 or B99) to chapter, block, letter, low, high: a block that spans
    letters gives a row a letter."""
    d = spark.createDataFrame(list(blocks), "chapter string, block string")
    ends = F.split("block", "-")
    d = d.withColumns({"a": F.get(ends, F.lit(0)), "z": F.coalesce(F.get(ends, F.lit(1)), F.get(ends, F.lit(0)))})
    d = d.withColumn("at", F.explode(F.sequence(F.ascii("a"), F.ascii("z"))))
    number = lambda c: F.substring(c, 2, 2).cast("int")
    low = F.when(F.col("at") == F.ascii("a"), number("a")).otherwise(0)
    high = F.when(F.col("at") == F.ascii("z"), number("z")).otherwise(99)
    return d.select("chapter", "block", F.char(F.col("at").cast("long")).alias("letter"), low.alias("low"), high.alias("high"))


def lookup(codes: DataFrame, ranges: DataFrame, code: str = "code") -> DataFrame:
    """Adds chapter and block: those of the range of the code's letter that holds its number, else null. At most 2,600
    letter and number pairs exist, so the ranges are spread over them and joined on equality."""
    cells = ranges.select("letter", "chapter", "block", F.explode(F.sequence("low", "high")).alias("number")).filter("number BETWEEN 0 AND 99")
    cells = cells.groupBy(F.concat("letter", F.lpad(F.col("number").cast("string"), 2, "0")).alias("__stem")).agg(F.min(F.struct("chapter", "block")).alias("__found"))
    stem = F.regexp_extract(F.col(code), r"^([A-Z]\d{2})", 1)
    found = codes.withColumn("__key", stem).join(F.broadcast(cells), F.col("__key") == F.col("__stem"), "left")  # 26 x 100 rows at most
    return found.select(*codes.columns, F.col("__found.chapter").alias("chapter"), F.col("__found.block").alias("block"))


def code_records(joined: DataFrame, ranges: DataFrame, kb: str = "icd") -> DataFrame:
    """(code, name_en, name_vi) to the records of the code table. The text is the Vietnamese name, also with lost
    glyphs, and the English one only where there is none."""
    d = lookup(joined, ranges).withColumns({"vi": split_head_tail(F.col("name_vi")), "en": split_head_tail(F.col("name_en"))})
    return d.select(
        F.concat(F.lit(f"{kb}_"), "code").alias("doc_id"), "code", F.coalesce("vi.head", "en.head").alias("text"), F.col("vi.head").alias("name_vi"), F.col("en.head").alias("name_en"),
        F.col("vi.tail").alias("note_vi"), F.col("en.tail").alias("note_en"), "chapter", "block", F.lit(kb).alias("kb"), F.lit("candidate").alias("role"),
        (F.col("vi.head").isNotNull() & ~has_glyph_drop(F.col("vi.head"))).alias("vi_glyph_ok"),
    )


def code_table(page_lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """page_lines (page, side: left English, right Vietnamese, line_no, text) to records. Lines are in order of page
    and number; a book's streams are two, so they are built in two groups."""
    ordered = page_lines.withColumn("line_no", F.struct("page", "line_no"))
    entries = code_entries(ordered, ["side"])
    return code_records(join_languages(entries.filter("side = 'left'"), entries.filter("side = 'right'")), ranges)


def table_quality(records: DataFrame) -> DataFrame:
    """n, n_glyph_broken, share_broken (percent), n_english."""
    return records.agg(
        F.count("*").alias("n"), F.count_if(~F.col("vi_glyph_ok") & F.col("name_vi").isNotNull()).alias("n_glyph_broken"),
        F.coalesce(100.0 * F.count_if(~F.col("vi_glyph_ok") & F.col("name_vi").isNotNull()) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("share_broken"),
        F.count_if(F.col("name_vi").isNull()).alias("n_english"),
    )


def code_shape_ok(kb: Column, codes: Column) -> Column:
    """Whether all codes look like those of their knowledge base."""
    return F.when(kb == "icd", F.forall(codes, lambda c: c.rlike(r"^[A-Z]\d"))).when(kb == "rxnorm", F.forall(codes, lambda c: c.rlike(r"^\d+$"))).otherwise(F.lit(False))
