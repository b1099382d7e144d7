"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters 0x20 and 0x09-0x0D.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"

#: A table with at most this many rows may be broadcast; larger ones are joined by a salted shuffle.
BROADCAST_ROWS = 100_000
SALTS = 64
#: Short rows that a checkpoint's file holds at least, where their number is known.
ROWS_A_FILE = 20_000


def quoted(name: str) -> str:
    """A column's name as a reference, whatever signs it has."""
    return f"`{name.replace('`', '``')}`"


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The runs of other characters than white space, in order; none for null."""
    t = F.btrim(whole(text), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN))


def word_count(text: Column) -> Column:
    t = F.btrim(whole(text), F.lit(SPACES))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE_RUN))).cast("long")


def fold(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def cut(df: DataFrame, rows: int | None = None, few: bool = False) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the folder of spark.checkpoint.dir. Where at most ``rows`` short
    rows are known to come, they lie in no more files than they fill; ``few`` is for tables of parameters' size."""
    shared_folder(df.sparkSession)
    if few:
        df = df.coalesce(max(1, partitions(df) // 50))
    elif rows is not None:
        df = df.coalesce(max(1, min(partitions(df), -(-rows // ROWS_A_FILE))))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is not set, a local session gets a folder of its own; on a cluster
    there is no folder that all executors see, which is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder in whatever store it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_counted(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Joins on keys where null equals null. ``small`` (one row a key) is counted: up to BROADCAST_ROWS rows
    are broadcast; beyond it, its rows are copied to SALTS salts, over which a hot key of ``big`` is dealt by the hash of
    its rows' plain columns, so that a repeated task gives the same salts."""
    renamed = small.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = F.lit(True)
    if small.count() <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    else:
        plain = [F.col(quoted(c)) for c, kind in big.dtypes if not kind.startswith(("array", "map", "struct", "variant"))]
        big = big.withColumn("__salt", F.pmod(F.xxhash64(F.lit(17), *plain), F.lit(SALTS)).cast("int"))
        renamed = renamed.withColumn("__salt_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        same = F.col("__salt") == F.col("__salt_of")
    for k in keys:
        same = same & big[k].eqNullSafe(renamed[f"__{k}"])
    return big.join(renamed, same, how).drop("__salt", "__salt_of", *[f"__{k}" for k in keys])
