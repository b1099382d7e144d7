"""A lexical index that changes: segments that are written once, tombstones, and merges by size.

An index is a folder: each segment has its documents' lengths and its postings; each deletion writes the deleted ids for
the segments that were there. What a reader sees is named by a list in ``path``/current, which a change replaces as its
last step, so a failed change leaves the index as it was. Documents that are replaced are deleted from older segments.
Segments are merged, without their deleted documents, when FANOUT of them are of about one size, so a document is
written a logarithmic number of times; files that no list names any more may be removed with vacuum()."""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionforge.operators.lexical import BROADCAST_ROWS, LexicalIndex, build_index
from mentionforge.operators.rows import materialized

FANOUT = 4


@dataclass
class Segment:
    """Its folder's name, its documents when it was written, and the folders of ids that have gone since."""

    name: str
    n_docs: int
    gone: list[str] = field(default_factory=list)

    @property
    def size_class(self) -> int:
        return int(math.log(max(1, self.n_docs), FANOUT))


class Segments:
    """An index in ``path``; add, delete, merge and index() work on what the list in ``current`` names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/current")
        there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
        self.segments = [Segment(**s) for s in json.loads(spark.read.text(f"{path}/current").first()["value"])] if there else []

    def _commit(self, segments: list[Segment]) -> None:
        line = json.dumps([asdict(s) for s in segments])
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/current")
        self.segments = segments

    def _read(self, segment: Segment, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{segment.name}/{table}")

    def _live(self, segment: Segment, table: str, gone: bool = False, known: DataFrame | None = None) -> DataFrame:
        """A segment's rows without, or only (gone), those of deleted documents; of postings only those of known tokens."""
        d = self._read(segment, table)
        if known is not None:
            d = d.join(known, "tok", "left_semi")
        if not segment.gone:
            return d.limit(0) if gone else d
        ids = self.spark.read.parquet(*[f"{self.path}/{g}" for g in segment.gone]).select("doc_id").distinct()
        return d.join(ids, "doc_id", "left_semi" if gone else "left_anti")

    def _write(self, lengths: DataFrame, postings: DataFrame) -> Segment | None:
        name = f"segment-{uuid.uuid4().hex}"
        lengths.write.parquet(f"{self.path}/{name}/lengths")
        postings.repartition("tok").sortWithinPartitions("tok").write.parquet(f"{self.path}/{name}/postings")
        n = self.spark.read.parquet(f"{self.path}/{name}/lengths").count()
        return Segment(name, n) if n else None

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Adds documents, one row an id; those whose ids are there already replace them."""
        built = build_index(docs, id_col, text_col)
        new = self._write(built.lengths, built.postings)
        if new is None:
            return
        ids = self._read(new, "lengths").select("doc_id")
        self._commit(self._merged([*self._without(ids), new]))

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        self._commit(self._without(ids.select(F.col(id_col).alias("doc_id"))))

    def _without(self, ids: DataFrame) -> list[Segment]:
        """The segments with the ids that they have noted as gone."""
        out = []
        for s in self.segments:
            name = f"gone-{uuid.uuid4().hex}"
            self._live(s, "lengths").select("doc_id").join(ids.distinct(), "doc_id", "left_semi").write.parquet(f"{self.path}/{name}")
            some = not self.spark.read.parquet(f"{self.path}/{name}").isEmpty()
            out.append(Segment(s.name, s.n_docs, [*s.gone, name] if some else s.gone))
        return out

    def _merged(self, segments: list[Segment]) -> list[Segment]:
        while True:
            classes: dict[int, list[Segment]] = {}
            for s in segments:
                classes.setdefault(s.size_class, []).append(s)
            full = next((c for c in classes.values() if len(c) >= FANOUT), None)
            if full is None:
                return segments
            lengths, postings = (self._union([self._live(s, t) for s in full]) for t in ("lengths", "postings"))
            one = self._write(lengths, postings)
            segments = [s for s in segments if s not in full] + ([one] if one else [])

    @staticmethod
    def _union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def index(self, vocabulary: DataFrame | None = None) -> LexicalIndex:
        """All live documents, for lexical.search. Frequencies are those of postings that are still there. With a vocabulary
        (tok) only its tokens' postings are read, before any is looked up among the deleted: enough for a search."""
        if not self.segments:
            raise ValueError(f"the index in {self.path} is empty")
        known = None
        if vocabulary is not None:
            known = materialized(vocabulary.select("tok").distinct())
            known = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
        lengths = self._union([self._live(s, "lengths") for s in self.segments])
        postings = self._union([self._live(s, "postings", known=known) for s in self.segments])
        postings = postings if known is None else materialized(postings)
        n, total = lengths.agg(F.count(F.lit(1)), F.coalesce(F.sum("doc_len"), F.lit(0))).first()
        frequencies = materialized(postings.groupBy("tok").agg(F.count(F.lit(1)).alias("df")))
        return LexicalIndex(postings, frequencies, n, total, lengths)

    def vacuum(self) -> None:
        """Removes what the current list does not name. No reader may still use an older one."""
        named = {"current", *(s.name for s in self.segments), *(g for s in self.segments for g in s.gone)}
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        store = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for status in store.listStatus(root):
            if status.getPath().getName() not in named:
                store.delete(status.getPath(), True)
