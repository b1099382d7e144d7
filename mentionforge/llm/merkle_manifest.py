"""Merkle dataset manifest: a tree of digests over each group's rows, and one over the groups, with checked proofs.

A row's leaf is the digest of its fields. Per group, leaves ascend by id, and every ARITY consecutive nodes become their
digest while several remain; what remains is the group's subroot, and the subroots in order of the group give the root.

Leaves are computed where texts lie; only digests move. They are range-partitioned by group and id, which splits a hot
group, and numbered with the counts of the partitions before. The numbers deal them to blocks of ARITY^k leaves, complete
subtrees. What is left of the groups of several blocks are block nodes, a sparse forest keyed by group, level and
index. Forests are a commutative monoid: merging unites the nodes, and wherever all siblings of a run are there (their
number is known from the group's size) adds their parent. treeReduce merges the partitions' forests; k is such that a
forest never has more than about MOST_NODES nodes, however many rows there are. With that forest, each block gives its
rows' proofs in place. The groups' tree is made the same way from the subroots.

Edge cases: null fields have a form of their own, so they differ from empty ones; a null group comes first, a null id
first in its group; rows that share an id come in order of their leaves; a text is hashed whole by one task, however
long; a group of one row has its leaf as subroot, one group alone its subroot as root; only the named columns are read,
so others of any name do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructType

from mentionforge.llm.common import cut, fold, join_counted, partitions, quoted

ARITY = 16
#: Levels of a block at least, and nodes above blocks at most (but for a group's last block), from which levels follow.
LEAST_LEVELS = 2
MOST_NODES = 1 << 16
#: Group paths that are broadcast at most; more are joined by a shuffle that adaptive execution can split.
BROADCAST_GROUPS = 4096
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(nodes: Iterable[bytes]) -> bytes:
    """SHA-256 of the nodes' digests in hex."""
    return hashlib.sha256(b"".join(nodes).hex().encode()).digest()


def leaf(fields: Iterable[Column]) -> Column:
    """SHA-256, in binary, of fields in the form length:value, or - for null."""
    text = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]).cast("binary"), 256))


def run_size(n: int, level: int, run: int) -> int:
    """How many nodes of ``level`` a run has in a tree of n leaves."""
    return min(ARITY, -(-n // ARITY**level) - run * ARITY)


class Forest:
    """Nodes of trees, keyed by tree, level and index; sizes: the leaves of each tree."""

    def __init__(self):
        self.sizes: dict[str | None, int] = {}
        self.nodes: dict[tuple[str | None, int, int], bytes] = {}

    def add(self, tree: str | None, n: int, level: int, index: int, node: bytes) -> None:
        self.sizes[tree] = n
        self.nodes[tree, level, index] = node
        self.complete(tree, level, index // ARITY)

    def complete(self, tree: str | None, level: int, run: int) -> None:
        """Adds the run's parent, and whatever that completes, where all siblings are there."""
        while -(-self.sizes[tree] // ARITY**level) > 1 and (tree, level + 1, run) not in self.nodes:
            siblings = self.run(tree, level, run)
            if None in siblings:
                return
            level, run, at = level + 1, run // ARITY, run
            self.nodes[tree, level, at] = digest(siblings)

    def run(self, tree: str | None, level: int, run: int) -> list[bytes]:
        return [self.nodes.get((tree, level, run * ARITY + k)) for k in range(run_size(self.sizes[tree], level, run))]

    def merge(self, other: Forest) -> Forest:
        """The union, with what it completes."""
        if len(other.nodes) > len(self.nodes):
            self, other = other, self
        self.sizes |= other.sizes
        self.nodes |= other.nodes
        for tree, level, index in other.nodes:
            self.complete(tree, level, index // ARITY)
        return self

    def root(self, tree: str | None) -> bytes:
        n, level = self.sizes[tree], 0
        while -(-n // ARITY**level) > 1:
            level += 1
        return self.nodes[tree, level, 0]

    def path(self, tree: str | None, level: int, index: int) -> list[tuple[int, list[bytes]]]:
        """The runs from a node up to below the root, each with the place in it."""
        out = []
        while -(-self.sizes[tree] // ARITY**level) > 1:
            out.append((index % ARITY, self.run(tree, level, index // ARITY)))
            level, index = level + 1, index // ARITY
        return out


def levels_of(leaves: list[bytes], levels: int | None) -> list[list[bytes]]:
    """All levels over the leaves: ``levels`` above them, or up to one node where None."""
    out = [leaves]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        out.append([digest(out[-1][k : k + ARITY]) for k in range(0, len(out[-1]), ARITY)])
    return out


def numbered(leaves: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """leaves (tree, key, leaf, ...) with idx, the place in its tree in order of key and leaf, nulls first; each tree's
    size (tree, n); the number of all leaves."""
    order = [F.col("tree").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf")]
    d = leaves.repartitionByRange(partitions(leaves), *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    d = cut(d)  # a row's place in its partition is fixed from here on
    spans = cut(d.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n")), few=True)
    before = F.sum("n").over(W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    # Only a partition's first tree can have begun in another one, so there is one number a partition at most.
    begun = {r.part: r.before for r in spans.withColumn("before", before).filter("before > 0").select("part", "before").collect()}
    sizes = spans.groupBy("tree").agg(F.sum("n").alias("n"))
    schema = d.select("*", F.lit(0).cast("long").alias("idx")).schema
    at_tree, at_part = d.columns.index("tree"), d.columns.index("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, None
        for b in batches:
            ends = pc.run_end_encode(b.column(at_tree))
            begin, idx = 0, []
            for end, tree in zip(ends.run_ends.to_pylist(), ends.values.to_pylist(), strict=True):
                if at is None:
                    at = begun.get(b.column(at_part)[0].as_py(), 0)
                elif tree != last:
                    at = 0
                idx.append(np.arange(at, at + end - begin))
                last, at, begin = tree, at + end - begin, end
            yield pa.record_batch([*b.columns, pa.array(np.concatenate(idx) if idx else [], pa.int64())], schema=pa.schema([*b.schema, ("idx", pa.int64())]))

    total = spans.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return d.mapInArrow(run, schema), sizes, total


class Trees:
    """The trees over ``leaves`` (tree string, key, leaf binary, extra): blocks, the forest above them, and subroots."""

    def __init__(self, leaves: DataFrame):
        d, sizes, total = numbered(leaves)
        self.levels = LEAST_LEVELS
        while total > MOST_NODES * ARITY**self.levels:
            self.levels += 1
        self.size = ARITY**self.levels
        # A block has at most ``size`` leaves.
        rows = F.sort_array(F.collect_list(F.struct("idx", "key", "leaf", "extra"))).alias("leaves")
        blocks = d.groupBy("tree", F.floor(F.col("idx") / self.size).alias("block")).agg(rows)
        self.blocks = cut(join_counted(blocks, sizes, ["tree"], "inner"))
        nodes = cut(self.blocks.select("tree", "n", "block", "leaves.leaf").mapInArrow(self._nodes(), "tree string, n long, block long, node binary"))
        self.forest = self._reduced(nodes.filter(F.col("n") > self.size))
        roots = [(tree, bytearray(self.forest.root(tree))) for tree in self.forest.sizes]
        self.subroots = nodes.filter(F.col("n") <= self.size).select("tree", F.col("node").alias("subroot"))
        if roots:
            self.subroots = self.subroots.unionAll(leaves.sparkSession.createDataFrame(roots, "tree string, subroot binary"))

    def _nodes(self):
        size, levels = self.size, self.levels

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [levels_of(leaves, levels if n > size else None)[-1][0] for n, leaves in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True)]
                yield pa.record_batch([*b.columns[:3], pa.array(found, pa.binary())], names=["tree", "n", "block", "node"])

        return run

    def _reduced(self, nodes: DataFrame) -> Forest:
        levels = self.levels

        def fragment(rows: Iterable) -> Iterator[Forest]:
            forest = Forest()
            for r in rows:
                forest.add(r.tree, r.n, levels, r.block, bytes(r.node))
            yield forest

        fragments = nodes.rdd.mapPartitions(fragment)
        return fragments.treeReduce(Forest.merge) if fragments.getNumPartitions() else Forest()

    def proofs(self, tops: DataFrame | None = None, root: bytes | None = None) -> DataFrame:
        """Without tops: per leaf key and path (its runs up to the root, and its place in each). With tops (tree, path
        from the subroot on, subroot): the rows' results."""
        forest = self.blocks.sparkSession.sparkContext.broadcast(self.forest)  # about MOST_NODES nodes
        size, levels, key = self.size, self.levels, self.blocks.schema["leaves"].dataType.elementType["key"].dataType
        steps = pa.list_(pa.struct([("place", pa.int32()), ("run", pa.list_(pa.binary()))]))

        def paths(b: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[bytes], list, list[list[tuple[int, list[bytes]]]]]]:
            """Of each block the keys, leaves, extras, and paths to the subroot."""
            for tree, n, block, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                keys, leaves, extra = (rows.values.field(f) for f in ("key", "leaf", "extra"))
                leaves = leaves.to_pylist()
                inside = levels_of(leaves, levels if n > size else None)[:-1]
                above = forest.value.path(tree, levels, block) if n > size else []
                yield keys, leaves, extra.to_pylist(), [[(i // ARITY**v % ARITY, nodes[i // ARITY ** (v + 1) * ARITY :][:ARITY]) for v, nodes in enumerate(inside)] + above for i in range(len(leaves))]

        def only_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for keys, _, _, found in paths(b):
                    rows = [[{"place": p, "run": r} for p, r in path] for path in found]
                    yield pa.record_batch([keys, pa.array(rows, steps)], names=["key", "path"])

        def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for (keys, leaves, changed, found), top, subroot in zip(paths(b), b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True):
                    top = [(s["place"], s["run"]) for s in top]
                    above = b"".join(node for place, run in top for k, node in enumerate(run) if k != place).hex().encode()
                    proof, folded = [], []
                    for node, other, path in zip(leaves, changed, found, strict=True):
                        siblings = b"".join(x for place, run in path for k, x in enumerate(run) if k != place).hex().encode()
                        proof.append(hashlib.sha256(siblings + above).hexdigest())
                        node = node if other is None else other
                        for place, run in path + top:
                            node = digest([*run[:place], node, *run[place + 1 :]])
                        folded.append(node)
                    n = len(leaves)
                    columns = [[x.hex() for x in leaves], [subroot.hex()] * n, [root.hex()] * n, proof, [x.hex() for x in folded]]
                    yield pa.record_batch([keys, *(pa.array(c, pa.string()) for c in columns), pa.array([x == root for x in folded], pa.bool_())], names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

        blocks = self.blocks.select("tree", "n", "block", "leaves")
        if tops is None:
            path = ArrayType(StructType().add("place", "integer").add("run", ArrayType(BinaryType())))
            return blocks.mapInArrow(only_paths, StructType().add("key", key).add("path", path))
        many = tops.count()
        tops = tops.withColumnRenamed("tree", "tree_of")
        joined = blocks.join(F.broadcast(tops) if many <= BROADCAST_GROUPS else tops, F.col("tree").eqNullSafe(F.col("tree_of")))
        schema = StructType().add("doc_id", key)
        for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root"):
            schema = schema.add(c, "string")
        return joined.select("tree", "n", "block", "leaves", "path", "subroot").mapInArrow(results, schema.add("verified", "boolean"))


def leaf_rows(docs: DataFrame, changed: Column | None = None, fields: list[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """tree (the group), key (the id), leaf, extra (the leaf of changed rows, else null)."""
    extra = F.lit(None).cast("binary") if changed is None else changed
    return docs.select(docs[quoted(group_col)].cast("string").alias("tree"), docs[quoted(id_col)].alias("key"), leaf([docs[quoted(c)] for c in fields]).alias("leaf"), extra.alias("extra"))


def group_leaves(trees: Trees) -> DataFrame:
    """The subroots as the leaves of one tree."""
    return trees.subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("subroot").alias("leaf"), F.lit(None).cast("binary").alias("extra"))


def manifest(docs: DataFrame, fields: list[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """Per group: group, subroot, root, in hex. Tables whose manifests are equal have equal rows, and where they differ
    the subroots tell in which groups."""
    trees = Trees(cut(leaf_rows(docs, None, fields, id_col, group_col)))
    top = Trees(group_leaves(trees)).subroots.select(F.col("subroot").alias("root"))  # one row
    hexed = lambda c: F.lower(F.hex(c)).alias(c)
    root = top.first()
    return trees.subroots.select(F.col("tree").alias("group"), hexed("subroot"), F.lit(bytes(root.root).hex() if root else None).cast("string").alias("root"))


def proofs(docs: DataFrame, changed: Column | None = None, fields: list[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256 (the digest of its path's siblings), folded_root (the root that
    its leaf, or its changed leaf, gives with these siblings), verified (that this is the root)."""
    # Texts are read once; digests alone are sorted and dealt.
    trees = Trees(cut(leaf_rows(docs, changed, fields, id_col, group_col)))
    groups = Trees(group_leaves(trees))
    root = groups.subroots.first()
    paths = groups.proofs()
    tops = cut(paths.join(trees.subroots, F.col("key").eqNullSafe(F.col("tree"))).select("tree", "path", "subroot"), few=True)
    return trees.proofs(tops, bytes(root.subroot) if root else b"")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fields = [docs[c] for c in FIELDS[:-1]]
    tampered = leaf([*fields, F.translate("text", UPPER, LOWER)])
    return proofs(docs, F.when(fold(F.col("doc_id")) == 0, tampered))


#: Levels of each tree in SQL, up to 16^5 leaves.
SQL_LEVELS = 5


def level_sql(name: str, rows: str) -> str:
    """Of a table ``rows`` (g, i, h) the tables name_0 to name_5 of levels, in which a tree that is one node stays so."""
    one = f"{name}_0 AS (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS m FROM {rows})"
    more = [
        f"""{name}_{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY g) AS m FROM (
  SELECT g, CASE WHEN m > 1 THEN i // 16 ELSE i END AS i, CASE WHEN any_value(m) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h
  FROM {name}_{k} GROUP BY g, m, CASE WHEN m > 1 THEN i // 16 ELSE i END))"""
        for k in range(SQL_LEVELS)
    ]
    runs = [
        f"""{name}_run_{k} AS (SELECT a.g, a.i, a.m > 1 AS is_run, CASE WHEN a.m > 1 THEN coalesce((SELECT string_agg(b.h, '' ORDER BY b.i) FROM {name}_{k} b
  WHERE b.g IS NOT DISTINCT FROM a.g AND b.i // 16 = a.i // 16 AND b.i < a.i), '') ELSE '' END AS lo,
  CASE WHEN a.m > 1 THEN coalesce((SELECT string_agg(b.h, '' ORDER BY b.i) FROM {name}_{k} b
  WHERE b.g IS NOT DISTINCT FROM a.g AND b.i // 16 = a.i // 16 AND b.i > a.i), '') ELSE '' END AS hi FROM {name}_{k} a)"""
        for k in range(SQL_LEVELS)
    ]
    return ",\n".join([one, *more, *runs])


def fold_sql(name: str, rows: str, columns: str, out: str) -> str:
    """Carries proof and folded up a tree: of ``rows`` (columns, g, i, proof, folded) to ``out`` after its levels."""
    steps, before = [], rows
    for k in range(SQL_LEVELS):
        after = out if k == SQL_LEVELS - 1 else f"{out}_{k}"
        steps.append(f"""{after} AS (SELECT {columns}, r.g, CASE WHEN is_run THEN r.i // 16 ELSE r.i END AS i, proof || lo || hi AS proof,
  CASE WHEN is_run THEN sha256(lo || folded || hi) ELSE folded END AS folded
  FROM {before} r JOIN {name}_run_{k} n ON r.g IS NOT DISTINCT FROM n.g AND r.i = n.i)""")
        before = after
    return ",\n".join(steps)


ORACLE = rf"""
WITH f AS (
  SELECT doc_id, source, text, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda k: ascii(substr(doc_id::VARCHAR, k, 1))::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS crc,
         {" || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in FIELDS[:-1])} AS head
  FROM documents),
leaves AS (
  SELECT doc_id, source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i,
         sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS h,
         sha256(head || coalesce(strlen(text)::VARCHAR || ':' || CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END, '-')) AS other
  FROM f),
{level_sql("low", "leaves")},
subroots AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, h, g AS source FROM low_{SQL_LEVELS}),
{level_sql("top", "subroots")},
start AS (SELECT doc_id, h AS leaf, g AS source, g, i, '' AS proof, other AS folded FROM leaves),
{fold_sql("low", "start", "doc_id, leaf, source", "up")},
between AS (SELECT u.doc_id, u.leaf, s.h AS subroot, 0 AS g, s.i, u.proof, u.folded FROM up u JOIN subroots s ON u.source IS NOT DISTINCT FROM s.source),
{fold_sql("top", "between", "doc_id, leaf, subroot", "done")}
SELECT doc_id, leaf, subroot, (SELECT h FROM top_{SQL_LEVELS}) AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = (SELECT h FROM top_{SQL_LEVELS}) AS verified
FROM done
"""
