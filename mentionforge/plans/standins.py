"""Stand-ins over the driver's tables for the domain tables, in Spark SQL and in the comparison's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Terminology: every part is an atom of one of 500 concepts; parts and suppliers that are sold together are related.
CONSO_BODY = """
SELECT CAST(p_partkey % 500 AS {text}) AS rxcui, CAST(p_partkey AS {text}) AS rxaui, p_name AS str,
       CASE WHEN p_size % 10 = 0 THEN 'OTHER' ELSE 'RXNORM' END AS sab,
       CASE p_partkey % 9 WHEN 0 THEN 'IN' WHEN 1 THEN 'MIN' WHEN 2 THEN 'SY' WHEN 3 THEN 'TMSY' WHEN 4 THEN 'BN' WHEN 5 THEN 'SBD' WHEN 6 THEN 'SBDC' WHEN 7 THEN 'SBDF' ELSE 'SBDG' END AS tty,
       CASE WHEN p_size % 7 = 0 THEN 'O' ELSE 'N' END AS suppress
FROM part"""
REL_BODY = """
SELECT CAST(l_partkey % 500 AS {text}) AS rxcui1, CAST((l_partkey + l_suppkey) % 500 AS {text}) AS rxcui2,
       CASE WHEN l_linenumber = 7 THEN 'OTHER' ELSE 'RXNORM' END AS sab, l_returnflag AS rela
FROM lineitem"""

#: Score dump: an order is a mention, its lines are the candidates.
RECORD_BODY = """
SELECT o_orderkey AS record_id, CASE WHEN o_orderkey % 2 = 0 THEN 'icd' ELSE 'rxnorm' END AS kb,
       CASE WHEN o_orderpriority < '3' THEN 'mild' ELSE 'heavy' END AS noise,
       CASE WHEN o_orderkey % 3 <> 0 THEN 'single' WHEN o_orderkey % 2 = 0 THEN 'multi_sibling' ELSE 'multi_solving' END AS gold_kind,
       CASE WHEN o_orderkey % 4 = 0 THEN concat('c', CAST(o_custkey % 20 AS {text})) END AS cluster_name,
       CAST(o_custkey % 10 AS {text}) AS gold_a, CASE WHEN o_orderkey % 3 = 0 THEN CAST((o_custkey + 1) % 10 AS {text}) END AS gold_b,
       CASE WHEN o_orderkey % 4 = 0 THEN CAST((o_custkey + 5) % 10 AS {text}) END AS other
FROM orders"""
CANDIDATE_BODY = """
SELECT l_orderkey AS record_id, CAST(l_linenumber AS {text}) AS doc_id, CASE WHEN l_linenumber % 2 = 0 THEN 'alias' ELSE 'candidate' END AS role,
       CAST(l_partkey % 10 AS {text}) AS code_a, CASE WHEN l_linenumber % 2 = 0 AND l_suppkey % 10 <> l_partkey % 10 THEN CAST(l_suppkey % 10 AS {text}) END AS code_b,
       CASE WHEN l_quantity > 10 THEN l_quantity END AS dense_score, CASE WHEN l_linenumber % 3 <> 0 THEN l_discount * 100 END AS bm25_score,
       l_extendedprice / 10000 AS rerank_score
FROM lineitem"""


def body(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    source = sql.format(text="string").rsplit("FROM ", 1)[0] + "FROM {t}"
    return spark.sql(source, t=table(spark, sf_dir, name))


def conso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return body(spark, sf_dir, CONSO_BODY, "part")


def rel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return body(spark, sf_dir, REL_BODY, "lineitem")


def dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = body(spark, sf_dir, CANDIDATE_BODY, "lineitem")
    grouped = c.sparkSession.sql(
        """SELECT record_id, sort_array(collect_list(struct(doc_id, role, array_compact(array(code_a, code_b)) AS codes, dense_score, bm25_score, rerank_score))) AS candidates
           FROM {c} GROUP BY record_id""", c=c)
    r = body(spark, sf_dir, RECORD_BODY, "orders")
    return r.sparkSession.sql(
        """SELECT r.record_id, CAST(r.record_id AS string) AS mention, kb, noise, gold_kind, cluster_name, array_compact(array(gold_a, gold_b)) AS gold, array_compact(array(other)) AS distractor, candidates
           FROM {r} r JOIN {g} g ON r.record_id = g.record_id""", r=r, g=grouped)


CONSO_SQL = f"conso AS ({CONSO_BODY.format(text='VARCHAR')}), rel AS ({REL_BODY.format(text='VARCHAR')})"
#: rec: one row a record; cand: one row a candidate, with its codes as a list.
DUMP_SQL = f"""
rec0 AS ({RECORD_BODY.format(text='VARCHAR')}), cand0 AS ({CANDIDATE_BODY.format(text='VARCHAR')}),
rec AS (SELECT record_id, kb, noise, gold_kind, cluster_name, list_filter([gold_a, gold_b], lambda x: x IS NOT NULL) AS gold, list_filter([other], lambda x: x IS NOT NULL) AS distractor
        FROM rec0 WHERE record_id IN (SELECT record_id FROM cand0)),
cand AS (SELECT record_id, doc_id, role, list_filter([code_a, code_b], lambda x: x IS NOT NULL) AS codes, dense_score, bm25_score, rerank_score FROM cand0)"""
