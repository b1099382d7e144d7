from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[1]), os.environ.get("PYTHONPATH", "")])

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))).config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def canonical(rows, columns):
    """Rows as sorted lists of text, floats to nine digits."""

    def one(v):
        if v is None or v != v:
            return "NULL"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"{float(v):.9g}"
        return str(v)

    return sorted([one(r[c]) for c in columns] for r in rows)


@pytest.fixture(scope="session")
def same_rows(spark, duck):
    def check(name, query, sql):
        got = [r.asDict() for r in query(spark, SF).collect()]
        frame = duck.sql(sql)
        want = [dict(zip(frame.columns, r, strict=True)) for r in frame.fetchall()]
        columns = sorted(frame.columns)
        assert not got or sorted(got[0]) == columns, name
        assert canonical(got, columns) == canonical(want, columns), name

    return check
