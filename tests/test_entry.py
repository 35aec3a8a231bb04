"""The driver's contract, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from lectern.plans import shared

from lectern import catalog


def test_entry(spark, sf):
    if not os.path.isdir(sf):
        pytest.skip("needs the test tables")
    df = entry.entry(spark)
    assert df.columns == ["bucket", "month", "links", "orphans"] and df.count() > 0


def test_names():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and len(q) > 60


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_core_query(spark, sf, name):
    """Runs, and agrees with its SQL where it has any."""
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(sf):
        pytest.skip("needs the test tables")
    df = catalog.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(str(tuple(r)) for r in df.select(*cols).collect())
    if name not in catalog.SQL:
        return
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    r = con.execute(catalog.SQL[name])
    there = [x[0] for x in r.description]
    assert sorted(there) == cols
    assert got == sorted(str(tuple(row[there.index(c)] for c in cols)) for row in r.fetchall())


def test_staged_tables_keep_rows_and_order_of_columns(spark):
    df = spark.createDataFrame([(1, None, ["a"]), (2, "x", None)], "b int, a string, c array<string>")
    again = shared.stage_table(df, "t")
    assert again.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))
    assert shared.stage_table(df.limit(0), "t").count() == 0


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        shared.shared_dir(Session())


def test_stream_of_books(spark, tmp_path):
    from lectern.streaming.ingest import stream_books

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("some words " * 80)

    def run() -> list[str]:
        out = stream_books(spark, str(tmp_path / "in")).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        out.trigger(availableNow=True).start().awaitTermination(120)
        return sorted(r.path.rpartition("/")[2] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == ["a.txt"]
    (tmp_path / "in" / "b.md").write_text("more words " * 80)
    assert run() == ["a.txt", "b.md"]
