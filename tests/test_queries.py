"""Every registered query with SQL gives what DuckDB gives on the smallest test tables, where they are there."""

import glob
import math
import os

import pytest

SF = os.environ.get("VOXLOOM_TEST_TABLES", "/root/testdata/sf0.001")


def norm(v):
    if v is None or isinstance(v, (str, bool)):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return norm(v.item()) if hasattr(v, "item") else float(f"{float(v):.9g}") if type(v).__name__ == "Decimal" else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_all_queries_with_sql(spark):
    import duckdb

    from voxloom.plans import core

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    wrong = []
    for name, sql in core.oracle_sql().items():
        df = core.queries()[name](spark, SF)
        got = sorted(repr(tuple(norm(r[c]) for c in sorted(df.columns))) for r in df.collect())
        rel = con.execute(sql)
        names = [d[0] for d in rel.description]
        want = sorted(repr(tuple(norm(dict(zip(names, r))[c]) for c in sorted(names))) for r in rel.fetchall())
        if sorted(names) != sorted(df.columns) or got != want:
            wrong.append(name)
    assert not wrong


def test_entry_works_without_the_subpackage():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and "p2_found" in entry.queries()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_language_labels_of_all_rows(spark):
    from voxloom.plans import core

    got = core.queries()["labelled_languages"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/feature_rows.parquet").count() and got.where("supported is null").count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_upsert_of_the_whole_table(spark):
    from voxloom.plans import core

    rows = spark.read.parquet(f"{SF}/transcript_rows.parquet")
    got = core.queries()["redelivered_results"](spark, SF)
    assert got.select("k").distinct().count() == rows.select("config_key", "idx").distinct().count()
