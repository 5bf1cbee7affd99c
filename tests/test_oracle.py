"""Every registered query equals its DuckDB oracle (small scale factor).

The driver runs the same comparison at sf0.01; sf0.001 keeps the suite quick.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from clickflow.operators import behavior as bh
from clickflow.plans.oracle import all_sql
from clickflow.plans.queries import all_queries
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "orders", "events", "documents"]
QUERIES = all_queries()
SQL = all_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.item() if hasattr(v, "item") else v


def _sorted_rows(pdf):
    cols = sorted(pdf.columns)
    data = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(data, key=repr)


def test_every_query_has_an_oracle_or_is_approximate():
    assert set(QUERIES) - set(SQL) == {"uv_hourly_approx"}
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(SQL[name])
    assert dict(sdf.dtypes) == {c: DUCK_TYPES.get(str(t), str(t))
                                for c, t in zip(rel.columns, rel.types)}
    got = sdf.toPandas()
    want = con.execute(SQL[name]).df()
    gc, gr = _sorted_rows(got)
    wc, wr = _sorted_rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "count"]
    assert df.count() > 0


def test_uv_approx_within_tolerance(spark):
    exact = {r.window_end: r["count"] for r in QUERIES["uv_hourly"](spark, SF_SMALL).collect()}
    approx = {r.window_end: r["count"] for r in QUERIES["uv_hourly_approx"](spark, SF_SMALL).collect()}
    assert exact.keys() == approx.keys()
    for k, v in exact.items():
        assert math.isclose(approx[k], v, rel_tol=0.05, abs_tol=1)


def test_uv_approx_on_a_large_hour(spark):
    """20,000 visitors in one hour: within three standard errors of the sketch."""
    from pyspark.sql import functions as F
    b = spark.range(60_000).select((F.col("id") % 20_000).alias("user_id"), F.lit("pv").alias("behavior"),
                                   (F.col("id") % 3600).alias("ts_sec"))
    got = bh.uv_hourly_approx(b).first()["count"]
    assert got != 20_000 and math.isclose(got, 20_000, rel_tol=0.15)
    assert math.isclose(bh.uv_hourly_approx(b, rsd=0.01).first()["count"], 20_000, rel_tol=0.03)
