"""A subset of the driver's correctness gate: Spark queries vs their DuckDB SQL twins."""

import os

import duckdb
import pytest

from helpers import SMALL

KEYS = ["daily_cost_summary", "sku_daily_details", "vm_cost_estimate", "cluster_config_as_of", "trailing_clusters", "top_skus", "cost_counters",
        "new_alerts", "catalog_price_extract", "upsert_daily_cost"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["lineitem", "orders", "customer", "part"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t + '.parquet')}')")
    return c


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(float(r[i]) if type(r[i]).__name__ == "Decimal" else r[i] for i in order))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    import __spark_entry__ as e

    df = e.queries()[key](spark, SMALL)
    res = con.execute(e.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm(df.columns, [tuple(r) for r in df.collect()]) == _norm(dcols, res.fetchall())


FAMILY = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
          "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("key", KEYS)
def test_column_types_match_oracle(spark, con, key):
    import __spark_entry__ as e

    spark_types = {f.name: FAMILY[f.dataType.simpleString()] for f in e.queries()[key](spark, SMALL).schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({e.oracle_sql()[key]})").fetchall()}
    assert spark_types == duck_types


def test_every_query_has_an_oracle():
    import __spark_entry__ as e

    from ledger.registry import QUERIES

    assert set(QUERIES) <= set(e.queries()) and set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
