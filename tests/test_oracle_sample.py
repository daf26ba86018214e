"""A representative sample of registered queries against their DuckDB oracles at sf0.001
(the full set runs with ``python tools/oracle_check.py``)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from kestrel.plans.testdata import TABLES
from tools.oracle_check import TYPE_MAP, frame_rows

SAMPLE = ["priority_rank", "priority_rank_large", "interpolate_linear", "dedup_keep_last", "panel_union_agg",
          "validation_checks", "descriptive_stats", "trend_slope", "priority_matrix", "silhouette",
          "json_records", "retention_plan", "supplier_panel_features", "coerce_numeric"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    rel = con.execute(E.oracle_sql()[name])
    duck_types = {d[0]: str(d[1]).split("(")[0].upper() for d in rel.description}
    od = rel.df()
    for f in sdf.schema.fields:
        assert TYPE_MAP[f.dataType.simpleString()] == duck_types[f.name], f.name
    c1, r1 = frame_rows(sdf.toPandas())
    c2, r2 = frame_rows(od)
    assert c1 == c2 and len(r1) == len(r2) and r1 == r2
