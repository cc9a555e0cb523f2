"""Tier 2: every registered query against its independent DuckDB SQL."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_MID, SF_SMALL
from verdant.plans.queries import QUERIES

TABLES = ["events"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        return dt.datetime(v.year, v.month, v.day)
    return v


def _sorted_rows(cols, recs):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in idx) for r in recs]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    cons = {}
    for sf in (SF_SMALL, SF_MID):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(sf) / (t + '.parquet')}')")
        cons[sf] = con
    yield cons
    for c in cons.values():
        c.close()


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_oracle_states_its_own_literals():
    import verdant.plans.oracle as o
    assert "from verdant" not in Path(o.__file__).read_text()
    from verdant import constants as c
    from verdant.plans import queries as q
    assert {k: v for k, v in vars(o.Q).items() if k.isupper()} == {k: getattr(q, k) for k in vars(o.Q) if k.isupper()}
    for name in ("SENSOR_TYPES", "SENSOR_UNITS", "RANGE_LIMITS", "SCORE_RANGES", "GAUGE_SCALES", "GAUGE_BANDS"):
        assert getattr(o, name) == getattr(c, name), name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sf = SF_SMALL
    df = E.queries()[name](spark, sf)
    got_cols = df.columns
    types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
             for f in df.schema.fields}
    want_types = {d[0]: str(d[1]) for d in duck[sf].execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert types == want_types
    got = df.collect()
    res = duck[sf].execute(E.oracle_sql()[name])
    want_cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(got_cols) == sorted(want_cols)
    assert len(got) == len(want)
    assert _sorted_rows(got_cols, [tuple(r) for r in got]) == _sorted_rows(want_cols, want)


@pytest.mark.parametrize("name", ["gold_climate", "vpd_pairs", "upsert_gold", "peer_outliers",
                                  "current_anomalies", "silver_readings"])
def test_query_matches_oracle_sf001(spark, duck, name):
    sf = SF_MID
    df = E.queries()[name](spark, sf)
    got = df.collect()
    res = duck[sf].execute(E.oracle_sql()[name])
    want_cols = [d[0] for d in res.description]
    assert _sorted_rows(df.columns, [tuple(r) for r in got]) == _sorted_rows(want_cols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "climate_score" in df.columns
