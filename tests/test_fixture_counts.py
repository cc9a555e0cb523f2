"""The counts FIXTURES.md records (measured independently with DuckDB) hold for our queries."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF_MID, SF_SMALL

EXPECTED = {
    SF_SMALL: {"classes": {"clean": 957, "dropout": 20, "statistical": 16, "range": 7}, "pairs": 3,
               "windows": 802, "all_four": 0, "peer": 8, "live_keys": 75, "live_null": 1},
    SF_MID: {"classes": {"clean": 9552, "dropout": 200, "statistical": 177, "range": 71}, "pairs": 88,
             "windows": 2774, "all_four": 164, "peer": 535, "live_keys": 750, "live_null": 13},
}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_fixture_counts(spark, sf):
    q, want = E.queries(), EXPECTED[sf]
    classes = {(r[0] or "clean"): r[1] for r in q["anomaly_classify"](spark, sf).groupBy("anomaly_type").count()
               .collect()}
    assert classes == want["classes"]
    assert q["vpd_pairs"](spark, sf).count() == want["pairs"]
    assert q["climate_30min"](spark, sf).select("facility_id", "window_start").distinct().count() == want["windows"]
    assert q["climate_score"](spark, sf).where("climate_score IS NOT NULL").count() == want["all_four"]
    assert q["peer_outliers"](spark, sf).where("is_peer_outlier").count() == want["peer"]
    live = q["live_latest"](spark, sf)
    assert (live.count(), live.where("value IS NULL").count()) == (want["live_keys"], want["live_null"])
