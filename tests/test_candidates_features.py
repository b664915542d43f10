import json

import pytest
from helpers import rows

from smogline.operators import candidates, features
from smogline.schema import FEATURE_METRICS, LONG_ROW, POLES, SITES

POLE = [(7, 1, 11, 5, 60601, "late", "2 B St", 41.0, -87.0, 9), (7, 1, 11, 5, 60601, "early", "1 A St", 41.5, -87.6, 3),
        (7, 2, 11, 5, 60601, "second", "3 C St", 41.25, -87.5, 4), (7, 3, 11, None, 60601, "wardless", "x", 1.0, 1.0, 5),
        (7, 9, 11, 5, 60601, "beyond", "x", 1.0, 1.0, 1)]
SITE = [(7, 60601, 11, 5), (7, 60601, 11, None)]


def tables(spark):
    return spark.createDataFrame(SITE, SITES), spark.createDataFrame(POLE, POLES)


def test_first_match_in_order(spark):
    sites, poles = tables(spark)
    got = candidates.fill_candidates(sites, poles)
    assert len(got.columns) == 4 + 15
    by_ward = {r["Ward Number"]: r for r in got.collect()}
    row = by_ward[5]
    assert row["Priority 1 CDOT Light Pole ID"] == "early"
    assert row["Priority 1 CDOT Light Pole Location Geocode"] == "41.5, -87.6"
    assert row["Priority 2 CDOT Light Pole Address"] == "3 C St"
    assert row["Priority 4 CDOT Light Pole ID"] is None
    assert by_ward[None]["Priority 1 CDOT Light Pole ID"] is None


def test_unmatched(spark):
    sites, poles = tables(spark)
    left = candidates.unmatched_candidates(sites, poles)
    assert rows(left, "Ward Number", "Candidate") == sorted(
        [(5, 3), (5, 4), (5, 5)] + [(None, p) for p in range(1, 6)], key=repr)
    with pytest.raises(LookupError):
        candidates.unmatched_candidates(sites, poles, strict=True)
    assert candidates.unmatched_candidates(sites.filter("`Ward Number` = 5"), poles, (1, 2), strict=True).count() == 0


def test_latest_and_history(spark):
    a, b = FEATURE_METRICS[:2]
    latest = spark.createDataFrame([("D", "2026-01-02T00", a, 5.0, 0.0, ""), ("D", "2026-01-01T00", a, 4.0, 0.0, ""),
                                    ("D", "2026-01-01T00", b, 7.0, 0.0, "")], LONG_ROW)
    assert [tuple(r) for r in features.latest_by_metric(latest).collect()] == [("D", "2026-01-02T00", 5.0, 7.0, None, None)]
    rows_in = spark.createDataFrame([("D", "2026-01-01T00", a, 4.0, 1), ("D", "2026-01-01T00", a, 6.0, 2)],
                                    "datasourceId string, time string, metric string, value double, n int")
    got = features.history_by_metric(rows_in, "n").first()
    assert got[a] == {"2026-01-01T00": 6.0} and [got[m] for m in FEATURE_METRICS[1:]] == [{}, {}, {}]


def test_features(spark):
    props = spark.createDataFrame([("D", "t", None)], "datasourceId string, time string, x double")
    places = spark.createDataFrame([("D", 41.5, -87.5), ("E", 1.0, 2.0)], "datasourceId string, lat double, lon double")
    made = features.features_with_geometry(props, places, "now").collect()
    assert len(made) == 1 and made[0]["timestamp"] == "now"
    assert json.loads(made[0]["feature"]) == {
        "type": "Feature", "properties": {"datasourceId": "D", "time": "t", "x": None},
        "geometry": {"type": "Point", "coordinates": [-87.5, 41.5]}}
    assert features.missing_properties(props, places).first()[0] == 1
