"""Places over a whole table, catalogs kept as tables, gaps filled per group, stacked tests."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipgauge.functions.catalog import MappingCatalog, TableCatalog
from shipgauge.operators import quality
from shipgauge.operators.ranking import with_place
from shipgauge.plans.semantic import gap_filled_by


def test_places_equal_row_number(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 0.0, 1.5, 1.5, 99.9, 100.0])) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, score double")
    got = {r["id"]: r["place"] for r in with_place(df, [F.asc("score"), F.desc("id")]).collect()}
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, -r[0]))
    assert got == {r[0]: i for i, r in enumerate(want, start=1)}


def test_places_of_ties_empty_tables_and_clashing_names(spark):
    ties = spark.createDataFrame([(1.0, "x")] * 50, "score double, place string")
    got = with_place(ties, [F.asc("score")])
    assert sorted(r["place"] for r in got.collect()) == list(range(1, 51))
    assert got.columns == ["score", "place"]
    empty = with_place(ties.limit(0), [F.asc("score")])
    assert empty.count() == 0 and empty.schema["place"].dataType == T.LongType()


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_table_catalog_equals_the_literal_map(spark, broadcast_rows):
    entries = {"a": ("Web", "tier-1"), "b": ("Data", "tier-2"), "unused": ("Ops", "tier-2")}
    teams = spark.createDataFrame([("a", "m1"), ("a", "m2"), ("b", "m1"), ("missing", "m1"), (None, "m1")], "team string, model_name string")
    rows = [(t, d, s) for t, (d, s) in entries.items()] + [("b", "Web", "tier-1"), (None, "Nobody", "tier-1")]
    table = spark.createDataFrame(rows, "team string, domain string, sla_tier string")
    got, want = TableCatalog(table, broadcast_rows).attach(teams), MappingCatalog(entries).attach(teams)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert ("BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()) or not broadcast_rows


def _weekly(spark, rows):
    return spark.createDataFrame(rows, "metric_time__week date, team string, n bigint, score double")


def test_gaps_by_group_and_by_data(spark):
    d = dt.date
    rows = [(d(2024, 1, 1), "a", 1, 1.0), (d(2024, 1, 22), "a", 4, None), (d(2024, 1, 8), "b", 2, 2.0), (d(2024, 1, 15), None, 3, 3.0),
            (None, "a", 9, 9.0)]
    df = _weekly(spark, rows)
    own = {(r[0], r[1]): (r["n"], r["score"]) for r in gap_filled_by(df, ["team"], "week", "group", {"n": 0}).collect()}
    assert own == {(d(2024, 1, 1), "a"): (1, 1.0), (d(2024, 1, 8), "a"): (0, None), (d(2024, 1, 15), "a"): (0, None),
                   (d(2024, 1, 22), "a"): (4, None), (d(2024, 1, 8), "b"): (2, 2.0), (d(2024, 1, 15), None): (3, 3.0)}
    whole = gap_filled_by(df, ["team"], "week").collect()
    weeks = [d(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(4)]
    assert sorted(((r[0], r[1] or "") for r in whole)) == sorted((w, t) for w in weeks for t in ("a", "b", ""))
    assert sum(r["n"] or 0 for r in whole) == 10
    assert gap_filled_by(df.limit(0), ["team"], "week").count() == 0
    months = df.select(F.trunc("metric_time__week", "month").alias("metric_time__month"), "n").limit(1)
    assert gap_filled_by(months, [], "month").count() == 1


def test_gap_filling_refuses_unknown_bounds_and_grains(spark):
    df = _weekly(spark, [])
    for kw in ({"bounds": "none"}, {"grain": "hour"}):
        with pytest.raises(ValueError):
            gap_filled_by(df, ["team"], **kw)


def test_stacked_tests_count_like_single_ones(spark):
    rng = random.Random(8)
    a = spark.createDataFrame([(rng.choice([None, *range(30)]), rng.choice([None, "x", "y", "z"])) for _ in range(60)], "id int, kind string")
    b = spark.createDataFrame([], "id int, kind string")
    T_ = quality.ColumnTest
    tests = [t for m in ("a", "b") for t in (T_(m, "id", "unique"), T_(m, "kind", "unique"), T_(m, "id", "not_null"),
                                             T_(m, "kind", "accepted_values", ("x", "y")))]
    got = {(r["model"], r["column_name"], r["test"]): r["failures"] for r in quality.run_tests({"a": a, "b": b}, tests).collect()}
    want = {("a", "id", "unique"): quality.unique(a, "id").count(), ("a", "kind", "unique"): quality.unique(a, "kind").count(),
            ("a", "id", "not_null"): quality.not_null(a, "id").count(),
            ("a", "kind", "accepted_values"): a.where("kind = 'z'").count(),
            **{("b", c, t): 0 for c, t in (("id", "unique"), ("kind", "unique"), ("id", "not_null"), ("kind", "accepted_values"))}}
    assert got == want and want[("a", "id", "unique")] > 0
    with pytest.raises(ValueError):
        quality.run_tests({"a": a}, [t for t in tests if t.model == "b"])
