import datetime

import pytest
from conftest import got, one

from ledgerloom.operators import profile
from ledgerloom.sources import tables as source


def test_profile_of_an_empty_table(make):
    empty = make("a int, b string")
    assert got(profile.profile_table(empty).select("column", "rows_profiled", "nulls", "null_pct", "distinct")) == [
        ("a", 0, 0, None, 0), ("b", 0, 0, None, 0),
    ]
    assert one(profile.profile_column(empty, "a")) == {
        "total": 0, "nulls": 0, "null_pct": None, "distinct": 0, "min": None, "max": None, "avg": None, "stddev": None,
    }


def test_profile_covers_every_kind_of_column(make):
    df = make(
        "flag boolean, day date, raw binary, items array<int>, nothing string, ratio double",
        (True, datetime.date(2024, 1, 2), b"x", [1], None, 0.0),
        (False, datetime.date(2024, 1, 1), b"y", None, None, -0.0),
    )
    rows = {row["column"]: row for row in profile.profile_table(df).collect()}
    assert set(rows) == {"flag", "day", "items", "nothing", "ratio"}
    assert (rows["flag"]["distinct"], rows["flag"]["sample_value"]) == (2, "false")
    assert rows["day"]["sample_value"] == "2024-01-01"
    assert (rows["items"]["nulls"], rows["items"]["distinct"], rows["items"]["sample_value"]) == (1, None, None)
    assert (rows["nothing"]["null_pct"], rows["nothing"]["distinct"]) == (100.0, 0)
    assert rows["ratio"]["distinct"] == 1
    assert not any(row["is_estimate"] for row in rows.values())


def test_exact_unless_estimates_are_asked_for(spark):
    df = spark.range(300)
    assert one(profile.profile_table(df, exact=False))["is_estimate"] is True
    assert one(profile.profile_table(df)) == {
        "column": "id", "type": "bigint", "rows_profiled": 300, "nulls": 0, "null_pct": 0.0, "distinct": 300,
        "is_estimate": False, "sample_value": "0",
    }


def test_null_share_of_a_sample_is_relative_to_the_sample(spark):
    df = spark.range(20_000).selectExpr("IF(id % 2 = 0, NULL, id) AS half")
    row = one(profile.profile_sampled(df, n=2_000, seed=3))
    assert 1_500 < row["rows_profiled"] < 2_500 and row["is_estimate"]
    assert 40 < row["null_pct"] < 60


def test_long_texts_differ_beyond_any_prefix(make):
    df = make("t string", ("a" * 5000 + "x",), ("a" * 5000 + "y",), ("a" * 5000 + "y",))
    row = one(profile.profile_table(df))
    assert row["distinct"] == 2 and len(row["sample_value"]) == 5001
    assert len(one(profile.profile_table(df, text_width=80))["sample_value"]) == 80


def test_one_row_has_no_deviation(make):
    row = one(profile.profile_column(make("n int", (4,)), "n"))
    assert (row["avg"], row["stddev"], row["min"], row["max"]) == (4.0, None, 4, 4)


def test_column_profile_of_booleans_and_binary(make):
    df = make("b boolean, raw binary", (True, b"x"), (None, b"x"))
    row = one(profile.profile_column(df, "b"))
    assert (row["min"], row["max"], row["avg"], row["nulls"]) == (True, True, None, 1)
    row = one(profile.profile_column(df, "raw"))
    assert (row["distinct"], row["min"]) == (1, None)


def test_top_values_break_ties_by_value_and_count_nulls(make):
    df = make("v string", *[(None,)] * 3, ("b",), ("b",), ("a",), ("a",), ("c",))
    assert [tuple(row) for row in profile.top_values(df, "v", k=2).collect()] == [
        (None, 3, 60.0, 37.5), ("a", 2, 40.0, 25.0),
    ]


def test_grouped_concat_and_segments(make):
    df = make("k int, v string", (1, "b"), (1, "a"), (2, None))
    assert got(profile.grouped_concat(df, ["k"], "v", ["v"])) == [(1, "a, b"), (2, None)]
    assert [tuple(row) for row in profile.segment_counts(df, "k").collect()] == [(1, 2), (2, 1)]


def test_sample_rows_gives_what_is_asked_for(spark):
    df = spark.range(500).selectExpr("id", "CAST('x' AS BINARY) AS raw")
    assert [row.id for row in source.sample_rows(df, ["id"], 3, "id >= 10").collect()] == [10, 11, 12]
    assert source.sample_rows(df, ["id"], 400).count() == 400
    assert source.sample_rows(df, ["id"]).columns == ["id"]
    with pytest.raises(ValueError):
        source.sample_rows(df, ["id"], -1)


def test_query_cap_is_taken_as_given(spark):
    assert source.query(spark, "SELECT id FROM range(12000)", 11_000).count() == 11_000
    for cap in (0, -5):
        with pytest.raises(ValueError):
            source.query(spark, "SELECT 1", cap)


def test_query_cap_is_outermost(spark):
    assert source.query(spark, "SELECT * FROM (SELECT id FROM range(9) LIMIT 5) UNION ALL SELECT id FROM range(9)", 8).count() == 8
    assert source.query(spark, "SELECT DISTINCT id % 3 AS r FROM range(9)", 2).count() == 2


def test_kept_profiles_are_merged(make, spark, tmp_path, monkeypatch):
    rows = [(i, None if i % 5 == 0 else i % 7, f"v{i % 40}", [i]) for i in range(2000)]
    frame, path = make("id int, small int, name string, nested array<int>", *rows), f"{tmp_path}/kept"
    for part in range(4):
        profile.keep_profile(frame.filter(f"id % 4 = {part}"), path, str(part))
    profile.keep_profile(frame.filter("id % 4 = 1"), path, "1")  # kept again
    found = {r.column: r for r in profile.kept_profile(spark, path).collect()}
    assert set(found) == {"id", "small", "name"} and found["small"].nulls == 400 and found["id"].rows_profiled == 2000
    assert found["small"].distinct == 7 and found["name"].distinct == 40 and abs(found["id"].distinct - 2000) < 100
    full = []
    real = profile.top_values
    monkeypatch.setattr(profile, "top_values", lambda *args: full.append(args[1]) or real(*args))
    for col, k in (("small", 5), ("small", 20), ("name", 3), ("id", 4)):
        assert got(profile.kept_top_values(frame, path, col, k)) == got(real(frame, col, k))
    # Where no value is frequent all are counted, by the same rule at every size.
    assert full.count("small") == 0
    monkeypatch.setattr(profile, "TRACKED", 100)
    profile.keep_profile(frame, f"{tmp_path}/few", "0")
    assert got(profile.kept_top_values(frame, f"{tmp_path}/few", "id", 4)) == got(real(frame, "id", 4)) and "id" in full
