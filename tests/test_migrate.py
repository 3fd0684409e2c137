import datetime
from decimal import Decimal as D

from conftest import got, one

from ledgerloom.operators import migrate
from ledgerloom.sources import sinks


def test_crosswalk_reports_what_does_not_map(make):
    df = make("code string, n int", ("a", 1), ("b", 2), ("b", 3), (None, 4))
    mapped, unmapped = migrate.apply_crosswalk(df, make("code string, new int", ("a", 10)), "code", "new")
    assert got(mapped) == [("a", 1, 10)]
    assert got(unmapped) == [("b", 2), (None, 1)]


def test_loading_twice_equals_once(make):
    target = make("id int, name string, rev int", (1, "a", 1))
    batch = make("id int, name string, rev int", (1, "b", 2), (2, "c", 1), (2, "c", 1), (3, None, 1))
    for order in (None, "rev"):
        once = migrate.idempotent_load(target, batch, ["id"], order)
        twice = migrate.idempotent_load(once, batch, ["id"], order)
        assert one(migrate.same_rows(once, twice))["same"]
        assert (1, "b" if order else "a", 2 if order else 1) in got(once)
        assert once.count() == 3
    older = make("id int, name string, rev int", (1, "z", 0))
    assert got(migrate.idempotent_load(target, older, ["id"], "rev")) == [(1, "a", 1)]


def test_reconcile_statuses(make):
    left = make("k string, v decimal(18,4)", ("a", D(1)), ("a", D(2)), ("b", D(1)), (None, D(1)), ("c", D("1.01")))
    right = make("k string, v decimal(18,4)", ("a", D(3)), ("d", D(1)), (None, D(1)), ("c", D(1)))
    status = {r.k: r.status for r in migrate.reconcile(left, right, ["k"], ["v"], tol=D("0.02")).collect()}
    assert status == {"a": "differ", "b": "left_only", "d": "right_only", None: "match", "c": "match"}
    assert {r.k: r.status for r in migrate.reconcile(left, right, ["k"], ["v"]).collect()}["c"] == "differ"


def test_trial_balances_compare_through_the_crosswalk(make):
    legacy = make("legacy_account string, debit decimal(18,4), credit decimal(18,4)", ("L1", D(5), D(0)), ("L9", D(1), D(0)))
    new = make("account_id int, debit decimal(18,4), credit decimal(18,4)", (1, D(5), D(0)), (2, D(1), D(0)))
    result = migrate.trial_balance_compare(legacy, new, make("legacy_account string, account_id int", ("L1", 1)))
    assert {r.account_id: r.status for r in result.collect()} == {1: "match", 2: "right_only", None: "left_only"}


def test_lossless_check(make):
    df = make(
        "amount decimal(12,4), name string, day string, big bigint, need int",
        (D("99999.99"), "abc", "2024-01-02", 1, 1), (D("100000.00"), "abcd", "soon", 2**40, None), (D("1.2345"), None, None, None, 2),
    )
    spec = {"amount": "decimal(7,2)", "name": "varchar(3)", "day": "date", "big": "int not null", "need": "bigint not null"}
    rows = {r["column"]: (r["lossy_rows"], r["example"]) for r in migrate.lossless_check(df, spec).collect()}
    assert rows == {
        "amount": (2, "1.2345"), "name": (1, "abcd"), "day": (1, "soon"), "big": (2, str(2**40)), "need": (1, None),
    }


def test_calendar_profile(make):
    periods = make("calendar string, fiscal_year int, period_no int, is_closing boolean", ("M", 2024, 1, False), ("M", 2024, 13, True))
    journal = make("calendar string, fiscal_year int, period_no int", ("M", 2024, 1), ("M", 2024, 0), ("M", 2023, 1), ("X", 2024, 1))
    assert got(migrate.fiscal_calendar_profile(periods, journal)) == [
        ("M", 1, 1, 1, 1, 1, 1, 2, 2), ("X", 0, 0, 0, 0, None, 0, 1, 1),
    ]


def test_party_master(make):
    parties = make("kind string, name string, external_id string", ("customer", "Acme ", "C1"), ("vendor", " acme", "V1"), ("vendor", "ACME", "V1"), ("vendor", "Bolt", "V2"))
    assert got(migrate.party_master(parties)) == [("ACME", "both", True, 2, "C1"), ("BOLT", "vendor", True, 1, "V2")]
    assert got(migrate.party_ids(parties)) == [("ACME", "customer", "C1"), ("ACME", "vendor", "V1"), ("BOLT", "vendor", "V2")]


def test_multisets_compare_with_copies_and_nulls(make):
    a = make("x int, y string", (1, None), (1, None), (2, "b"))
    b = make("y string, x int", (None, 1), ("b", 2), ("c", 3))
    assert got(migrate.except_rows(a, b)) == [(1, None, "left", 1), (3, "c", "right", 1)]
    assert one(migrate.same_rows(a, b)) == {"left_extra": 1, "right_extra": 1, "same": False}
    assert one(migrate.same_rows(a, a))["same"]


def test_export_splits_by_value(make, spark, tmp_path):
    df = make("k int, day date, v int", *[(i % 3, datetime.date(2024, 1, 1), i) for i in range(30)])
    sinks.export_table(df, str(tmp_path / "out"), ["k"])
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["k=0", "k=1", "k=2"]
    assert one(migrate.same_rows(spark.read.parquet(str(tmp_path / "out")).select(df.columns), df))["same"]
