import datetime
import random
from decimal import Decimal as D

import pytest
from conftest import SMALL, got
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ledgerloom.operators import closing, dims, invoicing, jobshop, ledger
from ledgerloom.sources import sinks

ENTRIES = (
    "entry_id int, entry_date date, source_type string, source_id int, status string, posted_at date, "
    "is_adjusting boolean, adjusting_reason string"
)
LINES = "entry_id int, account_id int, debit decimal(18,4), credit decimal(18,4), site_id int, cost_center_id int, business_unit_id int"
PERIODS = "period_id int, start_date date, end_date date, status string"
ACCOUNTS = "account_id int, parent_account_id int, account_type string"


def day(month, number, year=2024):
    return datetime.date(year, month, number)


def entry(i, date, status="draft", adjusting=False, reason=None, posted=None):
    return (i, date, "test", i, status, posted or date, adjusting, reason)


def line(i, account, debit=0, credit=0, site=1):
    amount = lambda value: None if value is None else D(value)
    return (i, account, amount(debit), amount(credit), site, 1, 1)


@pytest.fixture
def periods(make):
    return make(
        PERIODS, (1, day(1, 1), day(1, 31), "closed"), (2, day(2, 1), day(2, 29), "reopened"),
        (3, day(3, 1), day(3, 31), "open"), (5, day(5, 1), day(5, 31), "open"), (6, day(5, 20), day(6, 30), "open"),
    )


def test_balance_check(make):
    entries = make(ENTRIES, *[entry(i, day(3, 1)) for i in (1, 2, 3, 4)])
    lines = make(LINES, line(1, 10, "1.5"), line(1, 20, 0, "1.5"), line(2, 10, 1), line(3, 10, None, None))
    assert got(ledger.balance_check(entries, lines).select("entry_id", "diff", "line_count", "balanced")) == [
        (1, D(0), 2, True), (2, D(1), 1, False), (3, D(0), 1, True), (4, D(0), 0, False),
    ]


def test_periods_are_inclusive_and_ambiguity_is_reported(make, periods):
    dates = [day(1, 1), day(1, 31), day(4, 2), day(5, 25), None]
    entries = make("entry_id int, entry_date date", *enumerate(dates))
    assert got(ledger.assign_period(entries, periods).select("entry_id", "period_id", "match_count")) == [
        (0, 1, 1), (1, 1, 1), (2, None, 0), (3, None, 2), (4, None, 0),
    ]


def test_calendar_issues_see_nested_ranges(make):
    periods = make(
        PERIODS, (1, day(1, 1), day(6, 30), ""), (2, day(2, 1), day(2, 28), ""), (3, day(6, 1), day(7, 31), ""),
        (4, day(9, 1), day(8, 1), ""),
    )
    assert got(ledger.period_calendar_check(periods)) == [(2, "overlap"), (3, "overlap"), (4, "gap"), (4, "inverted")]


def test_posting_decisions(make, periods):
    entries = make(
        ENTRIES, entry(1, day(3, 1), "posted"), entry(2, day(3, 1)), entry(3, day(3, 1)), entry(4, day(4, 1)),
        entry(5, day(5, 25)), entry(6, day(1, 5)), entry(7, day(2, 29)), entry(8, day(2, 1), adjusting=True, reason=" "),
        entry(9, day(2, 1), adjusting=True, reason="audit 7"), entry(10, day(3, 31)), entry(11, day(1, 5), adjusting=True, reason="x"),
    )
    lines = make(
        LINES, line(3, 10, 5), *[l for i in (1, 4, 5, 6, 7, 8, 9, 10, 11) for l in (line(i, 10, 5), line(i, 20, 0, 5))]
    )
    decisions = {r.entry_id: (r.decision, r.reason) for r in ledger.classify_posting(entries, lines, periods).collect()}
    assert decisions == {
        1: ("reject", "already_posted"), 2: ("reject", "no_lines"), 3: ("reject", "unbalanced"), 4: ("reject", "no_period"),
        5: ("reject", "ambiguous_period"), 6: ("reject", "period_closed"), 7: ("reject", "reopened_requires_adjusting"),
        8: ("reject", "adjusting_reason_required"), 9: ("post", None), 10: ("post", None), 11: ("reject", "period_closed"),
    }


def test_reversal_nets_to_zero_and_refuses_drafts(make):
    entries = make(ENTRIES, entry(1, day(3, 1), "posted"), entry(2, day(3, 1)))
    lines = make(LINES, line(1, 10, 5), line(1, 20, 0, 5, site=2), line(2, 10, 7))
    new_entries, new_lines = ledger.reversal_entries(entries, lines, make("entry_id int", (1,), (1,), (2,), (9,)), "2024-04-01")
    assert got(new_entries.select("entry_id", "reverses_entry_id", "status")) == [("REV-1", 1, "draft")]
    both = lines.filter("entry_id = 1").select("account_id", "site_id", "debit", "credit").unionAll(
        new_lines.select("account_id", "site_id", "debit", "credit")
    )
    nets = both.groupBy("account_id", "site_id").agg(F.sum(F.col("debit") - F.col("credit")).alias("net"))
    assert {row.net for row in nets.collect()} == {D(0)}

    again_entries, again_lines = ledger.reversal_entries(
        new_entries.withColumn("status", F.lit("posted")), new_lines, make("entry_id string", ("REV-1",)), "2024-05-01"
    )
    assert got(again_entries.select("entry_id")) == [("REV-REV-1",)]
    assert got(again_lines.select("account_id", "debit", "credit")) == got(
        lines.filter("entry_id = 1").select("account_id", "debit", "credit")
    )


def test_correction_must_balance(make):
    entries = make(ENTRIES, entry(1, day(3, 1), "posted"))
    lines = make(LINES, line(1, 10, 5), line(1, 20, 0, 5))
    corrections = make("entry_id string, corrects_entry_id int", ("N1", 1), ("N2", 1), ("N3", 8))
    fixed = make("entry_id string, debit decimal(18,4), credit decimal(18,4)", ("N1", D(4), D(4)), ("N2", D(4), D(3)))
    result = ledger.correcting_entries(entries, lines, corrections, fixed, "2024-04-01")
    assert got(result.select("entry_id", "role", "balanced")) == [
        ("N1", "correction", True), ("N2", "correction", False), ("REV-1", "reversal", True),
    ]


def test_trial_balance_sums_to_zero(tables):
    posted = tables["journal_entry"].join(
        ledger.balance_check(tables["journal_entry"], tables["journal_line"]).filter("balanced"), "entry_id", "left_semi"
    )
    tb = ledger.trial_balance(posted, tables["journal_line"], tables["account"])
    assert tb.agg(F.sum("net")).first()[0] == 0


def test_subtotals_tell_a_missing_value_from_a_total(make):
    entries = make(ENTRIES, entry(1, day(3, 1), "posted"))
    lines = make(LINES, line(1, 10, 5, site=None), line(1, 20, 0, 5, site=2))
    rows = got(ledger.balances_by_dimension(entries, lines, ["site_id"]).select("site_id", "gid", "net", "lines"))
    assert rows == [(2, 0, D(-5), 1), (None, 0, D(5), 1), (None, 1, D(0), 2)]
    with pytest.raises(ValueError):
        ledger.balances_by_dimension(entries, lines, ["site_id"], mode="pivot")


def test_immutability_audit(make):
    before = make("id int, status string, amount int", (1, "posted", 5), (2, "posted", 5), (3, "posted", None), (4, "draft", 5))
    after = make("id int, status string, amount int", (1, "posted", 5), (2, "posted", None), (4, "posted", 9), (7, "posted", 1))
    audit = ledger.immutability_audit(before, after, ["id"], ["status", "amount"], F.col("status") == "posted")
    assert got(audit) == [(2, "updated"), (3, "deleted")]


def test_opening_entry(make):
    entries = make(ENTRIES, entry(1, day(1, 1), "posted"), entry(2, day(2, 1), "posted"))
    lines = make(LINES, line(1, 10, 5), line(1, 20, 0, 3), line(1, 30, 4, 4), line(2, 10, 100))
    rows = got(ledger.opening_balances(entries, lines, "2024-02-01", dims=[], balancing_account=99))
    assert rows == [("OPENING", 10, D(5), D(0)), ("OPENING", 20, D(0), D(3)), ("OPENING", 99, D(0), D(2))]
    assert len(got(ledger.opening_balances(entries, lines, "2024-02-01", dims=["site_id"]))) == 2


def test_rollup_reports_cycles_and_missing_parents(make):
    accounts = make(
        ACCOUNTS, (1, None, "A"), (2, 1, "A"), (3, 2, "A"), (4, 99, "A"), (5, 6, "A"), (6, 5, "A"), (7, 7, "A"), (8, 6, "A"),
    )
    tb = make("account_id int, net decimal(38,4)", *[(i, D(i)) for i in range(1, 9)])
    rows = {r.account_id: (r.own_net, r.subtree_net, r.depth, r.issue) for r in closing.account_rollup(tb, accounts).collect()}
    assert rows[1] == (D(1), D(6), 0, None)
    assert rows[2] == (D(2), D(5), 1, None)
    assert rows[3] == (D(3), D(3), 2, None)
    assert rows[4][3] == "missing_parent"
    assert rows[5][3] == rows[6][3] == rows[7][3] == rows[8][3] == "cycle"
    assert rows[8][0] == D(8)


def test_statements_use_the_normal_sign(make):
    accounts = make(ACCOUNTS, (1, None, "A"), (2, None, "R"))
    tb = make("account_id int, net decimal(38,4)", (1, D(5)), (2, D(-5)))
    assert got(closing.financial_statements(tb, accounts)) == [("balance_sheet", "A", D(5)), ("income_statement", "R", D(5))]


def test_roll_forward_carries_quiet_periods(make):
    periods = make(PERIODS, *[(m, day(m, 1), day(m, 28), "open") for m in (1, 2, 3, 4)])
    entries = make(ENTRIES, entry(1, day(2, 3), "posted"), entry(2, day(4, 3), "posted"), entry(3, day(3, 3)))
    lines = make(LINES, line(1, 10, 5), line(2, 10, 0, 2), line(3, 10, 50))
    accounts = make(ACCOUNTS, (10, None, "A"), (20, None, "A"))
    rows = got(closing.roll_forward(entries, lines, periods, accounts))
    assert [r[:2] + (r[2], r[5]) for r in rows if r[0] == 10] == [
        (10, 1, D(0), D(0)), (10, 2, D(0), D(5)), (10, 3, D(5), D(5)), (10, 4, D(5), D(3)),
    ]
    assert [r[5] for r in rows if r[0] == 20] == [D(0)] * 4


def test_closing_is_the_next_opening(tables):
    rows = closing.roll_forward(
        tables["journal_entry"], tables["journal_line"], tables["accounting_period"], tables["account"]
    ).collect()
    by_account = {}
    for row in sorted(rows, key=lambda r: (r.account_id, r.period_id)):
        if row.account_id in by_account:
            assert by_account[row.account_id] == row.opening
        by_account[row.account_id] = row.closing


def test_close_versions(make, periods):
    entries = make(
        ENTRIES, entry(1, day(2, 3), "posted", posted=day(3, 1)),
        entry(2, day(2, 4), "posted", adjusting=True, reason="a", posted=day(4, 1)),
    )
    lines = make(LINES, line(1, 10, 5), line(2, 10, 2), line(2, 20, 0, 0))
    closes = make("period_id int, close_version int, closed_on date", (2, 1, day(3, 10)), (2, 2, day(4, 15)), (3, 1, day(4, 10)))
    snap = closing.close_snapshot(entries, lines, periods, closes)
    assert got(snap) == [(1, 2, 10, D(5)), (2, 2, 10, D(7)), (2, 2, 20, D(0))]
    assert got(closing.close_diff(snap, 1, 2, entries, lines, periods, closes)) == [(2, 10, D(5), D(7), D(2), 1, D(2))]
    assert got(closing.close_diff(snap, 1, 2)) == [(2, 10, D(5), D(7), D(2))]


def test_ledger_is_only_appended(make, spark, tmp_path):
    path = str(tmp_path / "ledger")
    first = make("entry_id int, amount int, period_id int", (1, 5, 1), (1, 6, 1), (2, 7, 2))
    sinks.append_ledger(first, path)
    sinks.append_ledger(first, path)
    sinks.append_ledger(make("entry_id int, amount int, period_id int", (1, 99, 1), (3, 1, 2)), path)
    assert got(spark.read.parquet(path).select("entry_id", "amount")) == [(1, 5), (1, 6), (2, 7), (3, 1)]


def test_entries_without_period_and_under_another_period_are_stored_once(make, spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = make("entry_id int, amount int, period_id int", (1, 5, None), (2, 7, 2))
    for batch in (rows, rows, make("entry_id int, amount int, period_id int", (2, 7, 3), (1, 5, 1))):
        sinks.append_ledger(batch, path)
    assert got(spark.read.parquet(path).select("entry_id", "amount")) == [(1, 5), (2, 7)]


def test_keys_of_different_types_meet(make):
    from ledgerloom.functions.skew import join_hot

    left = make("i int, d decimal(10,2), t date, n int", (1, D("2.50"), datetime.date(2024, 1, 2), 7))
    right = make("i bigint, d decimal(12,4), t timestamp, n smallint", (1, D("2.5"), datetime.datetime(2024, 1, 2), 7))
    for name in ("i", "d", "t", "n"):
        assert join_hot(left, right.select(name), [name], "inner").count() == 1, name
    names = make("site bigint, name string", (1, "north"), (1, "also north"))
    rows = make("id int, site int", (1, 1))
    assert got(dims.validate_refs(rows, ["id"], {"site": (names, "site")})) == []
    assert got(dims.with_dimensions(rows, {"site": (names, "site", "name")}).select("site_name")) == [("also north",)]


def test_a_chain_of_any_depth_is_rolled_up(make):
    accounts = make("account_id int, parent_account_id int", *[(i, i - 1 or None) for i in range(1, 120)])
    tb = make("account_id int, net decimal(38,4)", (119, D(100)))
    rows = {r.account_id: (r.subtree_net, r.depth, r.issue) for r in closing.account_rollup(tb, accounts).collect()}
    assert all(rows[i] == (D(100), i - 1, None) for i in range(1, 120))


def test_a_timestamp_falls_into_its_day_and_only_open_periods_post(make):
    periods = make("period_id int, start_date date, end_date date, status string",
                   (1, datetime.date(2024, 1, 1), datetime.date(2024, 1, 31), "open"),
                   (2, datetime.date(2024, 2, 1), datetime.date(2024, 2, 29), "draft"))
    entries = make("entry_id int, entry_date timestamp, status string, is_adjusting boolean, adjusting_reason string",
                   (1, datetime.datetime(2024, 1, 31, 10), "draft", False, None), (2, datetime.datetime(2024, 2, 1), "draft", False, None))
    lines = make("entry_id int, debit decimal(18,4), credit decimal(18,4)", *[(e, d, c) for e in (1, 2) for d, c in ((D(1), D(0)), (D(0), D(1)))])
    assert got(ledger.classify_posting(entries, lines, periods)) == [(1, "post", None), (2, "reject", "period_not_open")]


def test_dimension_checks(make):
    lines = make("id int, site int, unit int", (1, 1, 1), (2, None, 9), (3, 1, 2))
    site = make("site int, name string", (1, "north"))
    unit = make("unit int, name string", (1, "repair"), (2, "owner"))
    assert got(dims.validate_refs(lines, ["id"], {"site": (site, "site"), "unit": (unit, "unit")})) == [
        (2, "site", None, "missing"), (2, "unit", "9", "unknown"),
    ]
    named = dims.with_dimensions(lines, {"site": (site, "site", "name"), "unit": (unit, "unit", "name")})
    assert got(named.select("id", "site_name", "unit_name")) == [(1, "north", "repair"), (2, None, None), (3, "north", "owner")]


INVOICES = "invoice_id int, customer_id int, status string, issued_at date"
INVOICE_LINES = "invoice_id int, qty decimal(9,0), unit_price decimal(12,2), amount decimal(18,2), site_id int"


def test_issued_invoices_post_balanced(make):
    invoices = make(INVOICES, (1, 7, "issued", day(3, 1)), (2, 7, "draft", day(3, 1)), (3, 8, "void", day(3, 1)))
    lines = make(INVOICE_LINES, (1, D(2), D("1.5"), D(3), 1), (1, D(1), D(4), D(5), 2), (2, D(1), D(1), D(1), 1), (3, D(1), D(6), D(6), 1))
    assert got(invoicing.invoice_totals(lines)) == [(1, 2, D(8), False), (2, 1, D(1), True), (3, 1, D(6), True)]
    entries, booked = invoicing.invoice_postings(invoices, lines, 1100, 4100, ["site_id"])
    assert got(entries.select("entry_id", "source_id")) == [("INV-1", 1)]
    assert got(ledger.balance_check(entries, booked).select("debit", "balanced")) == [(D(8), True)]
    notes, note_lines = invoicing.credit_notes(invoices, lines, make("invoice_id int", (2,), (3,), (3,)))
    assert got(notes) == [("CN-3", 3, 8)]
    assert got(note_lines.select("credit_note_id", "qty", "amount")) == [("CN-3", D(-1), D(-6))]


def test_every_event_posts_once(make):
    events = make("source_type string, source_id int", ("a", 1), ("a", 2), ("a", 3), ("a", 3))
    entries = make("source_type string, source_id int", ("a", 1), ("a", 3), ("a", 3), ("b", 2))
    assert got(invoicing.posting_completeness(events, entries)) == [("a", 2, 0, "missing"), ("a", 3, 2, "duplicate")]


def test_quality_rule(make):
    jobs = make("job_id int", (1,), (2,), (3,))
    routings = make("routing_id int, job_id int", (10, 1), (11, 1), (20, 2))
    ops = make(
        "routing_id int, sequence int, required boolean, status string",
        (10, 1, True, "complete"), (11, 1, True, "pending"), (11, 2, False, "pending"), (20, 1, True, "complete"),
    )
    qa = make("job_id int, status string", (1, "approved"), (2, "approved"), (2, "open"))
    assert got(jobshop.job_progress(jobs, routings, ops, qa)) == [
        (1, 2, 1, 50.0, "approved"), (2, 1, 1, 100.0, "open"), (3, 0, 0, None, "none"),
    ]
    assert got(jobshop.qa_violations(jobs, routings, ops, qa)) == [(1, 1)]


def test_a_batch_reads_the_ids_of_its_own_buckets(make, spark, tmp_path):
    path = f"{tmp_path}/ledger"
    rows = spark.range(20_000).selectExpr("id AS entry_id", "1 AS amount", "cast(id % 3 as int) AS period_id")
    sinks.append_ledger(rows, path)
    files = sinks._Files(spark, path)
    batch = make("entry_id int, amount int, period_id int", (5, 9, 7), (6, 9, None), (30_000, 1, 1))
    buckets = [r[0] for r in batch.select(sinks._bucket("entry_id")).distinct().collect()]
    read = sinks._indexed(spark, files, buckets)
    # Files of three buckets, and no file of the ledger itself.
    assert len(read.inputFiles()) <= 3 * 4 and all("/_ids/" in name for name in read.inputFiles())
    assert read.count() < 20_000 * 6 / sinks.ID_BUCKETS
    sinks.append_ledger(batch, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 20_001 and got(stored.filter("entry_id in (5, 6, 30000)").select("entry_id", "amount")) == [(30_000, 1), (5, 1), (6, 1)]


def test_an_append_that_broke_off_is_made_good(make, spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/ledger"
    schema = "entry_id int, amount int, period_id int"
    make(schema, (1, 1, 1)).write.partitionBy("period_id").parquet(path)  # a ledger without an index
    real = sinks._index

    def broken(rows, files, key):
        if files.exists("_appending"):
            raise RuntimeError("lost")
        real(rows, files, key)

    monkeypatch.setattr(sinks, "_index", broken)
    with pytest.raises(RuntimeError):
        sinks.append_ledger(make(schema, (1, 5, 2), (2, 1, 1)), path)
    monkeypatch.setattr(sinks, "_index", real)
    sinks.append_ledger(make(schema, (1, 5, 2), (2, 5, 2), (3, 1, 1)), path)
    assert got(spark.read.parquet(path).select("entry_id", "amount")) == [(1, 1), (2, 1), (3, 1)]
    assert not (tmp_path / "ledger" / "_appending").exists() and not list((tmp_path / "ledger" / "_making").glob("[!.]*"))


def rollup_by_hand(parents, nets):
    """Every account walks up as far as it has not been."""
    sums, out = dict.fromkeys(parents, D(0)), {}
    for start in parents:
        seen, at = [], start
        while at in parents and at not in seen:
            seen.append(at)
            sums[at] += nets.get(start, D(0))
            at = parents[at]
        out[start] = len(seen) - 1, None if at is None else "cycle" if at in seen else "missing_parent"
    return {i: (sums[i], *out[i]) for i in parents}


@pytest.mark.parametrize("seed", range(4))
def test_rollup_of_any_shape(make, seed):
    rng = random.Random(seed)
    parents = {i: rng.choice([None, 999, *range(1, 41), *range(max(1, i - 3), i)]) for i in range(1, 41)}
    nets = {i: D(rng.randint(-50, 50)) for i in range(1, 45) if rng.random() < 0.8}
    accounts = make(ACCOUNTS, *[(i, p, "A") for i, p in parents.items()])
    found = closing.account_rollup(make("account_id int, net decimal(38,4)", *nets.items()), accounts).collect()
    assert {r.account_id: (r.subtree_net, r.depth, r.issue) for r in found} == rollup_by_hand(parents, nets)


def test_rollup_of_a_long_chain_keeps_a_row_an_account(spark):
    """20,000 accounts, each below the one before: the closure would have 200 million rows."""
    accounts = spark.range(1, 20_001).selectExpr("cast(id as int) as account_id", "cast(nullif(id - 1, 0) as int) as parent_account_id")
    tb = accounts.selectExpr("account_id", "cast(1 as decimal(38,4)) as net")
    found = closing.account_rollup(tb, accounts)
    assert found.filter("subtree_net = 20001 - account_id and depth = account_id - 1 and issue is null").count() == found.count() == 20_000


@pytest.mark.parametrize("seed", range(3))
def test_closes_see_what_was_posted_by_their_day(make, seed):
    rng = random.Random(seed)
    days = lambda low, high: day(rng.randint(low, high), rng.randint(1, 28))
    periods = [(m, day(m, 1), day(m, 28), "closed") for m in (1, 2, 3)]
    entries = [(i, days(1, 3), "manual", None, rng.choice(["posted", "posted", "draft"]), rng.choice([None, days(1, 6), days(1, 6)]),
                rng.random() < 0.4, None) for i in range(60)]
    lines = [(e[0], rng.randint(10, 13), D(rng.randint(0, 9)), D(rng.randint(0, 9)), 1, 1, 1) for e in entries for _ in range(2)]
    # Versions do not follow the days; two closes may be on one day.
    closes = [(v, p, days(2, 6)) for p in (1, 2) for v in (1, 2, 3, 4)] + [(9, 1, None)]
    closes += [(5, 1, closes[0][2]), (1, 3, days(2, 6))]
    frames = (make(ENTRIES, *entries), make(LINES, *lines), make(PERIODS, *periods), make("close_version int, period_id int, closed_on date", *closes))
    found = {(r.close_version, r.period_id, r.account_id): r.balance for r in closing.close_snapshot(*frames).collect()}

    def balance(period, account, until, after=None, adjusting=False):
        rows = [(e[0], n[2] - n[3]) for e in entries for n in lines if n[0] == e[0] and n[1] == account and e[4] == "posted" and e[1].month == period
                and e[5] and e[5] <= until and (after is None or e[5] > after) and (e[6] or not adjusting)]
        return (sum(x for _, x in rows), len({i for i, _ in rows})) if rows else None

    wanted = {(v, p, a): balance(p, a, on)[0] for v, p, on in closes if on for a in range(10, 14) if balance(p, a, on)}
    assert found == wanted
    diff = {(r.period_id, r.account_id): tuple(r)[2:] for r in closing.close_diff(None, 1, 2, *frames).collect()}
    on = {(v, p): d for v, p, d in closes if d}
    expected = {}
    for p in (1, 2):
        for a in range(10, 14):
            old, new = ((balance(p, a, on[v, p]) or (D(0), 0))[0] for v in (1, 2))
            net, count = balance(p, a, on[2, p], on[1, p], True) or (D(0), 0)
            if old != new:
                expected[p, a] = (old, new, new - old, count, net)
    assert diff == expected


def test_a_rollup_takes_every_entry_once(make, spark, tmp_path, monkeypatch):
    path, schema = f"{tmp_path}/rollup", "entry_id long, period_id int, account_id int, debit decimal(18,4)"
    dims, sums = ["period_id", "account_id"], ["debit"]
    rows = [(i, i % 3 if i % 7 else None, i % 2, D(i)) for i in range(60) for _ in range(2)]
    fold = lambda some: sinks.fold_rollup(make(schema, *some), path, dims, sums)
    wanted = lambda some: got(make(schema, *some).groupBy(*dims).agg(F.sum("debit")))
    read = lambda: got(sinks.rollup(spark, path, dims, sums))
    fold(rows[:40])
    fold(rows[20:80])
    assert read() == wanted(rows[:80])
    # A load that broke off leaves nothing behind.
    real = sinks._Files.move
    with monkeypatch.context() as patch:
        patch.setattr(sinks._Files, "move", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            fold(rows)
    assert read() == wanted(rows[:80])
    assert sinks.compact_rollup(spark, path, dims, sums) and read() == wanted(rows[:80])
    # Another load is first: what it brought is looked at again.
    first = []

    def late(files, source, target):
        if not first:
            first.append(1)
            fold(rows[80:100])
        return real(files, source, target)

    monkeypatch.setattr(sinks._Files, "move", late)
    fold([*rows[70:], *rows[:2]])
    assert read() == wanted(rows)
    assert sinks.compact_rollup(spark, path, dims, sums)
    sinks.vacuum_rollup(spark, path, 0)
    assert read() == wanted(rows) and len([p for p in (tmp_path / "rollup" / "loads").iterdir() if not p.name.startswith(".")]) == 1
    fold(rows)
    assert read() == wanted(rows)


def test_loads_of_a_rollup_meet_their_entries_once(spark, monkeypatch):
    seen, fold = [], sinks.fold_rollup

    def watched(lines, *more):
        seen.append(lines._jdf.queryExecution().executedPlan().toString())
        fold(lines, *more)

    monkeypatch.setattr(sinks, "fold_rollup", watched)
    queries()["s7_rollup_by_increments"](spark, SMALL)
    assert len(seen) == 3 and not any("Join" in text for text in seen)


def test_a_rollup_takes_null_ids_once(make, spark, tmp_path):
    path, schema = f"{tmp_path}/rollup", "entry_id int, period_id int, debit int"
    rows = [(None, 1, 3), (None, 1, 3), (1, 1, 5), (2, None, 7), (2, None, 7)]
    for part in (rows[:3], rows, rows, rows[:0]):
        sinks.fold_rollup(make(schema, *part), path, ["period_id"], ["debit"])
    assert got(sinks.rollup(spark, path, ["period_id"], ["debit"])) == [(1, 11), (None, 14)]
    assert sum(spark.read.parquet(str(ids)).count() for ids in (tmp_path / "rollup").glob("loads/*/ids/bucket=*")) == 3
