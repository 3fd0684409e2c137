"""What the plans must and must not contain, and hot keys."""

import re
from pathlib import Path

import pytest
from conftest import SMALL, got, one
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ledgerloom.operators import dims, invoicing, keys, ledger, lookup, migrate
from ledgerloom.session import SETTINGS, shared_dir, sizing

ROOT = Path(__file__).resolve().parent.parent / "ledgerloom"
# Writing streams and tables is part of these; their inputs are covered by the others.
RUNS = ("s4_", "s5_", "s6_", "s7_", "pr2_", "pr5_", "w9_", "o4_", "o5_alert_stream", "w1_replay_in_blocks", "w1_redelivered_in_blocks", "r6_")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The theta join is a statement of the user's; operators for training data have tests of their own.
OTHERS = re.compile(r"s2_query_theta_join|op[0-9]+_|pipeline")


@pytest.mark.parametrize("name", [n for n in sorted(queries()) if not n.startswith(RUNS) and not OTHERS.match(n)])
def test_no_query_compares_all_pairs(spark, name):
    text = plan(queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_source_has_no_hints_and_no_local_state():
    text = "\n".join(p.read_text() for p in ROOT.rglob("*.py") if p.parent.name != "llm")
    assert not re.search(r"broadcast\(|localCheckpoint|toPandas|crossJoin|\.rdd\b", text)


def test_filters_and_columns_reach_the_scan(spark, tables):
    df = ledger.journal_query(
        tables["journal_entry"], tables["journal_line"], date_from="1997-01-01", dims={"site_id": 3}
    ).groupBy("account_id").agg(F.sum("debit"))
    text = plan(df)
    assert "GreaterThanOrEqual(entry_date,1997-01-01)" in text and "EqualTo(site_id,3)" in text
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert not any("memo" in s or "cost_center_id" in s or "adjusting_reason" in s for s in scans)


def test_estimated_profile_is_one_scan_and_one_exchange(tables):
    from ledgerloom.operators.profile import profile_table

    text = plan(profile_table(tables["lineitem"], exact=False))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Expand" not in text


def test_top_k_is_cut_before_the_shuffle(make):
    df = lookup.suggest_matches(make("code string", ("a",)), make("name string", ("ab",)))
    assert "WindowGroupLimit" in plan(df)


@pytest.fixture
def hot(spark):
    """A third of all rows share one key."""
    child = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit(1).cast("decimal(18,4)").alias("v")
    )
    parent = spark.range(60_000).select(F.when(F.col("id") == 0, F.lit(-1)).otherwise(F.col("id")).alias("p"))
    return child, parent


@pytest.fixture
def sensitive(spark):
    """Small partitions count as oversized, and nothing is broadcast."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_join_partitions_are_split(spark, hot, sensitive, tmp_path):
    child, parent = hot
    child.withColumn("v", F.rand(1)).repartition(8).write.parquet(f"{tmp_path}/c")
    parent.repartition(2).write.parquet(f"{tmp_path}/p")
    child, parent = spark.read.parquet(f"{tmp_path}/c"), spark.read.parquet(f"{tmp_path}/p")
    lost = keys.orphans(child, parent.filter("p <> 7"), [("k", "p")])
    assert [row.k for row in lost.collect()] == [7]
    assert "skew=true" in plan(lost)
    flaws = dims.validate_refs(child, ["v"], {"k": (parent.filter("p <> 7"), "p")})
    assert [row.bad_value for row in flaws.collect()] == ["7"]
    assert "skew=true" in plan(flaws)


def invoices_and_lines(make):
    invoices = make(
        "invoice_id long, status string, issued_at date", (1, "issued", None), (1, "issued", None), (2, "draft", None), (None, "issued", None))
    lines = make("invoice_id long, amount int, site_id int", (1, 3, 7), (1, 3, 7), (1, 4, None), (2, 5, 7), (None, 6, 7))
    return invoices, lines.withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def test_postings_hold_ids_and_not_sorted_lines(make, sensitive):
    _, booked = invoicing.invoice_postings(*invoices_and_lines(make), 1100, 4100, ["site_id"])
    text = plan(booked)
    assert text.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in text and "Sort [" not in text
    found = booked.select("entry_id", "account_id", "site_id", F.col("debit").cast("int"), F.col("credit").cast("int"))
    assert got(found) == [
        ("INV-1", 1100, 7, 6, 0), ("INV-1", 1100, None, 4, 0), ("INV-1", 4100, 7, 0, 3), ("INV-1", 4100, 7, 0, 3), ("INV-1", 4100, None, 0, 4)]


def test_balances_of_postings_sort_no_lines(make, sensitive):
    checked = ledger.balance_check(*invoicing.invoice_postings(*invoices_and_lines(make), 1100, 4100, ["site_id"]))
    text = plan(checked)
    # Entries are sorted to meet their sums, lines are not.
    assert text.count("ShuffledHashJoin") == 2 and text.count("SortMergeJoin") == 1
    assert got(checked.select("entry_id", F.col("debit").cast("int"), "line_count", "balanced")) == [
        ("INV-1", 10, 5, True), ("INV-1", 10, 5, True), (None, 0, 0, False)]


def test_hot_keys_are_reduced_before_they_are_joined(hot):
    child, parent = hot
    assert one(keys.fk_check(child, parent, [("k", "p")]))["orphans"] == 0
    assert one(keys.relationship_cardinality(child, parent, [("k", "p")]))["max_children"] == 20_000
    assert migrate.reconcile(child, child, ["k"], ["v"]).filter("status <> 'match'").isEmpty()
    assert one(migrate.same_rows(child, child.orderBy(F.desc("k"))))["same"]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark) == named.rstrip("/")
    assert SETTINGS["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(sizing(100 << 40, 8000)["spark.sql.shuffle.partitions"]) == 524_288
    assert int(sizing(1 << 30, 8)["spark.sql.shuffle.partitions"]) == 16
