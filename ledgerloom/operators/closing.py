"""Account hierarchy, statements, roll-forward and versioned period closes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY_TOTAL, total, zero
from ledgerloom.functions.skew import join_hot
from ledgerloom.operators.ledger import assign_period, posted_lines
from ledgerloom.operators.migrate import reconcile
from ledgerloom.session import shared_dir


def _jumped(nodes: DataFrame, many: int) -> DataFrame:
    """Follow parents by doubling: (account_id, hop, depth, issue, top, low, net) after all that matters.

    After k rounds ``hop`` is the account 2^k above, if there is one, ``net`` the sum of those less than 2^k below,
    itself included; ``depth`` counts the accounts above, ``top`` is the last and ``low`` the least of them, as far as
    2^k. Each round adds to an account what those have whose ``hop`` it is, so that rows stay as many as accounts.
    What still has a hop after as many steps as there are accounts leads into a cycle.
    """
    reach = 1
    while True:
        nodes = nodes.checkpoint()
        if reach > many or nodes.filter("hop is not null").isEmpty():
            return nodes
        above = nodes.select(
            F.col("account_id").alias("at"), F.col("hop").alias("hop2"), F.col("depth").alias("depth2"), F.col("issue").alias("issue2"),
            F.col("top").alias("top2"), F.col("low").alias("low2"),
        )
        below = nodes.filter("hop is not null").groupBy(F.col("hop").alias("account_id")).agg(total("net").alias("more"))
        moved = join_hot(nodes, above, {"hop": "at"}, "left")
        nodes = moved.join(below, "account_id", "left").select(
            "account_id", F.col("hop2").alias("hop"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"),
            F.coalesce("issue", "issue2").alias("issue"), F.coalesce("top2", "top").alias("top"), F.least("low", "low2").alias("low"),
            (F.col("net") + F.coalesce("more", zero())).cast(MONEY_TOTAL).alias("net"),
        )
        reach *= 2


def account_rollup(tb: DataFrame, accounts: DataFrame) -> DataFrame:
    """Own and subtree balance of each account, its depth, and what is wrong with its chain.

    Balances reach every real ancestor once, also when the chain ends in an issue: ``missing_parent``, or ``cycle``, of
    which all members have one subtree. An account named twice has the least of its parents. Sums are carried up by
    doubling steps; no row is made for an account and one of those above it.
    """
    shared_dir(accounts.sparkSession)
    parents = accounts.groupBy("account_id").agg(F.min("parent_account_id").alias("parent_id"))
    own = tb.groupBy("account_id").agg(total("net").alias("own_net"))
    known = parents.select(F.col("account_id").alias("known"))
    hop = F.col("known")
    started = (
        join_hot(parents, known.withColumn("found", F.col("known")), {"parent_id": "known"}, "left").withColumnRenamed("found", "known")
        .join(own, "account_id", "left")
        .select(
            "account_id", F.coalesce("own_net", zero()).alias("own_net"), hop.alias("hop"),
            F.when(hop.isNotNull(), 1).otherwise(0).cast("long").alias("depth"),
            F.when(F.col("parent_id").isNotNull() & hop.isNull(), "missing_parent").alias("issue"),
            F.coalesce(hop, "account_id").alias("top"), F.least("account_id", hop).alias("low"),
            F.coalesce("own_net", zero()).alias("net"),
        ).checkpoint()
    )
    many = started.count()
    nodes = _jumped(started.drop("own_net"), many)
    result = ["account_id", "own_net", F.col("net").alias("subtree_net"), "depth", "issue"]
    owned = started.select("account_id", "own_net")
    ended = nodes.join(owned, "account_id")
    if nodes.filter("hop is not null").isEmpty():
        return ended.select(*result)
    # After so many steps a hop is a member of the cycle, and each member is the hop of some account; the
    # least account that members meet names their cycle.
    members = nodes.join(nodes.select(F.col("hop").alias("account_id")).filter("account_id is not null").distinct(), "account_id").select(
        "account_id", F.col("low").alias("cycle"))
    cut = started.join(members, "account_id", "left")
    open_hop = F.when(F.col("cycle").isNull(), F.col("hop"))
    trees = _jumped(cut.select(
        "account_id", open_hop.alias("hop"), F.when(open_hop.isNotNull(), 1).otherwise(0).cast("long").alias("depth"), "issue",
        F.coalesce(open_hop, "account_id").alias("top"), "low", F.col("own_net").alias("net")), many)
    cycles = trees.join(members, "account_id").groupBy("cycle").agg(F.count(F.lit(1)).alias("length"), total("net").alias("whole"))
    member = members.join(cycles, "cycle").select(F.col("account_id").alias("member"), "length", "whole")
    placed = join_hot(trees, member, {"top": "member"}, "left").join(owned, "account_id")
    return placed.select(
        "account_id", "own_net", F.when(F.col("account_id") == F.col("top"), F.coalesce("whole", "net")).otherwise(F.col("net")).alias("subtree_net"),
        (F.col("depth") + F.coalesce(F.col("length") - 1, F.lit(0))).alias("depth"),
        F.when(F.col("length").isNotNull(), "cycle").otherwise(F.col("issue")).alias("issue"),
    )


def financial_statements(tb: DataFrame, accounts: DataFrame) -> DataFrame:
    """Balance sheet and income statement totals by account type, in their normal sign."""
    kind = F.col("account_type")
    signed = F.when(kind.isin("A", "X"), F.col("net")).otherwise(-F.col("net"))
    return (
        tb.join(accounts.select("account_id", "account_type"), "account_id")
        .groupBy("account_type").agg(total(signed).alias("amount"))
        .select(
            F.when(kind.isin("A", "L", "E"), "balance_sheet").otherwise("income_statement").alias("statement"),
            "account_type", "amount",
        )
    )


def close_statements(snapshots: DataFrame, accounts: DataFrame) -> DataFrame:
    """Balance sheet and income statement totals of each close version and period, from `close_snapshot`."""
    kind = F.col("account_type")
    signed = F.when(kind.isin("A", "X"), F.col("balance")).otherwise(-F.col("balance"))
    return (
        snapshots.join(accounts.select("account_id", "account_type"), "account_id")
        .groupBy("close_version", "period_id", "account_type").agg(total(signed).alias("amount"))
        .select(
            "close_version", "period_id",
            F.when(kind.isin("A", "L", "E"), "balance_sheet").otherwise("income_statement").alias("statement"),
            "account_type", "amount",
        )
    )


def roll_forward(entries: DataFrame, lines: DataFrame, periods: DataFrame, accounts: DataFrame) -> DataFrame:
    """Opening balance, movement and closing balance of each account in each period.

    Lines are reduced to account and period first. Periods without activity are filled
    from the row before them, each row producing the run of periods up to the next.
    """
    calendar = periods.select(
        "period_id", F.row_number().over(Window.orderBy("start_date", "period_id")).alias("idx")
    )  # window over the calendar, not the ledger
    moved = (
        assign_period(posted_lines(entries, lines, None, "entry_date"), periods)
        .groupBy("account_id", "period_id").agg(total("debit").alias("debit"), total("credit").alias("credit"))
        .join(calendar, "period_id").select("account_id", "idx", "debit", "credit")
    )
    start = accounts.select("account_id", F.lit(1).alias("idx"), zero().alias("debit"), zero().alias("credit"))
    active = moved.unionByName(start).groupBy("account_id", "idx").agg(
        total("debit").alias("debit"), total("credit").alias("credit")
    )
    by_period = Window.partitionBy("account_id").orderBy("idx")
    last = calendar.select(F.max("idx")).scalar()
    movement = F.col("debit") - F.col("credit")
    carried = active.select(
        "account_id", F.col("idx").alias("moved_idx"), "debit", "credit",
        F.sum(movement).over(by_period.rowsBetween(Window.unboundedPreceding, 0)).cast(MONEY_TOTAL).alias("closing"),
        F.lead("idx").over(by_period).alias("next_idx"), last.alias("last_idx"),
    )
    until = F.coalesce(F.col("next_idx") - 1, F.col("last_idx"))
    filled = carried.filter("moved_idx <= last_idx").select(
        "account_id", "moved_idx", "debit", "credit", "closing", F.explode(F.sequence("moved_idx", until)).alias("idx")
    )
    here = F.col("idx") == F.col("moved_idx")
    rows = filled.select(
        "account_id", "idx",
        F.when(here, F.col("debit")).otherwise(zero()).alias("debit"),
        F.when(here, F.col("credit")).otherwise(zero()).alias("credit"), "closing",
    )
    return rows.join(calendar, "idx").select(
        "account_id", "period_id", (F.col("closing") - movement).cast(MONEY_TOTAL).alias("opening"),
        "debit", "credit", "closing",
    )


def close_snapshot(entries: DataFrame, lines: DataFrame, periods: DataFrame, close_events: DataFrame) -> DataFrame:
    """Balance of each account in a period as each close of that period saw it.

    An entry belongs to a close when it was posted on or before that day. Each posting day falls to the first close
    that saw it; the sums so far run on from close to close, so that no row is made for a posting day and each close after it.
    """
    # The closes of one period are few: they travel as a list in the order of their days.
    closes = close_events.filter("closed_on is not null").groupBy("period_id").agg(
        F.sort_array(F.collect_set(F.struct("closed_on", "close_version"))).alias("closes"))
    posted = assign_period(posted_lines(entries, lines, None, "entry_date", "posted_at"), periods)
    place = F.size(F.filter("closes", lambda close: close["closed_on"] < F.col("posted_at")))
    moved = (
        posted.filter("posted_at is not null").groupBy("period_id", "account_id", "posted_at")
        .agg((total("debit") - total("credit")).cast(MONEY_TOTAL).alias("net"))
        .join(closes, "period_id").withColumn("place", place).filter(F.col("place") < F.size("closes"))
        .groupBy("period_id", "account_id", "place").agg(total("net").alias("net"))
    )
    so_far = Window.partitionBy("period_id", "account_id").orderBy("place")  # rows are closes
    carried = moved.select(
        "period_id", "account_id", "place",
        F.sum("net").over(so_far.rowsBetween(Window.unboundedPreceding, 0)).cast(MONEY_TOTAL).alias("balance"),
        F.lead("place").over(so_far).alias("next"),
    ).join(closes, "period_id")
    until = F.coalesce(F.col("next"), F.size("closes"))
    return carried.select(
        "period_id", "account_id", "balance", F.explode(F.slice("closes", F.col("place") + 1, until - F.col("place"))).alias("close")
    ).select("close.close_version", "period_id", "account_id", "balance")


def close_diff(
    snapshots: DataFrame, v1: int, v2: int, entries: DataFrame | None = None, lines: DataFrame | None = None,
    periods: DataFrame | None = None, close_events: DataFrame | None = None,
) -> DataFrame:
    """Accounts whose balance in a period differs between two closes of it.

    Only periods that have both closes are compared. Given the ledger as well, the
    adjusting entries posted between the two closes are counted and summed; balances and entries then come
    from one pass over the ledger, and ``snapshots`` is not read.
    """
    change = (F.col("new_balance") - F.col("old_balance")).cast(MONEY_TOTAL)
    if entries is None:
        def balance_at(version: int) -> Column:
            return total(F.when(F.col("close_version") == version, F.col("balance")))

        two = snapshots.filter(F.col("close_version").isin(v1, v2))
        reclosed = two.groupBy("period_id").agg(F.count_distinct("close_version").alias("versions")).filter("versions = 2")
        return (
            two.groupBy("period_id", "account_id").agg(balance_at(v1).alias("old_balance"), balance_at(v2).alias("new_balance"))
            .join(reclosed.select("period_id"), "period_id", "left_semi").withColumn("change", change).filter("change <> 0")
        )

    def closed_on(version: int) -> Column:
        return F.max(F.when(F.col("close_version") == version, F.col("closed_on")))

    spans = close_events.groupBy("period_id").agg(closed_on(v1).alias("first_on"), closed_on(v2).alias("second_on")).filter(
        "first_on is not null and second_on is not null")
    between = F.col("is_adjusting") & (F.col("posted_at") > F.col("first_on")) & (F.col("posted_at") <= F.col("second_on"))
    net = F.col("debit") - F.col("credit")

    def part(condition: Column | str) -> Column:
        return total(F.when(F.expr(condition) if isinstance(condition, str) else condition, net))

    # Per adjusting entry first, to count them; all other lines of an account come together at once.
    parts = (
        assign_period(posted_lines(entries, lines, None, "entry_date", "posted_at", "is_adjusting"), periods)
        .join(spans, "period_id").withColumn("adjusting", F.coalesce(between, F.lit(False)))
        .groupBy("period_id", "account_id", F.when(F.col("adjusting"), F.col("entry_id")).alias("entry"))
        .agg(part("posted_at <= first_on").alias("old"), part("posted_at <= second_on").alias("new"), part(F.col("adjusting")).alias("net"))
    )
    return (
        parts.groupBy("period_id", "account_id").agg(
            total("old").alias("old_balance"), total("new").alias("new_balance"),
            F.count("entry").alias("adjusting_entries"), total("net").alias("adjusting_net"))
        .withColumn("change", change).filter("change <> 0")
        .select("period_id", "account_id", "old_balance", "new_balance", "change", "adjusting_entries", "adjusting_net")
    )


def subledger_reconcile(
    invoices: DataFrame, invoice_lines: DataFrame, entries: DataFrame, lines: DataFrame, control_account: int
) -> DataFrame:
    """Open receivables per customer against the control account of the ledger.

    Issued invoices count as open. A ledger line belongs to the customer of the invoice
    its entry was made from.
    """
    # Lines of other invoices are dropped before they are summed.
    billed = (
        invoice_lines.join(invoices.filter("status = 'issued'").select("invoice_id", "customer_id"), "invoice_id")
        .groupBy("invoice_id", "customer_id").agg(total("amount").alias("open")).select("customer_id", "open")
    )
    control = posted_lines(entries, lines.filter(F.col("account_id") == control_account), None, "source_id")
    booked = (
        control.groupBy("source_id").agg((total("debit") - total("credit")).cast(MONEY_TOTAL).alias("open"))
        .join(invoices.select(F.col("invoice_id").alias("source_id"), "customer_id"), "source_id", "left")
        .select("customer_id", "open")
    )
    return reconcile(billed, booked, ["customer_id"], ["open"])
