"""Queries over the ledger, invoices, jobs and migration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import closing, dims, invoicing, jobshop, ledger, migrate
from ledgerloom.plans.registry import register

MONEY = "DECIMAL(38,4)"


def _sum(expression: str) -> str:
    return f"CAST(coalesce(sum({expression}), 0) AS {MONEY})"


_DR, _CR = f"{_sum('debit')} AS debit", f"{_sum('credit')} AS credit"
_NET = f"CAST({_sum('debit')} - {_sum('credit')} AS {MONEY})"
_POSTED = "journal_line l JOIN journal_entry e ON e.entry_id = l.entry_id AND e.status = 'posted'"
_PERIOD = "accounting_period p ON e.entry_date BETWEEN p.start_date AND p.end_date"

# -- entries and periods --------------------------------------------------------------

register("f2_journal_query", """SELECT e.entry_id, entry_date, source_type, source_id, status, posted_at, is_adjusting,
      adjusting_reason, account_id, debit, credit, site_id, cost_center_id, business_unit_id
    FROM journal_entry e JOIN journal_line l ON e.entry_id = l.entry_id
    WHERE source_type = 'order' AND entry_date BETWEEN DATE '1997-03-01' AND DATE '1999-06-30'
      AND cost_center_id = 2 AND business_unit_id = 1""")(
    lambda t: ledger.journal_query(
        t["journal_entry"], t["journal_line"], source_type="order", date_from="1997-03-01", date_to="1999-06-30",
        dims={"cost_center_id": 2, "business_unit_id": 1},
    )
)

_BALANCES = f"""SELECT e.entry_id, {_DR}, {_CR}, {_NET} AS diff, count(l.entry_id) AS line_count,
    count(l.entry_id) > 0 AND {_NET} = 0 AS balanced
    FROM journal_entry e LEFT JOIN journal_line l ON e.entry_id = l.entry_id GROUP BY e.entry_id"""
register("l1_balance_check", _BALANCES)(lambda t: ledger.balance_check(t["journal_entry"], t["journal_line"]))

register("l2_assign_period", f"""SELECT e.entry_id, e.entry_date, min(p.period_id) AS period_id, count(p.period_id) AS match_count
    FROM journal_entry e LEFT JOIN {_PERIOD} GROUP BY e.entry_id, e.entry_date""")(
    lambda t: ledger.assign_period(t["journal_entry"].select("entry_id", "entry_date"), t["accounting_period"])
)

_ISSUES = """WITH spans AS (SELECT period_id, start_date, end_date,
      max(greatest(start_date, end_date)) OVER (ORDER BY start_date, end_date, period_id
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ends FROM {table})
    SELECT period_id, 'inverted' AS issue FROM spans WHERE start_date > end_date
    UNION ALL SELECT period_id, 'overlap' FROM spans WHERE start_date <= ends
    UNION ALL SELECT period_id, 'gap' FROM spans WHERE start_date > ends + 1"""
# Shipping months of two suppliers' nations overlap, and busy days leave gaps.
_SHIP_SPANS = """SELECT CAST(year(l_shipdate) * 10 + l_linenumber AS INT) AS period_id,
    CAST(min(l_shipdate) AS DATE) AS start_date, CAST(max(l_shipdate) AS DATE) AS end_date
    FROM lineitem GROUP BY year(l_shipdate), l_linenumber"""
register("l3_period_calendar_check", _ISSUES.format(table=f"({_SHIP_SPANS})"))(
    lambda t: ledger.period_calendar_check(t.sql(_SHIP_SPANS))
)

register("l4_classify_posting", f"""WITH balances AS ({_BALANCES}),
    dated AS (SELECT e.entry_id, e.status AS entry_status, is_adjusting, adjusting_reason,
                count(p.period_id) AS periods, min(p.status) AS period_status
              FROM journal_entry e LEFT JOIN {_PERIOD}
              GROUP BY e.entry_id, e.status, is_adjusting, adjusting_reason),
    judged AS (SELECT d.entry_id, CASE
        WHEN entry_status = 'posted' THEN 'already_posted' WHEN line_count = 0 THEN 'no_lines'
        WHEN NOT balanced THEN 'unbalanced' WHEN periods = 0 THEN 'no_period' WHEN periods > 1 THEN 'ambiguous_period'
        WHEN period_status = 'closed' THEN 'period_closed'
        WHEN period_status = 'reopened' AND NOT is_adjusting THEN 'reopened_requires_adjusting'
        WHEN is_adjusting AND trim(coalesce(adjusting_reason, '')) = '' THEN 'adjusting_reason_required' END AS reason
      FROM dated d JOIN balances b ON b.entry_id = d.entry_id)
    SELECT entry_id, CASE WHEN reason IS NULL THEN 'post' ELSE 'reject' END AS decision, reason FROM judged""")(
    lambda t: ledger.classify_posting(t["journal_entry"], t["journal_line"], t["accounting_period"])
)

# -- corrections ------------------------------------------------------------------------


def _reversed(t):
    return ledger.reversal_entries(t["journal_entry"], t["journal_line"], t["journal_entry"].select("entry_id"), "2001-12-31")


register("l5_reversal_entries", """SELECT concat('REV-', entry_id) AS entry_id, DATE '2001-12-31' AS entry_date,
    'reversal' AS source_type, CAST(entry_id AS VARCHAR) AS source_id, 'draft' AS status, entry_id AS reverses_entry_id
    FROM journal_entry WHERE status = 'posted'""")(lambda t: _reversed(t)[0])
register("l5_reversal_lines", """SELECT concat('REV-', l.entry_id) AS entry_id, account_id, site_id, cost_center_id, business_unit_id,
    credit AS debit, debit AS credit FROM journal_line l JOIN journal_entry e ON e.entry_id = l.entry_id AND e.status = 'posted'""")(
    lambda t: _reversed(t)[1]
)
register("l5_reversal_lines_mixed_types", """SELECT concat('REV-', l.entry_id) AS entry_id, account_id, site_id, cost_center_id, business_unit_id,
    credit AS debit, debit AS credit FROM journal_line l JOIN journal_entry e ON e.entry_id = l.entry_id AND e.status = 'posted'""")(
    # Lines with int ids, entries with bigint ids.
    lambda t: ledger.reversal_entries(
        t["journal_entry"], t["journal_line"].withColumn("entry_id", F.col("entry_id").cast("int")), t["journal_entry"].select("entry_id"), "2001-12-31"
    )[1]
)
register("l6_correcting_entries", f"""WITH posted AS (
      SELECT corrects_entry_id, c.entry_id FROM correction c JOIN journal_entry e ON e.entry_id = c.corrects_entry_id AND e.status = 'posted'),
    both_roles AS (
      SELECT concat('REV-', corrects_entry_id) AS entry_id, 'reversal' AS role, corrects_entry_id AS original_id FROM posted
      UNION ALL SELECT entry_id, 'correction', corrects_entry_id FROM posted),
    amounts AS (
      SELECT concat('REV-', l.entry_id) AS entry_id, credit AS debit, debit AS credit
      FROM journal_line l JOIN posted p ON p.corrects_entry_id = l.entry_id
      UNION ALL SELECT entry_id, debit, credit FROM corrected_line)
    SELECT b.entry_id, role, original_id, {_DR}, {_CR}, {_NET} AS diff, count(a.entry_id) AS line_count,
           count(a.entry_id) > 0 AND {_NET} = 0 AS balanced
    FROM both_roles b LEFT JOIN amounts a ON a.entry_id = b.entry_id GROUP BY b.entry_id, role, original_id""")(
    lambda t: ledger.correcting_entries(
        t["journal_entry"], t["journal_line"], t["correction"], t["corrected_line"], "2001-12-31"
    )
)
register("l7_immutability_audit", """SELECT b.entry_id, CASE WHEN a.entry_id IS NULL THEN 'deleted' ELSE 'updated' END AS change
    FROM journal_entry b LEFT JOIN changed_entry a ON a.entry_id = b.entry_id
    WHERE b.status = 'posted' AND (a.entry_id IS NULL OR a.entry_date IS DISTINCT FROM b.entry_date
      OR a.source_id IS DISTINCT FROM b.source_id OR a.adjusting_reason IS DISTINCT FROM b.adjusting_reason)""")(
    lambda t: ledger.immutability_audit(
        t["journal_entry"], t["changed_entry"], ["entry_id"], ["entry_date", "source_id", "adjusting_reason"],
        F.col("status") == "posted",
    )
)

# -- balances -----------------------------------------------------------------------------


def _trial_sql(extra: str = "") -> str:
    return f"""SELECT a.account_id, {_DR}, {_CR}, {_NET} AS net FROM account a
        LEFT JOIN (SELECT l.account_id, debit, credit FROM {_POSTED} {extra}) l ON l.account_id = a.account_id
        GROUP BY a.account_id"""


def _trial(t, as_of=None):
    return ledger.trial_balance(t["journal_entry"], t["journal_line"], t["account"], as_of)


register("l8_trial_balance", _trial_sql())(_trial)
register("l8_trial_balance_as_of", _trial_sql("WHERE e.entry_date <= DATE '1998-06-30'"))(lambda t: _trial(t, "1998-06-30"))

_DIMS = "site_id, cost_center_id, business_unit_id"


def _dim_sql(grouping: str) -> str:
    return f"""SELECT {_DIMS}, CAST(grouping({_DIMS}) AS BIGINT) AS gid, {_DR}, {_CR}, {_NET} AS net, count(*) AS lines
        FROM (SELECT {_DIMS}, debit, credit FROM {_POSTED}) GROUP BY {grouping}"""


def _by_dims(mode: str, **extra):
    return lambda t: ledger.balances_by_dimension(t["journal_entry"], t["journal_line"], mode=mode, **extra)


register("l9_balances_by_dimension", _dim_sql(f"ROLLUP ({_DIMS})"))(_by_dims("rollup"))
register("l9_balances_cube", _dim_sql(f"CUBE ({_DIMS})"))(_by_dims("cube"))
register("l9_balances_sets", _dim_sql("GROUPING SETS ((site_id, business_unit_id), (cost_center_id), ())"))(
    _by_dims("sets", sets=[["site_id", "business_unit_id"], ["cost_center_id"], []])
)

register("l10_account_rollup", f"""WITH tb AS ({_trial_sql()}),
    chain (account_id, ancestor_id, depth) AS (
      SELECT account_id, account_id, 0 FROM account
      UNION ALL SELECT c.account_id, a.parent_account_id, c.depth + 1 FROM chain c
      JOIN account a ON a.account_id = c.ancestor_id WHERE a.parent_account_id IS NOT NULL)
    SELECT a.account_id, t.net AS own_net,
      (SELECT {_sum('s.net')} FROM chain c JOIN tb s ON s.account_id = c.account_id WHERE c.ancestor_id = a.account_id) AS subtree_net,
      (SELECT max(depth) FROM chain c WHERE c.account_id = a.account_id) AS depth, CAST(NULL AS VARCHAR) AS issue
    FROM account a JOIN tb t ON t.account_id = a.account_id""")(lambda t: closing.account_rollup(_trial(t), t["account"]))
register("l10_deep_rollup", """SELECT a.account_id, a.net AS own_net,
      CAST((SELECT sum(d.net) FROM deep_account d WHERE d.account_id >= a.account_id) AS DECIMAL(38,4)) AS subtree_net,
      CAST(a.account_id AS BIGINT) AS depth, CAST(NULL AS VARCHAR) AS issue FROM deep_account a""")(
    # One chain of 150 accounts.
    lambda t: closing.account_rollup(t["deep_account"].select("account_id", "net"), t["deep_account"])
)
register("l11_financial_statements", f"""WITH tb AS ({_trial_sql()})
    SELECT CASE WHEN account_type IN ('A', 'L', 'E') THEN 'balance_sheet' ELSE 'income_statement' END AS statement, account_type,
      {_sum("CASE WHEN account_type IN ('A', 'X') THEN net ELSE -net END")} AS amount
    FROM tb JOIN account a ON a.account_id = tb.account_id GROUP BY account_type""")(
    lambda t: closing.financial_statements(_trial(t), t["account"])
)
register("l12_roll_forward", f"""WITH moves AS (
      SELECT l.account_id, p.period_id, {_DR}, {_CR} FROM {_POSTED} JOIN {_PERIOD} GROUP BY l.account_id, p.period_id),
    spine AS (SELECT a.account_id, p.period_id, coalesce(debit, 0) AS debit, coalesce(credit, 0) AS credit
      FROM account a CROSS JOIN accounting_period p LEFT JOIN moves m ON m.account_id = a.account_id AND m.period_id = p.period_id),
    carried AS (SELECT *, sum(debit - credit) OVER (PARTITION BY account_id ORDER BY period_id) AS closing FROM spine)
    SELECT account_id, period_id, CAST(closing - (debit - credit) AS {MONEY}) AS opening, CAST(debit AS {MONEY}) AS debit,
      CAST(credit AS {MONEY}) AS credit, CAST(closing AS {MONEY}) AS closing FROM carried""")(
    lambda t: closing.roll_forward(t["journal_entry"], t["journal_line"], t["accounting_period"], t["account"])
)

_SNAPSHOTS = f"""SELECT c.close_version, p.period_id, l.account_id, {_NET} AS balance FROM {_POSTED} JOIN {_PERIOD}
    JOIN close_event c ON c.period_id = p.period_id AND e.posted_at <= c.closed_on
    GROUP BY c.close_version, p.period_id, l.account_id"""


def _snapshots(t):
    return closing.close_snapshot(t["journal_entry"], t["journal_line"], t["accounting_period"], t["close_event"])


register("l13_close_snapshot", _SNAPSHOTS)(_snapshots)
register("l13_close_statements", f"""WITH snap AS ({_SNAPSHOTS})
    SELECT close_version, period_id, CASE WHEN account_type IN ('A', 'L', 'E') THEN 'balance_sheet' ELSE 'income_statement' END AS statement,
      account_type, {_sum("CASE WHEN account_type IN ('A', 'X') THEN balance ELSE -balance END")} AS amount
    FROM snap s JOIN account a ON a.account_id = s.account_id GROUP BY close_version, period_id, account_type""")(
    lambda t: closing.close_statements(_snapshots(t), t["account"])
)
register("l14_close_diff", f"""WITH snap AS ({_SNAPSHOTS}),
    reclosed AS (SELECT a.period_id, a.closed_on AS first_on, b.closed_on AS second_on
      FROM close_event a JOIN close_event b ON a.period_id = b.period_id AND a.close_version = 1 AND b.close_version = 2),
    pairs AS (SELECT period_id, account_id, {_sum('CASE WHEN close_version = 1 THEN balance END')} AS old_balance,
        {_sum('CASE WHEN close_version = 2 THEN balance END')} AS new_balance
      FROM snap WHERE period_id IN (SELECT period_id FROM reclosed) GROUP BY period_id, account_id),
    adjusting AS (SELECT p.period_id, l.account_id, count(DISTINCT l.entry_id) AS n, {_NET} AS net FROM {_POSTED} JOIN {_PERIOD}
      JOIN reclosed r ON r.period_id = p.period_id AND e.posted_at > r.first_on AND e.posted_at <= r.second_on
      WHERE e.is_adjusting GROUP BY p.period_id, l.account_id)
    SELECT d.period_id, d.account_id, old_balance, new_balance, CAST(new_balance - old_balance AS {MONEY}) AS change,
      coalesce(n, 0) AS adjusting_entries, CAST(coalesce(net, 0) AS {MONEY}) AS adjusting_net
    FROM pairs d LEFT JOIN adjusting a ON a.period_id = d.period_id AND a.account_id = d.account_id
    WHERE new_balance <> old_balance""")(
    lambda t: closing.close_diff(
        _snapshots(t), 1, 2, t["journal_entry"], t["journal_line"], t["accounting_period"], t["close_event"]
    )
)


def _reconcile_sql(left: str, right: str, keys: list[str], measures: list[str]) -> str:
    by = ", ".join(keys)
    sums = ", ".join(f"{_sum(m)} AS {m}" for m in measures)
    match = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    columns = [f"coalesce(a.{k}, b.{k}) AS {k}" for k in keys]
    for m in ["n", *measures]:
        name, kind = ("rows", "BIGINT") if m == "n" else (m, MONEY)
        columns += [
            f"CAST(coalesce(a.{m}, 0) AS {kind}) AS left_{name}", f"CAST(coalesce(b.{m}, 0) AS {kind}) AS right_{name}",
            f"CAST(coalesce(a.{m}, 0) - coalesce(b.{m}, 0) AS {kind}) AS diff_{name}",
        ]
    equal = " AND ".join(f"a.{m} = b.{m}" for m in ["n", *measures])
    return f"""WITH a AS (SELECT {by}, count(*) AS n, {sums}, true AS here FROM ({left}) GROUP BY {by}),
        b AS (SELECT {by}, count(*) AS n, {sums}, true AS here FROM ({right}) GROUP BY {by})
        SELECT {', '.join(columns)}, CASE WHEN b.here IS NULL THEN 'left_only' WHEN a.here IS NULL THEN 'right_only'
          WHEN {equal} THEN 'match' ELSE 'differ' END AS status
        FROM a FULL OUTER JOIN b ON {match}"""


register("l15_subledger_reconcile", _reconcile_sql(
    """SELECT customer_id, open FROM (SELECT invoice_id, sum(amount) AS open FROM invoice_line GROUP BY invoice_id) s
       JOIN invoice i ON i.invoice_id = s.invoice_id AND i.status = 'issued'""",
    f"""SELECT customer_id, open FROM (SELECT e.source_id, sum(debit - credit) AS open FROM {_POSTED}
       WHERE l.account_id = 1100 GROUP BY e.source_id) s LEFT JOIN invoice i ON i.invoice_id = s.source_id""",
    ["customer_id"], ["open"],
))(
    lambda t: closing.subledger_reconcile(
        t["invoice"], t["invoice_line"], t["journal_entry"], t["journal_line"], control_account=1100
    )
)
register("l16_opening_balances", f"""WITH nets AS (
      SELECT account_id, {_DIMS}, {_NET} AS net FROM {_POSTED} WHERE e.entry_date < DATE '1998-01-01' GROUP BY account_id, {_DIMS}),
    carried AS (SELECT * FROM nets UNION ALL
      SELECT 3000, NULL, NULL, NULL, CAST(-coalesce(sum(net), 0) AS {MONEY}) FROM nets)
    SELECT 'OPENING' AS entry_id, account_id, {_DIMS}, CAST(greatest(net, 0) AS {MONEY}) AS debit,
      CAST(greatest(-net, 0) AS {MONEY}) AS credit FROM carried WHERE net <> 0""")(
    lambda t: ledger.opening_balances(t["journal_entry"], t["journal_line"], "1998-01-01", balancing_account=3000)
)

# -- dimensions ----------------------------------------------------------------------------

register("dm1_validate_refs", """SELECT l.entry_id, l.account_id, d.dimension, d.bad_value, d.reason FROM journal_line l, LATERAL (
      SELECT 'business_unit_id' AS dimension, CAST(l.business_unit_id AS VARCHAR) AS bad_value,
        CASE WHEN l.business_unit_id IS NULL THEN 'missing' ELSE 'unknown' END AS reason
      WHERE l.business_unit_id IS NULL OR l.business_unit_id NOT IN (SELECT business_unit_id FROM business_unit)
      UNION ALL SELECT 'cost_center_id', CAST(l.cost_center_id AS VARCHAR),
        CASE WHEN l.cost_center_id IS NULL THEN 'missing' ELSE 'unknown' END
      WHERE l.cost_center_id IS NULL OR l.cost_center_id NOT IN (SELECT business_unit_id FROM business_unit)) d""")(
    # Cost centers are held against the shorter list of units on purpose, to get unknown ones.
    lambda t: dims.validate_refs(t["journal_line"], ["entry_id", "account_id"], {
        "business_unit_id": (t["business_unit"], "business_unit_id"),
        "cost_center_id": (t["business_unit"], "business_unit_id"),
    })
)
register("dm1_mixed_types", """SELECT l.entry_id, l.account_id, 'site_id' AS dimension, CAST(l.site_id AS VARCHAR) AS bad_value,
      CASE WHEN l.site_id IS NULL THEN 'missing' ELSE 'unknown' END AS reason
    FROM journal_line l WHERE l.site_id IS NULL OR l.site_id NOT IN (SELECT site_id FROM bigint_site WHERE site_id % 2 = 0)""")(
    # An int column against a bigint reference that lacks every other row.
    lambda t: dims.validate_refs(t["journal_line"], ["entry_id", "account_id"], {"site_id": (t["bigint_site"].filter("site_id % 2 = 0"), "site_id")})
)
register("dm2_mixed_types", """SELECT l.*, s.name AS site_name FROM journal_line l LEFT JOIN bigint_site s ON s.site_id = l.site_id""")(
    lambda t: dims.with_dimensions(t["journal_line"], {"site_id": (t["bigint_site"], "site_id", "name")})
)
register("dm2_with_dimensions", """SELECT l.*, s.name AS site_name, c.name AS cost_center_name, b.name AS business_unit_name
    FROM journal_line l LEFT JOIN site s ON s.site_id = l.site_id LEFT JOIN cost_center c ON c.cost_center_id = l.cost_center_id
    LEFT JOIN business_unit b ON b.business_unit_id = l.business_unit_id""")(
    lambda t: dims.with_dimensions(t["journal_line"], {
        name: (t[name.removesuffix("_id")], name, "name") for name in ledger.DIMENSIONS
    })
)

# -- invoices and jobs ------------------------------------------------------------------------

register("i1_invoice_totals", f"""SELECT invoice_id, count(*) AS lines, {_sum('amount')} AS total,
    bool_and(amount = qty * unit_price) AS amount_ok FROM invoice_line GROUP BY invoice_id""")(
    lambda t: invoicing.invoice_totals(t["invoice_line"])
)
_BOOKED = f"""SELECT concat('INV-', l.invoice_id) AS entry_id, CAST(1100 AS INT) AS account_id, site_id,
      {_sum('amount')} AS debit, CAST(0 AS {MONEY}) AS credit
    FROM invoice_line_site l JOIN invoice i ON i.invoice_id = l.invoice_id AND i.status = 'issued' GROUP BY l.invoice_id, site_id
    UNION ALL SELECT concat('INV-', l.invoice_id), 4100, site_id, CAST(0 AS {MONEY}), CAST(amount AS {MONEY})
    FROM invoice_line_site l JOIN invoice i ON i.invoice_id = l.invoice_id AND i.status = 'issued'"""


def _booked(t):
    return invoicing.invoice_postings(t["invoice"], t["invoice_line_site"], 1100, 4100, ["site_id"])


register("i2_invoice_postings", _BOOKED)(lambda t: _booked(t)[1])
register("i2_posting_balance", f"""WITH booked AS ({_BOOKED})
    SELECT count(*) AS entries, count(*) FILTER (n > 0 AND debit = credit) AS balanced, count(*) FILTER (n = 0) AS without_lines
    FROM (SELECT i.invoice_id, count(b.entry_id) AS n, sum(debit) AS debit, sum(credit) AS credit
          FROM invoice i LEFT JOIN booked b ON b.entry_id = concat('INV-', i.invoice_id)
          WHERE i.status = 'issued' GROUP BY i.invoice_id)""")(
    lambda t: ledger.balance_check(*_booked(t)).agg(
        F.count(F.lit(1)).alias("entries"), F.count_if("balanced").alias("balanced"),
        F.count_if(F.col("line_count") == 0).alias("without_lines"),
    )
)


def _credited(t):
    return invoicing.credit_notes(t["invoice"], t["invoice_line"], t["invoice"].filter("status = 'void'"))


register("i3_credit_notes", """SELECT concat('CN-', invoice_id) AS credit_note_id, invoice_id AS credits_invoice_id, customer_id
    FROM invoice WHERE status = 'void'""")(lambda t: _credited(t)[0])
register("i3_credit_note_lines", """SELECT concat('CN-', l.invoice_id) AS credit_note_id, unit_price, -qty AS qty, -amount AS amount
    FROM invoice_line l JOIN invoice i ON i.invoice_id = l.invoice_id WHERE i.status = 'void'""")(lambda t: _credited(t)[1])
register("i4_posting_completeness", """SELECT e.source_type, e.source_id, count(b.source_id) AS postings,
    CASE WHEN count(b.source_id) = 0 THEN 'missing' ELSE 'duplicate' END AS problem
    FROM journal_entry e LEFT JOIN booking b ON b.source_type = e.source_type AND b.source_id = e.source_id
    GROUP BY e.source_type, e.source_id HAVING count(b.source_id) <> 1""")(
    lambda t: invoicing.posting_completeness(t["journal_entry"], t["booking"])
)

_PROGRESS = """SELECT r.job_id, count(*) FILTER (o.required) AS required,
    count(*) FILTER (o.required AND o.status = 'complete') AS complete
    FROM routing r LEFT JOIN operation o ON o.routing_id = r.routing_id GROUP BY r.job_id"""
register("j1_job_progress", f"""SELECT p.job_id, required, complete, CAST(complete AS DOUBLE) * 100 / nullif(required, 0) AS pct_complete,
    q.status AS qa_status FROM ({_PROGRESS}) p JOIN qa_record q ON q.job_id = p.job_id""")(
    lambda t: jobshop.job_progress(t["job"], t["routing"], t["operation"], t["qa_record"])
)
register("j2_qa_violations", f"""SELECT p.job_id, required - complete AS incomplete FROM ({_PROGRESS}) p
    JOIN qa_record q ON q.job_id = p.job_id WHERE q.status = 'approved' AND complete < required""")(
    lambda t: jobshop.qa_violations(t["job"], t["routing"], t["operation"], t["qa_record"])
)

# -- migration ------------------------------------------------------------------------------------


def _crossed(t):
    return migrate.apply_crosswalk(t["legacy_line"], t["account_map"], "legacy_account", "account_id")


register("m1_apply_crosswalk", """SELECT l.*, m.account_id FROM legacy_line l JOIN account_map m
    ON m.legacy_account = l.legacy_account""")(lambda t: _crossed(t)[0])
register("m1_unmapped_codes", """SELECT legacy_account AS code, count(*) AS "rows" FROM legacy_line
    WHERE legacy_account NOT IN (SELECT legacy_account FROM account_map) GROUP BY legacy_account""")(lambda t: _crossed(t)[1])

register("m2_idempotent_load", """SELECT * FROM customer_stored UNION ALL
    SELECT DISTINCT * FROM customer_load b WHERE b.c_custkey NOT IN (SELECT c_custkey FROM customer_stored)""")(
    lambda t: migrate.idempotent_load(t["customer_stored"], t["customer_load"], ["c_custkey"])
)
register("m2_latest_wins", """SELECT c_custkey, c_name, c_nationkey, revision FROM (
      SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY revision DESC, c_name DESC) AS n
      FROM (SELECT * FROM customer_stored UNION ALL SELECT * FROM customer_load)) WHERE n = 1""")(
    lambda t: migrate.idempotent_load(t["customer_stored"], t["customer_load"], ["c_custkey"], order="revision")
)
register("m3_reconcile", _reconcile_sql(
    "SELECT l.*, m.account_id FROM legacy_line l JOIN account_map m ON m.legacy_account = l.legacy_account",
    "SELECT * FROM journal_line", ["account_id", "site_id", "business_unit_id"], ["debit", "credit"],
))(
    lambda t: migrate.reconcile(_crossed(t)[0], t["journal_line"], ["account_id", "site_id", "business_unit_id"], ["debit", "credit"])
)
_LEGACY_TB = f"SELECT legacy_account, {_DR}, {_CR} FROM legacy_line GROUP BY legacy_account"
register("m4_trial_balance_compare", _reconcile_sql(
    f"SELECT m.account_id, debit, credit FROM ({_LEGACY_TB}) l LEFT JOIN account_map m ON m.legacy_account = l.legacy_account",
    f"SELECT account_id, {_DR}, {_CR} FROM journal_line GROUP BY account_id", ["account_id"], ["debit", "credit"],
))(
    lambda t: migrate.trial_balance_compare(
        t.sql(_LEGACY_TB), t.sql(f"SELECT account_id, {_DR}, {_CR} FROM journal_line GROUP BY account_id"), t["account_map"]
    )
)

_TARGET = {
    "o_orderkey": "smallint not null", "o_custkey": "int not null", "o_totalprice": "decimal(7,2)",
    "o_orderdate": "date", "o_orderpriority": "varchar(8)", "o_orderstatus": "varchar(1)",
}


def _lossless_sql(table: str, target: dict[str, str]) -> str:
    parts = []
    for c, kind in target.items():
        required, kind = kind.endswith("not null"), kind.removesuffix("not null").strip()
        if kind.startswith("varchar("):
            lossy = f"length({c}) > {kind[8:-1]}"
        else:
            lossy = f"{c} IS NOT NULL AND TRY_CAST({c} AS {kind}) IS DISTINCT FROM {c}"
        lossy = f"({lossy}) OR ({c} IS NULL AND {required})"
        parts.append(f"""SELECT '{c}' AS "column", count(*) AS "rows", count(*) FILTER ({lossy}) AS lossy_rows,
            min(CAST({c} AS VARCHAR)) FILTER ({lossy}) AS example FROM {table}""")
    return " UNION ALL ".join(parts)


register("m5_lossless_check", _lossless_sql("orders", _TARGET))(lambda t: migrate.lossless_check(t["orders"], _TARGET))
register("m6_fiscal_calendar_profile", """WITH lost AS (
      SELECT calendar, count(*) AS n, count(DISTINCT fiscal_year * 100 + period_no) AS periods FROM fiscal_journal j WHERE NOT EXISTS (SELECT 1 FROM fiscal_period p
        WHERE p.calendar = j.calendar AND p.fiscal_year = j.fiscal_year AND p.period_no = j.period_no) GROUP BY calendar)
    SELECT p.calendar, count(DISTINCT fiscal_year) AS years,
      (SELECT min(n) FROM (SELECT count(*) FILTER (NOT is_closing) AS n FROM fiscal_period y WHERE y.calendar = p.calendar GROUP BY fiscal_year)) AS least_periods,
      (SELECT max(n) FROM (SELECT count(*) FILTER (NOT is_closing) AS n FROM fiscal_period y WHERE y.calendar = p.calendar GROUP BY fiscal_year)) AS most_periods,
      count(*) FILTER (is_closing) AS closing_periods,
      CAST(max(period_no) FILTER (NOT is_closing) AS INT) AS last_period_no,
      count(*) FILTER (period_no = 0) + (SELECT count(*) FROM fiscal_journal j WHERE j.calendar = p.calendar AND period_no = 0) AS period0_rows,
      coalesce((SELECT periods FROM lost l WHERE l.calendar = p.calendar), 0) AS unmatched_periods,
      coalesce((SELECT n FROM lost l WHERE l.calendar = p.calendar), 0) AS unmatched_rows
    FROM fiscal_period p GROUP BY p.calendar""")(
    lambda t: migrate.fiscal_calendar_profile(t["fiscal_period"], t["fiscal_journal"])
)
register("m7_party_master", """SELECT upper(trim(name)) AS name_key,
    CASE WHEN count(DISTINCT kind) = 2 THEN 'both' ELSE min(kind) END AS type, true AS active,
    count(DISTINCT external_id) AS external_id_count, min(external_id) AS first_external_id
    FROM party_source GROUP BY upper(trim(name))""")(lambda t: migrate.party_master(t["party_source"]))
register("m7_party_ids", "SELECT DISTINCT upper(trim(name)) AS name_key, kind, external_id FROM party_source")(
    lambda t: migrate.party_ids(t["party_source"])
)


def _legacy_as_lines(t):
    return _crossed(t)[0].select(t["journal_line"].columns)


_LEGACY_LINES = f"""SELECT l.entry_id, m.account_id, debit, credit, {_DIMS} FROM legacy_line l
    JOIN account_map m ON m.legacy_account = l.legacy_account"""
_EXCEPT = f"""WITH counted AS (SELECT entry_id, account_id, debit, credit, {_DIMS}, CAST(sum(sign) AS BIGINT) AS copies FROM (
      SELECT *, 1 AS sign FROM journal_line UNION ALL SELECT *, -1 FROM ({_LEGACY_LINES})) GROUP BY ALL),
    extra AS (SELECT * REPLACE (abs(copies) AS copies), CASE WHEN copies > 0 THEN 'left' ELSE 'right' END AS side
      FROM counted WHERE copies <> 0)"""
register("m8_except_rows", f"{_EXCEPT} SELECT * FROM extra")(
    lambda t: migrate.except_rows(t["journal_line"], _legacy_as_lines(t))
)
register("m8_same_rows", f"""{_EXCEPT} SELECT CAST(coalesce(sum(copies) FILTER (side = 'left'), 0) AS BIGINT) AS left_extra,
    CAST(coalesce(sum(copies) FILTER (side = 'right'), 0) AS BIGINT) AS right_extra, count(*) = 0 AS same FROM extra""")(
    lambda t: migrate.same_rows(t["journal_line"], _legacy_as_lines(t))
)
