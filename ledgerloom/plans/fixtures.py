"""ERP tables derived from the driver tables.

Every text runs unchanged in Spark and in DuckDB, so a query and its check read
the same input. `Tables` builds a view only when a query asks for it.
"""

from __future__ import annotations

import re

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import work_dir
from ledgerloom.sources.tables import load_table

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Accounts, business units, workflow states, events and rules.
VIEWS = {
    "account": """
SELECT * FROM (VALUES
  (1000, 'Assets', 'A', CAST(NULL AS INT)), (1100, 'Accounts receivable', 'A', 1000),
  (2000, 'Liabilities', 'L', CAST(NULL AS INT)), (3000, 'Equity', 'E', CAST(NULL AS INT)),
  (4000, 'Revenue', 'R', CAST(NULL AS INT)), (4100, 'Sales', 'R', 4000),
  (4110, 'ECONOMY', 'R', 4100), (4120, 'LARGE', 'R', 4100), (4130, 'MEDIUM', 'R', 4100),
  (4140, 'PROMO', 'R', 4100), (4150, 'SMALL', 'R', 4100), (4160, 'STANDARD', 'R', 4100),
  (5000, 'Expense', 'X', CAST(NULL AS INT))
) AS t(account_id, name, account_type, parent_account_id)""",
    "business_unit": """
SELECT * FROM (VALUES (1, 'MachiningRepair'), (2, 'IndustrialProducts'), (3, 'Corporate'), (4, 'Owner'))
AS t(business_unit_id, name)""",
    "site": """
SELECT n_nationkey AS site_id, n_name AS name FROM nation""",
    "cost_center": """
SELECT r_regionkey AS cost_center_id, r_name AS name FROM region""",
    "accounting_period": """
SELECT CAST(year(start_date) * 100 + month(start_date) AS INT) AS period_id,
       start_date, last_day(start_date) AS end_date,
       CASE WHEN year(start_date) <= 1998 THEN 'closed'
            WHEN year(start_date) = 1999 THEN 'reopened' ELSE 'open' END AS status
FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS start_date FROM orders) m""",
    "journal_entry": """
SELECT o_orderkey AS entry_id, CAST(o_orderdate AS DATE) AS entry_date,
       'order' AS source_type, o_orderkey AS source_id,
       CASE WHEN o_orderstatus = 'F' THEN 'posted' ELSE 'draft' END AS status,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS posted_at,
       o_orderpriority = '1-URGENT' AS is_adjusting,
       CASE WHEN o_orderkey % 2 = 0 THEN concat('AUDIT-', CAST(o_orderkey AS STRING))
            WHEN o_orderkey % 3 = 0 THEN ' ' END AS adjusting_reason
FROM orders""",
    "revenue_line": """
SELECT l.l_orderkey AS entry_id,
       CASE p.p_type WHEN 'ECONOMY' THEN 4110 WHEN 'LARGE' THEN 4120 WHEN 'MEDIUM' THEN 4130
                     WHEN 'PROMO' THEN 4140 WHEN 'SMALL' THEN 4150 ELSE 4160 END AS account_id,
       CAST(CAST(l.l_extendedprice AS DECIMAL(12,2))
            * (CAST(1 AS DECIMAL(4,2)) - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS amount,
       s.s_nationkey AS site_id, n.n_regionkey AS cost_center_id,
       CASE c.c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 2
                           WHEN 'AUTOMOBILE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 END AS business_unit_id
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey""",
    "journal_line": """
SELECT entry_id, account_id, CAST(0 AS DECIMAL(18,4)) AS debit, amount AS credit,
       site_id, cost_center_id, business_unit_id
FROM revenue_line
UNION ALL
SELECT r.entry_id, 1100,
       CAST(SUM(r.amount) + CASE WHEN r.entry_id % 97 = 0 THEN CAST(0.01 AS DECIMAL(4,2))
                                 ELSE CAST(0 AS DECIMAL(4,2)) END AS DECIMAL(18,4)),
       CAST(0 AS DECIMAL(18,4)),
       MIN(r.site_id), MIN(r.cost_center_id), MIN(r.business_unit_id)
FROM revenue_line r GROUP BY r.entry_id""",
    "close_event": """
SELECT period_id, 1 AS close_version, end_date + 10 AS closed_on FROM accounting_period WHERE status <> 'open'
UNION ALL
SELECT period_id, 2, end_date + 45 FROM accounting_period WHERE status = 'reopened'""",
    "invoice": """
SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, o_orderkey AS job_id,
       CASE o_orderstatus WHEN 'F' THEN 'issued' WHEN 'P' THEN 'void' ELSE 'draft' END AS status,
       CAST(o_orderdate AS DATE) AS issued_at
FROM orders""",
    "invoice_line": """
SELECT l.l_orderkey AS invoice_id, CAST(l.l_quantity AS DECIMAL(9,0)) AS qty,
       CAST(p.p_retailprice AS DECIMAL(12,2)) AS unit_price,
       CAST(CAST(l.l_quantity AS DECIMAL(9,0)) * CAST(p.p_retailprice AS DECIMAL(12,2))
            + CASE WHEN l.l_orderkey % 101 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS amount
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "job": """
SELECT o_orderkey AS job_id, o_custkey AS customer_id FROM orders""",
    "routing": """
SELECT o_orderkey AS routing_id, o_orderkey AS job_id FROM orders""",
    "operation": """
SELECT l_orderkey AS routing_id, l_linenumber AS sequence,
       l_returnflag <> 'N' AS required,
       CASE WHEN l_linestatus = 'F' THEN 'complete' ELSE 'pending' END AS status
FROM lineitem""",
    "qa_record": """
SELECT o_orderkey AS job_id, CASE WHEN o_orderstatus = 'F' THEN 'approved' ELSE 'open' END AS status
FROM orders""",
    "transition": """
SELECT * FROM (VALUES
  ('DraftScope', 'ScopeDefined', 'Estimating', CAST(NULL AS STRING)),
  ('Estimating', 'EstimateUpdated', 'Estimating', NULL),
  ('Estimating', 'QuoteIssued', 'Quoted', NULL),
  ('Quoted', 'CustomerPOAttached', 'CustomerPOReceived', NULL),
  ('CustomerPOReceived', 'MaterialsAllocated', 'MaterialSourcing', NULL),
  ('CustomerPOReceived', 'Scheduled', 'Scheduled', 'MaterialsAllocated'),
  ('MaterialSourcing', 'Scheduled', 'Scheduled', 'MaterialsAllocated'),
  ('Scheduled', 'WorkStarted', 'InProcess', NULL),
  ('InProcess', 'OperationCompleted', 'InProcess', NULL),
  ('InProcess', 'QAApproved', 'QAComplete', NULL),
  ('QAComplete', 'ShipmentCreated', 'Shipped', 'QAApproved'),
  ('Shipped', 'InvoiceIssued', 'Invoiced', 'ShipmentCreated'),
  ('Invoiced', 'Closed', 'Closed', NULL),
  ('*', 'HoldPlaced', 'OnHold', NULL),
  ('OnHold', 'HoldReleased', '<state before hold>', NULL),
  ('*', 'Cancelled', 'Cancelled', NULL),
  ('*', 'OverrideTransition', '<target_state>', NULL)
) AS t(from_state, event_type, to_state, guard_event)""",
    "workflow_event": """
SELECT event_id, ts, 'mr_job_shop' AS workflow_name, instance_id, seq,
       CASE WHEN event_id % 17 = 0 THEN 'OverrideTransition'
            WHEN event_id % 19 = 0 THEN 'HoldPlaced'
            WHEN event_id % 23 = 0 THEN 'HoldReleased'
            WHEN event_id % 53 = 0 THEN 'Cancelled'
            ELSE CASE seq WHEN 1 THEN 'ScopeDefined' WHEN 2 THEN 'EstimateUpdated'
              WHEN 3 THEN 'QuoteIssued' WHEN 4 THEN 'CustomerPOAttached'
              WHEN 5 THEN 'MaterialsAllocated' WHEN 6 THEN 'Scheduled' WHEN 7 THEN 'WorkStarted'
              WHEN 8 THEN 'OperationCompleted' WHEN 9 THEN 'OperationCompleted'
              WHEN 10 THEN 'QAApproved' WHEN 11 THEN 'ShipmentCreated'
              WHEN 12 THEN 'InvoiceIssued' WHEN 13 THEN 'Closed' ELSE 'HoldPlaced' END END AS event_type,
       concat('k', CAST(CASE WHEN event_id % 11 = 0 THEN coalesce(prev_id, event_id)
                             ELSE event_id END AS STRING)) AS idempotency_key,
       CAST(NULL AS INT) AS expected_version,
       user_id % 7 AS actor_id,
       CASE user_id % 3 WHEN 0 THEN 'planner' WHEN 1 THEN 'controller' ELSE 'operator' END AS actor_role,
       CASE WHEN event_id % 17 = 0 THEN 'Scheduled' END AS target_state,
       CASE WHEN event_id % 17 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'approved' ELSE '' END END AS override_reason
FROM (
  SELECT *, lag(event_id) OVER (PARTITION BY instance_id ORDER BY event_id) AS prev_id
  FROM (
    SELECT *, user_id * 1000 + CAST(floor(rn / 14) AS BIGINT) AS instance_id,
           CAST(rn % 14 + 1 AS INT) AS seq
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS rn FROM events) a
  ) b
) c""",
    "permission_rule": """
SELECT * FROM (VALUES
  ('mr_job_shop', CAST(NULL AS STRING), 'planner', CAST(NULL AS STRING), false),
  ('mr_job_shop', NULL, 'controller', NULL, false),
  ('mr_job_shop', 'OverrideTransition', 'controller', NULL, true),
  ('mr_job_shop', 'OperationCompleted', 'operator', 'InProcess', false)
) AS t(workflow_name, event_type, role, current_state, override_flag)""",
    "outbox_attempt": """
SELECT message_id, CAST(row_number() OVER (PARTITION BY message_id ORDER BY event_id) AS INT) AS attempt,
       ts AS attempted_at, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'sent' END AS status
FROM (SELECT *, CAST(floor(event_id / 4) AS BIGINT) AS message_id FROM events) e""",
    "account_map": """
SELECT concat('L-', CAST(account_id AS STRING)) AS legacy_account, account_id
FROM account WHERE account_id <> 4160""",
    "legacy_line": """
SELECT concat('L-', CAST(account_id AS STRING)) AS legacy_account, entry_id, debit, credit,
       site_id, cost_center_id, business_unit_id
FROM journal_line WHERE entry_id % 89 <> 0""",
    "party_source": """
SELECT 'customer' AS kind, concat('P', CAST(c_custkey % 500 AS STRING)) AS name,
       concat('C', CAST(c_custkey AS STRING)) AS external_id FROM customer
UNION ALL
SELECT 'vendor', concat(' p', CAST(s_suppkey * 7 AS STRING)), concat('V', CAST(s_suppkey AS STRING)) FROM supplier""",
    "attachment": """
SELECT doc_id AS id, concat('doc', CAST(doc_id AS STRING), '.pdf') AS filename,
       CASE doc_id % 3 WHEN 0 THEN 'job' WHEN 1 THEN 'invoice' ELSE 'party' END AS entity_type,
       doc_id % 100 AS entity_id, CAST(DATE '2024-01-01' AS DATE) + CAST(doc_id % 30 AS INT) AS uploaded_at
FROM documents""",
    "invoice_line_site": """
SELECT i.l_orderkey AS invoice_id, CAST(i.l_quantity AS DECIMAL(9,0)) AS qty,
       CAST(p.p_retailprice AS DECIMAL(12,2)) AS unit_price,
       CAST(CAST(i.l_quantity AS DECIMAL(9,0)) * CAST(p.p_retailprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS amount,
       s.s_nationkey AS site_id
FROM lineitem i JOIN part p ON i.l_partkey = p.p_partkey JOIN supplier s ON i.l_suppkey = s.s_suppkey""",
    "outbox": """
SELECT a.message_id, CASE WHEN a.status = 'failed' THEN 'pending' ELSE a.status END AS status,
       a.attempted_at + INTERVAL '1' MINUTE AS next_attempt_at
FROM outbox_attempt a
JOIN (SELECT message_id, max(attempt) AS attempt FROM outbox_attempt GROUP BY message_id) l
  ON a.message_id = l.message_id AND a.attempt = l.attempt""",
    "changed_entry": """
SELECT e.entry_id, e.entry_date, e.source_id,
       CASE WHEN e.adjusting_reason = ' ' THEN 'n/a' ELSE e.adjusting_reason END AS adjusting_reason
FROM journal_entry e JOIN (SELECT DISTINCT entry_id FROM journal_line) l ON e.entry_id = l.entry_id""",
    "correction": """
SELECT concat('COR-', CAST(entry_id AS STRING)) AS entry_id, entry_id AS corrects_entry_id
FROM journal_line GROUP BY entry_id HAVING SUM(debit) <> SUM(credit)""",
    "corrected_line": """
SELECT concat('COR-', CAST(r.entry_id AS STRING)) AS entry_id, r.account_id,
       CAST(0 AS DECIMAL(18,4)) AS debit, r.amount AS credit
FROM revenue_line r JOIN correction c ON r.entry_id = c.corrects_entry_id
UNION ALL
SELECT concat('COR-', CAST(r.entry_id AS STRING)), 1100, CAST(SUM(r.amount) AS DECIMAL(18,4)), CAST(0 AS DECIMAL(18,4))
FROM revenue_line r JOIN correction c ON r.entry_id = c.corrects_entry_id GROUP BY r.entry_id""",
    "booking": """
SELECT 'order' AS source_type, entry_id AS source_id FROM journal_line WHERE account_id = 1100
UNION ALL
SELECT source_type, source_id FROM journal_entry WHERE is_adjusting""",
    "fiscal_period": """
SELECT 'MAIN' AS calendar, year(start_date) AS fiscal_year, month(start_date) AS period_no, false AS is_closing
FROM accounting_period
UNION ALL
SELECT DISTINCT 'SHIP', year(l_shipdate), month(l_shipdate), false FROM lineitem WHERE l_linestatus = 'F'
UNION ALL
SELECT DISTINCT 'SHIP', year(l_shipdate), 13, true FROM lineitem""",
    "fiscal_journal": """
SELECT 'MAIN' AS calendar, year(entry_date) AS fiscal_year, month(entry_date) AS period_no FROM journal_entry
UNION ALL
SELECT 'SHIP', year(l_shipdate), CASE WHEN l_linenumber = 7 THEN 0 ELSE month(l_shipdate) END FROM lineitem""",
    "customer_load": """
SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, 2 AS revision FROM customer WHERE c_acctbal >= 0
UNION ALL
SELECT s_suppkey + 1000000000, s_name, s_nationkey, 1 FROM supplier
UNION ALL
SELECT s_suppkey + 1000000000, s_name, s_nationkey, 1 FROM supplier""",
    "customer_stored": """
SELECT c_custkey, c_name, c_nationkey, 1 AS revision FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "trade_edge": """
SELECT DISTINCT concat('segment ', c.c_mktsegment) AS src, concat('nation ', n.n_name) AS dst
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
UNION
SELECT DISTINCT concat('nation ', n.n_name), concat('region ', r.r_name)
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
UNION
SELECT DISTINCT concat('type ', p.p_type), concat('nation ', n.n_name)
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "alert_rule": """
SELECT * FROM (VALUES ('HoldPlaced', 'InProcess', 'quality hold'), ('HoldPlaced', 'QAComplete', 'quality hold'),
  ('OverrideTransition', CAST(NULL AS STRING), 'override'), ('InvoiceIssued', NULL, 'invoice issued'))
AS t(event_type, from_state, alert)""",
    "versioned_event": """
SELECT event_id, ts, workflow_name, instance_id, seq, event_type, idempotency_key, seq - 1 AS expected_version,
       actor_id, actor_role, target_state, override_reason
FROM workflow_event""",
    "redelivered_event": """
SELECT event_id, ts, workflow_name, instance_id, seq, event_type, idempotency_key, expected_version, actor_id, actor_role,
       CASE WHEN event_type = 'OverrideTransition' AND event_id % 3 = 0 THEN 'Nowhere' ELSE target_state END AS target_state,
       override_reason
FROM (SELECT * FROM workflow_event UNION ALL SELECT * FROM workflow_event WHERE event_id % 10 < 1
  UNION ALL SELECT * FROM workflow_event WHERE event_id % 10 < 2) e""",
    "unnumbered_event": """
SELECT event_id, ts, workflow_name, instance_id, seq, event_type, idempotency_key, expected_version, actor_id, actor_role, target_state,
       override_reason
FROM workflow_event
UNION ALL
SELECT event_id + 1000000000, ts, workflow_name, instance_id, CASE WHEN event_id % 2 = 0 THEN 0 END, event_type, idempotency_key,
       expected_version, actor_id, actor_role, target_state, override_reason
FROM workflow_event WHERE event_id % 7 = 0""",
    "supply": """
SELECT l_partkey AS part_id, l_suppkey AS supplier_id, count(*) AS lines FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "deep_account": """
SELECT CAST(l_partkey % 150 AS INT) AS account_id, CAST(nullif(l_partkey % 150, 0) - 1 AS INT) AS parent_account_id,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS net
FROM lineitem GROUP BY l_partkey % 150""",
    "bigint_site": """
SELECT CAST(site_id AS BIGINT) AS site_id, name FROM site""",
    "role_assignment": """
SELECT DISTINCT actor_id, actor_role AS role FROM workflow_event WHERE actor_id % 5 <> 0""",
    "role_unit": """
SELECT DISTINCT actor_role AS role, CASE WHEN actor_role LIKE '%a%' THEN 1 END AS business_unit_id FROM workflow_event""",
    "undated_line": """
SELECT entry_id, account_id, debit, credit,
       CASE WHEN entry_id % 5 > 0 THEN CAST(entry_id % 5 AS INT) END AS period_id FROM journal_line""",
}


def _named_in(text: str, names) -> list[str]:
    words = set(re.findall(r"\w+", text))
    return [name for name in names if name in words]


def views_behind(text: str) -> list[str]:
    """Derived views a statement needs, each after the ones it reads."""
    ordered: list[str] = []

    def visit(body: str) -> None:
        for name in _named_in(body, VIEWS):
            if name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(text)
    return ordered


# In a running system these are tables, not views: they are written once per session and
# read back, so that queries see files, statistics and filters that reach the scan.
STORED = (
    "accounting_period", "journal_entry", "revenue_line", "journal_line", "legacy_line", "workflow_event", "trade_edge",
)
_PATHS: dict[tuple[str, str, str], str] = {}


class Tables:
    """Driver tables and derived views as DataFrames, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in STORED:
                self._made[name] = self.stored(name, lambda: self.sql(VIEWS[name]))
            elif name in VIEWS:
                self._made[name] = self.sql(VIEWS[name])
            else:
                self._made[name] = load_table(self.spark, self.sf_dir, name)
        return self._made[name]

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table written to the shared folder on first use."""
        place = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if place not in _PATHS:
            path = work_dir(self.spark, name)
            build().write.parquet(path)
            _PATHS[place] = path
        return self.spark.read.parquet(_PATHS[place])

    def sql(self, text: str) -> DataFrame:
        """Run a statement over these tables."""
        self.register(text)
        return self.spark.sql(text)

    def register(self, text: str) -> None:
        """Give the tables a statement names their names in the session."""
        for name in _named_in(text, [*BASE, *VIEWS]):
            self[name].createOrReplaceTempView(name)
