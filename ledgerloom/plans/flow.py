"""Queries over workflow events, read models, the outbox and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import closing, ledger, outbox, projections, workflow
from ledgerloom.plans.registry import register
from ledgerloom.session import work_dir
from ledgerloom.sources import sinks
from ledgerloom.sources.streams import read_event_stream
from ledgerloom.streaming import projection
from ledgerloom.streaming.replay import stream_replay

# -- replay ----------------------------------------------------------------------------------------

_CARRIED = "event_id, ts, event_type, actor_id, actor_role, target_state, override_reason, expected_version, idempotency_key"


def _replay_sql(source: str = "workflow_event") -> str:
    """Common table expressions that end in replay_log."""
    return f"""first_event AS (
      SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY seq) AS rn FROM (
        SELECT *, row_number() OVER (PARTITION BY instance_id, idempotency_key ORDER BY seq, event_id) AS copy FROM {source})
      WHERE copy = 1),
    walk (instance_id, rn, from_state, state, version, outcome, held_from, held_seq, held_before, materials, quality, shipped) AS (
      SELECT DISTINCT instance_id, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), 'DraftScope', 0, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
        CAST(NULL AS INT), CAST(NULL AS INT), false, false, false FROM first_event
      UNION ALL
      SELECT instance_id, rn, state, CASE WHEN ok THEN target ELSE state END, version + CASE WHEN ok THEN 1 ELSE 0 END, outcome,
        CASE WHEN NOT ok THEN held_from WHEN target <> 'OnHold' THEN NULL WHEN state <> 'OnHold' THEN state ELSE held_from END,
        CASE WHEN NOT ok THEN held_seq WHEN target <> 'OnHold' THEN NULL WHEN state <> 'OnHold' THEN seq ELSE held_seq END,
        held_seq, materials OR (ok AND event_type = 'MaterialsAllocated'), quality OR (ok AND event_type = 'QAApproved'),
        shipped OR (ok AND event_type = 'ShipmentCreated')
      FROM (SELECT *, outcome = 'applied' AS ok FROM (SELECT *, CASE
          WHEN expected_version <> version THEN 'version_conflict'
          WHEN to_state IS NULL THEN 'no_transition'
          WHEN to_state = '<target_state>' AND trim(coalesce(override_reason, '')) = '' THEN 'reason_missing'
          WHEN target IS NULL THEN 'no_target'
          WHEN to_state = '<target_state>' AND target NOT IN (
            SELECT from_state FROM transition WHERE from_state <> '*' UNION
            SELECT to_state FROM transition WHERE to_state NOT LIKE '<%') THEN 'unknown_target'
          WHEN (guard = 'MaterialsAllocated' AND NOT materials) OR (guard = 'QAApproved' AND NOT quality)
            OR (guard = 'ShipmentCreated' AND NOT shipped) THEN 'guard_not_met'
          ELSE 'applied' END AS outcome
        FROM (SELECT w.*  EXCLUDE (rn, outcome, from_state), e.rn, e.seq, e.event_type, e.expected_version, e.override_reason,
            coalesce(x.to_state, y.to_state) AS to_state, CASE WHEN x.to_state IS NOT NULL THEN x.guard_event ELSE y.guard_event END AS guard,
            CASE coalesce(x.to_state, y.to_state) WHEN '<state before hold>' THEN w.held_from WHEN '<target_state>' THEN e.target_state
              ELSE coalesce(x.to_state, y.to_state) END AS target
          FROM walk w JOIN first_event e ON e.instance_id = w.instance_id AND e.rn = w.rn + 1
          LEFT JOIN transition x ON x.from_state = w.state AND x.event_type = e.event_type
          LEFT JOIN transition y ON y.from_state = '*' AND y.event_type = e.event_type AND w.state NOT IN ('Closed', 'Cancelled'))))),
    replay_log AS (
      SELECT e.workflow_name, e.instance_id, e.seq, w.from_state, w.state AS to_state, w.version,
        CASE WHEN e.event_id = f.event_id AND e.delivery = 1 THEN w.outcome ELSE 'duplicate' END AS outcome, w.held_before AS held_seq,
        {', '.join(f'e.{c.strip()}' for c in _CARRIED.split(','))}
      FROM (SELECT *, row_number() OVER (PARTITION BY instance_id, event_id) AS delivery FROM {source}) e JOIN first_event f ON f.instance_id = e.instance_id AND f.idempotency_key = e.idempotency_key
      JOIN walk w ON w.instance_id = f.instance_id AND w.rn = f.rn),
    transitions AS (SELECT * FROM replay_log WHERE outcome = 'applied')"""


_LOG = f"WITH {_replay_sql()}"


def _replayed(t) -> DataFrame:
    """The log as its readers find it: a stored table."""
    return t.stored("replay_log", lambda: workflow.replay(t["workflow_event"], t["transition"]))


def _transitions(t) -> DataFrame:
    return workflow.applied(_replayed(t))


register("w1_replay", f"{_LOG} SELECT * FROM replay_log")(lambda t: workflow.replay(t["workflow_event"], t["transition"]))
register("w1_replay_in_blocks", f"{_LOG} SELECT * FROM replay_log")(
    # Blocks of five events make every instance cross block borders.
    lambda t: workflow.replay(t["workflow_event"], t["transition"], block_events=5)
)
register("w1_replay_redelivered", f"WITH {_replay_sql('redelivered_event')} SELECT * FROM replay_log")(
    lambda t: workflow.replay(t["redelivered_event"], t["transition"])
)
register("w1_redelivered_in_blocks", f"WITH {_replay_sql('redelivered_event')} SELECT * FROM replay_log")(
    lambda t: workflow.replay(t["redelivered_event"], t["transition"], block_events=5)
)
register("w1_versioned_in_blocks", f"WITH {_replay_sql('versioned_event')} SELECT * FROM replay_log")(
    # Nearly every block meets versions that depend on the blocks before.
    lambda t: workflow.replay(t["versioned_event"], t["transition"], block_events=5)
)
_UNNUMBERED = f"""{_LOG} SELECT * FROM replay_log
    UNION ALL SELECT workflow_name, instance_id, seq, NULL, NULL, NULL, 'no_seq', NULL, {_CARRIED}
    FROM unnumbered_event WHERE seq IS NULL OR seq < 1"""
register("w1_replay_unnumbered", _UNNUMBERED)(lambda t: workflow.replay(t["unnumbered_event"], t["transition"]))
register("w1_unnumbered_in_blocks", _UNNUMBERED)(
    lambda t: workflow.replay(t["unnumbered_event"], t["transition"], block_events=5)
)
register("w2_transition_history", f"""{_LOG} SELECT workflow_name, instance_id, version AS seq, from_state, to_state, event_type, actor_id, ts,
    CAST(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY instance_id ORDER BY version) AS DOUBLE) / 1000000 AS gap_seconds
    FROM transitions""")(lambda t: workflow.transition_history(_transitions(t)))
register("w3_guard_violations", """SELECT e.workflow_name, e.instance_id, e.seq, e.event_id, e.event_type, g.guard_event
    FROM workflow_event e JOIN (SELECT DISTINCT event_type, guard_event FROM transition WHERE guard_event IS NOT NULL) g
      ON g.event_type = e.event_type
    WHERE NOT EXISTS (SELECT 1 FROM workflow_event m WHERE m.instance_id = e.instance_id AND m.event_type = g.guard_event AND m.seq < e.seq)""")(
    lambda t: workflow.guard_violations(t["workflow_event"], t["transition"])
)
register("w4_dedupe_idempotent", """SELECT workflow_name, instance_id, idempotency_key, min(seq) AS seq, min(event_id) AS event_id,
    count(*) AS deliveries FROM workflow_event GROUP BY workflow_name, instance_id, idempotency_key""")(
    lambda t: workflow.dedupe_idempotent(t["workflow_event"]).select(
        "workflow_name", "instance_id", "idempotency_key", "seq", "event_id", "deliveries"
    )
)
register("w5_version_conflicts", f"""WITH {_replay_sql('versioned_event')}
    SELECT workflow_name, instance_id, seq, event_id, event_type, expected_version, version AS current_version, to_state AS current_state
    FROM replay_log WHERE outcome = 'version_conflict'""")(
    lambda t: workflow.version_conflicts(workflow.replay(t["versioned_event"], t["transition"]))
)
register("w5_version_audit", """WITH log AS (SELECT DISTINCT instance_id, seq, count(*) OVER (PARTITION BY instance_id, seq) AS n
      FROM workflow_event WHERE event_type <> 'Cancelled')
    SELECT 'mr_job_shop' AS workflow_name, instance_id, seq AS version, 'gap' AS issue FROM log l
    WHERE seq > 1 AND NOT EXISTS (SELECT 1 FROM log b WHERE b.instance_id = l.instance_id AND b.seq = l.seq - 1)""")(
    # The log with cancellations taken out has holes.
    lambda t: workflow.version_audit(
        t["workflow_event"].filter("event_type <> 'Cancelled'").withColumnRenamed("seq", "version")
    )
)
_ALLOWED = """EXISTS (SELECT 1 FROM permission_rule r WHERE (r.workflow_name IS NULL OR r.workflow_name = l.workflow_name)
      AND (r.event_type IS NULL OR r.event_type = l.event_type) AND (r.role IS NULL OR r.role = l.actor_role)
      AND (r.current_state IS NULL OR r.current_state = l.from_state)
      AND (r.override_flag IS NULL OR r.override_flag = (l.event_type = 'OverrideTransition')))"""
register("w6_override_audit", f"""{_LOG} SELECT workflow_name, instance_id, seq, event_id, actor_id, actor_role, target_state, override_reason,
    trim(coalesce(override_reason, '')) = '' AS reason_blank, NOT {_ALLOWED} AS not_permitted, outcome
    FROM replay_log l WHERE event_type = 'OverrideTransition'""")(
    lambda t: workflow.override_audit(_replayed(t), t["permission_rule"])
)
register("w7_permission_audit", f"""{_LOG} SELECT workflow_name, instance_id, seq, event_id, event_type, actor_role AS role,
    from_state AS current_state, event_type = 'OverrideTransition' AS override_flag, {_ALLOWED} AS allowed FROM replay_log l""")(
    lambda t: workflow.permission_audit(_replayed(t), t["permission_rule"])
)
register("w6_override_redelivered", f"""WITH {_replay_sql('redelivered_event')}
    SELECT workflow_name, instance_id, seq, event_id, actor_id, actor_role, target_state, override_reason,
    trim(coalesce(override_reason, '')) = '' AS reason_blank, NOT {_ALLOWED} AS not_permitted, outcome
    FROM replay_log l WHERE event_type = 'OverrideTransition'""")(
    lambda t: workflow.override_audit(workflow.replay(t["redelivered_event"], t["transition"]), t["permission_rule"])
)
register("w7_role_audit", """SELECT workflow_name, instance_id, seq, event_id, actor_id, actor_role,
    CASE WHEN NOT EXISTS (SELECT 1 FROM role_assignment a WHERE a.actor_id = e.actor_id AND a.role = e.actor_role) THEN 'role_not_held'
      ELSE 'role_without_unit' END AS issue
    FROM workflow_event e WHERE NOT EXISTS (SELECT 1 FROM role_assignment a WHERE a.actor_id = e.actor_id AND a.role = e.actor_role)
      OR NOT EXISTS (SELECT 1 FROM role_unit u WHERE u.role = e.actor_role AND u.business_unit_id IS NOT NULL)""")(
    lambda t: workflow.role_audit(t["workflow_event"], t["role_assignment"], t["role_unit"])
)
register("w8_hold_intervals", f"""{_LOG}, began AS (SELECT * FROM transitions WHERE from_state <> 'OnHold' AND to_state = 'OnHold'),
    ended AS (SELECT * FROM transitions WHERE from_state = 'OnHold' AND to_state <> 'OnHold')
    SELECT b.workflow_name, b.instance_id, b.seq AS held_seq, b.ts AS held_at, b.from_state AS held_from, e.ts AS released_at,
      e.to_state AS resumed_state, e.event_type AS released_by
    FROM began b LEFT JOIN ended e ON e.instance_id = b.instance_id AND e.version = (
      SELECT min(x.version) FROM ended x WHERE x.instance_id = b.instance_id AND x.version > b.version)""")(
    lambda t: workflow.hold_intervals(_transitions(t))
)

# -- read models -----------------------------------------------------------------------------------

_SUMMARY = f"""{_LOG}, summary AS (SELECT workflow_name, instance_id, to_state AS current_state, ts AS updated_at,
      event_type AS last_event_type, actor_id AS last_actor, version
    FROM transitions t WHERE version = (SELECT max(version) FROM transitions x WHERE x.instance_id = t.instance_id))"""


def _summary(t) -> DataFrame:
    return projections.instance_summary(_transitions(t))


register("pr1_instance_summary", f"{_SUMMARY} SELECT * FROM summary")(_summary)
register("pr3_state_counts", f"""{_SUMMARY} SELECT workflow_name, current_state AS state, count(*) AS instances, max(updated_at) AS newest
    FROM summary GROUP BY workflow_name, current_state""")(lambda t: projections.state_counts(_summary(t)))
register("pr4_attachments", """WITH docs AS (SELECT entity_id, count(*) AS n, max(uploaded_at) AS latest FROM attachment
      WHERE entity_type = 'invoice' GROUP BY entity_id),
    last_doc AS (SELECT entity_id, uploaded_at, max(id) AS id FROM attachment WHERE entity_type = 'invoice' GROUP BY entity_id, uploaded_at)
    SELECT 'invoice' AS entity_type, i.invoice_id AS entity_id, coalesce(n, 0) AS documents, l.id AS latest_id,
      CASE WHEN l.id IS NOT NULL THEN concat('doc', l.id, '.pdf') END AS latest_filename, d.latest AS latest_uploaded_at
    FROM invoice i LEFT JOIN docs d ON d.entity_id = i.invoice_id
    LEFT JOIN last_doc l ON l.entity_id = d.entity_id AND l.uploaded_at = d.latest""")(
    lambda t: projections.attachments(t["invoice"].selectExpr("invoice_id AS entity_id"), t["attachment"], "invoice")
)
register("f3_read_model_page", f"""{_SUMMARY} SELECT * FROM summary WHERE current_state = 'OnHold'
    AND (updated_at > TIMESTAMP '2024-01-08 00:00:00' OR (updated_at = TIMESTAMP '2024-01-08 00:00:00' AND instance_id > 5000))
    ORDER BY updated_at, instance_id LIMIT 20""")(
    lambda t: projections.read_model_page(
        _summary(t), {"current_state": "OnHold"}, ["updated_at", "instance_id"], 20,
        after=(F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"), F.lit(5000)),
    )
)

# -- outbox -------------------------------------------------------------------------------------------

register("o1_due_messages", """SELECT * FROM outbox WHERE status = 'pending' AND next_attempt_at <= TIMESTAMP '2024-01-20 00:00:00'
    ORDER BY next_attempt_at, message_id LIMIT 100""")(
    lambda t: outbox.due_messages(t["outbox"], F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), 100)
)
_LATEST = """SELECT message_id, attempt, status, attempted_at FROM outbox_attempt a
    WHERE attempt = (SELECT max(attempt) FROM outbox_attempt b WHERE b.message_id = a.message_id)"""
register("o2_latest_delivery", _LATEST)(lambda t: outbox.latest_delivery(t["outbox_attempt"]))
register("o3_retry_schedule", f"""SELECT message_id, attempt,
    attempted_at + to_seconds(CAST(60 * power(2, attempt - 1) AS BIGINT)) AS next_attempt_at
    FROM ({_LATEST}) WHERE status = 'failed' AND attempt < 5""")(
    lambda t: outbox.retry_schedule(t["outbox_attempt"], 60, 2, 5)
)
register("o3_dead_letters", f"""SELECT message_id, attempt AS attempts, attempted_at AS failed_at FROM ({_LATEST})
    WHERE status = 'failed' AND attempt >= 4""")(lambda t: outbox.dead_letters(t["outbox_attempt"], 4))

# -- streams ------------------------------------------------------------------------------------------


def _as_files(t, df: DataFrame, name: str, files: int = 4) -> str:
    """Write rows as event files, split by event id."""
    path = work_dir(t.spark, name)
    df.repartitionByRange(files, "event_id").write.parquet(path)
    return path


def _sink(t, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over the files there are and read what it wrote."""
    path = work_dir(t.spark, name)
    run = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", work_dir(t.spark, f"{name}-state"))
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return t.spark.read.parquet(path)


def _plain_time(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return df


@register("s4_read_event_stream", """SELECT event_type, count(*) AS n FROM workflow_event GROUP BY event_type""")
def _event_stream(t):
    events = t["workflow_event"]
    stream = read_event_stream(t.spark, _as_files(t, events, "events"), events.schema, max_files=2)
    return _sink(t, stream.select("event_id", "event_type"), "streamed").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("s5_upsert_read_model", f"{_SUMMARY} SELECT * FROM summary")
def _upserted(t):
    path, log = work_dir(t.spark, "read-model"), _transitions(t)
    for batch_id, part in [(1, log.filter("seq > 5")), (0, log.filter("seq <= 5")), (1, log.filter("seq > 5"))]:
        sinks.upsert_read_model(
            projections.instance_summary(part), batch_id, path, projections.SUMMARY_KEYS, "version"
        )
    return sinks.read_model(t.spark, path, projections.SUMMARY_KEYS, "version")


@register("s5_read_model_compacted", f"{_SUMMARY} SELECT * FROM summary")
def _compacted(t):
    path, log = work_dir(t.spark, "read-model"), _transitions(t)
    for batch_id in range(4):
        part = projections.instance_summary(log.filter(F.col("seq") % 4 == (batch_id + 2) % 4))
        sinks.upsert_read_model(part, batch_id, path, projections.SUMMARY_KEYS, "version")
        if batch_id % 2:
            sinks.compact_read_model(t.spark, path, projections.SUMMARY_KEYS, "version")
            # A batch that comes again after it has been folded changes nothing.
            sinks.upsert_read_model(part.limit(0), batch_id, path, projections.SUMMARY_KEYS, "version")
    return sinks.read_model(t.spark, path, projections.SUMMARY_KEYS, "version")


@register("s6_append_undated", "SELECT period_id, count(*) AS lines, CAST(sum(debit) AS DECIMAL(38,4)) AS debit FROM undated_line GROUP BY period_id")
def _appended_undated(t):
    path = work_dir(t.spark, "ledger")
    rows = t["undated_line"]
    # The second time some entries come back under another period; what is stored stays.
    moved = rows.withColumn("period_id", F.when(F.col("entry_id") % 3 == 0, F.lit(9)).otherwise(F.col("period_id")))
    for batch in (rows, moved, rows):
        sinks.append_ledger(batch, path)
    return t.spark.read.parquet(path).groupBy("period_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("debit").cast("decimal(38,4)").alias("debit")
    )


@register("s6_append_ledger", """SELECT p.period_id, count(*) AS lines, CAST(sum(debit) AS DECIMAL(38,4)) AS debit
    FROM journal_line l JOIN journal_entry e ON e.entry_id = l.entry_id AND e.status = 'posted'
    JOIN accounting_period p ON e.entry_date BETWEEN p.start_date AND p.end_date GROUP BY p.period_id""")
def _appended(t):
    path = work_dir(t.spark, "ledger")
    posted = ledger.posted_lines(t["journal_entry"], t["journal_line"], None, "entry_date")
    rows = ledger.assign_period(posted, t["accounting_period"]).drop("match_count")
    for batch in (rows.filter("entry_date < date'1998-01-01'"), rows, rows):
        sinks.append_ledger(batch, path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy("period_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("debit").cast("decimal(38,4)").alias("debit")
    )


@register("s7_export_table", """SELECT p.period_id, l.account_id,
    CAST(sum(debit) AS DECIMAL(38,4)) AS debit, CAST(sum(credit) AS DECIMAL(38,4)) AS credit
    FROM journal_line l JOIN journal_entry e ON e.entry_id = l.entry_id AND e.status = 'posted'
    JOIN accounting_period p ON e.entry_date BETWEEN p.start_date AND p.end_date
    GROUP BY p.period_id, l.account_id""")
def _exported(t):
    path = work_dir(t.spark, "export")
    figures = closing.roll_forward(t["journal_entry"], t["journal_line"], t["accounting_period"], t["account"])
    moved = figures.filter("debit <> 0 or credit <> 0").select("period_id", "account_id", "debit", "credit")
    sinks.export_table(moved, path, ["period_id"])
    return t.spark.read.parquet(path)


@register("s7_rollup_by_increments", """SELECT p.period_id, l.account_id, CAST(sum(debit) AS DECIMAL(38,4)) AS debit,
    CAST(sum(credit) AS DECIMAL(38,4)) AS credit
    FROM journal_line l JOIN journal_entry e ON e.entry_id = l.entry_id AND e.status = 'posted'
    JOIN accounting_period p ON e.entry_date BETWEEN p.start_date AND p.end_date GROUP BY p.period_id, l.account_id""")
def _rolled_up(t):
    path, kept, figures = work_dir(t.spark, "rollup"), ["period_id", "account_id"], ["debit", "credit"]
    posted = ledger.posted_lines(t["journal_entry"], t["journal_line"], None, "entry_date")
    dated = ledger.assign_period(posted, t["accounting_period"]).filter("period_id is not null")
    # A load looks at its lines several times: they meet their entries once.
    dated.select("entry_id", *kept, *figures).write.parquet(f"{path}-lines")
    rows = t.spark.read.parquet(f"{path}-lines")
    # The second load brings lines of periods already in, and the first load again.
    for load in (rows.filter("entry_id % 3 = 0"), rows.filter("entry_id % 3 < 2"), rows):
        sinks.fold_rollup(load, path, kept, figures)
        sinks.compact_rollup(t.spark, path, kept, figures)
    return sinks.rollup(t.spark, path, kept, figures).select(*kept, *[F.col(m).cast("decimal(38,4)").alias(m) for m in figures])


@register("pr2_stream_instance_summary", f"{_SUMMARY} SELECT * FROM summary")
def _streamed_summary(t):
    log, path = _transitions(t), work_dir(t.spark, "summary")
    stream = read_event_stream(t.spark, _as_files(t, log, "log"), log.schema, max_files=1)
    projection.stream_instance_summary(stream, path, work_dir(t.spark, "summary-state")).awaitTermination()
    return _plain_time(sinks.read_model(t.spark, path, projections.SUMMARY_KEYS, "version"), "updated_at")


@register("pr5_rebuild", f"{_SUMMARY} SELECT * FROM summary")
def _rebuilt(t):
    return projections.rebuild(t.spark.read.parquet(_as_files(t, _transitions(t), "log")))


def _replayed_stream(t, events):
    stream = read_event_stream(t.spark, _as_files(t, events, "events"), events.schema, max_files=2)
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(setting)
    t.spark.conf.set(setting, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return _plain_time(_sink(t, stream_replay(stream, t["transition"]), "replayed"), "ts")
    finally:
        t.spark.conf.set(setting, before)


register("w9_stream_replay", f"{_LOG} SELECT * FROM replay_log")(lambda t: _replayed_stream(t, t["workflow_event"]))
register("w9_stream_redelivered", f"WITH {_replay_sql('redelivered_event')} SELECT * FROM replay_log")(
    lambda t: _replayed_stream(t, t["redelivered_event"])
)

register("w9_stream_unnumbered", _UNNUMBERED)(lambda t: _replayed_stream(t, t["unnumbered_event"]))


@register("o4_stream_dedupe", "SELECT DISTINCT workflow_name, instance_id, idempotency_key FROM workflow_event")
def _deduped(t):
    events = t["workflow_event"]
    stream = read_event_stream(t.spark, _as_files(t, events, "events"), events.schema, max_files=2)
    kept = projection.stream_dedupe(stream, "60 days").select("workflow_name", "instance_id", "idempotency_key")
    return _sink(t, kept, "deduped")


_ALERTS = f"""{_LOG} SELECT workflow_name, instance_id, seq, event_id, ts, alert, t.from_state, to_state, actor_id FROM transitions t
    JOIN alert_rule r ON r.event_type = t.event_type AND (r.from_state IS NULL OR r.from_state = t.from_state)"""
register("o5_alerts", _ALERTS)(lambda t: projection.alert_stream(_transitions(t), t["alert_rule"]))


@register("o5_alert_stream", _ALERTS)
def _streamed_alerts(t):
    log = _transitions(t)
    stream = read_event_stream(t.spark, _as_files(t, log, "log"), log.schema, max_files=2)
    return _plain_time(_sink(t, projection.alert_stream(stream, t["alert_rule"]), "alerts"), "ts")
