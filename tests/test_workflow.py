import datetime
import random

import pytest
from conftest import got
from pyspark.sql import functions as F

from ledgerloom.operators import outbox, projections, workflow
from ledgerloom.plans.fixtures import VIEWS
from ledgerloom.streaming.replay import decide

EVENTS = (
    "workflow_name string, instance_id long, seq int, event_id long, ts timestamp_ntz, event_type string, idempotency_key string, "
    "expected_version int, actor_id long, actor_role string, target_state string, override_reason string"
)
START = datetime.datetime(2024, 1, 1)


def event(instance, seq, kind, key=None, expected=None, target=None, reason=None, role="planner"):
    i = instance * 10_000 + seq
    return ("w", instance, seq, i, START + datetime.timedelta(minutes=seq), kind, key or f"k{i}", expected, 1, role, target, reason)


@pytest.fixture(scope="module")
def transitions(spark):
    return spark.sql(VIEWS["transition"])


def run(make, transitions, *events, **options):
    rows = workflow.replay(make(EVENTS, *events), transitions, **options).collect()
    return [(r.seq, r.outcome, r.to_state, r.version) for r in sorted(rows, key=lambda r: (r.instance_id, r.seq))]


PATH = [
    "ScopeDefined", "QuoteIssued", "CustomerPOAttached", "MaterialsAllocated", "Scheduled", "WorkStarted",
    "OperationCompleted", "QAApproved", "ShipmentCreated", "InvoiceIssued", "Closed",
]


def test_happy_path(make, transitions):
    rows = run(make, transitions, *[event(1, i + 1, kind) for i, kind in enumerate(PATH)])
    assert {row[1] for row in rows} == {"applied"}
    assert rows[-1] == (11, "applied", "Closed", 11)


def test_nothing_leaves_a_terminal_state(make, transitions):
    rows = run(make, transitions, event(1, 1, "Cancelled"), event(1, 2, "HoldPlaced"), event(1, 3, "OverrideTransition", target="Quoted", reason="r"))
    assert [row[1] for row in rows] == ["applied", "no_transition", "no_transition"]


def test_guard_looks_at_earlier_events_only(make, transitions):
    to_order = [event(1, i + 1, kind) for i, kind in enumerate(PATH[:3])]
    rows = run(make, transitions, *to_order, event(1, 4, "Scheduled"), event(1, 5, "MaterialsAllocated"), event(1, 6, "Scheduled"))
    assert [row[1] for row in rows[3:]] == ["guard_not_met", "applied", "applied"]


def test_override_needs_a_reason_and_a_target(make, transitions):
    rows = run(
        make, transitions, event(1, 1, "OverrideTransition", target="Scheduled", reason=" "),
        event(1, 2, "OverrideTransition", reason="because"), event(1, 3, "OverrideTransition", target="Scheduled", reason="because"),
    )
    assert [row[1:3] for row in rows] == [("reason_missing", "DraftScope"), ("no_target", "DraftScope"), ("applied", "Scheduled")]


def test_hold_returns_to_the_state_before(make, transitions):
    events = [
        event(1, 1, "ScopeDefined"), event(1, 2, "HoldPlaced"), event(1, 3, "HoldPlaced"), event(1, 4, "QuoteIssued"),
        event(1, 5, "HoldReleased"), event(1, 6, "HoldReleased"), event(1, 7, "HoldPlaced"),
    ]
    rows = run(make, transitions, *events)
    assert [row[2] for row in rows] == ["Estimating", "OnHold", "OnHold", "OnHold", "Estimating", "Estimating", "OnHold"]
    assert [row[1] for row in rows][5] == "no_transition"
    holds = workflow.hold_intervals(workflow.replay(make(EVENTS, *events), transitions))
    assert got(holds.select("held_seq", "held_from", "resumed_state", "released_by")) == [
        (2, "Estimating", "Estimating", "HoldReleased"), (7, "Estimating", None, None),
    ]


def test_repeated_key_is_checked_before_the_version(make, transitions):
    rows = run(
        make, transitions, event(1, 1, "ScopeDefined", key="a", expected=0), event(1, 2, "ScopeDefined", key="a", expected=0),
        event(1, 3, "QuoteIssued", key="b", expected=0), event(1, 4, "QuoteIssued", key="c", expected=1),
    )
    assert rows == [
        (1, "applied", "Estimating", 1), (2, "duplicate", "Estimating", 1), (3, "version_conflict", "Estimating", 1),
        (4, "applied", "Quoted", 2),
    ]


def test_conflicts_show_the_current_version(make, transitions):
    log = workflow.replay(make(EVENTS, event(1, 1, "ScopeDefined"), event(1, 2, "QuoteIssued", expected=0)), transitions)
    assert got(workflow.version_conflicts(log).select("expected_version", "current_version", "current_state")) == [(0, 1, "Estimating")]


def random_events(seed, versions):
    rng = random.Random(seed)
    events = []
    for instance in range(5):
        level, keys = 0, []
        for seq in range(1, rng.choice([3, 8, 26]) + 1):
            kind = rng.choice([*PATH, "HoldPlaced", "HoldReleased", "OverrideTransition", "EstimateUpdated", "Nonsense"])
            if rng.random() < 0.02:
                kind = "Cancelled"
            key = rng.choice(keys) if keys and rng.random() < 0.1 else f"{instance}-{seq}"
            keys.append(key)
            level = level + 1 if rng.random() < 0.5 else level
            events.append(event(
                instance, seq, kind, key, rng.choice([None, level]) if versions else None,
                rng.choice(["Scheduled", "OnHold", None]) if kind == "OverrideTransition" else None, rng.choice(["x", " ", None]),
            ))
    return events


def by_hand(events, rows):
    """The same rules, one event after the other."""
    moves = {(r.from_state, r.event_type): (r.to_state, r.guard_event) for r in rows}
    guards = {r.guard_event for r in rows if r.guard_event}
    states = set(workflow.known_states([(r.from_state, r.event_type, r.to_state, r.guard_event) for r in rows]))
    names = [field.split()[0] for field in EVENTS.split(", ")]
    current, seen, out = {}, {}, []
    for values in sorted(events, key=lambda e: (e[1], e[2])):
        e = dict(zip(names, values))
        state = current.get(e["instance_id"]) or {"state": "DraftScope", "version": 0, "held_from": None, "held_seq": None, "seen": []}
        once = (e["instance_id"], e["idempotency_key"])
        if once in seen:
            first = seen[once]
            result = (*first[:3], "duplicate", first[4])
        else:
            current[e["instance_id"]], result = decide(state, e, moves, guards, states)
            seen[once] = result
        out.append((e["instance_id"], e["seq"], *result))
    return sorted(out, key=repr)


@pytest.mark.parametrize("versions", [False, True])
@pytest.mark.parametrize("block", [6, 4096])
def test_replay_in_blocks_of_any_size(make, transitions, versions, block):
    events = random_events(block + versions, versions)
    shuffled = make(EVENTS, *random.Random(1).sample(events, len(events))).repartition(5)
    log = workflow.replay(shuffled, transitions, block_events=block)
    mine = got(log.select("instance_id", "seq", "from_state", "to_state", "version", "outcome", "held_seq"))
    assert mine == by_hand(events, transitions.collect())


def test_an_orderly_long_instance_settles_at_once(make, transitions):
    events = [event(1, i + 1, kind) for i, kind in enumerate(PATH[:6])]
    events += [event(1, seq, "OperationCompleted", expected=seq - 1) for seq in range(7, 200)]
    rows = run(make, transitions, *events, block_events=10)
    assert {row[1] for row in rows} == {"applied"} and rows[-1][3] == 199


def test_missing_keys_are_never_duplicates(make, transitions):
    bare = [tuple(None if i == 6 else v for i, v in enumerate(event(1, seq, "EstimateUpdated"))) for seq in (2, 3)]
    rows = run(make, transitions, event(1, 1, "ScopeDefined"), *bare)
    assert [row[1] for row in rows] == ["applied"] * 3


def test_dedupe_keeps_the_first_and_counts(make):
    events = make(EVENTS, event(1, 3, "b", key="x"), event(1, 1, "a", key="x"), event(2, 2, "c", key="x"))
    assert got(workflow.dedupe_idempotent(events).select("instance_id", "seq", "event_type", "deliveries")) == [(1, 1, "a", 2), (2, 2, "c", 1)]


def test_history_gaps_cross_blocks(make, transitions):
    log = workflow.replay(make(EVENTS, *[event(1, i + 1, kind) for i, kind in enumerate(PATH)]), transitions)
    for block in (1, 2, 5, 100):
        rows = got(workflow.transition_history(log, block=block).select("seq", "from_state", "gap_seconds"))
        assert sorted(rows)[0][2] is None and {row[2] for row in rows} == {None, 60.0} and len(rows) == len(PATH)


def test_guard_violations(make, transitions):
    log = make(EVENTS, event(1, 1, "Scheduled"), event(1, 2, "MaterialsAllocated"), event(1, 3, "Scheduled"), event(2, 1, "ShipmentCreated"))
    assert got(workflow.guard_violations(log, transitions).select("instance_id", "seq", "guard_event")) == [
        (1, 1, "MaterialsAllocated"), (2, 1, "QAApproved"),
    ]


def test_version_audit(make):
    log = make("workflow_name string, instance_id int, version int", ("w", 1, 1), ("w", 1, 2), ("w", 1, 2), ("w", 1, 4), ("w", 2, 2))
    assert got(workflow.version_audit(log)) == [("w", 1, 2, "repeated"), ("w", 1, 4, "gap"), ("w", 2, 2, "gap")]


RULES = "workflow_name string, event_type string, role string, current_state string, override_flag boolean"


def test_permissions(make, transitions):
    rules = make(RULES, ("w", "ScopeDefined", "planner", "DraftScope", False), (None, None, "boss", None, None))
    events = [
        event(1, 1, "ScopeDefined"), event(1, 2, "QuoteIssued"), event(2, 1, "OverrideTransition", target="Quoted", reason="r"),
        event(2, 2, "OverrideTransition", target="Quoted", reason="", role="boss"),
    ]
    log = workflow.replay(make(EVENTS, *events), transitions)
    assert got(workflow.permission_audit(log, rules).select("instance_id", "seq", "allowed")) == [
        (1, 1, True), (1, 2, False), (2, 1, False), (2, 2, True),
    ]
    assert got(workflow.override_audit(log, rules).select("seq", "reason_blank", "not_permitted")) == [(1, False, True), (2, True, False)]
    assert not any(row.allowed for row in workflow.permission_audit(log, rules.limit(0)).collect())


def test_summary_does_not_care_about_order_or_copies(make, transitions):
    log = workflow.applied(workflow.replay(make(EVENTS, *[event(1, i + 1, kind) for i, kind in enumerate(PATH)]), transitions))
    once = got(projections.instance_summary(log))
    assert once == got(projections.instance_summary(log.unionAll(log).orderBy(F.desc("seq"))))
    assert once[0][2] == "Closed" and once[0][6] == 11
    assert got(projections.state_counts(projections.instance_summary(log)).select("state", "instances")) == [("Closed", 1)]


def test_pages_follow_each_other(make):
    rm = make("id int, state string, at int", *[(i, "a" if i % 2 else "b", i // 4) for i in range(20)])
    first = projections.read_model_page(rm, {"state": "a"}, ["at", "id"], 4).collect()
    second = projections.read_model_page(rm, {"state": "a"}, ["at", "id"], 4, after=(first[-1]["at"], first[-1]["id"])).collect()
    assert [r.id for r in first + second] == [1, 3, 5, 7, 9, 11, 13, 15]


def test_a_page_goes_on_after_a_missing_value(make):
    rm = make("id int, at int", (1, None), (2, None), (3, 5), (4, 6))
    first = projections.read_model_page(rm, None, ["at", "id"], 1).collect()
    rest = projections.read_model_page(rm, None, ["at", "id"], 9, after=(first[-1]["at"], first[-1]["id"])).collect()
    assert [r.id for r in first + rest] == [1, 2, 3, 4]


def test_redelivered_events_count_once(make, transitions):
    events = [event(1, 1, "OverrideTransition", target="Scheduled", reason="r"), event(1, 2, "WorkStarted")]
    rows = workflow.replay(make(EVENTS, *events, *events, events[0]), transitions)
    assert got(rows.select("seq", "outcome", "version")) == [
        (1, "applied", 1), (1, "duplicate", 1), (1, "duplicate", 1), (2, "applied", 2), (2, "duplicate", 2),
    ]
    rules = make("workflow_name string, event_type string, role string, current_state string, override_flag boolean", (None,) * 5)
    assert workflow.override_audit(rows, rules).count() == 3
    assert len(got(workflow.transition_history(rows))) == 2


def test_only_states_of_the_definition_are_entered(make, transitions):
    for reason, outcome in (("why", "unknown_target"), (" \t\n", "reason_missing")):
        assert run(make, transitions, event(1, 1, "OverrideTransition", target="Nowhere", reason=reason)) == [
            (1, outcome, "DraftScope", 0)]


def test_roles_claimed_are_held(make, transitions):
    log = workflow.replay(make(EVENTS, event(1, 1, "ScopeDefined"), event(1, 2, "QuoteIssued", role="boss"), event(1, 3, "Closed", role="clerk")), transitions)
    held = make("actor_id long, role string", (1, "planner"), (1, "clerk"))
    units = make("role string, business_unit_id int", ("planner", 1), ("boss", 1), ("clerk", None))
    assert got(workflow.role_audit(log, held, units).select("seq", "issue")) == [(2, "role_not_held"), (3, "role_without_unit")]


def test_attachments(make):
    docs = make("id int, filename string, entity_type string, entity_id int, uploaded_at int", (1, "a", "job", 7, 5), (2, "b", "job", 7, 5), (3, "c", "x", 8, 1))
    assert got(projections.attachments(make("entity_id int", (7,), (8,)), docs, "job").select("entity_id", "documents", "latest_id")) == [
        (7, 2, 2), (8, 0, None),
    ]


def test_outbox(make):
    at = lambda minute: START + datetime.timedelta(minutes=minute)
    box = make("message_id int, status string, next_attempt_at timestamp_ntz", (1, "pending", at(5)), (2, "pending", at(3)), (3, "sent", at(1)), (4, "pending", at(9)))
    due = outbox.due_messages(box, F.lit(at(5)).cast("timestamp_ntz"), 5)
    assert [r.message_id for r in due.collect()] == [2, 1]
    attempts = make(
        "message_id int, attempt int, attempted_at timestamp_ntz, status string", (1, 1, at(0), "failed"), (1, 2, at(1), "failed"),
        (2, 1, at(0), "failed"), (2, 2, at(1), "sent"), (3, 3, at(0), "failed"),
    )
    assert got(outbox.retry_schedule(attempts, base=60, factor=3, max_attempts=3)) == [(1, 2, at(4))]
    assert got(outbox.dead_letters(attempts, max_attempts=3).select("message_id", "attempts")) == [(3, 3)]
    assert got(outbox.latest_delivery(attempts).select("message_id", "status")) == [(1, "failed"), (2, "sent"), (3, "failed")]
