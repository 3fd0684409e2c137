"""Replay of workflow event logs and audits of the result.

Events carry workflow_name, instance_id, seq (1, 2, ... within an instance), event_id, ts,
event_type, idempotency_key, expected_version, actor_id, actor_role, target_state and
override_reason. Transitions are rows (from_state, event_type, to_state, guard_event).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import is_blank
from ledgerloom.functions.skew import join_hot
from ledgerloom.operators import composition

# Markers of the transition table and states no event leaves.
ANY_STATE = "*"
BEFORE_HOLD = "<state before hold>"
GIVEN_TARGET = "<target_state>"
INITIAL = "DraftScope"
HELD = "OnHold"
TERMINAL = ("Closed", "Cancelled")
OVERRIDE = "OverrideTransition"

INSTANCE = ["workflow_name", "instance_id"]
BLOCK_EVENTS = 256
MAX_TRANSITIONS = 10_000

_PASSED = ["event_id", "ts", "event_type", "actor_id", "actor_role", "target_state", "override_reason", "expected_version"]


def _once_key() -> Column:
    """The idempotency key; an event without one is only itself."""
    return F.coalesce(
        F.concat(F.lit("k"), F.col("idempotency_key")), F.concat(F.lit("e"), F.col("event_id").cast("string"))
    )


def dedupe_idempotent(events: DataFrame) -> DataFrame:
    """The first event of each idempotency key of an instance, and how often the key came.

    An aggregation rather than a window, so a key repeated very often is reduced to one
    row by each task before it is shuffled.
    """
    rest = [c for c in events.columns if c not in (*INSTANCE, "seq", "event_id")]
    # Equal numbers are settled by the other values, so any order of arrival gives one result.
    row = F.struct("seq", "event_id", *rest)
    return (
        events.groupBy(*INSTANCE, _once_key().alias("once"))
        .agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("deliveries"))
        .select(*INSTANCE, "first.*", "deliveries")
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Use a computed value several times inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def definition(transitions: DataFrame) -> list[tuple]:
    """The rows of a transition table, refused when it is too long to be one."""
    rows = transitions.select("from_state", "event_type", "to_state", "guard_event").take(MAX_TRANSITIONS + 1)
    if len(rows) > MAX_TRANSITIONS:
        raise ValueError(f"a workflow definition has at most {MAX_TRANSITIONS} transitions")
    return [tuple(row) for row in rows]


def known_states(rows: list[tuple]) -> list[str]:
    """The states a definition names."""
    return sorted({state for row in rows for state in (row[0], row[2])} - {ANY_STATE, BEFORE_HOLD, GIVEN_TARGET})


class _Machine:
    """A definition as constants inside a query."""

    def __init__(self, rows: list[tuple]):
        if not rows:
            raise ValueError("a workflow definition needs transitions")
        per_event: dict[str, dict[str, Column]] = {}
        for from_state, event_type, to_state, guard_event in rows:
            per_event.setdefault(event_type, {})[from_state] = F.struct(
                F.lit(to_state).alias("to_state"), F.lit(guard_event).cast("string").alias("guard_event")
            )
        self._moves = F.create_map(*[
            part for event_type, moves in per_event.items()
            for part in (F.lit(event_type), F.create_map(*[x for state, move in moves.items() for x in (F.lit(state), move)]))
        ])
        self.states = known_states(rows)
        self.guards = sorted({row[3] for row in rows if row[3]})
        self.guarded = sorted({row[1] for row in rows if row[3]})

    def move(self, state: Column, event_type: Column) -> Column:
        """Where an event leads from a state, and the event it depends on."""
        moves = F.element_at(self._moves, event_type)
        anywhere = F.when(~state.isin(*TERMINAL), F.element_at(moves, F.lit(ANY_STATE)))
        return F.coalesce(F.element_at(moves, state), anywhere)


_STATE_TYPE = "state:string,version:int,held_from:string,held_seq:int"
_START_TYPE = f"struct<{_STATE_TYPE},seen:array<string>>"


def _step(machine: _Machine, now: Column, event: Column, keep: list[str]) -> Column:
    """State after one event. ``gained`` holds the guard events applied in the block so far."""

    def with_move(move: Column) -> Column:
        to, guard = move["to_state"], move["guard_event"]
        target = F.when(to == BEFORE_HOLD, now["held_from"]).when(to == GIVEN_TARGET, event["target_state"]).otherwise(to)
        met = F.array_contains(F.col("start")["seen"], guard) | F.array_contains(now["gained"], guard)
        outcome = (
            F.when(event["expected_version"] != now["version"], "version_conflict")
            .when(move.isNull(), "no_transition")
            .when((to == GIVEN_TARGET) & is_blank(event["override_reason"]), "reason_missing")
            .when(target.isNull(), "no_target")
            .when((to == GIVEN_TARGET) & ~target.isin(machine.states), "unknown_target")
            .when(guard.isNotNull() & ~met, "guard_not_met")
            .otherwise("applied")
        )
        return _let(F.struct(target.alias("target"), outcome.alias("outcome")), after)

    def after(result: Column) -> Column:
        applied = result["outcome"] == "applied"
        state = F.when(applied, result["target"]).otherwise(now["state"])
        entered = (now["state"] != HELD) & (state == HELD)
        remembered = applied & event["event_type"].isin(machine.guards)
        return F.struct(
            state.alias("state"), F.when(applied, now["version"] + 1).otherwise(now["version"]).alias("version"),
            F.when(entered, now["state"]).when(state == HELD, now["held_from"]).alias("held_from"),
            F.when(entered, event["seq"]).when(state == HELD, now["held_seq"]).alias("held_seq"),
            F.when(remembered, F.array_union(now["gained"], F.array(event["event_type"]))).otherwise(now["gained"]).alias("gained"),
            *([
                now["state"].alias("from_state"), result["outcome"].alias("outcome"), now["held_seq"].alias("held_before"),
                *[event[c].alias(c) for c in keep],
            ] if keep else []),
        )

    return _let(machine.move(now["state"], event["event_type"]), with_move)


def _first_state(blocks: DataFrame, begin: list[Column], keep: list[str]) -> Column:
    """State, version and hold at the start of a block in the form `_step` goes on from."""
    kinds = {field.name: field.dataType.simpleString() for field in blocks.schema["events"].dataType.elementType}
    kept = ",from_state:string,outcome:string,held_before:int," + ",".join(f"{c}:{kinds[c]}" for c in keep) if keep else ""
    nothing = [F.lit(None)] * (3 + len(keep)) if keep else []
    return F.struct(*begin, F.array(), *nothing).cast(f"struct<{_STATE_TYPE},gained:array<string>{kept}>")


def _log(machine: _Machine, blocks: DataFrame) -> Column:
    """State after each event of a block.

    The step works on the last state alone; the states before are only moved along.
    """
    keep = ["seq", *_PASSED, "idempotency_key"]
    first = _first_state(blocks, [F.col("start")[name] for name in ("state", "version", "held_from", "held_seq")], keep)
    zero = F.struct(F.slice(F.array(first), 1, 0).alias("done"), first.alias("last"))
    return F.aggregate(
        "events", zero,
        lambda acc, event: F.struct(
            F.concat(acc["done"], F.array(acc["last"])).alias("done"), _step(machine, acc["last"], event, keep).alias("last")
        ),
        lambda acc: F.slice(F.concat(acc["done"], F.array(acc["last"])), F.lit(2), F.size(acc["done"])),
    )


def replay(
    events: DataFrame, transitions: DataFrame, initial: str = INITIAL, block_events: int = BLOCK_EVENTS,
    duplicates: bool = True,
) -> DataFrame:
    """Outcome of every event, folding each instance's events in order of seq.

    An applied event raises the version by one; any other outcome changes nothing.
    Checked in this order: repeated key (``duplicate``, with the first event's states
    and version), ``version_conflict``, ``no_transition``, ``reason_missing`` (override),
    ``no_target``, ``unknown_target`` (a state the definition does not name),
    ``guard_not_met``, ``applied``. Of an event delivered several times one row is the
    original, and the others are duplicates.

    An event without a sequence number, or with one below 1, has no place in the order: it is ``no_seq``,
    without states and version, and changes nothing, its key included.

    Events are grouped by instance and block of ``block_events`` sequence numbers, so no
    group grows with the log. Blocks of instances that have several are described as functions, which
    compose to where each block begins (see `composition`); then every block is folded once.
    """
    events = events.withColumn("seq", F.col("seq").cast("int"))
    placed = F.coalesce(F.col("seq") >= 1, F.lit(False))
    unplaced, events = events.filter(~placed), events.filter(placed)
    event = F.struct("seq", *_PASSED, "idempotency_key")
    block = F.floor((F.col("seq") - 1) / block_events).cast("long")
    rows = definition(transitions)
    machine = _Machine(rows)
    blocks = dedupe_idempotent(events).groupBy(*INSTANCE, block.alias("block")).agg(F.sort_array(F.collect_list(event)).alias("events"))
    beginning = F.struct(F.lit(initial), F.lit(0), *[F.lit(None)] * 2, F.array()).cast(_START_TYPE)
    several = blocks.filter("block > 0").select(*INSTANCE).distinct()
    starts = composition.block_starts(
        join_hot(blocks, several, INSTANCE, "left_semi"),
        composition.Machine(rows, machine.states, initial, HELD, TERMINAL, ANY_STATE, BEFORE_HOLD, GIVEN_TARGET),
    )
    blocks = blocks.join(starts, [*INSTANCE, "block"], "left").withColumn("start", F.coalesce("start", beginning))
    results = blocks.select(*INSTANCE, F.explode(_log(machine, blocks)).alias("entry")).select(
        *INSTANCE, "entry.seq", "entry.from_state", F.col("entry.state").alias("to_state"), "entry.version", "entry.outcome",
        F.col("entry.held_before").alias("held_seq"), *[f"entry.{c}" for c in [*_PASSED, "idempotency_key"]],
    )
    nothing = F.lit(None)
    lost = unplaced.select(
        *INSTANCE, "seq", nothing.cast("string").alias("from_state"), nothing.cast("string").alias("to_state"),
        nothing.cast("int").alias("version"), F.lit("no_seq").alias("outcome"), nothing.cast("int").alias("held_seq"),
        *_PASSED, "idempotency_key",
    )
    if not duplicates:
        return results.unionByName(lost)
    # Later deliveries of a key get the first one's result. Equal deliveries are counted, and one of
    # those that equal the first is the original.
    values = ["seq", *_PASSED, "idempotency_key"]
    whole = F.struct(*values)
    first = results.select(
        *[F.col(c).alias(f"{c}_") for c in INSTANCE], _once_key().alias("once_"), whole.alias("whole_"),
        *[F.col(c).alias(f"{c}_") for c in ("from_state", "to_state", "version", "outcome", "held_seq")],
    )
    match = [F.col(c) == F.col(f"{c}_") for c in INSTANCE] + [_once_key() == F.col("once_")]
    deliveries = events.groupBy(*INSTANCE, *values).agg(F.count(F.lit(1)).alias("copies"))
    original = whole.eqNullSafe(F.col("whole_")) & (F.col("copy") == 1)
    return deliveries.join(first, match).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *INSTANCE, "seq", *[F.col(f"{c}_").alias(c) for c in ("from_state", "to_state", "version")],
        F.when(original, F.col("outcome_")).otherwise("duplicate").alias("outcome"), F.col("held_seq_").alias("held_seq"),
        *_PASSED, "idempotency_key",
    ).unionByName(lost)


def applied(log: DataFrame) -> DataFrame:
    """The transition log: events that took effect."""
    return log.filter("outcome = 'applied'")


def transition_history(log: DataFrame, block: int = BLOCK_EVENTS) -> DataFrame:
    """Transitions of each instance in order, with the seconds since the one before.

    Versions of applied transitions are 1, 2, 3 ..., so an instance is cut into blocks of
    versions; the last row of a block is also given to the next one.
    """
    rows = applied(log)
    home = F.floor((F.col("version") - 1) / block)
    homes = F.when(F.col("version") % block == 0, F.array(home, home + 1)).otherwise(F.array(home))
    order = Window.partitionBy(*INSTANCE, "home").orderBy("version")
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(order).cast("timestamp"))
    return (
        rows.withColumn("own", home).withColumn("home", F.explode(homes))
        .withColumn("gap_seconds", seconds / F.lit(1_000_000.0)).filter("home = own")
        .select(
            *INSTANCE, F.col("version").alias("seq"), "from_state", "to_state", "event_type", "actor_id", "ts", "gap_seconds"
        )
    )


def guard_violations(log: DataFrame, guards: DataFrame) -> DataFrame:
    """Events that came before the event they depend on.

    ``guards`` has event_type and guard_event. The log is taken as it is, so this also
    audits logs that were written without checks; overrides are another event type and
    never violate. The earliest guard event per instance is found by aggregation.
    """
    needed = guards.select("event_type", "guard_event").filter("guard_event is not null").distinct()
    met = (
        log.join(needed.select(F.col("guard_event").alias("event_type")).distinct(), "event_type", "left_semi")
        .groupBy(*INSTANCE, F.col("event_type").alias("guard_event")).agg(F.min("seq").alias("met_seq"))
    )
    return (
        join_hot(log.join(needed, "event_type"), met, [*INSTANCE, "guard_event"], "left")
        .filter("met_seq is null or met_seq >= seq")
        .select(*INSTANCE, "seq", "event_id", "event_type", "guard_event")
    )


def version_conflicts(log: DataFrame) -> DataFrame:
    """Rejected attempts of a replayed log, with the state and version they met."""
    return log.filter("outcome = 'version_conflict'").select(
        *INSTANCE, "seq", "event_id", "event_type", "expected_version",
        F.col("version").alias("current_version"), F.col("to_state").alias("current_state"),
    )


def version_audit(log: DataFrame) -> DataFrame:
    """Versions of a transition log that are repeated or lack the one before.

    Rows are matched by instance and version, so an instance of any length is spread.
    """
    versions = log.groupBy(*INSTANCE, "version").agg(F.count(F.lit(1)).alias("n"))
    before = versions.select(*INSTANCE, (F.col("version") + 1).alias("version"), F.lit(True).alias("follows"))
    checked = versions.join(before, [*INSTANCE, "version"], "left")
    issues = F.array_compact(F.array(
        F.when(F.col("n") > 1, "repeated"), F.when((F.col("version") > 1) & F.col("follows").isNull(), "gap"),
    ))
    return checked.select(*INSTANCE, "version", F.explode(issues).alias("issue"))


def permission_audit(log: DataFrame, rules: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """Whether some rule allows each event; without a matching rule it is denied.

    ``carried`` names further columns of the log that come out.
    A NULL in a rule matches anything. The few different situations in the log are
    looked up with every choice of fields left open, an equality join for any
    number of rules, and the answers are joined back.
    """
    fields = ["workflow_name", "event_type", "role", "current_state", "override_flag"]
    asked = log.select(
        "workflow_name", "instance_id", "seq", "event_id", "event_type", F.col("actor_role").alias("role"),
        F.col("from_state").alias("current_state"), (F.col("event_type") == OVERRIDE).alias("override_flag"),
        *(carried or []),
    )
    situations = asked.select(*fields).distinct()
    masks = F.array(*[F.lit(i) for i in range(1 << len(fields))])
    opened = situations.withColumn("mask", F.explode(masks)).select(
        *fields,
        *[F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) == 0, F.col(c)).alias(f"{c}_") for i, c in enumerate(fields)],
    )
    known = rules.select(*[F.col(c).alias(f"{c}_rule") for c in fields]).distinct()
    match = [F.col(f"{c}_").eqNullSafe(F.col(f"{c}_rule")) for c in fields]
    allowed = opened.join(known, match, "left_semi").select(*[F.col(c).alias(f"{c}_ok") for c in fields]).distinct()
    back = [F.col(c).eqNullSafe(F.col(f"{c}_ok")) for c in fields]
    return asked.join(allowed.withColumn("found", F.lit(True)), back, "left").select(
        "workflow_name", "instance_id", "seq", "event_id", "event_type", "role", "current_state", "override_flag",
        F.col("found").isNotNull().alias("allowed"), *(carried or []),
    )


def role_audit(log: DataFrame, assignments: DataFrame, roles: DataFrame) -> DataFrame:
    """Events whose actor does not hold the role claimed, or whose role has no business unit.

    ``assignments`` has actor_id and role, ``roles`` has role and business_unit_id. The few different
    (actor, role) pairs of the log are looked up and the answers joined back.
    """
    claimed = log.select("actor_id", "actor_role").distinct()
    held = assignments.select(F.col("actor_id").alias("holder"), F.col("role").alias("held_role")).distinct()
    mapped = roles.filter("business_unit_id is not null").select(F.col("role").alias("mapped_role")).distinct()
    issue = F.when(F.col("held_role").isNull(), "role_not_held").when(F.col("mapped_role").isNull(), "role_without_unit")
    flawed = (
        claimed.join(held, (F.col("actor_id") == F.col("holder")) & (F.col("actor_role") == F.col("held_role")), "left")
        .join(mapped, F.col("actor_role") == F.col("mapped_role"), "left")
        .select(F.col("actor_id").alias("actor_id_"), F.col("actor_role").alias("actor_role_"), issue.alias("issue"))
        .filter("issue is not null")
    )
    same = F.col("actor_id").eqNullSafe(F.col("actor_id_")) & F.col("actor_role").eqNullSafe(F.col("actor_role_"))
    return log.join(flawed, same).select(*INSTANCE, "seq", "event_id", "actor_id", "actor_role", "issue")


def override_audit(log: DataFrame, rules: DataFrame) -> DataFrame:
    """Every override with actor, role and reason, flagging blank reasons and lacking permission."""
    carried = ["actor_id", "actor_role", "target_state", "override_reason", "outcome"]
    audited = permission_audit(log.filter(F.col("event_type") == OVERRIDE), rules, carried)
    return audited.select(
        *INSTANCE, "seq", "event_id", "actor_id", "actor_role", "target_state", "override_reason",
        is_blank(F.col("override_reason")).alias("reason_blank"), (~F.col("allowed")).alias("not_permitted"), "outcome",
    )


def hold_intervals(log: DataFrame) -> DataFrame:
    """Holds of each instance, and the state it went on in; an open hold has no release.

    The replay carries the sequence number at which a hold began, so begin and end
    meet by equality, without sorting an instance. A hold inside a hold is part of it.
    """
    rows = applied(log)
    began = rows.filter((F.col("from_state") != HELD) & (F.col("to_state") == HELD)).select(
        *INSTANCE, F.col("seq").alias("held_seq"), F.col("ts").alias("held_at"), F.col("from_state").alias("held_from")
    )
    ended = rows.filter((F.col("from_state") == HELD) & (F.col("to_state") != HELD)).select(
        *INSTANCE, "held_seq", F.col("ts").alias("released_at"), F.col("to_state").alias("resumed_state"),
        F.col("event_type").alias("released_by"),
    )
    return began.join(ended, [*INSTANCE, "held_seq"], "left")
