import random

import pytest
from conftest import got
from test_workflow import EVENTS, PATH, by_hand, event, random_events, transitions  # noqa: F401

from ledgerloom.operators import composition, workflow
from ledgerloom.streaming.replay import decide


def rows_of(transitions):  # noqa: F811
    return workflow.definition(transitions)


def machine_of(rows):
    return composition.Machine(
        rows, workflow.known_states(rows), "DraftScope", workflow.HELD, workflow.TERMINAL, workflow.ANY_STATE, workflow.BEFORE_HOLD,
        workflow.GIVEN_TARGET)


def random_log(rng, length):
    kinds = [*PATH, "HoldPlaced", "HoldReleased", "OverrideTransition", "Nonsense", "Cancelled"]
    level, out = 0, []
    for seq in range(1, length + 1):
        level += rng.random() < 0.4
        out.append((seq, rng.choice(kinds[:-1] if rng.random() < 0.95 else kinds), rng.choice([None, None, level, max(0, level - rng.randint(0, 3))]),
                    rng.choice(["Scheduled", "OnHold", "Nowhere", None]), rng.random() < 0.3))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_blocks_compose(transitions, seed):  # noqa: F811
    """Any cut of a log, composed in any grouping, ends where one event after the other ends."""
    rng, rows = random.Random(seed), rows_of(transitions)
    machine = machine_of(rows)
    moves, guards = {(r[0], r[1]): (r[2], r[3]) for r in rows}, {r[3] for r in rows if r[3]}
    log = random_log(rng, rng.choice([6, 25, 60]))
    cuts = sorted(rng.sample(range(1, len(log)), min(len(log) - 1, rng.choice([1, 4, 9]))))
    parts = [log[a:b] for a, b in zip([0, *cuts], [*cuts, len(log)])]
    blocks = [composition.Block(composition.written(composition.of_events(machine, part))) for part in parts]
    half = rng.randrange(len(blocks) + 1)
    joined = [composition.Block(composition.written(composition.of_blocks(machine, some))) for some in (blocks[:half], blocks[half:])]
    state = {"state": "DraftScope", "version": 0, "held_from": None, "held_seq": None, "seen": []}
    points = []
    for part in parts:
        for seq, kind, expected, target, blank in part:
            state, _ = decide(state, {"seq": seq, "event_type": kind, "expected_version": expected, "target_state": target,
                                      "override_reason": None if blank else "x"}, moves, guards, set(workflow.known_states(rows)))
        points.append(state)

    def same(course, wanted):
        seen = sorted(name for name, bit in machine.guards.items() if course[3] & bit)
        assert (course[0], course[7], course[1], course[2], seen) == (
            wanted["state"], wanted["version"], wanted["held_from"], wanted["held_seq"], wanted["seen"])

    course = composition.first(machine)
    for block, wanted in zip(blocks, points):
        course = composition.after(machine, course, block)
        same(course, wanted)
    course = composition.first(machine)
    for block in joined:
        course = composition.after(machine, course, block)
    same(course, points[-1])


@pytest.mark.parametrize("versions", [False, True])
def test_replay_over_many_stretches(make, transitions, monkeypatch, versions):  # noqa: F811
    monkeypatch.setattr(composition, "WIDTH", 2)
    events = random_events(3 + versions, versions)
    log = workflow.replay(make(EVENTS, *events).repartition(3), transitions, block_events=3)
    mine = got(log.select("instance_id", "seq", "from_state", "to_state", "version", "outcome", "held_seq"))
    assert mine == by_hand(events, transitions.collect())


def test_jobs_do_not_follow_conflicts(make, spark, transitions):  # noqa: F811
    def jobs(conflicts):
        events, version = [event(1, i + 1, kind) for i, kind in enumerate(PATH[:6])], 6
        for seq in range(7, 1201):
            # An event at a block border expects a version that an earlier conflict has made wrong.
            wrong = conflicts and seq % 6 == 1
            events.append(event(1, seq, "OperationCompleted", expected=version + 5 if wrong else version))
            version += not wrong
        log = workflow.replay(make(EVENTS, *events), transitions, block_events=6)
        name = f"conflicts {conflicts}"
        spark.sparkContext.setJobGroup(name, name)
        try:
            outcomes = [row.outcome for row in log.collect()]
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert outcomes.count("version_conflict") == (199 if conflicts else 0) and len(outcomes) == 1200
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    assert jobs(False) == jobs(True)


@pytest.mark.parametrize("block", [3, 256])
def test_events_without_a_number(make, transitions, block):  # noqa: F811
    events = [event(1, i + 1, kind) for i, kind in enumerate(PATH[:7])]
    bare = [tuple(seq if i == 2 else v for i, v in enumerate(event(1, 500 + k, "ScopeDefined", key="k10001"))) for k, seq in enumerate((None, 0, -4))]
    log = workflow.replay(make(EVENTS, *bare, *events), transitions, block_events=block)
    rows = got(log.select("seq", "outcome", "version", "to_state"))
    assert len(rows) == 10 and [r[1:] for r in rows if r[1] == "no_seq"] == [("no_seq", None, None)] * 3
    assert sorted(r[2] for r in rows if r[1] == "applied") == list(range(1, 8))


@pytest.mark.parametrize("block", [3, 256])
def test_short_instances_are_followed(make, transitions, monkeypatch, block):  # noqa: F811
    """No functions are made for an instance of one stretch."""
    monkeypatch.setattr(composition, "of_events", None)
    events = random_events(5, True)
    log = workflow.replay(make(EVENTS, *events), transitions, block_events=block)
    mine = got(log.select("instance_id", "seq", "from_state", "to_state", "version", "outcome", "held_seq"))
    assert mine == by_hand(events, transitions.collect())
