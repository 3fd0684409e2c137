"""Continuous replay of workflow events."""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import groupby, islice

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerloom.operators.workflow import (
    ANY_STATE, BEFORE_HOLD, GIVEN_TARGET, HELD, INITIAL, INSTANCE, TERMINAL, definition, known_states,
)
from ledgerloom.session import reach_workers

FRAME_ROWS = 10_000
# Events of an instance that a batch holds in memory; more wait in the state.
HELD_EVENTS = 50_000
# The keys of an instance are read at once while so few numbers are behind it.
FEW_KEYS = 1000
EVENT_FIELDS = (
    "seq int, event_id long, ts timestamp, event_type string, actor_id long, actor_role string, "
    "target_state string, override_reason string, expected_version int, idempotency_key string"
)
OUTPUT = (
    "workflow_name string, instance_id long, seq int, from_state string, to_state string, version int, "
    "outcome string, held_seq int, event_id long, ts timestamp, event_type string, actor_id long, "
    "actor_role string, target_state string, override_reason string, expected_version int, idempotency_key string"
)
_EVENT = [field.split()[0] for field in EVENT_FIELDS.split(", ")]
_OUT = [field.split()[0] for field in OUTPUT.split(", ")]
_OUT_ROW = Row(*_OUT)
_RESULT = ["from_state", "to_state", "version", "outcome", "held_seq"]


_INTEGERS = {"seq", "event_id", "actor_id", "expected_version"}


def _plain(row) -> tuple:
    """Missing values as None."""
    return tuple(None if pd.isna(value) else value for value in row)


def _event(row) -> tuple:
    """Event values as stored; pandas makes a column of integers with gaps one of floats."""
    return tuple(
        int(value) if name in _INTEGERS and value is not None else value for name, value in zip(_EVENT, _plain(row))
    )


def _order(event: tuple) -> tuple:
    """By sequence number, then by the other values, missing ones first."""
    return tuple((value is not None, value) for value in event)


def _stored(event: tuple) -> list:
    """An event as values of JSON."""
    return [value.value // 1000 if isinstance(value, pd.Timestamp) else value for value in event]


def _restored(values: list) -> tuple:
    at = _EVENT.index("ts")
    return tuple(pd.Timestamp(value, unit="us") if i == at and value is not None else value for i, value in enumerate(values))


def _once(event: dict) -> str:
    """The idempotency key; an event without one is only itself."""
    key = event["idempotency_key"]
    return f"e{event['event_id']}" if key is None else f"k{key}"


_WHOLE = {"seq": "Int32", "version": "Int32", "held_seq": "Int32", "expected_version": "Int32", "event_id": "Int64", "actor_id": "Int64"}


def _frame(rows: list[dict]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[field.split()[0] for field in OUTPUT.split(", ")])
    return frame.astype(_WHOLE).astype({"ts": "datetime64[us]"})


def decide(current: dict, event: dict, moves: dict, guards: set, states: set) -> tuple[dict, tuple]:
    """The state after one event, and its (from, to, version, outcome, held_seq)."""
    state, reason = current["state"], event["override_reason"]
    move = moves.get((state, event["event_type"]))
    if move is None and state not in TERMINAL:
        move = moves.get((ANY_STATE, event["event_type"]))
    target = move and {BEFORE_HOLD: current["held_from"], GIVEN_TARGET: event["target_state"]}.get(move[0], move[0])
    if event["expected_version"] is not None and event["expected_version"] != current["version"]:
        outcome = "version_conflict"
    elif move is None:
        outcome = "no_transition"
    elif move[0] == GIVEN_TARGET and not (reason or "").strip():
        outcome = "reason_missing"
    elif target is None:
        outcome = "no_target"
    elif move[0] == GIVEN_TARGET and target not in states:
        outcome = "unknown_target"
    elif move[1] is not None and move[1] not in current["seen"]:
        outcome = "guard_not_met"
    else:
        outcome = "applied"
    if outcome != "applied":
        return current, (state, state, current["version"], outcome, current["held_seq"])
    new = {"state": target, "version": current["version"] + 1, "held_from": None, "held_seq": None, "seen": current["seen"]}
    if target == HELD:
        entered = state != HELD
        new["held_from"] = state if entered else current["held_from"]
        new["held_seq"] = event["seq"] if entered else current["held_seq"]
    if event["event_type"] in guards:
        new["seen"] = sorted({*current["seen"], event["event_type"]})
    return new, (state, target, new["version"], outcome, current["held_seq"])


class ReplayProcessor(StatefulProcessor):
    """State of one instance: where it stands, the keys it has seen, events that came early by their numbers."""

    def __init__(self, transitions: list[tuple], initial: str, key_ttl_ms: int | None, gap_ms: int | None, event_time: bool):
        self.moves = {(row[0], row[1]): (row[2], row[3]) for row in transitions}
        self.guards = {row[3] for row in transitions if row[3]}
        self.states = set(known_states(transitions))
        self.initial, self.key_ttl_ms, self.gap_ms, self.event_time = initial, key_ttl_ms, gap_ms, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.current = handle.getValueState(
            "current",
            "state string, version int, held_from string, held_seq int, seen string, next_seq int, waiting int, timer long",
        )
        self.results = handle.getMapState(
            "results", "once string",
            "from_state string, to_state string, version int, outcome string, held_seq int", self.key_ttl_ms,
        )
        self.early = handle.getMapState("early", "seq int", "events string, since long")

    def _load(self, key) -> None:
        self.key = dict(zip(INSTANCE, key))
        found = self.current.get()
        stored = (self.initial, 0, None, None, "", 1, 0, None) if found is None else _plain(found)
        self.stand = dict(zip(("state", "version", "held_from", "held_seq"), stored[:4]))
        self.stand["seen"] = [name for name in stored[4].split(",") if name]
        # The number that is due, how many numbers wait, and when a missing one is given up.
        self.due, self.waiting, self.timer = stored[5:]
        # The keys seen; None: ask the state for each.
        self.known = set() if found is None else {_plain(key)[0] for key in self.results.keys()} if self.due <= FEW_KEYS else None

    def _save(self, now: int, due_before: int) -> None:
        """Store the state, and set the timer anew when another number is missing."""
        if self.gap_ms is not None and (self.timer is None or self.due != due_before or not self.waiting):
            if self.timer is not None:
                self.handle.deleteTimer(self.timer)
            self.timer = now + self.gap_ms if self.waiting else None
            if self.timer is not None:
                self.handle.registerTimer(self.timer)
        self.current.update((
            self.stand["state"], self.stand["version"], self.stand["held_from"], self.stand["held_seq"],
            ",".join(self.stand["seen"]), self.due, self.waiting, self.timer,
        ))

    def _now(self, values) -> int:
        return values.getCurrentWatermarkInMs() if self.event_time else values.getCurrentProcessingTimeInMs()

    def _row(self, result: tuple, event: dict) -> dict:
        return {**self.key, **dict(zip(_RESULT, result)), **event}

    def _decided(self, values: tuple) -> dict:
        """The outcome of an event whose turn it is."""
        event = dict(zip(_EVENT, values))
        once = (_once(event),)
        if self.results.containsKey(once) if self.known is None else once[0] in self.known:
            first = _plain(self.results.getValue(once))
            result = (*first[:3], "duplicate", first[4])
        else:
            self.stand, result = decide(self.stand, event, self.moves, self.guards, self.states)
            self.results.updateValue(once, result)
            if self.known is not None:
                self.known.add(once[0])
        return self._row(result, event)

    def _taken(self) -> list[tuple]:
        """Events that wait under the number that is due."""
        if not self.waiting or not self.early.containsKey((self.due,)):
            return []
        events = [self._restored(values) for values in json.loads(self.early.getValue((self.due,))[0])]
        self.early.removeKey((self.due,))
        self.waiting -= 1
        return events

    def _put_aside(self, events: list[tuple], now: int) -> None:
        """Keep events under their numbers until these are due. ``events`` are in order."""
        for seq, some in groupby(events, key=lambda event: event[0]):
            stored, since = [_stored(event) for event in some], now
            if self.waiting and self.early.containsKey((seq,)):
                before, since = self.early.getValue((seq,))
                stored = json.loads(before) + stored
            else:
                self.waiting += 1
            self.early.updateValue((seq,), (json.dumps(stored), since))

    def _due_rows(self, heap: list) -> Iterator[dict]:
        """Outcomes in the order of the numbers, up to the first that is missing."""
        while True:
            events = self._taken()
            while heap and heap[0][1][0] == self.due:
                events.append(heappop(heap)[1])
            if not events:
                return
            for event in sorted(events, key=_order):
                yield self._decided(event)
            self.due += 1

    def _restored(self, values: list) -> tuple:
        return _restored(values)

    def _events(self, rows: Iterator) -> Iterator[list[tuple]]:
        """The events that arrive, some at a time."""
        for frame in rows:
            yield [_event(row) for row in frame[_EVENT].itertuples(index=False, name=None)]

    def _out(self, rows: Iterator[dict]) -> Iterator:
        return _frames(rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        self._load(key)
        now = self._now(timerValues) if self.gap_ms is not None else 0
        due_before = self.due

        def results() -> Iterator[dict]:
            heap: list[tuple] = []
            for some in self._events(rows):
                for event in some:
                    if event[0] is None or event[0] < 1:
                        yield self._row((None, None, None, "no_seq", None), dict(zip(_EVENT, event)))
                    elif event[0] < due_before:  # an earlier number comes again
                        yield self._decided(event)
                    else:
                        heappush(heap, (_order(event), event))
                if len(heap) > HELD_EVENTS:  # the later half waits outside
                    heap.sort()
                    self._put_aside([event for _, event in heap[HELD_EVENTS // 2:]], now)
                    del heap[HELD_EVENTS // 2:]
            yield from self._due_rows(heap)
            self._put_aside([event for _, event in sorted(heap)], now)

        yield from self._out(results())
        self._save(now, due_before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        """Give up numbers for which later ones have waited long enough: a row ``gap`` for each run of them."""
        self._load(key)
        if expiredTimerInfo.getExpiryTimeInMs() != self.timer:
            return
        now, due_before, self.timer = self._now(timerValues), self.due, None

        def results() -> Iterator[dict]:
            seqs = [row[0] for row in self.early.keys()]
            heapify(seqs)
            while seqs:
                seq = heappop(seqs)
                if seq < self.due:
                    continue
                if seq > self.due:
                    if self.early.getValue((seq,))[1] + self.gap_ms > now:
                        return
                    stand = self.stand
                    yield self._row(
                        (stand["state"], stand["state"], stand["version"], "gap", stand["held_seq"]),
                        {**dict.fromkeys(_EVENT), "seq": self.due})
                    self.due = seq
                yield from self._due_rows([])

        yield from self._out(results())
        self._save(now, due_before)

    def close(self) -> None:
        pass


class RowReplay(ReplayProcessor):
    """The same by rows: most instances have few events in a batch, and a frame for each of them costs far more than these.

    Times are whole microseconds.
    """

    def _restored(self, values: list) -> tuple:
        return tuple(values)

    def _events(self, rows: Iterator[Row]) -> Iterator[list[tuple]]:
        while some := [tuple(row[name] for name in _EVENT) for row in islice(rows, FRAME_ROWS)]:
            yield some

    def _out(self, rows: Iterator[dict]) -> Iterator[Row]:
        for row in rows:
            yield _OUT_ROW(*[row[name] for name in _OUT])


def _frames(rows: Iterator[dict]) -> Iterator[pd.DataFrame]:
    while some := list(islice(rows, FRAME_ROWS)):
        yield _frame(some)


def stream_replay(
    events: DataFrame, transitions: DataFrame, initial: str = INITIAL, key_ttl_ms: int | None = None,
    gap_ms: int | None = None, event_time: bool = False,
) -> DataFrame:
    """Outcome of every event as it arrives, the same as `replay` gives on the whole log.

    The transition table becomes part of the operator. Sequence numbers of an instance start at 1
    without gaps; an event that comes early waits for the missing ones, one that comes again is a
    duplicate, one without a number (or below 1) is ``no_seq`` at once. With ``gap_ms`` a missing number is given up when
    a later one has waited so long: one row ``gap`` bears the first missing number of the run, with the state as
    it stands, and the instance goes on after it. A lost event that comes after that is decided by the state of
    then. Time is that of processing, or with ``event_time`` the watermark of the stream. Needs the RocksDB
    state store. ``key_ttl_ms`` lets the keys of events expire, by processing time.

    Early events lie in a map by number, so that a batch touches only those whose turn has come; of the events of one
    instance in a batch at most ``HELD_EVENTS`` and a frame are held in memory.
    """
    if event_time and key_ttl_ms:
        raise ValueError("keys expire by processing time only")
    reach_workers(events.sparkSession)
    mode = "EventTime" if event_time else "ProcessingTime" if key_ttl_ms or gap_ms is not None else "None"
    # The watermark is that of a column of the rows, which so has to stay.
    rows = events.select(*INSTANCE, *[F.unix_micros(F.col(c).cast("timestamp")).alias(c) if c == "ts" else F.col(c) for c in _EVENT],
                         *[F.col("ts").alias("event_time")] * event_time)
    found = rows.groupBy(*INSTANCE).transformWithState(
        RowReplay(definition(transitions), initial, key_ttl_ms, gap_ms, event_time), OUTPUT.replace("ts timestamp", "ts long"), "Append", mode
    )
    return found.withColumn("ts", F.timestamp_micros("ts"))
