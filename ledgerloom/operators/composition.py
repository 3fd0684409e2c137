"""Blocks of a workflow log as functions that compose.

What a block of events does depends on where its instance stands when it begins: the state (with the state that a
hold returns to), the version, and the guard events seen so far. All of this is followed at once. Courses that come
to the same point are joined, a guard event is assumed both seen and unseen only where an event asks for it, and the
version is left open: an event that expects a version settles it for the one start version with which the check
passes, and fails for all others. A block is so described by a course for each begin with the version left open, and
one for each critical start version. Such descriptions compose, so long logs are scanned in parallel: blocks by
themselves, stretches of blocks, the stretches of an instance one after the other, and the blocks of each stretch again.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import product

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import is_blank
from ledgerloom.functions.skew import join_hot
from ledgerloom.session import reach_workers

# Blocks in a stretch.
WIDTH = 256
# A hold that began before the block.
BEFORE = 0

Course = tuple  # state, held_from, held_seq, guards seen (bits), unseen, gained; is the version known, version or gain
START = "struct<state:string,version:int,held_from:string,held_seq:int,seen:array<string>>"


class Machine:
    """A workflow definition: rows (from_state, event_type, to_state, guard_event), and what its markers mean."""

    def __init__(self, rows: list[tuple], states: list[str], initial: str, held: str, terminal: tuple, anywhere: str, back: str, given: str):
        self.moves = {(row[0], row[1]): (row[2], row[3]) for row in rows}
        self.guards = {name: 1 << i for i, name in enumerate(sorted({row[3] for row in rows if row[3]}))}
        self.states, self.initial, self.held, self.terminal = set(states), initial, held, terminal
        self.anywhere, self.back, self.given = anywhere, back, given
        places = sorted(self.states | {initial})
        self.begins = [(s, None) for s in places] + [(held, s) for s in places if s != held]
        self.number = {begin: i for i, begin in enumerate(self.begins)}

    def target(self, state: str, held_from: str | None, event: tuple) -> tuple[str, int] | None:
        """Where an event leads that passes its version check, and the guard it needs (0: none)."""
        _, kind, _, wanted, blank = event
        move = self.moves.get((state, kind))
        if move is None and state not in self.terminal:
            move = self.moves.get((self.anywhere, kind))
        if move is None:
            return None
        target, guard = move
        if target == self.back:
            target = held_from
        elif target == self.given:
            target = None if blank or wanted not in self.states else wanted
        return None if target is None else (target, self.guards[guard] if guard else 0)


class _Courses:
    """Courses with the begins they come from: a set of settled start versions each, or the start versions."""

    def __init__(self):
        self.open: dict[Course, dict[int, set[int]]] = defaultdict(dict)
        self.known: dict[Course, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))

    def add(self, course: Course, labels: dict) -> None:
        if course[6]:
            mine = self.known[course]
            for begin, versions in labels.items():
                mine[begin].extend(versions)
        else:
            self.open[course].update(labels)

    def each(self) -> Iterator[tuple[Course, dict]]:
        yield from self.open.items()
        yield from self.known.items()


def _settled(labels: dict[int, set[int]], start: int) -> dict[int, list[int]]:
    """Begins for which a start version is met for the first time; from here it goes its own way."""
    found = {}
    if start >= 0:
        for begin, taken in labels.items():
            if start not in taken:
                taken.add(start)
                found[begin] = [start]
    return found


def _copied(labels: dict) -> dict:
    return {begin: x.copy() for begin, x in labels.items()}


def _beginning(machine: Machine) -> _Courses:
    courses = _Courses()
    for i, (state, held_from) in enumerate(machine.begins):
        courses.add((state, held_from, BEFORE if state == machine.held else None, 0, 0, 0, False, 0), {i: set()})
    return courses


def _stepped(machine: Machine, course: Course, labels: dict, event: tuple, out: _Courses) -> None:
    """One event that passes its version check."""
    state, held_from, held_seq, yes, no, gained, known, version = course
    found = machine.target(state, held_from, event)
    if found is None:
        return out.add(course, labels)
    target, guard = found
    if guard and not (yes | gained) & guard:
        if no & guard:
            return out.add(course, labels)
        out.add((state, held_from, held_seq, yes, no | guard, gained, known, version), _copied(labels))
        yes |= guard
    if target != machine.held:
        held_from = held_seq = None
    elif state != machine.held:
        held_from, held_seq = state, event[0]
    out.add((target, held_from, held_seq, yes, no, gained | machine.guards.get(event[1], 0), known, version + 1), labels)


def of_events(machine: Machine, events: Iterable[tuple]) -> _Courses:
    """What a block does. Events are (seq, event_type, expected_version, target_state, is the reason blank)."""
    courses = _beginning(machine)
    for event in events:
        out, expected = _Courses(), event[2]
        for course, labels in courses.each():
            if expected is None or (course[6] and course[7] == expected):
                _stepped(machine, course, labels, event, out)
                continue
            if not course[6] and (met := _settled(labels, expected - course[7])):
                _stepped(machine, (*course[:6], True, expected), met, event, out)
            out.add(course, labels)
        courses = out
    return courses


def _ranges(values: list[int]) -> list[list[int]]:
    """Runs (first, last) of whole numbers."""
    out: list[list[int]] = []
    for v in sorted(values):
        if out and v == out[-1][1] + 1:
            out[-1][1] = v
        else:
            out.append([v, v])
    return out


def written(courses: _Courses) -> str:
    """A description as text."""
    return json.dumps([
        [*course, list(labels) if not course[6] else [[b, _ranges(v)] for b, v in labels.items()]] for course, labels in courses.each()
    ], separators=(",", ":"))


class Block:
    """A description to look things up in."""

    def __init__(self, text: str):
        self.asked: dict[int, int] = defaultdict(int)
        self.open: dict[int, list[Course]] = defaultdict(list)
        self.known: dict[int, dict[int, list[Course]]] = defaultdict(lambda: defaultdict(list))
        for *course, labels in json.loads(text):
            for label in labels:
                begin = label[0] if course[6] else label
                self.asked[begin] |= course[3] | course[4]
                if course[6]:
                    for low, high in label[1]:
                        for v in range(low, high + 1):
                            self.known[begin][v].append(tuple(course))
                else:
                    self.open[begin].append(tuple(course))

    def fitting(self, courses: list[Course], seen: int) -> Course | None:
        """The course for guards seen, all that are asked for being settled."""
        return next((c for c in courses if c[3] & ~seen == 0 and c[4] & seen == 0), None)


def _joined(course: Course, block: Course) -> Course:
    """A course that goes on through a block."""
    state, held_from, held_seq, _, _, gained, known, version = block
    if held_seq == BEFORE:
        held_seq = course[2]
    return (state, held_from, held_seq, course[3], course[4], course[5] | gained, known or course[6], version if known else course[7] + version)


def _passed(machine: Machine, courses: _Courses, block: Block) -> _Courses:
    """Courses after one more block."""
    out = _Courses()
    for course, labels in courses.each():
        begin = machine.number[course[0], course[1]]
        unsettled = block.asked[begin] & ~(course[3] | course[4] | course[5])
        bits = [1 << i for i in range(unsettled.bit_length()) if unsettled >> i & 1]
        for chosen in product((0, 1), repeat=len(bits)):
            yes = course[3] | sum(b for b, c in zip(bits, chosen) if c)
            no = course[4] | sum(b for b, c in zip(bits, chosen) if not c)
            here, mine = (*course[:3], yes, no, *course[5:]), _copied(labels) if bits else labels
            seen = yes | course[5]
            usual = block.fitting(block.open[begin], seen)
            if course[6]:
                out.add(_joined(here, block.fitting(block.known[begin].get(course[7], []), seen) or usual), mine)
                continue
            for version, found in block.known[begin].items():
                special = block.fitting(found, seen)
                if special and (met := _settled(mine, version - course[7])):
                    out.add(_joined(here, special), met)
            out.add(_joined(here, usual), mine)
    return out


def of_blocks(machine: Machine, blocks: Iterable[Block]) -> _Courses:
    """What a run of blocks does."""
    courses = _beginning(machine)
    for block in blocks:
        courses = _passed(machine, courses, block)
    return courses


def after(machine: Machine, start: Course, block: Block) -> Course:
    """Where a block ends for a start of which all is known."""
    begin, seen = machine.number[start[0], start[1]], start[3] | start[5]
    found = block.fitting(block.known[begin].get(start[7], []), seen) or block.fitting(block.open[begin], seen)
    state, held_from, held_seq, _, _, gained, _, version = _joined(start, found)
    return state, held_from, held_seq, start[3] | gained, 0, 0, True, version


def first(machine: Machine) -> Course:
    """Where every instance begins."""
    return machine.initial, None, None, 0, 0, 0, True, 0


def followed(machine: Machine, start: Course, events: Iterable[tuple]) -> Course:
    """Where events lead from a start of which all is known: the same as `after` with what they do."""
    state, held_from, held_seq, yes, _, gained, _, version = start
    seen = yes | gained
    for event in events:
        if event[2] is not None and event[2] != version:
            continue
        found = machine.target(state, held_from, event)
        if found is None or (found[1] and not seen & found[1]):
            continue
        if found[0] != machine.held:
            held_from = held_seq = None
        elif state != machine.held:
            held_from, held_seq = state, event[0]
        state, version = found[0], version + 1
        seen |= machine.guards.get(event[1], 0)
    return state, held_from, held_seq, seen, 0, 0, True, version


def _keys(batch: pa.RecordBatch) -> list[pa.Array]:
    return [batch.column(0), batch.column(1)]


def block_starts(blocks: DataFrame, machine: Machine, width: int | None = None) -> DataFrame:
    """Where each block begins: instance, block, start. ``blocks`` has instance, block and its events in order.

    An instance of one stretch is followed from its beginning, which is known; blocks of longer ones are described as
    functions. The number of jobs does not follow from the log; no row grows with an instance, and what one task
    sees of a long instance, a row for each stretch, passes by in order.
    """
    reach_workers(blocks.sparkSession)
    blocks.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    width = width or WIDTH
    instance = blocks.columns[:2]
    key = ", ".join(f"{name} {blocks.schema[name].dataType.simpleString()}" for name in instance)
    fields = ["seq", "event_type", "expected_version", "target_state", "blank"]

    kind = pa.struct([("state", pa.string()), ("version", pa.int32()), ("held_from", pa.string()), ("held_seq", pa.int32()),
                      ("seen", pa.list_(pa.string()))])

    def as_start(course: Course) -> dict:
        return {"state": course[0], "version": course[7], "held_from": course[1], "held_seq": course[2],
                "seen": [name for name, bit in machine.guards.items() if course[3] & bit]}

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                blocks_of = batch.column("items")
                flat = blocks_of.flatten()
                numbers, inside = flat.field("block"), flat.field("events")
                events = inside.flatten()
                columns = [events.field(name).to_pylist() for name in fields]
                each, owners, starts, at, item = list(zip(*columns)), [], [], 0, 0
                sizes = [n or 0 for n in pc.list_value_length(inside).to_pylist()]
                for row, count in enumerate(pc.list_value_length(blocks_of).to_pylist()):
                    start = first(machine)
                    for size in sizes[item:item + count]:
                        owners.append(row)
                        starts.append(as_start(start))
                        start = followed(machine, start, each[at:at + size])
                        at += size
                    item += count
                yield pa.RecordBatch.from_arrays([*[column.take(pa.array(owners, pa.int64())) for column in _keys(batch)], numbers, pa.array(starts, kind)],
                                                 names=[*instance, "block", "start"])

    def tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for events in batch.column("events"):
                columns = [events.values.field(name).to_pylist() for name in fields]
                texts.append(written(of_events(machine, zip(*columns))))
            yield pa.RecordBatch.from_arrays([*_keys(batch), batch.column("block"), pa.array(texts, pa.string())], names=[*instance, "block", "does"])

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for items in batch.column("items"):
                parts = (Block(text) for text in items.values.field("does").to_pylist())
                texts.append(written(of_blocks(machine, parts)))
            yield pa.RecordBatch.from_arrays([*_keys(batch), batch.column("stretch"), pa.array(texts, pa.string())], names=[*instance, "stretch", "does"])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, start = None, first(machine)
        for batch in batches:
            starts = []
            for one, other, text in zip(*(column.to_pylist() for column in (*_keys(batch), batch.column("does")))):
                if (one, other) != now:
                    now, start = (one, other), first(machine)
                starts.append(json.dumps(start))
                start = after(machine, start, Block(text))
            yield pa.RecordBatch.from_arrays([*_keys(batch), batch.column("stretch"), pa.array(starts, pa.string())], names=[*instance, "stretch", "start"])

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, numbers, starts = tuple(json.loads(batch.column("start")[i].as_py())), [], []
                items = batch.column("items")[i].values
                for number, text in zip(items.field("block").to_pylist(), items.field("does").to_pylist()):
                    numbers.append(number)
                    starts.append(as_start(start))
                    start = after(machine, start, Block(text))
                same = [pa.array([column[i].as_py()] * len(numbers), column.type) for column in _keys(batch)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(numbers, pa.int64()), pa.array(starts, kind)], names=[*instance, "block", "start"])

    slim = F.transform("events", lambda e: F.struct(
        e["seq"].alias("seq"), e["event_type"].alias("event_type"), e["expected_version"].cast("int").alias("expected_version"),
        e["target_state"].alias("target_state"), is_blank(e["override_reason"]).alias("blank")))
    late = blocks.filter(F.col("block") >= width).select(*instance).distinct()
    short = blocks.join(late, instance, "left_anti").select(*instance, "block", slim.alias("events")).groupBy(*instance).agg(
        F.sort_array(F.collect_list(F.struct("block", "events"))).alias("items")).mapInArrow(walked, f"{key}, block long, start {START}")
    long = join_hot(blocks, late, instance, "left_semi")
    tables = long.select(*instance, "block", slim.alias("events")).mapInArrow(tabled, f"{key}, block long, does string")
    stretches = tables.groupBy(*instance, F.floor(F.col("block") / width).alias("stretch")).agg(
        F.sort_array(F.collect_list(F.struct("block", "does"))).alias("items"))
    whole = stretches.mapInArrow(composed, f"{key}, stretch long, does string")
    starts = whole.repartition(*instance).sortWithinPartitions(*instance, "stretch").mapInArrow(chained, f"{key}, stretch long, start string")
    return stretches.join(starts, [*instance, "stretch"]).select(*instance, "items", "start").mapInArrow(
        opened, f"{key}, block long, start {START}").unionByName(short)
