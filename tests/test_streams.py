import datetime

import pandas as pd
import pyspark.sql
import pytest
from conftest import got, one
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from test_workflow import EVENTS, event, random_events, transitions  # noqa: F401

from ledgerloom.operators import migrate, projections, workflow
from ledgerloom.sources import sinks
from ledgerloom.sources.streams import read_event_stream
from ledgerloom.streaming import projection, replay
from ledgerloom.streaming.replay import ReplayProcessor, RowReplay, stream_replay

KEYS = projections.SUMMARY_KEYS


def drain(stream, spark, folder):
    run = (
        stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@pytest.mark.parametrize("versions", [False, True])
def test_stream_replay_equals_batch_whatever_the_order(make, spark, tmp_path, transitions, versions):  # noqa: F811
    events = random_events(11, versions)
    whole = make(EVENTS, *events)
    # Three deliveries: the late events first, some of them again at the end.
    for part in (events[1::2], events[0::2], events[::5]):
        make(EVENTS, *part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = read_event_stream(spark, f"{tmp_path}/in", whole.schema, max_files=1)
    streamed = drain(stream_replay(stream, transitions), spark, tmp_path)
    batch = workflow.replay(whole.unionByName(make(EVENTS, *events[::5])), transitions)
    batch = batch.withColumn("ts", batch.ts.cast("timestamp"))
    assert got(streamed.select(batch.columns)) == got(batch)


def test_read_model_ignores_replays_and_late_rows(make, spark, tmp_path):
    schema = "workflow_name string, instance_id int, current_state string, version int"
    path = f"{tmp_path}/rm"
    new, old = make(schema, ("w", 1, "B", 2), ("w", 2, "A", 1)), make(schema, ("w", 1, "A", 1), ("w", 3, "A", 1))
    for batch_id, batch in [(0, new), (1, old), (1, old), (0, new)]:
        sinks.upsert_read_model(batch, batch_id, path, KEYS, "version")
    expected = [("w", 1, "B", 2), ("w", 2, "A", 1), ("w", 3, "A", 1)]
    assert got(sinks.read_model(spark, path, KEYS, "version").select(new.columns)) == expected
    assert sinks.compact_read_model(spark, path, KEYS, "version")
    assert got(sinks.read_model(spark, path, KEYS, "version").select(new.columns)) == expected


def test_read_model_generations(make, spark, tmp_path):
    schema = "workflow_name string, instance_id int, current_state string, version int"
    path = f"{tmp_path}/rm"
    write = lambda batch_id, *rows: sinks.upsert_read_model(make(schema, *rows), batch_id, path, KEYS, "version")
    read = lambda: sinks.read_model(spark, path, KEYS, "version").select(make(schema).columns)
    with pytest.raises(FileNotFoundError):
        read()
    write(0, ("w", 1, "A", 1))
    write(2, ("w", 2, "A", 1))
    before = read()
    assert sinks.compact_read_model(spark, path, KEYS, "version")
    write(1, ("w", 1, "B", 2))  # an id between those folded is a batch of its own
    write(2, ("w", 2, "Z", 9))  # one that was folded comes again
    write(3, ("w", 3, "A", 1))
    # Somebody who began to read before the switch still sees what there was.
    assert got(before) == [("w", 1, "A", 1), ("w", 2, "A", 1)]
    expected = [("w", 1, "B", 2), ("w", 2, "A", 1), ("w", 3, "A", 1)]
    assert got(read()) == expected
    sinks.vacuum_read_model(spark, path, 3600)
    assert got(before) == [("w", 1, "A", 1), ("w", 2, "A", 1)]
    assert sinks.compact_read_model(spark, path, KEYS, "version")
    sinks.vacuum_read_model(spark, path, 0)
    assert got(read()) == expected
    names = lambda folder: [p.name for p in (tmp_path / "rm" / folder).iterdir() if not p.name.startswith(".")]
    assert len(names("generations")) == 1 and names("batches/main") == [] and len(names("manifests")) == 1


def test_of_two_compactions_one_wins(make, spark, tmp_path, monkeypatch):
    schema, path = "workflow_name string, instance_id int, version int", f"{tmp_path}/rm"
    sinks.upsert_read_model(make(schema, ("w", 1, 1)), 0, path, KEYS, "version")
    real, once = sinks._merged, []

    def slow(*args):
        found = real(*args)
        if not once:
            once.append(1)
            assert sinks.compact_read_model(spark, path, KEYS, "version")
            sinks.upsert_read_model(make(schema, ("w", 2, 1)), 1, path, KEYS, "version")
        return found

    monkeypatch.setattr(sinks, "_merged", slow)
    assert not sinks.compact_read_model(spark, path, KEYS, "version")
    assert got(sinks.read_model(spark, path, KEYS, "version").select("instance_id")) == [(1,), (2,)]


def test_a_stream_goes_on_across_compactions(make, spark, tables, tmp_path):
    log = workflow.applied(workflow.replay(tables["workflow_event"], tables["transition"]))
    log.repartitionByRange(7, "event_id").write.parquet(f"{tmp_path}/log")
    stored = spark.read.parquet(f"{tmp_path}/log")
    stream = read_event_stream(spark, f"{tmp_path}/log", stored.schema, max_files=1)
    projection.stream_instance_summary(stream, f"{tmp_path}/rm", f"{tmp_path}/state", compact_every=2, keep_seconds=0).awaitTermination()
    kept = sinks.read_model(spark, f"{tmp_path}/rm", KEYS, "version")
    rebuilt = projections.rebuild(stored.withColumn("ts", stored.ts.cast("timestamp")))
    assert one(migrate.same_rows(kept.select(rebuilt.columns), rebuilt))["same"]
    folders = [p for p in (tmp_path / "rm").glob("*/*") if not p.name.startswith(".") and p.parent.name in ("batches", "generations")]
    assert len([p for p in folders if p.parent.name == "generations"]) <= 2


def test_streamed_projection_equals_rebuild(spark, tables, tmp_path):
    log = workflow.applied(workflow.replay(tables["workflow_event"], tables["transition"]))
    log.repartitionByRange(3, "event_id").write.parquet(f"{tmp_path}/log")
    stored = spark.read.parquet(f"{tmp_path}/log")
    stream = read_event_stream(spark, f"{tmp_path}/log", stored.schema, max_files=1)
    projection.stream_instance_summary(stream, f"{tmp_path}/rm", f"{tmp_path}/state").awaitTermination()
    kept = sinks.read_model(spark, f"{tmp_path}/rm", KEYS, "version")
    rebuilt = projections.rebuild(stored.withColumn("ts", stored.ts.cast("timestamp")))
    assert one(migrate.same_rows(kept.select(rebuilt.columns), rebuilt))["same"]


def test_stream_dedupe(make, spark, tmp_path):
    make(EVENTS, event(1, 1, "a", key="x"), event(1, 2, "a", key="x")).coalesce(1).write.parquet(f"{tmp_path}/in")
    make(EVENTS, event(1, 3, "a", key="x"), event(2, 1, "a", key="x")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = read_event_stream(spark, f"{tmp_path}/in", make(EVENTS).schema, max_files=1)
    assert got(drain(projection.stream_dedupe(stream), spark, tmp_path).select("instance_id", "idempotency_key")) == [(1, "x"), (2, "x")]


def test_event_time_is_a_timestamp(make, spark, tmp_path):
    make("ts timestamp_ntz, v int", (datetime.datetime(2024, 1, 1), 1)).write.parquet(f"{tmp_path}/in")
    stream = read_event_stream(spark, f"{tmp_path}/in", "ts timestamp_ntz, v int")
    assert stream.isStreaming and dict(stream.dtypes)["ts"] == "timestamp"


class Value:
    """A value state in memory."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Map:
    """A map state in memory that counts what is asked of it."""

    def __init__(self):
        self.values, self.calls, self.bytes = {}, 0, 0

    def containsKey(self, key):
        self.calls += 1
        return key in self.values

    def getValue(self, key):
        self.calls += 1
        return self.values[key]

    def updateValue(self, key, value):
        self.calls += 1
        self.bytes += len(repr(value))
        self.values[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self.values[key]

    def keys(self):
        return iter(list(self.values))


class Handle:
    def __init__(self):
        self.maps, self.timers = {}, set()

    def getValueState(self, name, schema):
        return Value()

    def getMapState(self, name, keys, values, ttl=None):
        return self.maps.setdefault(name, Map())

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def processor(transitions, **more):  # noqa: F811
    made = ReplayProcessor(workflow.definition(transitions), "DraftScope", None, more.get("gap_ms"), False)
    made.init(Handle())
    return made


def frames(events, size=5000):
    names = [field.split()[0] for field in EVENTS.split(", ")]
    for k in range(0, len(events), size):
        yield pd.DataFrame(events[k:k + size], columns=names)


def outcomes(batches):
    return [tuple(None if pd.isna(v) else v for v in row) for frame in batches for row in frame[["seq", "outcome", "version"]].itertuples(index=False)]


@pytest.mark.parametrize("held", [100, 50_000])
def test_one_instance_costs_in_proportion(transitions, monkeypatch, held):  # noqa: F811
    """What the state is asked, and what is written to it, follows the events, though all come in the wrong order."""
    monkeypatch.setattr(replay, "HELD_EVENTS", held)
    cost = {}
    for count in (2_000, 8_000):
        events = [event(1, seq, "EstimateUpdated") for seq in range(count, 0, -1)]
        made = processor(transitions)
        first = outcomes(made.handleInputRows(("w", 1), frames(events[:-1], 500), TimerValues(0, 0)))
        assert first == []
        rows = outcomes(made.handleInputRows(("w", 1), frames(events[-1:]), TimerValues(0, 0)))
        assert [r[0] for r in rows] == list(range(1, count + 1))
        cost[count] = sum(m.calls for m in made.handle.maps.values()), sum(m.bytes for m in made.handle.maps.values())
    assert all(big < 4.2 * small for small, big in zip(cost[2_000], cost[8_000]))


def test_lost_numbers_are_given_up(transitions):  # noqa: F811
    made = processor(transitions, gap_ms=1000)
    events = [event(1, seq, kind) for seq, kind in ((1, "ScopeDefined"), (4, "QuoteIssued"), (5, "EstimateUpdated"), (9, "QuoteIssued"))]
    assert [r[:2] for r in outcomes(made.handleInputRows(("w", 1), frames(events[:3]), TimerValues(100, 0)))] == [(1, "applied")]
    assert made.handle.timers == {1100}
    assert outcomes(made.handleInputRows(("w", 1), frames(events[3:]), TimerValues(600, 0))) == []
    assert made.handle.timers == {1100}
    assert outcomes(made.handleExpiredTimer(("w", 1), TimerValues(1200, 0), ExpiredTimerInfo(999))) == []
    rows = outcomes(made.handleExpiredTimer(("w", 1), TimerValues(1200, 0), ExpiredTimerInfo(1100)))
    assert [r[:2] for r in rows] == [(2, "gap"), (4, "applied"), (5, "no_transition")]
    # The next missing number has its own time.
    later = max(made.handle.timers)
    rows = outcomes(made.handleExpiredTimer(("w", 1), TimerValues(later, 0), ExpiredTimerInfo(later)))
    assert [r[:2] for r in rows] == [(6, "gap"), (9, "no_transition")] and made.waiting == 0


def test_gap_in_a_stream(make, spark, tmp_path, transitions):  # noqa: F811
    """By event time: a number is given up when the watermark has passed it by."""
    schema = make(EVENTS).schema
    make(EVENTS, event(1, 1, "ScopeDefined"), event(1, 3, "QuoteIssued")).coalesce(1).write.parquet(f"{tmp_path}/in")
    make(EVENTS, event(2, 60, "ScopeDefined")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    events = read_event_stream(spark, f"{tmp_path}/in", schema, max_files=1).withWatermark("ts", "0 seconds")
    found = got(drain(stream_replay(events, transitions, gap_ms=600_000, event_time=True), spark, tmp_path).select("instance_id", "seq", "outcome"))
    # The other instance lacks all numbers before its first; one row stands for the run.
    assert found == [(1, 1, "applied"), (1, 2, "gap"), (1, 3, "applied"), (2, 1, "gap"), (2, 60, "applied")]


def test_events_without_a_number_hold_nobody_back(make, spark, tmp_path, transitions):  # noqa: F811
    events = [event(1, i + 1, kind) for i, kind in enumerate(["ScopeDefined", "QuoteIssued", "CustomerPOAttached"])]
    bare = [tuple(seq if i == 2 else v for i, v in enumerate(event(1, 700 + k, "Closed"))) for k, seq in enumerate((None, 0))]
    whole = make(EVENTS, bare[0], *events, bare[1])
    whole.coalesce(1).write.parquet(f"{tmp_path}/in")
    streamed = drain(stream_replay(read_event_stream(spark, f"{tmp_path}/in", whole.schema), transitions), spark, tmp_path)
    batch = workflow.replay(whole, transitions)
    assert got(streamed.select(batch.columns)) == got(batch.withColumn("ts", batch.ts.cast("timestamp")))


def test_short_instances_ask_the_state_little(transitions):  # noqa: F811
    """A write for each key, and a look at the keys there are; rows come and go as rows."""
    made = RowReplay(workflow.definition(transitions), "DraftScope", None, None, False)
    made.init(Handle())
    names = [field.split()[0] for field in EVENTS.split(", ")]
    row = lambda *at: pyspark.sql.Row(*names)(*[v.value // 1000 if isinstance(v, pd.Timestamp) else v for v in event(*at)])
    events = [row(1, seq, "EstimateUpdated") for seq in range(1, 15)]
    results = made.handle.maps["results"]
    first = list(made.handleInputRows(("w", 1), iter(events[:7]), TimerValues(0, 0)))
    assert results.calls == 7 and made.handle.maps["early"].calls == 0
    second = list(made.handleInputRows(("w", 1), iter(events[7:]), TimerValues(0, 0)))
    assert results.calls == 14 and [r.seq for r in first + second] == list(range(1, 15))
    again = list(made.handleInputRows(("w", 1), iter(events[:3]), TimerValues(0, 0)))
    assert [r.outcome for r in again] == ["duplicate"] * 3
