"""W5 on a stream: rows out of order get the batch form's answer."""

import random
import time

import pandas as pd
import pytest
from pyspark.sql.streaming.stateful_processor import TimerValues

from cursorlake.operators.active_shape import active_shape_single_window
from cursorlake.session import work_dir
from cursorlake.streaming.active_shape_ordered import ActiveShape, active_shape_in_order
from cursorlake.streaming.ingest import await_all

SCHEMA = "who string, event_id long, timestamp long, event_type string, shape_id string, note string"
T0 = 1704067200000


def _run(spark, deliveries, **options):
    """One available-now run per delivery; rows written, and the checkpoint."""
    d = work_dir(spark, "w5")
    for rows in deliveries:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(d + "/in")
        stream = active_shape_in_order(spark.readStream.schema(SCHEMA).json(d + "/in"), key="who", **options)
        q = stream.writeStream.format("parquet").option("checkpointLocation", d + "/cp").trigger(availableNow=True).start(d + "/out")
        await_all([q])
        time.sleep(0.1)
    return spark.read.parquet(d + "/out"), d + "/cp"


def _rows(n, keys, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        kind = r.choice(["mousedown", "mouseup", "mousemove", "mousemove"])
        shape = r.choice(["s1", "s2", None, None]) if kind != "mousemove" else None
        out.append((r.choice(keys), i, T0 + r.randrange(20) * 30_000 + r.randrange(5), kind, shape, f"n{i}"))
    return out


TICK = ("tick", -1, T0 + 10_000_000, "mousemove", None, None)


@pytest.mark.parametrize("slice_ms", [1_000, 3_600_000])
def test_shuffled_deliveries_equal_batch(spark, slice_ms):
    """Any order within the delay, a hot key, a NULL key, ties in time; batches of
    few rows, so that slices come in several blocks."""
    rows = _rows(300, ["hot"] * 6 + ["a", None], 1)
    deliveries = [rows[i::3] for i in range(3)] + [[TICK]]
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "7")
    try:
        got, _ = _run(spark, deliveries, delay="1 hour", slice_ms=slice_ms)
    finally:
        spark.conf.set(batch, before)
    want = active_shape_single_window(spark.createDataFrame(rows, SCHEMA), key="who")
    cols = ["who", "event_id", "timestamp", "event_type", "shape_id", "note", "active_shape"]
    assert sorted(map(str, got.where("event_id >= 0").select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_state_after_clear_and_rows_behind(spark):
    """A clear leaves no active shape in state; waiting rows go once answered; a row
    behind the watermark is not answered."""
    rows = [("a", 1, T0, "mousedown", "s1", None), ("a", 2, T0 + 1, "mouseup", None, None), ("b", 3, T0, "mousedown", "s2", None)]
    behind = ("b", 4, T0 + 2, "mouseup", None, None)
    got, checkpoint = _run(spark, [rows, [TICK], [behind], [("tick", -2, T0 + 20_000_000, "mousemove", None, None)]], delay="10 seconds")
    assert {r.event_id: r.active_shape for r in got.collect()} == {1: "s1", 2: None, 3: "s2", -1: None}

    def state(name):
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()

    assert [(r.key[0], r.value.shape) for r in state("active").collect()] == [("b", "s2")]
    assert {r.key[0] for r in state("blocks").collect()} == {"tick"}


def test_rows_without_a_time(spark):
    """They are answered at once, with the state they find."""
    rows = [("a", 1, None, "mousedown", "s9", None), ("a", 2, None, "mousemove", None, None), ("a", 3, T0, "mousemove", None, None)]
    got, _ = _run(spark, [rows, [("a", 4, None, "mousemove", None, None)], [TICK]])
    assert {r.event_id: r.active_shape for r in got.where("event_id > 0").collect()} == {1: "s9", 2: "s9", 3: "s9", 4: "s9"}


class _Batches:
    """An ActiveShape with its state in plain dicts, which counts the calls."""

    def __init__(self, few_rows):
        self.calls, outer = 0, self

        class Value:
            held = None

            def get(self):
                outer.calls += 1
                return self.held

            def update(self, value):
                outer.calls += 1
                self.held = value

            def clear(self):
                self.held = None

        class Map(dict):
            def getValue(self, key):
                outer.calls += 1
                return self.get(key)

            def updateValue(self, key, value):
                outer.calls += 1
                self[key] = value

            def removeKey(self, key):
                outer.calls += 1
                del self[key]

            def iterator(self):
                outer.calls += 1
                return iter(list(self.items()))

        class Handle:
            timers = set()

            def getValueState(self, *_):
                return Value()

            def getMapState(self, *_):
                return Map()

            def registerTimer(self, at):
                outer.calls += 1
                outer.timers.add(at)

        self.timers = set()
        self.fold = ActiveShape(["timestamp", "event_id"], ["timestamp", "event_id"], "shape", 1_000, few_rows)
        self.fold.init(Handle())

    def give(self, rows):
        pdf = pd.DataFrame([(ms, i, mark, "k", None, ms) for ms, i, mark in rows])
        assert not list(self.fold.handleInputRows(("k",), iter([pdf]), None))

    def at(self, watermark):
        out = []
        for timer in sorted(t for t in self.timers if t < watermark):
            self.timers.discard(timer)
            out += self.fold.handleExpiredTimer(("k",), TimerValues(0, watermark), None)
        return [tuple(r) for pdf in out for r in pdf.itertuples(index=False)]


@pytest.mark.parametrize("few_rows", [0, 40, 5_000])
def test_blocks_of_several_slices(few_rows):
    """Rows come whole and in order at any watermark, in blocks or by slices; none stays."""
    r, got = random.Random(3), []
    rows = [(r.randrange(60_000), i, r.choice(["a", "b", "", None, None])) for i in range(400)]
    state = _Batches(few_rows)
    for turn, part in enumerate([rows[i::4] for i in range(4)]):
        state.give([x for x in part if x[0] >= turn * 5_000])
        got += state.at(turn * 5_000 + 500)
    got += state.at(100_000)
    rows = sorted(x for turn in range(4) for x in rows[turn::4] if x[0] >= turn * 5_000)
    want, shape = [], None
    for ms, i, mark in rows:
        shape = shape if mark is None else mark or None
        want.append((ms, i, shape))
    assert [(ms, i, s if isinstance(s, str) else None) for ms, i, s in got] == want
    assert not state.fold.blocks and not state.fold.waiting and not state.timers and state.fold.held.get()[0] == 0


def test_calls_to_state_follow_batches_and_not_rows():
    """A key of 300 rows in 300 slices."""
    state = _Batches(5_000)
    state.give([(i * 1_000, i, "a") for i in range(300)])
    assert len(state.at(1_000_000)) == 300 and state.calls < 30
