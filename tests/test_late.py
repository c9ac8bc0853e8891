"""Late and unordered rows: the stream ends where the batch does, and forgets idle keys."""

import random
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadloom.operators import context, pairs
from threadloom.streaming import late, streams

MESSAGES = "conv_id long, turn long, role string, text string, sent timestamp"


def files(spark, batches, schema):
    """One file per micro-batch."""
    folder = tempfile.mkdtemp(prefix="threadloom-test-")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    return stream, folder


def run(stream, folder):
    writer = late.write_batches(stream, f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(180)
    return query


def message(conv, turn, role=None, text=None, at=None):
    sent = pd.Timestamp(1_700_000_000 + 60 * (turn if at is None else at), unit="s").to_pydatetime()
    return (conv, turn, role or ("user" if turn % 2 == 0 else "assistant"), text or f"t{conv}.{turn}", sent)


def batch_histories(spark, rows):
    found = context.last_n_history(context.dialogue(spark.createDataFrame(rows, MESSAGES)))
    return sorted((r.conv_id, r.turn, r.ctx) for r in found.collect())


def stream_histories(spark, folder):
    found = late.latest(spark, f"{folder}/out", "conv_id", "turn", version="revision")
    return sorted((r.conv_id, r.turn, r.history) for r in found.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_gives_the_batch(spark, seed):
    rng = random.Random(seed)
    rows = [message(c, t, rng.choice(["user", "assistant", "system"])) for c in range(6) for t in range(rng.randint(1, 40))]
    shuffled = rng.sample(rows, len(rows))
    size = len(rows) // 5 + 1
    stream, folder = files(spark, [shuffled[i : i + size] for i in range(0, len(rows), size)], MESSAGES)
    run(late.late_history_stream(stream, "sent", "1 day", 86_400), folder)
    assert stream_histories(spark, folder) == batch_histories(spark, rows)


def test_changed_turns_and_rows_too_late(spark):
    """A turn that comes again replaces the first and mends what follows; what the watermark has passed is dropped."""
    first = [message(1, t) for t in range(0, 200)]
    again = [message(1, 195, text="changed"), message(1, 200)]
    stale = [message(1, 20, text="too late"), message(1, 201), message(1, 202)]
    stream, folder = files(spark, [first, again, stale], MESSAGES)
    query = run(late.late_history_stream(stream, "sent", "30 minutes", 864_000), folder)
    kept = {t: m for t, m in enumerate(first)} | {195: again[0], 200: again[1], 201: stale[1], 202: stale[2]}
    assert stream_histories(spark, folder) == batch_histories(spark, list(kept.values()))
    # the state is the delay's messages and ten before, not the whole conversation
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(rows) >= 200 and rows[-1] < 60


def test_idle_conversations_are_forgotten(spark):
    old = [message(c, t) for c in range(20) for t in range(4)]
    stream, folder = files(spark, [old, [message(99, 0, at=10_000)], [message(99, 2, at=20_000)]], MESSAGES)
    query = run(late.late_history_stream(stream, "sent", "10 minutes", 3600), folder)
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(rows) >= 80 and rows[-1] <= 12
    assert len(stream_histories(spark, folder)) == 20 * 2 + 2


def test_histories_after_a_change():
    turns = [(t, "user" if t % 3 == 0 else "assistant", f"l{t}") for t in range(12)]
    whole = dict(late.histories(turns, set(range(12)), 4))
    assert whole[0] == "" and whole[9] == "l5\nl6\nl7\nl8"
    assert dict(late.histories(turns, {5}, 4)) == {t: whole[t] for t in (6, 9)}
    assert dict(late.histories(turns, {3}, 4)) == {t: whole[t] for t in (3, 6)}


def test_last_row_per_key(spark):
    schema = "k long, n long, v string, seen timestamp"
    rng = random.Random(3)
    rows = [(i % 7, i, f"v{i}", pd.Timestamp(i * 1000, unit="s").to_pydatetime()) for i in range(200)]
    odd = [(None, 1, "x", rows[0][3]), (1, None, "x", rows[0][3]), (1, 1, "x", None)]
    shuffled = rng.sample(rows + odd, 203)
    stream, folder = files(spark, [shuffled[:80], shuffled[80:120], shuffled[120:]], schema)
    run(late.latest_rows_stream(stream, "k", "n", "seen", "30 days", 86_400), folder)
    got = late.latest(spark, f"{folder}/out", "k", version="n")
    want = pairs.latest_by_id(spark.createDataFrame(rows, schema), "k", "n")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_a_repeated_batch_overwrites_itself(spark):
    path = tempfile.mkdtemp(prefix="threadloom-test-")
    rows = spark.createDataFrame([(1, 5, "a"), (2, 1, "b")], "k int, n int, v string")
    for _ in range(2):
        rows.write.mode("overwrite").parquet(f"{path}/batch=0")
    rows.where("k = 1").select("k", F.lit(4).alias("n"), F.lit("late").alias("v")).write.parquet(f"{path}/batch=1")
    got = {r.k: r.v for r in late.latest(spark, path, "k", version="n").collect()}
    assert got == {1: "late", 2: "b"}  # the later batch wins


def test_rocksdb_is_asked_for(spark):
    streams.keep_state_in_rocksdb(spark)
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


class Handle:
    """A state store of one key that counts the calls to it."""

    def __init__(self):
        self.calls, self.value, self.timers, self.turns = 0, None, set(), {}

    def called(self):
        self.calls += 1

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, *schema):
        return Turns(self)

    def exists(self):
        self.called()
        return self.value is not None

    def get(self):
        self.called()
        return self.value

    def update(self, value):
        self.called()
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.called()
        self.timers.add(at)

    def deleteTimer(self, at):
        self.called()
        self.timers.remove(at)


class Turns:
    def __init__(self, handle):
        self.handle = handle

    def iterator(self):
        self.handle.called()
        return iter(self.handle.turns.items())

    def updateValue(self, key, value):
        self.handle.called()
        self.handle.turns[key] = value

    def clear(self):
        self.handle.turns.clear()


class Watermark:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


def test_a_key_costs_few_state_calls_and_its_timer_moves_on():
    frame = pd.DataFrame({"at": pd.to_datetime([3000, 5000], unit="ms"), "p": [7, 9]})
    row, handle = late.LatestRow(100, "p"), Handle()
    row.init(handle)
    assert [r["p"].tolist() for r in row.handleInputRows((1,), iter([frame]), None)] == [[9]]
    assert handle.calls <= 3 and handle.timers == {5100}
    handle.calls, later = 0, frame.assign(p=[8, 9], at=pd.to_datetime([6000, 4000], unit="ms"))
    assert not list(row.handleInputRows((1,), iter([later]), None)) and handle.calls <= 2
    handle.timers.clear()
    list(row.handleExpiredTimer((1,), Watermark(5100), None))
    assert handle.timers == {6100} and handle.value is not None
    list(row.handleExpiredTimer((1,), Watermark(6100), None))
    assert handle.value is None


def test_a_history_costs_few_state_calls():
    frame = pd.DataFrame({"turn": [1, 2], "at": pd.to_datetime([3000, 5000], unit="ms"), "role": ["user", "user"], "line": ["a", "b"]})
    history, handle = late.LateHistory(100, 4), Handle()
    history.init(handle)
    out = pd.concat(history.handleInputRows((1,), iter([frame]), Watermark(0)))
    assert out["history"].tolist() == ["", "a"] and out["revision"].tolist() == [1, 1]
    assert handle.calls <= 6 and handle.timers == {5100}
    list(history.handleExpiredTimer((1,), Watermark(5100), None))
    assert handle.value is None and not handle.turns
