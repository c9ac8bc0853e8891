"""Streams whose rows come late and out of order: histories that are mended, and the last row per key.

Both keep state per key in event time. A row may come as late as the watermark's delay; what came before
is emitted again when it changes, so results are upserts: ``write_batches`` puts each micro-batch
into a folder of its own (a repeated batch overwrites itself) and ``latest`` reads the last version
of each key. A key without rows for ``idle`` of event time is forgotten by a timer. Times up to 1970 count
as passed from the start.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from threadloom import constants as K
from threadloom.operators import context

HISTORY = "conv_id long, turn long, revision long, history string"


def millis(at: pd.Series) -> pd.Series:
    """Timestamps as milliseconds since 1970."""
    return at.astype("datetime64[ms]").astype("int64")


class _Idle(StatefulProcessor):
    """A key is forgotten when the watermark passes its newest row by ``idle`` milliseconds.

    The newest row's time and what else is known of a key are one value; the timer stays where the first row
    set it, and moves on when it expires. So a key costs few calls to the state store.
    """

    idle: int
    known = "at long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.known)

    def active(self, held: tuple | None, at: int, *more: int) -> None:
        """Keep the newest row's time, and ``more``."""
        value = (at if held is None else max(held[0], at), *more)
        if held is None or tuple(held) != value:
            self.newest.update(value)
        if held is None:
            self.handle.registerTimer(value[0] + self.idle)

    def forget(self) -> None:
        self.newest.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.newest.get()
        if held is not None and held[0] + self.idle > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(held[0] + self.idle)
        else:
            self.forget()
        return iter(())

    def close(self) -> None:
        pass


def histories(turns: list[tuple[int, str, str]], changed: set[int], limit: int) -> Iterator[tuple[int, str]]:
    """(turn, history) of the user messages that a change of some turns reaches.

    ``turns`` are (turn, role, line) in the order of turns; the first ``limit`` of them need not
    have a whole history before them if nothing there has changed.
    """
    since = limit + 1  # messages since the last change
    for k, (turn, role, _) in enumerate(turns):
        if role == "user" and (since <= limit or turn in changed):
            yield turn, "\n".join(line for _, _, line in turns[max(0, k - limit) : k])
        since = 1 if turn in changed else since + 1


class LateHistory(_Idle):
    """The last ``limit`` lines before each user message, mended when an earlier turn comes late.

    The state holds the messages that the watermark has not passed, and the newest ``limit`` before
    them. Turns must rise with event time. A turn that comes again replaces the first.
    """

    known = "at long, revision long"

    def __init__(self, idle: int, limit: int = 2 * K.MAX_TURNS):
        self.idle, self.limit = idle, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.messages = handle.getMapState("messages", "turn long", "at long, role string, line string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {turn: tuple(value) for (turn,), value in self.messages.iterator()}
        before, changed = dict(held), set()
        for frame in rows:
            for turn, at, role, line in zip(frame["turn"].tolist(), millis(frame["at"]).tolist(), frame["role"], frame["line"], strict=True):
                if held.get(turn) != (at, role, line):
                    held[turn] = (at, role, line)
                    changed.add(turn)
        if not changed:
            return
        ordered = sorted(held)
        known = self.newest.get()
        n = 1 if known is None else known[1] + 1
        found = list(histories([(t, *held[t][1:]) for t in ordered], changed, self.limit))
        passed = [t for t in ordered if held[t][0] <= timerValues.getCurrentWatermarkInMs()]
        gone = set(passed[: max(0, len(passed) - self.limit)])
        for turn in changed - gone:
            self.messages.updateValue((turn,), held[turn])
        for turn in gone & set(before):
            self.messages.removeKey((turn,))
        self.active(known, max(held[t][0] for t in changed), n)
        yield pd.DataFrame([(key[0], t, n, h) for t, h in found], columns=["conv_id", "turn", "revision", "history"])

    def forget(self) -> None:
        super().forget()
        self.messages.clear()


def late_history_stream(messages: DataFrame, at: str, delay: str, idle_seconds: int) -> DataFrame:
    """(conv_id, turn, revision, history) per user message, again when a late turn changes it.

    ``at`` is the event time of a message; rows later than ``delay`` are dropped. Needs the RocksDB state store.
    """
    timed = messages.withColumn("at", F.col(at)).withWatermark("at", delay)
    rows = context.dialogue(timed).select(
        "conv_id", "turn", "at", "role", context.prompts.message_line("role", "text").alias("line")
    )
    return rows.groupBy("conv_id").transformWithStateInPandas(
        statefulProcessor=LateHistory(idle_seconds * 1000), outputStructType=HISTORY, outputMode="Update", timeMode="EventTime"
    )


class LatestRow(_Idle):
    """Passes a row on if its position is above all of its key before."""

    known = "at long, position long"

    def __init__(self, idle: int, position: str):
        self.idle, self.position = idle, position

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.newest.get()
        best, newest, top = None, None, None if held is None else held[1]
        for frame in rows:
            seen = int(frame["at"].to_numpy().max().astype("datetime64[ms]").astype("int64"))
            newest = seen if newest is None else max(newest, seen)
            positions = frame[self.position].to_numpy()
            k = int(positions.argmax())
            if top is None or positions[k] > top:
                best, top = frame.iloc[k : k + 1], int(positions[k])
        if newest is not None:
            self.active(held, newest, top)
        if best is not None:
            yield best.drop(columns="at")


def latest_rows_stream(rows: DataFrame, key: str, position: str, at: str, delay: str, idle_seconds: int) -> DataFrame:
    """The rows of a stream that are the last of their key so far, by an integer position.

    Positions must rise with event time for keys that come again after ``idle_seconds``. Rows
    without a key, a position or a time are left out.
    """
    timed = rows.where(F.col(key).isNotNull() & F.col(position).isNotNull() & F.col(at).isNotNull())
    timed = timed.withColumn("at", F.col(at)).withWatermark("at", delay)
    schema = T.StructType([f for f in rows.schema.fields if f.name != "at"])
    return timed.groupBy(key).transformWithStateInPandas(
        statefulProcessor=LatestRow(idle_seconds * 1000, position), outputStructType=schema, outputMode="Update", timeMode="EventTime"
    )


def write_batches(stream: DataFrame, path: str) -> DataStreamWriter:
    """The writer of a stream of upserts: one folder per micro-batch, which a repeated batch overwrites."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return stream.writeStream.outputMode("update").foreachBatch(write)


def latest(spark: SparkSession, path: str, *key: str, version: str) -> DataFrame:
    """The last version of each key among the batches at ``path``."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c not in (*key, "batch")]
    last = F.max_by(F.struct(*columns), F.struct("batch", version))
    return rows.groupBy(*key).agg(last.alias("last")).select(*key, "last.*")
