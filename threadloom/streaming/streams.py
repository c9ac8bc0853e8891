"""The stateless operators over streams, and the rolling history as keyed state."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from threadloom import constants as K
from threadloom.operators import admit, clean, context

HISTORY_OUTPUT = "conv_id long, turn long, history string"


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Run a stream over what its source holds now, and wait for it."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Keyed state with timers and maps needs this store."""
    store = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", store)


def clean_ascii_stream(comments: DataFrame) -> DataFrame:
    """Admission of ASCII texts and cleaning; the same functions as in batch."""
    return clean.clean_comments(admit.admit_ascii_comments(comments))


def clean_each_batch(
    comments: DataFrame, model, write: Callable[[DataFrame, int], None]
):
    """Admission with the language model and cleaning, micro-batch by micro-batch.

    ``write(rows, batch_id)`` must be idempotent per batch id. Returns the stream writer.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write(clean.clean_comments(admit.admit_comments(batch, model)), batch_id)

    return comments.writeStream.foreachBatch(run)


def route_stream(messages: DataFrame, label: str) -> DataFrame:
    """Route, temperatures and prompts per message."""
    return context.route_prompt(messages, label)


def in_turn_order(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames sorted by turn; a frame is held back until the next one starts after it."""
    held = None
    for frame in frames:
        if held is not None and frame["turn"].min() > held["turn"].iloc[-1]:
            yield held
            held = None
        held = pd.concat([held, frame] if held is not None else [frame]).sort_values("turn")
    if held is not None:
        yield held


class RollingHistory(StatefulProcessor):
    """Keeps the last messages of a conversation and emits the history at each user message.

    The state is a list of at most ``2 * MAX_TURNS`` lines, however long a conversation is.
    The rows of a key come in frames of bounded size. They are put in the order of turns
    frame by frame; only when a frame begins before the end of the one before it, the two
    are merged. So messages that arrive in order, as a log does, are held one frame at a time.
    """

    def __init__(self, limit: int = 2 * K.MAX_TURNS):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lines = handle.getListState("lines", "line string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        lines = [line for (line,) in self.lines.get()]
        for messages in in_turn_order(rows):
            out = []
            for turn, role, line in zip(messages["turn"], messages["role"], messages["line"]):
                if role == "user":
                    out.append((key[0], turn, "\n".join(lines)))
                lines = [*lines, line][-self.limit :]
            yield pd.DataFrame(out, columns=["conv_id", "turn", "history"])
        self.lines.put([(line,) for line in lines])

    def close(self) -> None:
        pass


def history_stream(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, history) per user message; needs the RocksDB state store.

    Messages of a conversation must arrive in turn order from batch to batch.
    """
    rows = context.dialogue(messages).select(
        "conv_id", "turn", "role", context.prompts.message_line("role", "text").alias("line")
    )
    return rows.groupBy("conv_id").transformWithStateInPandas(
        statefulProcessor=RollingHistory(),
        outputStructType=HISTORY_OUTPUT,
        outputMode="Append",
        timeMode="None",
    )
