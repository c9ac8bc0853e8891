"""Streams give the same rows as the batch operators."""

import tempfile

from pyspark.sql import functions as F

from threadloom.catalog import views as V
from threadloom.operators import admit, clean, context, language
from threadloom.streaming import streams


def as_files(df, files):
    """Write rows as one file per batch, in order, and give the folder."""
    folder = tempfile.mkdtemp(prefix="threadloom-test-")
    for part in files:
        df.where(part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return f"{folder}/in", folder


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run_to_table(stream, folder, mode="append"):
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/cp")
        .option("path", f"{folder}/out")
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    return f"{folder}/out"


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_stream_clean(spark, sf):
    comments = V.comments(spark, sf)
    path, folder = as_files(comments, ["pos % 3 = 0", "pos % 3 = 1", "pos % 3 = 2"])
    out = run_to_table(streams.clean_ascii_stream(stream_of(spark, path, comments.schema)), folder)
    batch = clean.clean_comments(admit.admit_ascii_comments(comments))
    assert rows_of(spark.read.parquet(out)) == rows_of(batch)


def test_stream_clean_with_model(spark, sf):
    comments = V.comments(spark, sf)
    model = language.fit(V.table(spark, sf, "documents"), "text", "lang", ["de", "en", "es", "fr"])
    path, folder = as_files(comments, ["pos % 2 = 0", "pos % 2 = 1"])

    def write(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    writer = streams.clean_each_batch(stream_of(spark, path, comments.schema), model, write)
    writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination(120)
    batch = clean.clean_comments(admit.admit_comments(comments, model))
    assert rows_of(spark.read.parquet(f"{folder}/out").drop("batch")) == rows_of(batch)


def test_stream_route(spark, sf):
    rows = V.labelled(spark, sf).select("conv_id", "turn", "label")
    path, folder = as_files(rows, ["turn < 2", "turn >= 2"])
    out = run_to_table(streams.route_stream(stream_of(spark, path, rows.schema), "label"), folder)
    assert rows_of(spark.read.parquet(out)) == rows_of(context.route_prompt(rows, "label"))


def test_stream_history(spark, sf):
    messages = V.table(spark, sf, "conversations")
    path, folder = as_files(messages, ["turn < 2", "turn in (2, 3)", "turn > 3"])
    out = run_to_table(streams.history_stream(stream_of(spark, path, messages.schema)), folder)
    batch = context.last_n_history(context.dialogue(messages)).withColumnRenamed("ctx", "history")
    assert rows_of(spark.read.parquet(out)) == rows_of(batch.select("conv_id", "turn", "history"))


def test_frames_are_put_in_order_one_at_a_time():
    import pandas as pd

    frames = [pd.DataFrame({"turn": t}) for t in ([0, 1], [3, 2], [9, 5], [7, 8], [10])]
    held = [f["turn"].tolist() for f in streams.in_turn_order(iter(frames))]
    assert held == [[0, 1], [2, 3], [5, 7, 8, 9], [10]]


def test_views_are_whole(spark, sf):
    documents = V.table(spark, sf, "documents")
    lines = documents.select(F.sum(F.size(F.split("text", "\n"))).alias("n")).first()["n"]
    assert V.comments(spark, sf).count() == lines
