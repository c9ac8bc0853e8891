"""A feed-forward classifier trained by synchronous mini-batches.

ReLU layers with dropout, softmax, cross-entropy and Adam. Rows are dealt into mini-batches once, by a hash
of their key, and written; every epoch visits the batches in another order. A step reads the rows of its batch only.

A batch for a few tasks is written as one file per task's share. A job is a stretch of steps: its tasks run side by side (a barrier stage),
each sums the gradients of its shares, tells the others through the shared folder and moves its own copy of the model, which is the
same in all of them, as sums are added in the order of the shares. So a step needs no job of its own, which takes longer than the step's arithmetic.
A batch for many tasks (more than ``GANG``) is a part of a written table, and each step a job: tasks read the weights from the shared
folder, sum the gradients of their rows, and the sums are added up slice by slice, in lanes first. A task, or the
driver, holds the model and Adam's two moments, all bounded by the number of features.

Sparse rows stay sparse: the first layer's products touch the weights of the features that rows hold.

Dropout masks depend on seed, step and key of a row, so neither the partitioning nor a repeated
task changes a result (but for the rounding of sums).
"""

import time
import uuid
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import constants as K
from threadloom.session import new_stage, open_uri

SLICE = 1 << 16
FAN_IN = 64
#: Shares of a batch, at most, whose tasks add their sums among themselves.
GANG = 8
#: Steps of a job, at most; what a lost executor repeats.
STRETCH = 1024
_CHUNK = 256
#: Rows of a sparse matrix, and the share of its cells from which a dense one is faster.
_PIECE, _DENSE = 1024, 1 / 32
#: Entries of a column up to which columns are multiplied many at a time, and entries of such a time.
_FEW, _TIME = 64, 1 << 12
#: Numbers that stay in a core's cache through the operations of a move.
_CACHED = 1 << 14
_SUMS = "slice int, lane int, part int, sum binary, rows long, loss double"


@dataclass(frozen=True)
class Settings:
    """Layers, training constants, and how many rows a task takes of a batch."""

    hidden: tuple[int, ...] = tuple(K.HIDDEN_LAYERS)
    dropout: float = 0.5
    rate: float = 1e-3
    epochs: int = 10
    batch_rows: int = 128
    task_rows: int = 1024
    seed: int = 42


@dataclass(frozen=True)
class Network:
    """Weights and biases layer by layer, one vector."""

    sizes: tuple[int, ...]
    flat: np.ndarray

    def layers(self) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for a, b in zip(self.sizes[:-1], self.sizes[1:], strict=True):
            out.append((self.flat[at : at + a * b].reshape(a, b), self.flat[at + a * b : at + a * b + b]))
            at += a * b + b
        return out


def initial(sizes: tuple[int, ...], seed: int) -> Network:
    """Uniform weights within one over the root of a layer's inputs."""
    rng, parts = np.random.default_rng(seed), []
    for a, b in zip(sizes[:-1], sizes[1:], strict=True):
        parts.append(rng.uniform(-1, 1, (a + 1) * b) / np.sqrt(a))
    return Network(sizes, np.concatenate(parts))


def probabilities(network: Network, x: np.ndarray) -> np.ndarray:
    """Class probabilities of the rows of ``x``."""
    *hidden, (w, b) = network.layers()
    for v, c in hidden:
        x = np.maximum(x @ v + c, 0)
    z = x @ w + b
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def gradient(network: Network, x: np.ndarray, y: np.ndarray, masks: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """The summed gradient and loss of rows; ``masks`` scale the outputs of the hidden layers."""
    layers = network.layers()
    inputs = [x]
    for (w, b), mask in zip(layers[:-1], masks, strict=True):
        inputs.append(np.maximum(inputs[-1] @ w + b, 0) * mask)
    z = inputs[-1] @ layers[-1][0] + layers[-1][1]
    z -= z.max(1, keepdims=True)
    log = z - np.log(np.exp(z).sum(1, keepdims=True))
    loss = -float(log[np.arange(len(y)), y].sum())
    delta = np.exp(log)
    delta[np.arange(len(y)), y] -= 1
    parts = []
    for k in range(len(layers) - 1, -1, -1):
        parts += [delta.sum(0), (inputs[k].T @ delta).ravel()]
        if k:
            delta = (delta @ layers[k][0].T) * masks[k - 1] * (inputs[k] > 0)
    return np.concatenate(parts[::-1]), loss


def dropout_masks(keys: np.ndarray, step: int, settings: Settings) -> list[np.ndarray]:
    """Per hidden layer, 0 or 1 / (1 - dropout) for each row and unit."""
    width = sum(settings.hidden)
    if not settings.dropout:
        return [np.ones((len(keys), n)) for n in settings.hidden]
    drawn = np.empty((len(keys), width))
    word, bits = step << 32 | settings.seed, np.random.Philox()
    draw, fresh = np.random.Generator(bits), bits.state
    for k, key in enumerate(keys.astype(np.uint64).tolist()):
        # as Philox(key=[key, word]), which reads keys from 2**63 as floats, in a fraction of the time
        fresh["state"]["key"] = np.asarray([key, word]).astype(np.uint64)
        bits.state = fresh
        draw.random(out=drawn[k])
    kept = (drawn >= settings.dropout) / (1 - settings.dropout)
    return np.split(kept, np.cumsum(settings.hidden)[:-1], axis=1)


class Sparse:
    """A matrix by the places and values of its rows; multiplies as an array does."""

    def __init__(self, ends: np.ndarray, places: np.ndarray, values: np.ndarray, width: int):
        self.ends, self.places, self.values, self.shape = ends, places, values, (len(ends) - 1, width)
        if len(places) and not 0 <= places.min() <= places.max() < width:
            raise IndexError(f"a place outside of {width} features")

    def __len__(self) -> int:
        return self.shape[0]

    def __matmul__(self, weights: np.ndarray) -> np.ndarray:
        out, ends, places = np.empty((len(self), weights.shape[1])), self.ends.tolist(), self.places.astype(np.intp)
        held = np.empty((np.diff(self.ends).max(initial=0), weights.shape[1]))
        for k, (a, b) in enumerate(zip(ends, ends[1:])):
            weights.take(places[a:b], 0, out=held[: b - a], mode="clip")  # the places are checked
            np.dot(self.values[a:b], held[: b - a], out=out[k])
        return out

    @property
    def T(self) -> "_Turned":
        return _Turned(self)


class _Turned:
    """A sparse matrix the other way round."""

    def __init__(self, rows: Sparse):
        self.of = rows

    def __matmul__(self, delta: np.ndarray) -> np.ndarray:
        x, width = self.of, self.of.shape[1]
        order = np.argsort(x.places.astype(np.uint16) if width <= 1 << 16 else x.places, kind="stable")
        rows, values = np.repeat(np.arange(len(x)), np.diff(x.ends))[order], x.values[order]
        held = np.bincount(x.places, minlength=width)
        begin, out = np.cumsum(held) - held, np.zeros((width, delta.shape[1]))
        for k in np.flatnonzero(held > _FEW).tolist():
            a, b = begin[k], begin[k] + held[k]
            np.dot(values[a:b], delta.take(rows[a:b], 0), out=out[k])
        for n in range(1, _FEW + 1):  # columns of so many entries
            columns = np.flatnonzero(held == n)
            for at in range(0, len(columns), _TIME // n):
                some = columns[at : at + _TIME // n]
                entries = begin[some][:, None] + np.arange(n)
                out[some] = np.matmul(values[entries][:, None], delta.take(rows[entries], 0))[:, 0]
        return out


# --- files --------------------------------------------------------------------
def save(network: Network, path: str) -> None:
    """One file with the sizes and the weights."""
    system, name = open_uri(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    head = np.array([len(network.sizes), *network.sizes], "<i8").tobytes()
    with system.open_output_stream(name, compression=None) as out:
        out.write(head + network.flat.astype("<f8").tobytes())


@lru_cache(maxsize=2)
def load(path: str) -> Network:
    return _read(path)


def _read(path: str) -> Network:
    system, name = open_uri(path)
    with system.open_input_stream(name, compression=None) as file:
        data = file.read()
    n = int(np.frombuffer(data, "<i8", 1)[0])
    sizes = tuple(np.frombuffer(data, "<i8", n, 8).tolist())
    return Network(sizes, np.frombuffer(data, "<f8", offset=8 * (n + 1)).copy())


# --- training -----------------------------------------------------------------
def _sparse(features: str) -> list[Column]:
    """Places and values of a vector column; a dense vector has no places."""
    vector = F.unwrap_udt(features)
    return [vector["indices"].alias("places"), vector["values"].alias("values")]


def matrices(places: pa.Array, values: pa.Array, width: int) -> Iterator[tuple[slice, "Sparse | np.ndarray"]]:
    """Matrices of consecutive rows, from lists of places (null: the first ones) and values."""
    for at in range(0, len(values), _PIECE):
        x = _sparse_rows(places.slice(at, _PIECE), values.slice(at, _PIECE), width)
        if len(x.values) < _DENSE * width * len(x):
            yield slice(at, at + len(x)), x
            continue
        for low in range(0, len(x), _CHUNK):
            ends = x.ends[low : low + _CHUNK + 1]
            rows = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            out = np.zeros((len(ends) - 1, width))
            out[rows, x.places[ends[0] : ends[-1]]] = x.values[ends[0] : ends[-1]]
            yield slice(at + low, at + low + len(out)), out


def _sparse_rows(places: pa.Array, values: pa.Array, width: int) -> Sparse:
    if values.null_count:
        raise ValueError("null features")
    lengths = values.value_lengths().to_numpy()
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)])
    given, listed = places.flatten().to_numpy(zero_copy_only=False), places.is_valid().to_numpy(zero_copy_only=False)
    if not listed.all():
        at = np.arange(ends[-1]) - np.repeat(ends[:-1], lengths)
        at[np.repeat(listed, lengths)] = given
        given = at
    return Sparse(ends, given, values.flatten().to_numpy(zero_copy_only=False), width)


def _added_gradients(network: Network, batch: pa.RecordBatch, step: int, settings: Settings, total: np.ndarray) -> float:
    """Adds the gradients of rows to ``total``; their summed loss."""
    key, places, values, code = batch.columns
    if code.null_count:
        raise ValueError("null codes")
    loss, keys, codes = 0.0, key.to_numpy(), code.to_numpy()
    for at, x in matrices(places, values, network.sizes[0]):
        more, lost = gradient(network, x, codes[at], dropout_masks(keys[at], step, settings))
        total += more
        loss += lost
    return loss


def _dealt(df: DataFrame, key: str, features: str, code: str, settings: Settings) -> tuple[DataFrame, int, int]:
    """Rows with their batch and the lane that takes them, the number of batches and of lanes."""
    n = df.count()
    steps = max(1, -(-n // settings.batch_rows))
    lanes = max(1, -(-settings.batch_rows // settings.task_rows))
    hashed = df.select(F.xxhash64(F.lit(settings.seed), key).alias("key"), *_sparse(features), F.col(code).cast("int").alias("code"))
    dealt = hashed.select(
        "*",
        F.pmod("key", F.lit(steps)).alias("batch"),
        F.pmod(F.xxhash64("key"), F.lit(lanes)).alias("lane"),
    )
    return dealt.repartition(min(steps * lanes, 1 << 14), "batch", "lane"), steps, lanes


def batches(df: DataFrame, key: str, features: str, code: str, settings: Settings) -> tuple[DataFrame, int]:
    """The table of mini-batches and their number."""
    dealt, steps, _ = _dealt(df, key, features, code, settings)
    path = new_stage(df.sparkSession)
    dealt.write.partitionBy("batch").parquet(path)
    schema = T.StructType([f for f in dealt.schema if f.name != "batch"]).add("batch", "long")
    return df.sparkSession.read.schema(schema).parquet(path), steps


def summed_gradients(rows: DataFrame, path: str, step: int, settings: Settings, lanes: int = 1) -> tuple[np.ndarray, int, float]:
    """Gradient sum, number and summed loss of ``rows`` under the weights at ``path``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        network, part = load(path), TaskContext.get().partitionId()
        total, n, loss = np.zeros(len(network.flat)), 0, 0.0
        for batch in parts:
            loss += _added_gradients(network, batch, step, settings, total)
            n += batch.num_rows
        if n:
            yield _sums([(k, part % lanes, part, total[at : at + SLICE], n, loss) for k, at in enumerate(range(0, len(total), SLICE))])

    sums = rows.select("key", "places", "values", "code").mapInArrow(run, _SUMS)
    if lanes > 1:
        sums = _added(_added(sums, lanes).withColumn("part", F.col("lane")).withColumn("lane", F.lit(0)), 1)
    found = sorted(zip(*(c.to_pylist() for c in sums.toArrow().columns), strict=True), key=lambda r: (r[0], r[2]))
    slices: dict[int, np.ndarray] = {}
    for k, _, _, values, _, _ in found:
        slices[k] = slices.get(k, 0) + np.frombuffer(values, "<f8")
    first = [r for r in found if r[0] == 0]
    return np.concatenate([slices[k] for k in sorted(slices)]), sum(r[4] for r in first), sum(r[5] for r in first)


def _sums(rows: list[tuple]) -> pa.RecordBatch:
    slices, lanes, parts, sums, counts, losses = zip(*rows, strict=True)
    columns = [
        pa.array(slices, pa.int32()),
        pa.array(lanes, pa.int32()),
        pa.array(parts, pa.int32()),
        pa.array([s.astype("<f8").tobytes() for s in sums], pa.binary()),
        pa.array(counts, pa.int64()),
        pa.array(losses, pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["slice", "lane", "part", "sum", "rows", "loss"])


def _added(sums: DataFrame, lanes: int) -> DataFrame:
    """One sum per slice and lane, in the order of the parts; one sum is held at a time."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, n, loss = None, None, 0, 0.0
        for batch in parts:
            for k, lane, _, values, count, lost in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (k, lane) != key:
                    if key is not None:
                        yield _sums([(*key, 0, total, n, loss)])
                    key, total, n, loss = (k, lane), np.zeros(len(values) // 8), 0, 0.0
                total, n, loss = total + np.frombuffer(values, "<f8"), n + count, loss + lost
        if key is not None:
            yield _sums([(*key, 0, total, n, loss)])

    dealt = sums.repartition("slice", "lane").sortWithinPartitions("slice", "lane", "part")
    return dealt.mapInArrow(run, _SUMS)


class Adam:
    """The published method, with its usual constants."""

    def __init__(self, size: int, rate: float):
        self.rate, self.first, self.second, self.steps = rate, np.zeros(size), np.zeros(size), 0

    def move(self, flat: np.ndarray, grad: np.ndarray) -> np.ndarray:
        self.steps += 1
        out = np.empty_like(flat)
        for at in range(0, len(flat), _CACHED):
            part = slice(at, at + _CACHED)
            first, second, g = self.first[part], self.second[part], grad[part]
            first *= 0.9
            first += 0.1 * g
            second *= 0.999
            second += 0.001 * g**2
            scaled = np.sqrt(second / (1 - 0.999**self.steps)) + 1e-8
            out[part] = flat[part] - self.rate * (first / (1 - 0.9**self.steps)) / scaled
        return out


def fit(
    df: DataFrame, key: str, features: str, code: str, width: int, classes: int, settings: Settings = Settings()
) -> tuple[Network, list[float]]:
    """The trained network and the mean loss of each epoch. ``features`` is a vector column of
    ``width`` components, ``code`` a class from 0; null features or codes are an error."""
    spark = df.sparkSession
    network = initial((width, *settings.hidden, classes), settings.seed)
    if -(-settings.batch_rows // settings.task_rows) <= GANG:
        return _fit_by_stretches(spark, network, _dealt(df, key, features, code, settings), settings)
    table, steps = batches(df, key, features, code, settings)
    adam, losses, folder = Adam(len(network.flat), settings.rate), [], new_stage(spark)
    tasks = max(1, -(-settings.batch_rows // settings.task_rows))
    lanes = 1 if tasks <= FAN_IN else -(-tasks // FAN_IN)
    for epoch in range(settings.epochs):
        seen, lost = 0, 0.0
        for batch in _order(steps, epoch, settings):
            path = f"{folder}/weights-{adam.steps}"
            save(network, path)
            grad, n, loss = summed_gradients(table.where(F.col("batch") == batch), path, adam.steps, settings, lanes)
            _delete(path)
            network = Network(network.sizes, adam.move(network.flat, grad / n))
            seen, lost = seen + n, lost + loss
        losses.append(lost / seen)
    return network, losses


def _order(steps: int, epoch: int, settings: Settings) -> list[int]:
    return np.random.default_rng([settings.seed, epoch]).permutation(steps).tolist()


def _delete(path: str) -> None:
    system, name = open_uri(path)
    system.delete_file(name)


def _delete_folder(path: str) -> None:
    system, name = open_uri(path)
    system.delete_dir(name)


# --- stretches of steps -------------------------------------------------------
def _shares(dealt: DataFrame, folder: str) -> dict[tuple[int, int], str]:
    """The file of each batch and lane. Only files that a finished task reports are read."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, name = open_uri(folder)
        system.create_dir(name, recursive=True)
        done, last = [], None
        with ExitStack() as opened:
            for part in parts:
                batch, lane = (c.to_numpy() for c in part.columns[:2])
                rows = pa.RecordBatch.from_arrays(part.columns[2:], part.schema.names[2:])
                if rows.column("values").null_count or rows.column("code").null_count:
                    raise ValueError("null features or codes")
                cuts = np.flatnonzero((np.diff(batch) != 0) | (np.diff(lane) != 0)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                    if a == b:
                        continue
                    if (batch[a], lane[a]) != last:
                        opened.close()
                        last = batch[a], lane[a]
                        done.append((*last, uuid.uuid4().hex))
                        out = opened.enter_context(system.open_output_stream(f"{name}/{done[-1][2]}", compression=None))
                        writer = opened.enter_context(pa.ipc.new_stream(out, rows.schema))
                    writer.write_table(pa.Table.from_batches([rows.slice(a, b - a)]), _PIECE)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["batch", "lane", "file"])

    rows = dealt.sortWithinPartitions("batch", "lane", "key").select("batch", "lane", "key", "places", "values", "code")
    found = rows.mapInArrow(run, "batch long, lane long, file string").collect()
    return {(r["batch"], r["lane"]): f"{folder}/{r['file']}" for r in found}


def _fit_by_stretches(
    spark: SparkSession, network: Network, dealt: tuple[DataFrame, int, int], settings: Settings
) -> tuple[Network, list[float]]:
    rows, batches, lanes = dealt
    written = new_stage(spark)
    shares = _shares(rows, written)
    held = {b: [shares.get((b, k)) for k in range(lanes)] for b in {b for b, _ in shares}}
    if not held:
        raise ValueError("no rows to fit")
    epochs = [[held[b] for b in _order(batches, epoch, settings) if b in held] for epoch in range(settings.epochs)]
    steps, folder, sums = [files for epoch in epochs for files in epoch], new_stage(spark), []
    state = f"{folder}/initial"
    _save_state(state, network, Adam(len(network.flat), settings.rate))
    members = min(lanes, _slots(spark))
    for first in range(0, len(steps), STRETCH):
        last, (state, found) = state, _stretch(spark, state, first, steps[first : first + STRETCH], members, settings)
        _drop_state(last)
        sums += found
    losses, at = [], 0
    for epoch in epochs:
        n, loss = map(sum, zip(*sums[at : at + len(epoch)], strict=True))
        losses.append(loss / n)
        at += len(epoch)
    network = _read(state)
    _drop_state(state)
    _delete_folder(written)
    return network, losses


def _slots(spark: SparkSession) -> int:
    """How many tasks may run side by side: one, where executors come and go, as Spark has no barrier stages there."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 1
    context = spark.sparkContext._jsc.sc()
    return max(1, context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))


def _save_state(path: str, network: Network, adam: Adam) -> None:
    for end, flat in (("", network.flat), ("-first", adam.first), ("-second", adam.second)):
        save(Network(network.sizes, flat), path + end)


def _read_state(path: str, steps: int, rate: float) -> tuple[Network, Adam]:
    network, adam = _read(path), Adam(0, rate)
    adam.first, adam.second, adam.steps = _read(f"{path}-first").flat, _read(f"{path}-second").flat, steps
    return network, adam


def _drop_state(path: str) -> None:
    for end in ("", "-first", "-second"):
        _delete(path + end)


def _stretch(
    spark: SparkSession, state: str, first: int, steps: list[list[str | None]], members: int, settings: Settings
) -> tuple[str, list[tuple[int, float]]]:
    """The state after some steps, which are lists of files by lane (None: no rows), and the rows and summed loss of each.
    The result is the same for any number of members."""
    told, folder = new_stage(spark), state.rsplit("/", 1)[0]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (me,) = (k for part in parts for k in part.column(0).to_pylist())
        network, adam = _read_state(state, first, settings.rate)
        sums, (system, name) = [], open_uri(f"{told}/{_attempt(members)}")
        system.create_dir(name, recursive=True)
        for step, files in enumerate(steps, first):
            own = {k: _share_sum(network, files[k], step, settings) for k in range(me, len(files), members)}
            if members > 1:
                for k, found in own.items():
                    with system.open_output_stream(f"{name}/{step}-{k}", compression=None) as out:
                        out.write(found)
            grad = np.zeros(len(network.flat) + 2)
            for k in range(len(files)):
                grad += own[k] if k in own else _heard(system, f"{name}/{step}-{k}", len(grad))
            n, loss = int(grad[-2]), float(grad[-1])
            network = Network(network.sizes, adam.move(network.flat, grad[:-2] / n))
            sums.append((n, loss))
            if members > 1 and step > first:  # who tells of this step has heard all of the one before
                for k in range(me, len(steps[step - 1 - first]), members):
                    system.delete_file(f"{name}/{step - 1}-{k}")
        if me == 0:
            path = f"{folder}/{uuid.uuid4().hex}"
            _save_state(path, network, adam)
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(sums)), *(pa.array(c) for c in zip(*sums, strict=True))], ["path", "rows", "loss"])

    # an operator of Spark SQL, so that it runs in the Python workers that are there
    found = spark.range(0, members, 1, members).mapInArrow(run, "path string, rows long, loss double", barrier=members > 1).collect()
    _delete_folder(told)
    return found[0]["path"], [(r["rows"], r["loss"]) for r in found]


def _attempt(members: int) -> str:
    """A name for this try of a stretch, the same in all its tasks, which begin together."""
    from pyspark import BarrierTaskContext

    name = uuid.uuid4().hex
    return BarrierTaskContext.get().allGather(name)[0] if members > 1 else name


def _share_sum(network: Network, path: str | None, step: int, settings: Settings) -> np.ndarray:
    """The summed gradient of the rows of a file; behind it their number and summed loss."""
    total = np.zeros(len(network.flat) + 2)
    if path is None:
        return total
    system, name = open_uri(path)
    with system.open_input_stream(name, compression=None) as file:
        for batch in pa.ipc.open_stream(file):
            total[-1] += _added_gradients(network, batch, step, settings, total[:-2])
            total[-2] += batch.num_rows
    return total


def _heard(system: fs.FileSystem, name: str, size: int) -> np.ndarray:
    """The numbers of a file that another task writes, as soon as all are there."""
    wait = 5e-4
    while system.get_file_info(name).size != 8 * size:
        time.sleep(wait)
        wait = min(2 * wait, 0.05)
    with system.open_input_stream(name, compression=None) as file:
        return np.frombuffer(file.read(), "<f8")


def score(spark: SparkSession, path: str, df: DataFrame, features: str, labels: list[str]) -> DataFrame:
    """``df`` without its features, with the predicted label and its confidence (the highest probability; the first class of equals)."""
    kept = [c for c in df.columns if c not in (features, "label", "confidence")]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = load(path)
        for batch in parts:
            for at, x in matrices(batch.column(len(kept)), batch.column(len(kept) + 1), network.sizes[0]):
                part = batch.slice(at.start, len(x))
                found = probabilities(network, x)
                best = [labels[k] for k in found.argmax(1).tolist()]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], pa.array(best), pa.array(found.max(1))], [*kept, "label", "confidence"])

    schema = T.StructType([df.schema[c] for c in kept]).add("label", "string").add("confidence", "double")
    return df.select(*[F.col(f"`{c}`") for c in kept], *_sparse(features)).mapInArrow(run, schema)
