"""Language identification with a byte convolutional network.

Bytes are mapped to symbols (letters in lower case; digits, white space and other ASCII as
one symbol each; every other byte as itself). Filters of several widths run over the symbols
of a window, each gives its largest response in the window, and a softmax layer makes
probabilities of them. Trained in numpy by Adam on windows of labelled texts.

A text is cut into windows of ``WINDOW`` bytes, all of them; the mean of the windows' log
probabilities, weighted by their lengths, decides. As a filter is a sum of one table per
offset, tables over pairs of symbols give its response with half the look-ups.

Training reads at most about ``PER_LANGUAGE`` texts of each language and ``PER_TEXT`` windows
of each, chosen by a hash of the row; more than ``MAX_LANGUAGES`` languages are an error.

A null text, or one without a letter, is ``und`` with score 0. Texts are judged one by one; ids
may repeat or be null (rows with a null id are not learned from); added columns replace
columns of the same name. Without any labelled text every answer is ``und``.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import as_bytes, schema_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
PER_LANGUAGE = 400
PER_TEXT = 4
MAX_LANGUAGES = 256
STEPS = 1200
BATCH = 64
UNKNOWN = "und"

_SPACE, _DIGIT, _OTHER = 26, 27, 28
SYMBOLS = 29 + 128
_TABLE = np.array(
    [
        c - 97 if 97 <= c <= 122
        else c - 65 if 65 <= c <= 90
        else _DIGIT if 48 <= c <= 57
        else _SPACE if c in (9, 10, 11, 12, 13, 32)
        else _OTHER if c < 128
        else c - 99
        for c in range(256)
    ],
    np.int64,
)
_LETTER = regex.compile(r"\p{L}")


def windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all windows (the last one filled up with spaces) and their lengths."""
    n = max(1, -(-len(text) // WINDOW))
    codes = np.full(n * WINDOW, _SPACE, np.int64)
    codes[: len(text)] = _TABLE[np.frombuffer(text, np.uint8)]
    sizes = np.full(n, WINDOW)
    sizes[-1] = len(text) - (n - 1) * WINDOW
    return codes.reshape(n, WINDOW), sizes


@dataclass
class Model:
    """``filters[w][j]`` holds the response of each symbol at offset j of the filters of width w."""

    labels: list[str]
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def __post_init__(self):
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(SYMBOLS**2, -1)
        f = self.filters
        zero = np.zeros((SYMBOLS, FILTERS), np.float32)
        self.first = np.hstack([pair(f[w][0], f[w][1]) for w in WIDTHS]).astype(np.float32)
        self.single = f[3][2].astype(np.float32) if 3 in f else zero
        self.second = pair(f[4][2], f[4][3]).astype(np.float32)

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(codes), 256):
            c = codes[at : at + 256]
            pairs = c[:, :-1] * SYMBOLS + c[:, 1:]
            last = WINDOW - max(WIDTHS) + 1
            response = self.first[pairs[:, :last]]
            response[..., FILTERS : 2 * FILTERS] += self.single[c[:, 2 : 2 + last]]
            response[..., 2 * FILTERS :] += self.second[pairs[:, 2 : 2 + last]]
            out.append(_log_softmax(np.maximum(response.max(axis=1) + self.bias, 0) @ self.dense + self.dense_bias))
        return np.concatenate(out)

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        """Language and score of each whole text."""
        labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        judged = [i for i, t in enumerate(texts) if t and self.labels and _LETTER.search(t.decode())]
        for i in range(0, len(judged), 64):  # texts of one matrix
            some = judged[i : i + 64]
            parts = [windows(texts[k]) for k in some]
            logs = self.log_probabilities(np.concatenate([p[0] for p in parts]))
            at = 0
            for k, (codes, sizes) in zip(some, parts, strict=True):
                own = logs[at : at + len(codes)]
                at += len(codes)
                mean = (own * sizes[:, None]).sum(axis=0) / sizes.sum()
                p = np.exp(mean - mean.max())
                best = int(p.argmax())
                labels[k], scores[k] = self.labels[best], float(p[best] / p.sum())
        return labels, scores


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def train(codes: np.ndarray, targets: np.ndarray, labels: list[str], steps: int = STEPS, seed: int = 0) -> Model:
    """Fit a model to windows (rows of ``codes``) and their label numbers."""
    rng = np.random.default_rng(seed)
    width = len(WIDTHS) * FILTERS
    p = {f"f{w}": rng.normal(0, 0.3, (w, SYMBOLS, FILTERS)) for w in WIDTHS}
    p |= {"bias": np.zeros(width), "dense": rng.normal(0, 0.3, (width, len(labels))), "out": np.zeros(len(labels))}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    last = WINDOW - max(WIDTHS) + 1
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(codes), BATCH)
        c = codes[pick].copy()
        for row, size in enumerate(np.where(rng.random(BATCH) < 0.5, rng.integers(16, WINDOW, BATCH), WINDOW)):
            c[row, size:] = _SPACE  # short texts look like this
        tops, places = [], []
        for w in WIDTHS:
            response = sum(p[f"f{w}"][j][c[:, j : j + last]] for j in range(w))
            place = response.argmax(axis=1)
            places.append(place)
            tops.append(np.take_along_axis(response, place[:, None, :], 1)[:, 0])
        raw = np.concatenate(tops, axis=1) + p["bias"]
        hidden = np.maximum(raw, 0)
        error = np.exp(_log_softmax(hidden @ p["dense"] + p["out"]))
        error[np.arange(BATCH), targets[pick]] -= 1
        error /= BATCH
        back = (error @ p["dense"].T) * (raw > 0)
        grad = {"dense": hidden.T @ error, "out": error.sum(axis=0), "bias": back.sum(axis=0)}
        for i, w in enumerate(WIDTHS):
            grad[f"f{w}"] = g = np.zeros_like(p[f"f{w}"])
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            for j in range(w):
                symbols = np.take_along_axis(c, places[i] + j, 1)
                np.add.at(g[j], (symbols, np.arange(FILTERS)[None, :]), own)
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * grad[k]
            v[k] = 0.99 * v[k] + 0.01 * grad[k] ** 2
            p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return Model(labels, {w: p[f"f{w}"] for w in WIDTHS}, p["bias"], p["dense"], p["out"])


def untrained() -> Model:
    """The model that knows no language."""
    width = len(WIDTHS) * FILTERS
    filters = {w: np.zeros((w, SYMBOLS, FILTERS)) for w in WIDTHS}
    return Model([], filters, np.zeros(width), np.zeros((width, 1)), np.zeros(1))


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> Model:
    """A model of the languages in the rows where ``learn`` holds."""
    rows = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = rows.groupBy(F.col(lang).cast("string").alias("lang")).count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; raise MAX_LANGUAGES if that is meant")
    sizes = {r["lang"]: r["count"] for r in counts}
    labels = sorted(sizes)
    if not labels:
        return untrained()
    share = F.create_map(*[F.lit(x) for n, k in sizes.items() for x in (n, min(1.0, PER_LANGUAGE / k))])
    # drawn by the text, so copies of a table in other files give the same model; equal texts count once
    draw = F.pmod(F.xxhash64(text, F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    named = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), draw.alias("draw"))
    sample = named.where(F.col("draw") < share[F.col("lang")]).select("lang", "text").distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parts = [], []
            for name, body in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                if not _LETTER.search(body.decode()):
                    continue
                starts = range(0, len(body), WINDOW)
                for i in np.unique(np.linspace(0, len(starts) - 1, PER_TEXT).astype(int)):
                    names.append(name)
                    parts.append(body[starts[i] : starts[i] + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(parts, pa.binary())], ["lang", "part"])

    found = sample.mapInArrow(cut, "lang string, part binary").collect()
    if not found:
        return untrained()
    found.sort(key=lambda r: (r.lang, bytes(r.part)))  # the fit does not depend on the order of rows
    codes = np.concatenate([windows(bytes(r.part))[0] for r in found])
    targets = np.array([labels.index(r.lang) for r in found])
    return train(codes, targets, labels)


def identify(docs: DataFrame, model: Model, text: str = "text", keep=None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``lang_pred`` and ``score``."""
    added = ("lang_pred", "score")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(F.col(text).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = model.predict(as_bytes(batch.column(0)))
            columns = [batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", *added])

    return rows.mapInArrow(judge, schema_of(rows, ["doc"], "lang_pred string, score double")).select("doc.*", *added)
