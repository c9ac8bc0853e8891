"""Benchmark decontamination: an FM-index per training shard, searched for test phrases.

A phrase is a window of ``WINDOW`` consecutive words of a benchmark item (a shorter item is
one phrase). Symbols are the words of the benchmark; any other word ends a run, as no phrase
can cross it, and runs shorter than the shortest phrase hold none. Runs of about
``SHARD_WORDS`` words make a shard; its index finds the row range of every phrase by backward
search, and positions from sampled suffixes. Occurrences become spans of words, and
overlapping spans are merged. A run longer than a shard is cut with an overlap of a phrase.

Null and empty texts have no words, in documents and items. Rows are judged one by one, so
ids may repeat or be null; an item's id is compared as text, and items with the same id count
once. Added columns replace columns of the same name. Empty tables give empty results, an
empty benchmark no hits.

The benchmark is a written table in blocks of about ``BLOCK_BYTES`` of text; a long item is cut into
pieces that overlap by all but one word of a phrase. A task reads block after block and holds one; what all blocks find in the text as it came is merged
once. With ``remove`` the spans are cut out, and a changed text is searched by all blocks again until none finds
anything, so results depend neither on the number of blocks nor on the order of the items.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import _WORD_BYTES, plain_words, rest_of, schema_of
from threadloom.llm.fm_index import FMIndex
from threadloom.session import new_stage, open_uri

WINDOW = 10
SHARD_WORDS = 1 << 18
BLOCK_BYTES = 1 << 22
#: With several blocks, documents of this many bytes together go through all of them.
TURN_BYTES = 1 << 25
_WORD = re.compile(rb"\S+")


class Owners:
    """The items of each phrase, as numbers into a list of names."""

    def __init__(self, names: list[str], starts: np.ndarray, numbers: np.ndarray):
        self.names, self.starts, self.numbers = names, starts, numbers

    def __getitem__(self, phrase: int) -> list[str]:
        return [self.names[k] for k in self.numbers[self.starts[phrase] : self.starts[phrase + 1]].tolist()]


@dataclass
class Phrases:
    """Distinct phrases of a block of items, by length, and the items of each."""

    words: dict[bytes, int]
    by_length: dict[int, tuple[np.ndarray, Owners]]

    @property
    def shortest(self) -> int:
        return min(self.by_length, default=1)

    @property
    def longest(self) -> int:
        return max(self.by_length, default=1)


def phrases(items: list[tuple[str | None, bytes | None]], window: int = WINDOW) -> Phrases:
    words: dict[bytes, int] = {}
    names: dict[str, int] = {}
    rows: dict[int, list[np.ndarray]] = {}
    owners: dict[int, list[np.ndarray]] = {}
    for item, text in items:
        ids = np.array([words.setdefault(w, len(words) + 1) for w in plain_words(text)], np.int64)
        if not len(ids):
            continue
        found = np.lib.stride_tricks.sliding_window_view(ids, min(window, len(ids)))
        rows.setdefault(found.shape[1], []).append(found)
        name = names.setdefault("" if item is None else item, len(names))
        owners.setdefault(found.shape[1], []).append(np.full(len(found), name))
    by_length = {}
    for n in sorted(rows):
        distinct, phrase = np.unique(np.concatenate(rows[n]), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([phrase.ravel(), np.concatenate(owners[n])]), axis=1)
        by_length[n] = distinct, Owners(list(names), np.searchsorted(pairs[0], np.arange(len(distinct) + 1)), pairs[1])
    return Phrases(words, by_length)


@dataclass
class Found:
    """What was found in one text: merged word spans (end exclusive) and the items."""

    n_words: int
    spans: list[tuple[int, int]]
    items: set[str]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def search(texts: list[bytes | None], known: Phrases, shard_words: int = SHARD_WORDS) -> list[Found]:
    """What is found in each text, shard by shard."""
    out, runs, places, waiting = [], [], [], 0
    step = max(1, shard_words)
    for k, text in enumerate(texts):
        words = plain_words(text)
        out.append(Found(len(words), [], set()))
        ids = np.array([known.words.get(w, 0) for w in words], np.int64)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ids != 0, [0]])))
        for start, end in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True):
            for at in range(start, end, step):
                stop = min(end, at + step + known.longest - 1)
                if stop - at >= known.shortest:
                    runs.append(ids[at:stop])
                    places.append((k, at))
                    waiting += stop - at
                if waiting >= shard_words:
                    _search_shard(runs, places, known, out)
                    runs, places, waiting = [], [], 0
    if runs:
        _search_shard(runs, places, known, out)
    for found in out:
        found.spans = merged(found.spans)
    return out


def _search_shard(runs: list, places: list, known: Phrases, out: list[Found]) -> None:
    index = FMIndex(runs, len(known.words) + 1)
    for length, (rows, owners) in known.by_length.items():
        low, high = index.find(rows)
        hits = np.flatnonzero(low < high)
        for at in range(0, len(hits), 256):
            some = hits[at : at + 256]
            sizes = high[some] - low[some]
            phrase = np.repeat(some, sizes)
            inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            run, place = index.run_of(index.locate(np.repeat(low[some], sizes) + inside))
            for r, i, p in zip(run.tolist(), place.tolist(), phrase.tolist(), strict=True):
                doc, start = places[r]
                out[doc].spans.append((start + i, start + i + length))
                out[doc].items.update(owners[p])


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text with the spans of words cut out; what stood between the words around stays."""
    bounds = [m.span() for m in _WORD.finditer(text.translate(_WORD_BYTES))]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : bounds[start][0]])
        at = bounds[end - 1][1]
    return b"".join([*out, text[at:]])


def search_blocks(texts: list[bytes | None], blocks) -> list[Found]:
    """What any of the blocks finds in each text; ``blocks`` are read one after the other."""
    out: list[Found] | None = None
    for known in blocks:
        found = search(texts, known)
        if out is None:
            out = found
            continue
        for a, b in zip(out, found, strict=True):
            a.spans, a.items = merged([*a.spans, *b.spans]), a.items | b.items
    return out if out is not None else search(texts, phrases([]))


def cleaned(texts: list[bytes | None], blocks) -> tuple[list[Found], list[bytes | None]]:
    """What was found, and the texts without it: searched again until no phrase is left,
    as a cut can bring the parts of another phrase together."""
    first = found = search_blocks(texts, blocks)
    texts, open_ = list(texts), list(range(len(texts)))
    while True:
        open_ = [k for k, f in zip(open_, found, strict=True) if f.spans]
        if not open_:
            return first, texts
        spans = [f.spans for f in found if f.spans]
        for k, s in zip(open_, spans, strict=True):
            texts[k] = without(texts[k], s)
        found = search_blocks([texts[k] for k in open_], blocks)


def pieces(text: bytes | None, most: int, window: int = WINDOW) -> list[bytes]:
    """A text in pieces of about ``most`` bytes that have all its windows and no others."""
    if text is None or len(text) <= most:
        return [text or b""]
    words = plain_words(text)
    step = max(1, most * len(words) // len(text))
    return [b" ".join(words[i : i + step + window - 1]) for i in range(0, max(1, len(words) - window + 1), step)]


def write_blocks(items: DataFrame, item: str, text: str, block_bytes: int) -> tuple[str, int]:
    """The folder of the benchmark's blocks, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, p) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for p in pieces(t, block_bytes)]
            names, texts = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], ["item", "text"])

    rows = items.select(F.col(item).cast("string").alias("item"), F.col(text).cast("binary").alias("text")).distinct()
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n)).alias("block")
    folder = new_stage(items.sparkSession)
    cut = rows.mapInArrow(run, "item string, text binary").select("item", "text", block)
    cut.repartition(min(n, 1 << 12), "block").write.partitionBy("block").parquet(folder)
    return folder, n


@lru_cache(maxsize=1)
def read_block(folder: str, block: int) -> Phrases:
    """The phrases of one block; a process holds the last one read."""
    system, root = open_uri(folder)
    chosen = fs.FileSelector(f"{root}/block={block}", allow_not_found=True)
    rows: list[tuple[str | None, bytes | None]] = []
    for found in system.get_file_info(chosen):
        if found.base_name.endswith(".parquet"):
            with system.open_input_file(found.path) as file:
                table = pq.ParquetFile(file).read(columns=["item", "text"])
            rows += zip(table["item"].to_pylist(), table["text"].to_pylist(), strict=True)
    return phrases(sorted(rows, key=str))


class Blocks:
    """All blocks, read as they are iterated over."""

    def __init__(self, folder: str, n: int):
        self.folder, self.n = folder, n

    def __iter__(self) -> Iterator[Phrases]:
        return (read_block(self.folder, k) for k in range(self.n))


FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep=None,
    remove: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_words``, merged ``spans`` of words and ``items``.

    With ``remove`` the text column loses the spans. Numbers and spans are those of the text
    as it came.
    """
    added = ["n_words", "spans", "items"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(F.col(text).alias("text"), rest_of(kept, text).alias("doc"))
    blocks = Blocks(*write_blocks(items, item, item_text, block_bytes))
    out = rows.mapInArrow(_searcher(blocks, remove), schema_of(rows, ["text", "doc"], FOUND))
    columns = [F.col("text").alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in kept]
    return out.select(*columns, *added)


def _turns(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches put together up to about ``most`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.get_total_buffer_size()
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _searcher(blocks: Blocks, remove: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _turns(batches, TURN_BYTES if blocks.n > 1 else 0):
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            found, left = cleaned(texts, blocks) if remove else (search_blocks(texts, blocks), texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(left, pa.binary()).cast(pa.string()) if remove else batch.column(0),
                    batch.column(1),
                    pa.array([f.n_words for f in found], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in f.spans] for f in found], _SPANS),
                    pa.array([sorted(f.items) for f in found], pa.list_(pa.string())),
                ],
                ["text", "doc", "n_words", "spans", "items"],
            )

    return run


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
