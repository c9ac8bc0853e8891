"""Token ids as list columns of Parquet files.

``write`` sorts documents by a key, encodes each whole text and writes one row per document:
the kept columns, ``part`` and ``first`` (which file, and ids before it in that file),
``n_tokens`` and ``ids``. ``Layout`` sets how: the ids dictionary-encoded or as binary-packed
deltas, the size of row groups and pages; the writer adds page indexes, so a reader that asks
for a few documents by key touches only their pages. ``read`` adds ``start``, the number of ids of
all documents before; a reader that leaves out ``ids`` reads just the small columns.

Ids are those of a ``tokenizers`` file (a parameter) without added special tokens, and an end id. Where its
form is the known one, which drops white space and lets no piece cross it, pieces are encoded once and their
ids kept in bounded tables; other files encode whole texts.

Documents are ordered by the key (null last), those of equal keys by their place in the files; so
one key may hold any share of the rows. A null or empty text is the end id alone. Added columns
replace kept columns of the same name. An empty table gives an empty result. Memory is one text and its ids, and the table
of words.
"""

import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.llm.common import by_bytes, schema_of, with_row_id
from threadloom.session import new_stage

END = 2
#: Words or pieces in each of two tables of a process: the ids of those seen lately, and before. Longer
#: ones than LONG_WORD are encoded each time.
KEPT_WORDS = 1 << 18
LONG_WORD = 64
#: Bytes of text that are encoded together (or one longer text).
TEXT_BYTES = 1 << 21
ADDED = "part int, first long, n_tokens long, ids array<int>"


@dataclass(frozen=True)
class Layout:
    """How the files are written. ``encoding``: "dictionary" or "delta"."""

    encoding: str = "dictionary"
    row_group_bytes: int = 16 << 20
    page_bytes: int = 128 << 10
    page_rows: int = 1000

    def options(self) -> dict[str, str]:
        if self.encoding not in ("dictionary", "delta"):
            raise ValueError("encoding must be dictionary or delta")
        coded = str(self.encoding == "dictionary").lower()
        return {
            "parquet.writer.version": "PARQUET_2_0",  # numbers without a dictionary are packed deltas
            "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#ids.list.element": coded,
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
        }


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts, as bytes of little-endian unsigned 32-bit numbers.

    Texts of Latin letters are cut into the vocabulary's pieces here, and its model gives the ids of each
    piece it has not seen lately. Of other texts each word (what ASCII white space separates; it joins with no
    other character) that is not of such letters goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.known_form = (config["normalizer"], config["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER)
        self.added = [t["content"] for t in config["added_tokens"]]
        self.lately: dict[bytes | str, bytes] = {}
        self.before: dict[bytes | str, bytes] = {}

    def _simple(self, text: str) -> bytes | None:
        """The text in lower case as Latin-1, if it has no characters but those of ``_SIMPLE``."""
        try:
            data = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if data.translate(None, _SIMPLE) or any(t in text for t in self.added):
            return None
        return data.translate(_LOWER)

    def _keys(self, text: str) -> list[bytes | str]:
        data = self._simple(text)
        if data is not None:
            return _PIECES.findall(data)
        words = [(w, self._simple(w)) for w in text.translate(_WHITE).split(" ")]
        return [k for w, data in words for k in ([w] if data is None else _PIECES.findall(data))]

    def _encode(self, keys: list[bytes | str]) -> list[bytes]:
        words = [k for k in keys if isinstance(k, str)]
        found = dict(zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True))
        out = []
        for k in keys:
            if isinstance(k, str):
                ids = found[k].ids
            else:
                named = k if k.isascii() else k.decode("latin-1").encode()
                ids = [t.id for t in self.model.tokenize(named.decode("latin-1").translate(_BYTE_NAMES))]
            out.append(_packed(ids))
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if not self.known_form:
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [_packed(e.ids) for e in found]
        split = [self._keys(t) for t in texts]
        keys = set().union(*split)
        if len(self.lately) + len(keys) > KEPT_WORDS:
            self.before, self.lately = self.lately, {}
        new = []
        for k in keys:
            if k not in self.lately:
                ids = self.before.get(k)
                if ids is None:
                    new.append(k)
                else:
                    self.lately[k] = ids
        self.lately.update(zip(new, self._encode(new), strict=True))
        out = [b"".join(map(self.lately.__getitem__, keys)) for keys in split]
        for k in new:
            if len(k) > LONG_WORD:
                del self.lately[k]
        return out


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if len(ids) > 64 else struct.pack(f"<{len(ids)}I", *ids)


_WHITE = str.maketrans("\t\n\x0b\x0c\r", " " * 5)
#: Printable ASCII, usual white space and the letters of Latin-1 that composition leaves alone.
_LETTERS = bytes([*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
_SIMPLE = b"\t\n\r" + bytes(range(0x20, 0x7F)) + _LETTERS
_LOWER = bytes(c + 32 if 65 <= c <= 90 or (0xC0 <= c <= 0xDE and c != 0xD7) else c for c in range(256))
_LATIN = rb"a-z\xdf-\xf6\xf8-\xff"
#: The pattern of the vocabulary for such texts.
_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[" + _LATIN + rb"]+|[0-9]|[^\s0-9" + _LATIN + rb"]+")
#: Byte-level vocabularies name a byte by its Latin-1 character if that is printable, and the others from 256 on.
_NAMED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_NAMES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _NAMED)}
#: The form of the vocabulary that the pieces above follow.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per process."""
    return Encoder(path)


def encode(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), path: str | None = None, end: int | None = END) -> DataFrame:
    """Documents in the order of their rows in each partition, with the columns of ``ADDED``."""
    path = path or default_vocabulary()
    names = [f.split()[0] for f in ADDED.split(", ")]
    kept = [c for c in keep if c not in names]
    tail = b"" if end is None else np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        for batch in by_bytes(batches, TEXT_BYTES):
            body = batch.column(batch.num_columns - 1).fill_null("").to_pylist()
            ids = [b + tail for b in encoder(path)(body)]
            sizes = np.array([len(b) // 4 for b in ids], np.int64)
            ends = np.cumsum(sizes)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), np.int32))
            )
            columns = [pa.array(np.full(len(ids), part, np.int32)), pa.array(first + ends - sizes), pa.array(sizes), lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*kept, *names])
            first += int(ends[-1])

    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("_text"))
    return rows.mapInArrow(run, schema_of(docs, kept, ADDED))


def write(
    docs: DataFrame,
    folder: str,
    order: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    path: str | None = None,
    layout: Layout = Layout(),
) -> None:
    """Encode documents in ascending order and write them as Parquet files in ``folder``."""
    named = with_row_id(docs, order=F.col(f"`{order}`"), body=F.col(f"`{text}`"))
    names = dict(enumerate(dict.fromkeys(keep)))
    columns = [F.col(f"doc.`{c}`").alias(f"k{i}") for i, c in names.items()]
    by = [F.col("order").asc_nulls_last(), F.col("row.file"), F.col("row.index")]
    ordered = named.select("order", "row", *columns, "body").repartitionByRange(*by).sortWithinPartitions(*by)
    coded = encode(ordered, "body", tuple(f"k{i}" for i in names), path)
    added = [f.split()[0] for f in ADDED.split(", ")]
    back = [F.col(f"k{i}").alias(c) for i, c in names.items() if c not in added]
    coded.select(*back, *added).write.options(**layout.options()).parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The written rows with ``start``; take only the columns you need."""
    rows = spark.read.parquet(folder)
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))  # a row per file
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_before"))
    joined = rows.join(F.broadcast(before), "part")
    kept = [F.col(f"`{c}`") for c in rows.columns if c != "start"]
    return joined.select(*kept, (F.col("_before") + F.col("first")).alias("start"))


def checksums(rows: DataFrame, keep: tuple[str, ...] = ("doc_id", "start", "n_tokens")) -> DataFrame:
    """``keep`` and ``ids_crc32``, of the ids as little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4", copy=False)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], [*keep, "ids_crc32"])

    chosen = rows.select(*[F.col(f"`{c}`") for c in keep], "ids")
    return chosen.mapInArrow(run, schema_of(rows, list(keep), "ids_crc32 long"))


def round_trip(docs: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Write documents to a new stage and return the rows read back."""
    folder = new_stage(docs.sparkSession)
    write(docs, folder, layout=layout)
    return read(docs.sparkSession, folder)
