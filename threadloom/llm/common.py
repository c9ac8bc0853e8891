"""Helpers shared by the operators of this folder."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.session import materialise

_SCAN_NODES = ("Project", "Filter", "LogicalRelation", "Relation", "SubqueryAlias", "View")


def _plain_scan(df: DataFrame) -> bool:
    """Whether the rows of ``df`` are rows of files, only filtered and projected."""
    node = df._jdf.queryExecution().analyzed()
    while node.children().size() == 1:
        if node.nodeName() not in _SCAN_NODES:
            return False
        node = node.children().apply(0)
    return node.children().isEmpty() and "Relation" in node.nodeName()


def with_row_id(df: DataFrame, **columns: Column) -> DataFrame:
    """``doc`` (all columns of ``df`` as a struct), ``row`` (an id of the row) and ``columns``.

    The id is the place of the row in its file (a hash of the file's path, and the row's
    index), so it stays the same when a task or an executor is lost and when the file is cut
    into other splits. A frame that is not a plain scan of files is written and read again.
    The struct keeps names of extra columns apart from those an operator adds.
    """
    names = df.columns
    if any(c.lower() == "_metadata" for c in names) or not _plain_scan(df):
        df = materialise(df.toDF(*[f"{c}_" if c.lower() == "_metadata" else c for c in names]))
    place = F.struct(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("index"),
    )
    whole = F.struct(*[F.col(f"`{own}`").alias(c) for own, c in zip(df.columns, names, strict=True)])
    return df.select(whole.alias("doc"), place.alias("row"), *[c.alias(n) for n, c in columns.items()])


def schema_of(df: DataFrame, columns: list[str], added: str) -> T.StructType:
    """The types of some columns of ``df``, and the columns that the DDL text ``added`` names."""
    return T.StructType([*[df.schema[c] for c in columns], *T.StructType.fromDDL(added).fields])


def rest_of(columns: list[str], text: str, of: str = "") -> Column:
    """A struct of all columns but the text, which travels beside it, so it is moved once."""
    others = [F.col(f"{of}`{c}`") for c in columns if c != text]
    return F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows, so that what Python holds beside a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def by_bytes(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose texts, in the last column, have about ``most`` bytes together."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0)
        group = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


#: ASCII letters in lower case and digits stay, all other ASCII becomes a space.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def plain_words(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text: runs of digits, letters and non-ASCII characters, A-Z as a-z."""
    return text.translate(_WORD_BYTES).split() if text else []


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """One table per run of equal values in ``key``, of batches sorted by it."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        change = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))
        cuts = [0, *(np.flatnonzero(change.to_numpy(zero_copy_only=False)) + 1).tolist(), len(keys)]
        if rest and rest[-1].column(key)[-1].as_py() != keys[0].as_py():
            yield pa.Table.from_batches(rest)
            rest = []
        for start, stop in zip(cuts[:-2], cuts[1:-1], strict=True):
            yield pa.Table.from_batches([*rest, batch.slice(start, stop - start)])
            rest = []
        rest.append(batch.slice(cuts[-2]))
    if rest:
        yield pa.Table.from_batches(rest)


def scramble(x: np.ndarray) -> np.ndarray:
    """A fixed bijection on unsigned 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
