"""Vector bin packing of token sequences.

An example has a size in three dimensions: tokens, one segment, and loss-bearing tokens (those
after the prompt). Sequences have a limit in each. The dot-product heuristic fills one
sequence at a time: of the waiting examples that fit, it takes the one whose size vector has
the largest dot product with the room left, all as shares of the limits.

Examples longer than a sequence are cut into full sequences and a rest. With ``cut`` a gap
that no waiting example fits is filled with the head of the longest one, and the last room of
a task becomes sequences whose lengths are powers of two, which need no padding. Every task
packs its own rows with a bounded pool of waiting examples, so nothing is shuffled.

A null text or prompt counts as empty; each example ends with id 0, so an empty one is one
token. Rows are examples: ids may repeat or be null. An empty table gives an empty result.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import tokens as T
from threadloom.llm.common import as_bytes, schema_of

END = 0
POOL = 1024


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold. A piece's loss-bearing tokens are never more than its tokens."""

    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


@dataclass
class Piece:
    """Part of one example: where it comes from and where it goes."""

    owner: int
    ids: np.ndarray
    start: int
    doc_tokens: int
    loss_from: int
    sequence: int = -1
    offset: int = 0

    @property
    def loss(self) -> int:
        return max(0, self.start + len(self.ids) - max(self.start, self.loss_from))

    def split(self, n: int) -> "Piece":
        """Take off the first ``n`` ids."""
        head = Piece(self.owner, self.ids[:n], self.start, self.doc_tokens, self.loss_from)
        self.ids, self.start = self.ids[n:], self.start + n
        return head

    def head_within(self, tokens: int, loss: int) -> int:
        """The most ids a head can have within a room."""
        free = max(0, self.loss_from - self.start)
        return min(len(self.ids), tokens, free + loss)


class Packer:
    """Sequences of one task. ``add`` examples; finished pieces come out of ``done``."""

    def __init__(self, limits: Limits, cut: bool, first: int):
        self.limits, self.cut, self.next = limits, cut, first
        self.scale = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.pool: list[Piece] = []
        self.done: list[Piece] = []

    def add(self, piece: Piece) -> None:
        room = self.limits
        while (n := piece.head_within(room.tokens, room.loss)) < len(piece.ids) or n == room.tokens:
            head = piece.split(n)
            if n == room.tokens:
                self._emit([head])
            else:
                self.pool.append(head)
            if not len(piece.ids):
                break
        else:
            self.pool.append(piece)
        if len(self.pool) >= 2 * POOL:
            self._fill(POOL)

    def _emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for p in pieces:
            p.sequence, p.offset = self.next, offset
            offset += len(p.ids)
        self.done += pieces
        self.next += 1

    def _fill(self, leave: int) -> None:
        """Fill sequences until no more than ``leave`` examples wait."""
        waiting = np.array([(len(p.ids), 1, p.loss) for p in self.pool], float).reshape(-1, 3)
        alive = np.ones(len(waiting), bool)
        while alive.sum() > leave:
            chosen, room = [], self.scale.copy()
            while room[0] >= 1 and room[1] >= 1:
                fits = alive & (waiting <= room).all(axis=1)
                if fits.any():
                    value = np.where(fits, (waiting / self.scale) @ (room / self.scale), -1)
                    k = int(value.argmax())
                    piece = self.pool[k]
                    alive[k] = False
                elif self.cut and alive.any():
                    k = int(np.where(alive, waiting[:, 0], -1).argmax())
                    n = self.pool[k].head_within(int(room[0]), int(room[2]))
                    if n == 0:
                        break
                    piece = self.pool[k].split(n)
                    waiting[k] = len(self.pool[k].ids), 1, self.pool[k].loss
                else:
                    break
                chosen.append(piece)
                room -= (len(piece.ids), 1, piece.loss)
            self._emit(chosen)
        self.pool = [p for p, a in zip(self.pool, alive, strict=True) if a]

    def flush(self) -> None:
        before = len(self.done)
        self._fill(0)
        if self.cut and len(self.done) > before:
            last = self.next - 1
            rest = [p for p in self.done[before:] if p.sequence == last]
            self.done = self.done[: len(self.done) - len(rest)]
            self.next = last
            self._emit_powers(rest)

    def _emit_powers(self, pieces: list[Piece]) -> None:
        """The pieces as sequences whose lengths are powers of two."""
        left = sum(len(p.ids) for p in pieces)
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            chosen = []
            while room:
                piece = pieces.pop(0)
                if len(piece.ids) > room:
                    pieces.insert(0, piece)
                    piece = piece.split(room)
                chosen.append(piece)
                room -= len(piece.ids)
            self._emit(chosen)


PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
)


def example_ids(prompt: bytes | None, text: bytes | None, path: str) -> tuple[np.ndarray, int]:
    """The ids of an example with its end, and where its loss begins."""
    head = T.encode(prompt, path) if prompt else np.zeros(0, np.uint32)
    body = T.encode(text, path) if text else np.zeros(0, np.uint32)
    return np.concatenate([head, body, np.array([END], np.uint32)]), len(head)


def pack(
    docs: DataFrame,
    limits: Limits = Limits(),
    cut: bool = True,
    text: str = "text",
    prompt: str | None = None,
    path: str | None = None,
    keep: tuple[str, ...] = ("doc_id",),
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the columns ``keep`` of its example, ``PIECES`` and, if asked, ``ids``."""
    path = path or T.default_vocabulary()
    added = [f.split()[0] for f in PIECES.split(", ")] + ["ids"] * with_ids
    kept = [c for c in keep if c not in added]
    rows = docs.select(
        F.col(text).alias("_text"),
        (F.col(prompt) if prompt else F.lit(None).cast("string")).alias("_prompt"),
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"),
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, cut, TaskContext.get().partitionId() << 40)
        owners: dict[int, pa.Scalar] = {}
        number = 0
        kind = None
        for batch in batches:
            kind = batch.schema.field(2).type
            for i, (body, head) in enumerate(zip(as_bytes(batch.column(0)), as_bytes(batch.column(1)), strict=True)):
                ids, loss_from = example_ids(head, body, path)
                owners[number] = batch.column(2)[i].as_py()
                packer.add(Piece(number, ids, 0, len(ids), loss_from))
                number += 1
                if len(packer.done) >= 4096:
                    yield out(packer, owners, kind)
        packer.flush()
        if packer.done:
            yield out(packer, owners, kind)

    def out(packer: Packer, owners: dict, kind: pa.DataType) -> pa.RecordBatch:
        done, packer.done = packer.done, []
        columns = [
            pa.array([owners[p.owner] for p in done], kind),
            *(
                pa.array(values, pa.int64())
                for values in zip(
                    *(
                        (
                            p.start,
                            len(p.ids),
                            zlib.crc32(p.ids.astype("<u4").tobytes()),
                            p.doc_tokens,
                            p.sequence,
                            p.offset,
                            p.loss,
                        )
                        for p in done
                    ),
                    strict=True,
                )
            ),
        ]
        if with_ids:
            columns.append(pa.array([p.ids.astype(np.int32) for p in done], pa.list_(pa.int32())))
        waiting = {p.owner for p in packer.pool}
        for owner in [o for o in owners if o not in waiting]:
            del owners[owner]
        return pa.RecordBatch.from_arrays(columns, ["doc", *added])

    schema = schema_of(rows, ["doc"], PIECES + ", ids array<int>" * with_ids)
    return rows.mapInArrow(pieces, schema).select("doc.*", *added)
