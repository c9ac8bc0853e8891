"""Edit-aware token counts: a segment tree over the pre-token segments of each document.

A leaf holds a segment of the text that no token crosses (white space and what follows it; of a
longer run of characters the letters, digits and marks apart) with its bytes and tokens; inner nodes hold sums. An edit re-encodes only the
leaves it touches plus those neighbours whose boundary the edit may have undone, cuts the region into leaves
again, and updates the sums on the way to the root. A tree whose leaves have grown by insertions is built anew.
The count after the edits equals that of encoding the edited text anew.

A null or empty text has 0 tokens and no edits. Documents are handled one by one, so ids may
repeat or be null; added columns replace columns of the same name.
"""

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import tokens as T
from threadloom.llm.common import as_bytes, schema_of

Edit = tuple[int, int, bytes]
ADDED = "n_edits long, tokens_before long, tokens_after long, bytes_after long, reencoded_bytes long"


#: Segments up to this many bytes are not cut further.
SHORT = 64
#: A leaf beyond this many bytes that could be cut counts as grown.
GROWN = 4096


def _may_part(before: str, after: str) -> bool:
    """Whether no token crosses from a character that is not white space to the next: they are of
    different kinds (letter, digit, mark), and no contraction begins with the first."""
    kinds = [_KINDS(c).lastgroup for c in (before, after)]
    if "space" in kinds or kinds[0] == kinds[1]:
        return False
    return not (before == "'" and kinds[1] == "letter")


_KINDS = regex.compile(r"(?P<space>\s)|(?P<letter>\p{L})|(?P<digit>\p{N})|(?P<mark>.)", regex.DOTALL).match
#: Runs of one kind, with the white space before them.
_RUNS = regex.compile(r"\s*(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|$)")
_SPECIAL = T.SPECIAL.encode()


def _in_special(left: bytes, right: bytes) -> bool:
    """Whether a border may lie in the string of the special token."""
    return any(
        left.endswith(_SPECIAL[:k]) and _SPECIAL[k:].startswith(right[: len(_SPECIAL) - k]) for k in range(1, len(_SPECIAL))
    )


def bound(left: bytes, right: bytes) -> bool:
    """Whether no token can cross from ``left`` to ``right``, whatever stands around them."""
    if not (left and right) or _in_special(left, right):
        return False
    if right[0] in b"\t\n\r ":
        return T.begins_white(left)
    before = left[-4:].decode(errors="ignore")[-1:]
    after = right[:4].decode(errors="ignore")[:1]
    return bool(before and after) and _may_part(before, after)


def segments(text: bytes) -> list[bytes]:
    """The text in segments that no token crosses."""
    bounds = [0, *T.cuts(text).tolist(), len(text)]
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a <= SHORT:
            out.append(text[a:b])
            continue
        start = a
        for run in _RUNS.finditer(text[a:b].decode()):
            piece = run.group().encode()
            if not piece:
                continue
            if start > a and bound(out[-1], piece):
                out.append(piece)
            elif start > a:
                out[-1] += piece
            else:
                out.append(piece)
            start += len(piece)
    return out


class TokenTree:
    """Token count of one text under edits."""

    def __init__(self, text: bytes, path: str):
        self.path, self.reencoded, self.grown = path, 0, 0
        leaves = segments(text) or [b""]
        ends = np.cumsum(T.token_sizes(path)[T.encode(text, path)])
        bounds = np.cumsum([0, *map(len, leaves)])
        self._build(leaves, np.diff(np.searchsorted(ends, bounds, side="right")))

    def _build(self, leaves: list[bytes], counts: np.ndarray) -> None:
        self.leaves = leaves
        self.size = 1 << max(0, len(leaves) - 1).bit_length()
        self.bytes, self.counts = (self._sums(values) for values in ([len(leaf) for leaf in leaves], counts))

    def _sums(self, values) -> list[int]:
        """The nodes of a tree over ``values``: the root at 1, the leaves from ``size`` on."""
        sums = np.zeros(2 * self.size, np.int64)
        sums[self.size : self.size + len(values)] = values
        level = self.size
        while level > 1:
            sums[level // 2 : level] = sums[level : 2 * level].reshape(-1, 2).sum(1)
            level //= 2
        return sums.tolist()

    def _rebuild(self) -> None:
        """Cut grown leaves; only those are encoded again."""
        leaves, counts = [], []
        for k, leaf in enumerate(self.leaves):
            parts = segments(leaf) if len(leaf) > GROWN else [leaf] if leaf else []
            leaves += parts
            counts += [self.counts[self.size + k]] if len(parts) == 1 else [self._count(p) for p in parts]
        self.grown = 0
        self._build(leaves or [b""], np.array(counts or [0], np.int64))

    def _count(self, text: bytes) -> int:
        self.reencoded += len(text)
        return len(T.encode(text, self.path)) if text else 0

    @property
    def tokens(self) -> int:
        return self.counts[1]

    @property
    def length(self) -> int:
        return self.bytes[1]

    @property
    def text(self) -> bytes:
        return b"".join(self.leaves)

    def locate(self, offset: int) -> tuple[int, int]:
        """The leaf that holds a byte offset, and the offset in it; the end is in the last leaf."""
        node, rest = 1, min(offset, self.length)
        at_end = rest == self.length
        if at_end:
            rest -= 1
        while node < self.size:
            node *= 2
            if rest >= self.bytes[node]:
                rest -= self.bytes[node]
                node += 1
        return node - self.size, rest + at_end

    def _set(self, leaf: int, text: bytes, count: int) -> None:
        self.leaves[leaf] = text
        node = leaf + self.size
        longer, more = len(text) - self.bytes[node], count - self.counts[node]
        while node:
            self.bytes[node] += longer
            self.counts[node] += more
            node //= 2

    def _neighbour(self, leaf: int, step: int) -> int | None:
        """The nearest leaf with text on one side."""
        leaf += step
        while 0 <= leaf < len(self.leaves):
            if self.leaves[leaf]:
                return leaf
            leaf += step
        return None

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Put ``new`` in the place of the bytes from ``start`` to ``end``."""
        if self.length == 0:
            first, last, region = 0, 0, new
        else:
            first, skip = self.locate(start)
            last, keep = self.locate(end)
            region = self.leaves[first][:skip] + new + self.leaves[last][keep:]
            while (left := self._neighbour(first, -1)) is not None and not bound(self.leaves[left], region):
                first, region = left, self.leaves[left] + region
            while (right := self._neighbour(last, 1)) is not None and not bound(region, self.leaves[right]):
                last, region = right, region + self.leaves[right]
        self._fill(first, last, segments(region))
        if self.grown > max(GROWN, self.length // 8):
            self._rebuild()

    def _fill(self, first: int, last: int, parts: list[bytes]) -> None:
        """Put segments into the leaves from ``first`` to ``last``; the last takes what is left over."""
        slots = last - first + 1
        rest = b"".join(parts[slots - 1 :])
        if len(parts) > slots and len(rest) > GROWN:
            self.grown += len(rest)
        given = [*parts[: slots - 1], rest]
        for leaf in range(first, last + 1):
            part = given[leaf - first] if leaf - first < len(given) else b""
            if part or self.leaves[leaf]:
                self._set(leaf, part, self._count(part))


def cleaning_edits(text: bytes) -> list[Edit]:
    """Edits of a light clean-up: later copies of a line go, long numbers become ``0``."""
    edits, seen, at = [], set(), 0
    for line in text.split(b"\n"):
        stop = at + len(line)
        if line.strip() and line in seen:
            edits.append((max(0, at - 1), stop, b""))
        else:
            seen.add(line)
            edits += [(at + m.start(), at + m.end(), b"0") for m in _NUMBER.finditer(line)]
        at = stop + 1
    return edits


_NUMBER = re.compile(rb"[0-9][0-9 ()\-]{5,}[0-9]")


def count(text: bytes | None, edits: Callable[[bytes], list[Edit]], path: str) -> tuple[int, ...]:
    """The columns of ``ADDED``; the edits are disjoint, in order, and in offsets of ``text``."""
    text = text or b""
    tree = TokenTree(text, path)
    before, moved, found = tree.tokens, 0, edits(text)
    for start, end, new in found:
        tree.replace(start + moved, end + moved, new)
        moved += len(new) - (end - start)
    return len(found), before, tree.tokens, tree.length, tree.reencoded


def recount(
    docs: DataFrame,
    edits: Callable[[bytes], list[Edit]] = cleaning_edits,
    text: str = "text",
    path: str | None = None,
    keep=None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the token counts before and after the edits."""
    path = path or T.default_vocabulary()
    added = [f.split()[0] for f in ADDED.split(", ")]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(F.col(text).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [count(t, edits, path) for t in as_bytes(batch.column(0))]
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(len(added))]
            yield pa.RecordBatch.from_arrays([batch.column(1), *columns], ["doc", *added])

    return rows.mapInArrow(counts, schema_of(rows, ["doc"], ADDED)).select("doc.*", *added)
