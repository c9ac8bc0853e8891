"""Line dedup: documents that share rare lines are aligned, and common blocks leave the later one.

1. Lines are hashed (md5 of the stripped line; blank lines count as nothing). So are the runs of
   neighbouring lines that just reach ``MIN_WORDS`` words, from each line on and up to each
   line: a common block of so many words holds such a run at each of its lines.
2. The first holder of a run is the earliest document with it, in the order of the id (null
   last) and then of the place in the files. A document is linked through its rarest runs (those in the
   fewest documents) to their first holders, as many as cover every line that lies in a shared run. So a
   passage that any number of documents share gives one link from each of them, never all
   pairs, and a rare run beside it spares it. Lines that everybody uses alone give none.
3. Each later document is aligned with its first holders by a patience diff of the line hashes: lines
   that occur once in both and lie in the longest increasing order are anchors, and blocks
   grow from them over equal neighbours. Between anchors the diff is repeated on what is left.
4. Aligned blocks of ``MIN_WORDS`` words or more are deleted from the later document, and with them
   shorter aligned blocks beside them: those at most ``GAP`` changed lines away in both documents.
5. A diff keeps one order, so passages that moved or repeat are left over. Every run of lines that just
   reaches ``MIN_WORDS`` words is looked up among the runs of the whole first holder.

The first holder of a line keeps it, so every line stays somewhere. Alignments read hashes,
never texts; a document's links are at most its lines, its deletions as many as them.

A null text has no lines and stays null; an empty one stays empty. Repeated rows with one id
are documents of their own, in the order of the files. Extra columns are kept; added columns
replace columns of the same name. An empty table gives an empty result.
"""

import bisect
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import rest_of, schema_of, slices, with_row_id
from threadloom.session import materialise

MIN_WORDS = 25
GAP = 1
HASH = 16


def blocks(earlier: list, later: list) -> list[tuple[int, int, int]]:
    """Aligned common blocks (start in earlier, start in later, length) by patience diff."""
    found: list[tuple[int, int, int]] = []
    open_ = [(0, len(earlier), 0, len(later))]
    while open_:
        a0, a1, b0, b1 = open_.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        grown, at = [], (a0, b0)
        for a, b in _anchors(earlier[a0:a1], later[b0:b1]):
            a, b = a + a0, b + b0
            if a < at[0] or b < at[1]:
                continue  # inside the block before
            start = 0
            while a - start > at[0] and b - start > at[1] and earlier[a - start - 1] == later[b - start - 1]:
                start += 1
            stop = 1
            while a + stop < a1 and b + stop < b1 and earlier[a + stop] == later[b + stop]:
                stop += 1
            grown.append((a - start, b - start, start + stop))
            at = (a + stop, b + stop)
        if not grown:  # no line occurs once in both: equal heads and tails are all that can be aligned
            n = 0
            while a0 + n < a1 and b0 + n < b1 and earlier[a0 + n] == later[b0 + n]:
                n += 1
            m = 0
            while a1 - m > a0 + n and b1 - m > b0 + n and earlier[a1 - m - 1] == later[b1 - m - 1]:
                m += 1
            found += [(a0, b0, n)] * (n > 0) + [(a1 - m, b1 - m, m)] * (m > 0)
            continue
        found += grown
        edges = [(a0, b0, 0), *grown, (a1, b1, 0)]
        for (pa_, pb, n), (a, b, _) in zip(edges[:-1], edges[1:], strict=True):
            open_.append((pa_ + n, a, pb + n, b))
    return sorted(found)


def _anchors(earlier: list, later: list) -> list[tuple[int, int]]:
    """Lines that occur once in both, as the longest run that increases in both."""
    once = {h for h, n in Counter(earlier).items() if n == 1}
    place = {h: i for i, h in enumerate(earlier) if h in once}
    count = Counter(later)
    pairs = [(place[h], j) for j, h in enumerate(later) if h in place and count[h] == 1]
    tails: list[int] = []
    ends: list[int] = []
    back: list[int | None] = []
    for k, (i, _) in enumerate(pairs):
        p = bisect.bisect_left(tails, i)
        back.append(ends[p - 1] if p else None)
        if p == len(tails):
            tails.append(i)
            ends.append(k)
        else:
            tails[p], ends[p] = i, k
    out, k = [], ends[-1] if ends else None
    while k is not None:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def cut_hashes(joined: bytes) -> list[bytes]:
    return [joined[i : i + HASH] for i in range(0, len(joined), HASH)]


def windows(words: list[int], min_words: int) -> set[tuple[int, int]]:
    """The shortest runs of lines (start, stop) of ``min_words`` words from each line on, and up
    to each line. Those inside a block of so many words cover it."""
    sums = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    n = len(words)
    stops = np.searchsorted(sums, sums[:-1] + min_words)
    starts = np.searchsorted(sums, sums[1:] - min_words, side="right") - 1
    onward = {(i, j) for i, j in enumerate(stops.tolist()) if j <= n}
    return onward | {(i, j) for j, i in enumerate(starts.tolist(), 1) if i >= 0}


def chains(found: list[tuple[int, int, int]], words: list[int], min_words: int) -> list[tuple[int, int, int]]:
    """Of aligned blocks those of ``min_words`` words, and shorter ones that a row of blocks, each
    at most ``GAP`` lines from the next in both documents, joins to one of them."""
    taken = [sum(words[b : b + n]) >= min_words for _, b, n in found]
    near = [
        a1 - a0 - n <= GAP and b1 - b0 - n <= GAP
        for (a0, b0, n), (a1, b1, _) in zip(found[:-1], found[1:], strict=True)
    ]
    for order in (range(len(near)), reversed(range(len(near)))):
        for k in order:
            if near[k] and taken[k] != taken[k + 1]:
                taken[k] = taken[k + 1] = True
    return [block for block, take in zip(found, taken, strict=True) if take]


def long_blocks(earlier: list, later: list, words: list[int], min_words: int) -> list[int]:
    """Places in ``later`` to delete: in aligned blocks, and in further runs that ``earlier`` has."""
    found = chains(blocks(earlier, later), words, min_words)
    gone = {j for _, b, n in found for j in range(b, b + n)}
    known = set(earlier)
    if all(j in gone or h not in known for j, h in enumerate(later)):
        return sorted(gone)
    by_length: dict[int, list[int]] = {}
    for start, stop in windows(words, min_words):
        by_length.setdefault(stop - start, []).append(start)
    for n, starts in by_length.items():
        runs = {tuple(earlier[i : i + n]) for i in range(len(earlier) - n + 1)}
        for j in starts:
            if tuple(later[j : j + n]) in runs:
                gone.update(range(j, j + n))
    return sorted(gone)


_RUN = "struct<run:binary,start:int,stop:int,again:boolean>"
_RUN_TYPE = pa.struct([("run", pa.binary()), ("start", pa.int32()), ("stop", pa.int32()), ("again", pa.bool_())])


def _runs(min_words: int):
    """For each document: its runs of lines that just reach ``min_words`` words, by their hashes;
    ``again`` marks those that stood in the document before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            runs = []
            for joined, words in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                own, seen = [], set()
                for i, j in sorted(windows(words, min_words)):
                    digest = hashlib.md5(joined[i * HASH : j * HASH]).digest()
                    own.append({"run": digest, "start": i, "stop": j, "again": digest in seen})
                    seen.add(digest)
                runs.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(runs, pa.list_(_RUN_TYPE))], ["row", "key", "runs"]
            )

    return run


def rarest(shared: list[tuple[int, int, int]]) -> list[int]:
    """Of shared runs (documents with it, start, stop), the places of the rarest that cover the lines of all."""
    chosen, covered = [], set()
    for k in sorted(range(len(shared)), key=lambda k: shared[k]):
        _, start, stop = shared[k]
        if not covered.issuperset(range(start, stop)):
            covered.update(range(start, stop))
            chosen.append(k)
    return chosen


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first holders that each document is aligned with."""
    for batch in slices(batches):
        holders = []
        for shared in batch.column(1).to_pylist():
            own = [shared[k]["holder"] for k in rarest([(s["n"], s["start"], s["stop"]) for s in shared])]
            holders.append(list({(h["file"], h["index"]): h for h in own}.values()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(holders, pa.list_(batch.schema.field(0).type))], ["row", "holders"])


def _deletions(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places = [], []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for row, later, words, earlier in zip(*columns, strict=True):
                places.append(long_blocks(cut_hashes(earlier), cut_hashes(later), words, min_words))
                rows.append(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, batch.schema.field(0).type), pa.array(places, pa.list_(pa.int32()))], ["row", "places"]
            )

    return run


def deletions(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """The documents with their row id, and per row id the places of lines to delete.

    Places count the lines that are not blank.
    """
    named = with_row_id(docs, key=F.col(key), text=F.col(text))
    stripped = F.filter(F.transform(F.split("text", "\n"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " "))), lambda s: s != "")
    lines = named.where(F.col("text").isNotNull()).select("row", "key", stripped.alias("lines"))
    lines = materialise(
        lines.select(
            "row",
            "key",
            F.transform("lines", lambda s: F.unhex(F.md5(s))).alias("hashes"),
            F.transform("lines", lambda s: F.size(F.split(s, " "))).alias("words"),
        ).where(F.size("hashes") > 0)
    )
    whole = F.array_join(F.transform("hashes", F.hex), "")
    packed = lines.select("row", "key", F.unhex(whole).alias("hashes"), "words")
    schema = schema_of(packed, ["row", "key"], f"runs array<{_RUN}>")
    runs = materialise(packed.mapInArrow(_runs(min_words), schema).where(F.size("runs") > 0))
    order = F.struct(F.col("key").isNull().alias("none"), "key", "row")
    each = runs.select("row", order.alias("doc"), F.inline("runs"))
    holders = materialise(
        each.groupBy("run")
        .agg(F.min("doc").alias("first"), F.count_if(~F.col("again")).alias("n"))
        .where("n > 1")
        .select("run", F.col("first.row").alias("holder"), "n")
    )
    shared = runs.select("row", F.inline("runs")).join(holders, "run").where(F.col("row") != F.col("holder"))
    place = "struct<file:bigint,index:bigint>"
    linked = shared.groupBy("row").agg(F.collect_list(F.struct("n", "start", "stop", "holder")).alias("shared"))
    holding = linked.mapInArrow(_links, f"row {place}, holders array<{place}>")
    pairs = materialise(holding.select("row", F.explode("holders").alias("holder")))
    packed = packed.drop("key")
    both = (
        pairs.join(packed.select(F.col("row").alias("holder"), F.col("hashes").alias("earlier")), "holder")
        .join(packed.withColumnRenamed("hashes", "later"), "row")
        .select("row", "later", "words", "earlier")
    )
    cut = both.mapInArrow(_deletions(min_words), f"row {place}, places array<int>")
    gone = cut.select("row", F.explode("places").alias("place")).distinct()
    return named, materialise(gone.groupBy("row").agg(F.collect_list("place").alias("places")))


ADDED = "n_lines long, n_removed long, removed_lines array<int>"


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, totals, removed = [], [], []
        for text, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            lines = text.split("\n") if text is not None else []
            filled = [i for i, s in enumerate(lines) if s.strip(_JAVA_SPACE)]
            gone = {filled[p] for p in places or []}
            texts.append("\n".join(s for i, s in enumerate(lines) if i not in gone) if gone else text)
            totals.append(len(filled))
            removed.append(sorted(gone))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(texts, pa.string()),
                pa.array(totals, pa.int64()),
                pa.array([len(r) for r in removed], pa.int64()),
                pa.array(removed, pa.list_(pa.int32())),
            ],
            ["doc", "text", "n_lines", "n_removed", "removed_lines"],
        )


#: What the pattern \s and trim take away in the JVM.
_JAVA_SPACE = " \t\n\x0b\x0c\r"


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the deleted lines, with ``n_lines`` (not blank, before), ``n_removed``
    and ``removed_lines`` (numbers of lines from 0)."""
    added = [f.split()[0] for f in ADDED.split(", ")]
    named, gone = deletions(docs, text, key, min_words)
    kept = [c for c in docs.columns if c not in added]
    rest = rest_of(kept, text, "doc.")
    # always by a merge join: the plan is the same for every number of deletions
    joined = named.select("row", "text", rest.alias("doc")).join(gone.hint("merge"), "row", "left")
    joined = joined.select("doc", "text", "places")
    schema = schema_of(joined, ["doc", "text"], ADDED)
    columns = [F.col("text").alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in kept]
    return joined.mapInArrow(_rebuild, schema).select(*columns, *added)
