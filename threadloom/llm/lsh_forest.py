"""N-gram Jaccard join: a MinHash LSH forest over distinct texts, with exact verification.

1. A text is the set of its shingles of ``SHINGLE`` words (a shorter one is one shingle). Equal
   texts are one class; everything below works on classes.
2. A class has one label of ``DEPTH`` MinHash values in each of ``TREES`` trees. Labels with a
   common prefix of k values are a bucket of the tree's trie at depth k. Buckets are found by
   grouping prefixes; those beyond ``BLOCK`` classes or ``BLOCK_BYTES`` of shingles are cut into
   blocks, and pairs of blocks compared, so no task ever holds more than two blocks.
3. The search starts with the longest prefixes and shortens them (halves, then the depth that
   the threshold needs). A pair of similarity s is found with probability
   1 - (1 - s**k) ** TREES. The search always goes down to the depth where a pair just at the
   threshold is found with the target probability; closer pairs are found more likely. What
   was found on the way does not end it: many close pairs say nothing of the others.
4. A pair is looked at in the first tree and at the first depth where it shares a prefix, so
   once. Its exact Jaccard similarity is computed from the shingle sets.
5. What leaves a group is one row per member: its number of links and a parent in a spanning
   forest of them. So the links of a large group of near copies are all counted and their
   connections kept, but never written out one by one; ``pairs`` does that on request.
6. Classes connected by links are a group; its id is the smallest id of its rows.

Joins ask for a merge join, so the plan is the same at every size and AQE splits hot keys.

Null texts belong to no class and have no links; texts without a word have no shingles and no
links, but equal ones are a class. Ids may repeat or be null: the class id is the smallest id
of its rows (null if none). An empty table gives an empty result.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import _WORD_BYTES, groups, scramble, with_row_id
from threadloom.session import materialise

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 8
TARGET = 0.9995
BLOCK = 1024
BLOCK_BYTES = 16 << 20
WITHIN = -1  #: the side of members that meet those of their own block

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = scramble(np.arange(1, 257, dtype=np.uint64) * _STEP)
_ODD = np.uint64(0xD1342543DE82EF95)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_ODD, 1 << 16)
_DOWN = _powers(np.uint64(pow(int(_ODD), -1, 1 << 64)), 1 << 16)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word (A-Z as a-z; words are runs of digits, letters, non-ASCII)."""
    b = np.frombuffer(text.translate(_WORD_BYTES), np.uint8)
    inside = np.concatenate([[False], b != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(b)) & 0xFFFF
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * _UP[place], dtype=np.uint64)])
    if len(b) <= 1 << 16:
        values = (sums[ends] - sums[starts]) * _DOWN[starts]
    else:  # powers start anew every 2**16 bytes, and words that cross that line are summed apart
        values = (sums[ends] - sums[starts]) * _DOWN[starts & 0xFFFF]
        for k in np.flatnonzero(starts >> 16 != (ends - 1) >> 16):
            own = _BYTE[b[starts[k] : ends[k]]]
            values[k] = sum(int(x) * pow(int(_ODD), i, 1 << 64) for i, x in enumerate(own.tolist())) % (1 << 64)
    return scramble(values ^ (ends - starts).astype(np.uint64) * _STEP)


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = scramble(out * _ODD + words[k : len(words) - size + 1 + k])
    return np.unique(out)


_SALTS = scramble(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * _STEP)


def signature(sets: np.ndarray) -> np.ndarray:
    """16 bits of the minimum of each hash function, tree by tree."""
    out = np.full(len(_SALTS), np.uint64(2**64 - 1))
    for at in range(0, len(sets), 1024):
        part = sets[at : at + 1024]
        mixed = (part[None, :] ^ _SALTS[:, None]) * _ODD
        mixed ^= mixed >> np.uint64(32)
        mixed *= _STEP
        out = np.minimum(out, mixed.min(axis=1))
    return (scramble(out) & np.uint64(0xFFFF)).astype("<u2")


def recall(similarity: float, depth: int) -> float:
    """The probability that a pair shares a prefix of ``depth`` values in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


def depths(threshold: float, target: float) -> list[int]:
    """Depths from the longest prefix to the one that finds pairs at the threshold."""
    last = next((k for k in range(DEPTH, 1, -1) if recall(threshold, k) >= target), 1)
    return sorted({k for k in (DEPTH, DEPTH // 2, DEPTH // 4) if k > last} | {last}, reverse=True)


def _prefixes(signatures: np.ndarray, depth: int) -> np.ndarray:
    """One number per signature and tree that is equal where the first ``depth`` values are."""
    values = signatures.reshape(len(signatures), TREES, DEPTH)[:, :, :depth].astype(np.uint64)
    out = np.zeros(values.shape[:2], np.uint64)
    for k in range(depth):
        out = scramble(out * _ODD + values[:, :, k] + np.uint64(1))
    return out


def new_pairs(signatures: np.ndarray, side: np.ndarray, tree: int, depth: int, before: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group of a tree to look at: within a block or across two, and met neither in an
    earlier tree nor at the depth before."""
    if side[0] == WITHIN:
        left, right = np.triu_indices(len(signatures), 1)
    else:
        low, high = np.flatnonzero(side == side.min()), np.flatnonzero(side != side.min())
        left, right = np.repeat(low, len(high)), np.tile(high, len(low))
    own = _prefixes(signatures, depth)
    apart = [own[:, t] for t in range(tree)]
    if before is not None:
        apart += list(_prefixes(signatures, before).T)
    meets = own[left, tree] == own[right, tree]
    left, right = left[meets], right[meets]
    for prefix in apart:
        new = prefix[left] != prefix[right]
        left, right = left[new], right[new]
    return left, right


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            sets = [shingles(t, size) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                [*batch.schema.names[1:], "n", "signature"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, size).tobytes() for t in batch.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sets, pa.binary())], ["digest", "shingles"])

    return run


def _group_arrays(table: pa.Table) -> tuple[int, list[bytes], np.ndarray, np.ndarray]:
    tree = table.column("tree")[0].as_py()
    digests = table.column("digest").to_pylist()
    joined = b"".join(table.column("signature").to_pylist())
    signatures = np.frombuffer(joined, "<u2").reshape(len(digests), -1)
    return tree, digests, signatures, table.column("side").to_numpy()


def _wanted(depth: int, before: int | None):
    """Members of a group that have a new pair in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["group", "tree", "side", "digest", "signature"]
        out: list[pa.Table] = []
        for table in groups(batches, "group"):
            if table.num_rows < 2:
                continue
            tree, _, signatures, side = _group_arrays(table)
            left, right = new_pairs(signatures, side, tree, depth, before)
            if len(left):
                out.append(table.select(names).take(np.unique(np.concatenate([left, right]))))
            if len(out) >= 512:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
                out = []
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    return run


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles the sets of each pair have in common.

    Where a group has many pairs they are counted as a product of matrices, over the shingles
    that two sets or more hold.
    """
    if len(left) >= 4 * len(sets):
        sizes = np.array([len(s) for s in sets])
        _, place, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = held > 1
        low, high = np.unique(left), np.unique(right)
        width = int(shared.sum())
        if len(low) * len(high) * width < len(left) * (200_000 + 300 * sizes.mean()):
            owner = np.repeat(np.arange(len(sets)), sizes)
            inside = shared[place]
            owner, column = owner[inside], (np.cumsum(shared) - 1)[place[inside]]
            order = np.argsort(column, kind="stable")
            owner, column = owner[order], column[order]
            both = np.zeros((len(low), len(high)), np.float32)
            for at in range(0, width, 1024):
                part = slice(*np.searchsorted(column, [at, at + 1024]))
                holds = np.zeros((len(sets), 1024), np.float32)
                holds[owner[part], column[part] - at] = 1
                both += holds[low] @ holds[high].T
            return both[np.searchsorted(low, left), np.searchsorted(high, right)].astype(np.int64)
    found = (len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left, right, strict=True))
    return np.fromiter(found, np.int64, len(left))


def _similar(table: pa.Table, depth: int, before: int | None, threshold: float):
    """The digests of a group, and its new pairs at the threshold with their similarities."""
    tree, digests, signatures, side = _group_arrays(table)
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    left, right = new_pairs(signatures, side, tree, depth, before)
    near = np.minimum(sizes[left], sizes[right]) >= threshold * np.maximum(sizes[left], sizes[right])
    left, right = left[near], right[near]
    both = overlaps(sets, left, right)
    similarity = both / (sizes[left] + sizes[right] - both)
    linked = similarity >= threshold
    return digests, left[linked], right[linked], similarity[linked]


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member each of ``n`` members is connected to by the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        for ends in (left, right, root[left], root[right]):
            np.minimum.at(new, ends, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _rows(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)], [n for n, _ in fields]
    )


_COUNTED = [("digest", pa.binary()), ("n_links", pa.int64()), ("parent", pa.binary())]
_COUNTED_DDL = "digest binary, n_links bigint, parent binary"


def _counted(depth: int, before: int | None, threshold: float):
    """One row per member of a group that has links in it: how many, and a member it is
    connected to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for table in groups(batches, "group"):
            digests, left, right, _ = _similar(table, depth, before, threshold)
            if not len(left):
                continue
            n = len(digests)
            count = np.bincount(left, minlength=n) + np.bincount(right, minlength=n)
            roots = forest(n, left, right).tolist()
            rows += [
                (digests[i], c, None if roots[i] == i else digests[roots[i]])
                for i, c in enumerate(count.tolist())
                if c
            ]
            if len(rows) >= 10_000:
                yield _rows(rows, _COUNTED)
                rows = []
        if rows:
            yield _rows(rows, _COUNTED)

    return run


_PAIRS = [("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())]
_PAIRS_DDL = "a binary, b binary, similarity double"


def _paired(depth: int, before: int | None, threshold: float):
    """The new pairs of each group, ``a`` < ``b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, "group"):
            digests, *found = _similar(table, depth, before, threshold)
            for at in range(0, len(found[0]), 10_000):
                part = zip(*(x[at : at + 10_000].tolist() for x in found), strict=True)
                yield _rows([(*sorted((digests[i], digests[j])), x) for i, j, x in part], _PAIRS)

    return run


def _prefixed(classes: DataFrame, depth: int, *keep: str) -> DataFrame:
    """One row per class and tree, with its prefix."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    each = classes.select("digest", "n", "signature", tree.alias("tree"))
    prefix = F.expr(f"substring(signature, tree * {2 * DEPTH} + 1, {2 * depth})")
    return each.select("tree", prefix.alias("prefix"), "digest", *keep)


def _buckets(classes: DataFrame, depth: int, *keep: str) -> DataFrame:
    """Members of buckets of two classes or more: ``tree``, ``prefix``, ``digest``, ``size``,
    ``bytes`` (of all its shingles)."""
    each = _prefixed(classes, depth, "n").groupBy("tree", "prefix")
    sizes = each.agg(F.count("*").alias("size"), (F.sum("n") * 8).alias("bytes"))
    several = materialise(sizes.where("size > 1"))
    return _prefixed(classes, depth, *keep).join(several.hint("merge"), ["tree", "prefix"])


def _in_groups(members: DataFrame) -> DataFrame:
    """Members dealt to groups: a bucket, or a pair of blocks of a large one."""
    enough = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES))
    blocks = F.least("size", enough).cast("int")
    placed = members.withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("digest"), blocks).cast("int")})
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = placed.select("*", other.alias("other"))
    group = F.concat_ws(
        "|", "tree", F.hex("prefix"), F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string")
    )
    side = F.when(F.expr("own = other"), WITHIN).otherwise(F.col("own"))
    return dealt.select(group.alias("group"), "tree", side.alias("side"), "digest", "signature")


def _sorted_by_group(df: DataFrame) -> DataFrame:
    return df.repartition("group").sortWithinPartitions("group")


_MEMBER = "group string, tree int, side int, digest binary, signature binary"


def _classes(docs: DataFrame, text: str, key: str, size: int) -> tuple[DataFrame, DataFrame]:
    """The rows (``doc``, ``row``, ``key``, ``text``, ``digest``) and the classes.

    Classes: ``digest``, ``first`` (the smallest key, null last, and row), ``class_id``,
    ``n`` (shingles), ``signature``.
    """
    body = F.col(text)
    named = with_row_id(docs, key=F.col(key), text=body, digest=F.unhex(F.md5(body)))
    there = named.where(F.col("text").isNotNull())
    signed = there.select("text", "key", "row", "digest").mapInArrow(
        _signatures(size),
        f"key {named.schema['key'].dataType.simpleString()}, row struct<file:bigint,index:bigint>, "
        "digest binary, n bigint, signature binary",
    )
    order = F.struct(F.col("key").isNull().alias("none"), "key", "row")
    classes = signed.groupBy("digest").agg(
        F.min(order).alias("first"), F.max("n").alias("n"), F.max("signature").alias("signature")
    )
    return named, materialise(classes.withColumn("class_id", F.col("first.key")))


def _search(named: DataFrame, classes: DataFrame, threshold: float, target: float, size: int, look, schema: str) -> DataFrame:
    """What ``look`` (``_counted`` or ``_paired``) makes of the groups, from depth to depth."""
    steps = depths(threshold, target)
    every = classes.where(F.col("signature").isNotNull())
    # classes that share no prefix at the last depth are never compared: they go at once
    shared = _buckets(every, steps[-1]).select("digest").distinct()
    several = materialise(every.join(shared.hint("merge"), "digest").select("digest", "n", "signature", F.col("first.row").alias("row")))
    texts = named.select("row", "text").join(several.select("row", "digest").hint("merge"), "row")
    sets = materialise(texts.select("text", "digest").mapInArrow(_sets(size), "digest binary, shingles binary"))
    found: list[DataFrame] = []
    before = None
    for depth in steps:
        dealt = _sorted_by_group(_in_groups(_buckets(several, depth, "signature")))
        wanted = materialise(dealt.mapInArrow(_wanted(depth, before), _MEMBER))
        full = _sorted_by_group(wanted.join(sets.hint("merge"), "digest"))
        found.append(materialise(full.mapInArrow(look(depth, before, threshold), schema)))
        before = depth
    return reduce(DataFrame.unionByName, found)


def pairs(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    threshold: float = THRESHOLD,
    target: float = TARGET,
    size: int = SHINGLE,
) -> DataFrame:
    """The links between classes as ``class_a``, ``class_b`` and ``similarity``, each once.

    Their number may grow with the square of a group of near copies; see ``join``.
    """
    named, classes = _classes(docs, text, key, size)
    found = _search(named, classes, threshold, target, size, _paired, _PAIRS_DDL)
    for side in ("a", "b"):
        ids = classes.select(F.col("digest").alias(side), F.col("class_id").alias(f"class_{side}"))
        found = found.join(ids.hint("merge"), side)
    low, high = F.least("class_a", "class_b"), F.greatest("class_a", "class_b")
    return found.select(low.alias("class_a"), high.alias("class_b"), "similarity")


def join(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    threshold: float = THRESHOLD,
    target: float = TARGET,
    size: int = SHINGLE,
) -> DataFrame:
    """One row per document: its key, ``class_id``, ``n_links`` (other texts at the threshold or
    above) and ``group_id`` (the smallest id of the texts it is connected to by links)."""
    named, classes = _classes(docs, text, key, size)
    found = _search(named, classes, threshold, target, size, _counted, _COUNTED_DDL)
    linked = found.groupBy("digest").agg(F.sum("n_links").alias("n_links"))
    near = classes.select("digest", "first").join(_labels(found).hint("merge"), "digest")
    heads = near.groupBy("label").agg(F.min("first").alias("head"))
    grouped = near.join(heads.hint("merge"), "label").select("digest", F.lit(True).alias("near"), F.col("head.key").alias("group_id"))
    known = materialise(
        classes.select("digest", "class_id")
        .join(linked.hint("merge"), "digest", "left")
        .join(grouped.hint("merge"), "digest", "left")
    )
    rows = named.select("key", "digest").join(known.hint("merge"), "digest", "left")
    return rows.select(
        F.col("key").alias(key),
        F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("key"))
        .when(F.col("near"), F.col("group_id"))
        .otherwise(F.col("class_id"))
        .alias("group_id"),
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) of an undirected graph.

    Edges are the columns ``a`` and ``b``. Labels move along edges and then jump to the label
    of the label, until none changes.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")))
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
    while True:
        told = labels.withColumnRenamed("node", "b").hint("merge")
        heard = both.join(told, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        lower = materialise(
            labels.join(heard.hint("merge"), "node").select(
                "node", F.least("label", "heard").alias("label"), F.col("label").alias("old")
            )
        )
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = materialise(lower.join(up.hint("merge"), "label").select("node", F.col("above").alias("label"), "old"))
        if new.where("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _labels(found: DataFrame) -> DataFrame:
    """``digest`` and ``label`` (of its group) of the classes that have links."""
    edges = found.where("parent is not null").select(F.col("digest").alias("a"), F.col("parent").alias("b"))
    return components(edges).withColumnRenamed("node", "digest")


def one_per_group(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    threshold: float = THRESHOLD,
    target: float = TARGET,
    size: int = SHINGLE,
) -> DataFrame:
    """``docs`` with one document of each group of linked texts, the one with the smallest id.

    Groups are connected components of the links. Documents with a null text stay.
    """
    named, classes = _classes(docs, text, key, size)
    found = _search(named, classes, threshold, target, size, _counted, _COUNTED_DDL)
    grouped = classes.join(_labels(found).hint("merge"), "digest", "left")
    group = F.coalesce("label", "digest")
    stay = materialise(grouped.groupBy(group.alias("group")).agg(F.min("first").alias("first")).select("first.row"))
    whole = named.select("doc", "row", F.col("text").isNull().alias("none"))
    kept = whole.where("not none").join(stay.hint("merge"), "row", "left_semi")
    return kept.unionByName(whole.where("none")).select("doc.*")
