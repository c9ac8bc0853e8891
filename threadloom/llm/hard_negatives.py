"""Hard negatives by an inverted multi-index.

Vectors become integers, floor(256 x), and are cut into two halves. Each half-space has a
codebook (k-means on a bounded sample); the pair of nearest codes is a row's cell. For an anchor, a
half's score in a code is at most its product with the centre plus its norm times the code's
radius (the largest distance of any row from that centre), and the sum of two such bounds holds for every row of
a cell. The multi-sequence heap visits cells in the order of falling sums and stops when what is
left cannot change a result: the window is certified. So results are exact, whatever the sample
and the codebooks; these only decide how early a search ends.

Rows are dealt by cell into blocks of about ``block_rows`` (small cells together, a large cell
in several), anchors go to the blocks whose bound reaches what they still look for, in three rounds: their
nearest cells, for a first limit; all others that can hold one of the first positives; and, when the
positives' scores are known, those that reach into the windows of negatives. A block is in memory
with its rows only, anchors pass by in batches; very many anchors are cut into slices, each with its own copy of the block.

Rows with a null label, a null vector, or a null or non-finite component take no part. Shorter
vectors are filled with zeros. Ids may repeat (rows are told apart by their place) or be null (a null id comes
last among ties and is no anchor by default). Scores must fit a long. Other columns are ignored; an empty
table gives an empty result.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import with_row_id
from threadloom.session import materialise

SCALE = 256
#: Anchors whose bounds are computed at once.
BATCH = 256
_NONE = np.iinfo(np.int64).max
FOUND = "file long, index long, k int, score long, id long"
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


@dataclass(frozen=True)
class Shape:
    """Codes per half, rows the codebooks are fitted on, rounds of k-means, rows of a block, anchors of a slice."""

    codes: int = 16
    sample: int = 4096
    rounds: int = 8
    block_rows: int = 8192
    slice_rows: int = 1 << 18


def vectors(rows: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``row``, ``id``, ``label``, ``anchor`` and the integer vector ``v`` of rows that take part."""
    named = with_row_id(
        rows,
        id=F.col(f"`{vec_id}`").cast("long"),
        label=F.col(f"`{label}`").cast("long"),
        anchor=F.coalesce(anchor, F.lit(False)),
        x=F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double")),
    )
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = named.where(F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    return whole.select("row", "id", "label", "anchor", F.transform("x", lambda x: F.floor(x * SCALE)).alias("v"))


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Lists of integers as rows of a matrix, filled up with zeros."""
    sizes, values = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
    if (sizes == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = values
    return out


def k_means(x: np.ndarray, codes: int, rounds: int) -> np.ndarray:
    """At most ``codes`` centres of the rows of ``x``; the start is a fixed draw of different rows."""
    different = np.unique(x, axis=0)
    start = np.random.default_rng(0).permutation(len(different))[:codes]
    centres = different[start]
    for _ in range(rounds):
        code = nearest(x, centres)
        size = np.bincount(code, minlength=len(centres))
        for k in np.flatnonzero(size):
            centres[k] = x[code == k].mean(axis=0)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * (x @ centres.T)).argmin(1)


@dataclass
class Codebooks:
    """Centres of the two half-spaces; the first ``half`` components are the first."""

    dims: int
    half: int
    centres: tuple[np.ndarray, np.ndarray]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half :]


def fit(rows: DataFrame, shape: Shape) -> Codebooks | None:
    """Codebooks from the ``shape.sample`` rows that come first by a hash; None if there are no rows."""
    dims = rows.agg(F.max(F.size("v"))).first()[0]
    if dims is None:
        return None
    hashed = F.xxhash64("v", "id")
    drawn = rows.select("v", hashed.alias("h")).orderBy("h").limit(shape.sample).select("v").toArrow()
    x = matrix(drawn.column(0).combine_chunks(), dims).astype(float)
    books = Codebooks(dims, dims // 2, ())
    books.centres = tuple(k_means(half, shape.codes, shape.rounds) for half in books.halves(x))
    return books


def coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """Rows with their codes ``c1``, ``c2``, the distances ``r1``, ``r2`` from the centres, and the vector as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(4), books.dims)
            codes, far = [], []
            for half, centres in zip(books.halves(x.astype(float)), books.centres, strict=True):
                code = nearest(half, centres)
                codes.append(pa.array(code.astype(np.int32)))
                far.append(pa.array(np.sqrt(((half - centres[code]) ** 2).sum(1))))
            packed = pa.array([r.tobytes() for r in np.ascontiguousarray(x, "<i8")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *codes, *far, packed], names)

    names = ["row", "id", "label", "anchor", "c1", "c2", "r1", "r2", "vec"]
    schema = T.StructType([*rows.select("row", "id", "label", "anchor").schema.fields, *T.StructType.fromDDL("c1 int, c2 int, r1 double, r2 double, vec binary").fields])
    return materialise(rows.select("row", "id", "label", "anchor", "v").mapInArrow(run, schema))


@dataclass
class Plan:
    """The cells: their codes, the radii of the codes, and how cells are dealt into groups of blocks.

    At most ``codes`` squared cells, whatever the number of rows. Group g has ``count[g]``
    blocks from ``base[g]`` on and the cells from ``first[g]`` to the next group's.
    """

    books: Codebooks
    radii: tuple[np.ndarray, np.ndarray]
    c1: np.ndarray
    c2: np.ndarray
    first: np.ndarray
    base: np.ndarray
    count: np.ndarray
    slices: int

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per anchor and code, what a half's score is at most, with room for rounding."""
        out = []
        for half, centres, radius in zip(self.books.halves(x), self.books.centres, self.radii, strict=True):
            top = half @ centres.T + np.sqrt((half**2).sum(1))[:, None] * radius
            out.append(top + 1 + np.abs(top) * 1e-9)
        return tuple(out)

    def group_bounds(self, x: np.ndarray) -> np.ndarray:
        one, two = self.bounds(x)
        return np.maximum.reduceat(one[:, self.c1] + two[:, self.c2], self.first, axis=1)


def plan(rows: DataFrame, books: Codebooks, shape: Shape) -> Plan:
    stats = rows.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect()
    radii = tuple(np.zeros(len(c)) for c in books.centres)
    for s in stats:
        for radius, code, far in zip(radii, (s.c1, s.c2), (s.r1, s.r2), strict=True):
            radius[code] = max(radius[code], far * (1 + 1e-9))
    cells = sorted((s.c1, s.c2, s.n) for s in stats)
    first, sizes = [], []
    for k, (_, _, n) in enumerate(cells):
        if not sizes or sizes[-1] + n > shape.block_rows:
            first.append(k)
            sizes.append(0)
        sizes[-1] += n
    count = -(-np.array(sizes) // shape.block_rows)
    anchors = rows.where("anchor").count()
    return Plan(
        books,
        radii,
        np.array([c[0] for c in cells]),
        np.array([c[1] for c in cells]),
        np.array(first),
        np.cumsum(count) - count,
        count,
        max(1, -(-anchors // shape.slice_rows)),
    )


def _dealt(rows: DataFrame, cells: Plan) -> DataFrame:
    """Every row in its block, once for each slice of the anchors."""
    of = np.repeat(np.arange(len(cells.first)), np.diff([*cells.first, len(cells.c1)]))
    table = [
        (int(a), int(b), k, int(cells.base[g]), int(cells.count[g]))
        for k, (a, b, g) in enumerate(zip(cells.c1, cells.c2, of, strict=True))
    ]
    spark = rows.sparkSession
    known = spark.createDataFrame(table, "c1 int, c2 int, cell int, base long, count long")
    block = F.col("base") + F.pmod(F.xxhash64("row"), F.col("count"))
    return rows.join(F.broadcast(known), ["c1", "c2"]).select(  # as many cells as codes squared
        block.alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(cells.slices - 1))).alias("slice"),
        F.lit(0).alias("kind"),
        "cell",
        "label",
        "id",
        "row",
        "vec",
        F.lit(None).cast("array<long>").alias("limits"),
    )


def _routed(anchors: DataFrame, cells: Plan, phase: str) -> DataFrame:
    """Anchors with their ``limits``, once for each block they visit in a phase.

    "home": the group with the highest bound. "others": all other groups that reach the limit,
    if there is one. "windows": all groups that reach the lowest score of a window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                top = cells.group_bounds(_unpack(part.column(3), cells.books.dims).astype(float))
                home = top.argmax(1)
                limits = part.column(4).to_pylist()
                chosen = []
                for k, limit in enumerate(limits):
                    if phase == "home":
                        visit = home[k : k + 1]
                    else:
                        visit = np.flatnonzero(top[k] >= (limit[-1] if limit else -np.inf))
                        visit = visit[visit != home[k]] if phase == "others" else visit
                    chosen.append([{"base": int(cells.base[g]), "last": int(cells.base[g] + cells.count[g] - 1)} for g in visit])
                groups = pa.array(chosen, pa.list_(pa.struct([("base", pa.int64()), ("last", pa.int64())])))
                yield pa.RecordBatch.from_arrays([*part.columns, groups], [*names, "groups"])

    names = ["row", "id", "label", "vec", "limits"]
    schema = T.StructType([*anchors.select(*names).schema.fields, *T.StructType.fromDDL("groups array<struct<base: long, last: long>>").fields])
    routed = anchors.select(*names).mapInArrow(run, schema).select(*names, F.explode("groups").alias("g"))
    return routed.select(
        F.explode(F.sequence("g.base", "g.last")).alias("block"),
        F.pmod(F.xxhash64("row"), F.lit(cells.slices)).cast("int").alias("slice"),
        F.lit(1).alias("kind"),
        F.lit(0).alias("cell"),
        "label",
        "id",
        "row",
        "vec",
        "limits",
    )


def _unpack(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dims)


def multi_sequence(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs of codes in the order of falling sums of their bounds: the sum, and the two codes."""
    i, j = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    a, b = one[i].tolist(), two[j].tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        bound, x, y = heapq.heappop(heap)
        yield -bound, int(i[x]), int(j[y])
        if y + 1 < len(b):
            heapq.heappush(heap, (-(a[x] + b[y + 1]), x, y + 1))
        if y == 0 and x + 1 < len(a):
            heapq.heappush(heap, (-(a[x + 1] + b[0]), x + 1, 0))


class Block:
    """The rows of one block, sorted by cell and label, and searches in them."""

    def __init__(self, table: pa.Table, cells: Plan):
        self.cells = cells
        cell, label = table["cell"].to_numpy(), table["label"].to_numpy()
        order = np.lexsort((label, cell))
        self.x = _unpack(table["vec"].combine_chunks(), cells.books.dims)[order]
        self.real = self.x.astype(float)
        self.most = float(np.abs(self.real).max(initial=0)) * max(1, cells.books.dims)
        self.label = label[order]
        given = table["id"].combine_chunks()
        self.null = given.is_null().to_numpy(zero_copy_only=False)[order]
        self.id = given.fill_null(_NONE).to_numpy()[order]
        rows = table["row"].combine_chunks()
        self.place = {p: k for k, p in enumerate(zip(rows.field("file").to_numpy()[order].tolist(), rows.field("index").to_numpy()[order].tolist(), strict=True))}
        found, starts = np.unique(cell[order], return_index=True)
        stops = [*starts[1:].tolist(), len(cell)]
        self.span = {
            (int(cells.c1[c]), int(cells.c2[c])): (a, b) for c, a, b in zip(found.tolist(), starts.tolist(), stops, strict=True)
        }
        self.codes = [np.unique([k[i] for k in self.span]) for i in (0, 1)]
        self.visited = 0

    def visit(self, one: np.ndarray, two: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """The bound and the span of rows of each cell, highest bound first."""
        for bound, i, j in multi_sequence(one[self.codes[0]], two[self.codes[1]]):
            span = self.span.get((int(self.codes[0][i]), int(self.codes[1][j])))
            if span:
                self.visited += 1
                yield bound, *span

    def scores(self, a: int, b: int, q: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Exact products: in doubles where no sum can leave their exact range."""
        if self.most * np.abs(real).max(initial=0) < 2**53:
            return (self.real[a:b] @ real).astype(np.int64)
        return self.x[a:b] @ q

    def _best(self, best: list, scores: np.ndarray, at: np.ndarray, n: int) -> list:
        """The first ``n`` of ``best`` (sorted: falling score, rising id) and further rows."""
        if len(at) > 4 * n:
            few = np.lexsort((self.id[at], -scores))[:n]
            scores, at = scores[few], at[few]
        return sorted([*best, *zip((-scores).tolist(), self.id[at].tolist(), at.tolist(), strict=True)])[:n]

    def positives(self, q, label: int, me: tuple, limit: list, n: int, bounds) -> list:
        """The first ``n`` other rows of a label with at least the score ``limit``."""
        real, best, floor = q.astype(float), [], limit[-1] if limit else -np.inf
        own = self.place.get(me, -1)
        for bound, a, b in self.visit(*bounds):
            if bound < floor:  # certified: no row of this or any later cell gets so far
                break
            labels = self.label[a:b]
            a, b = a + int(labels.searchsorted(label)), a + int(labels.searchsorted(label, "right"))
            if a == b:
                continue
            scores = self.scores(a, b, q, real)
            take = scores >= floor
            if a <= own < b:
                take[own - a] = False
            at = np.flatnonzero(take)
            best = self._best(best, scores[at], at + a, n)
            if len(best) == n:
                floor = max(floor, -best[-1][0])
        return [(0, -s, at) for s, _, at in best]

    def negatives(self, q, label: int, me: tuple, tops: list, n: int, bounds, share: int) -> list:
        """Per window, the first ``n`` rows of other labels; ``tops``: scores of the positives, and the lowest of all."""
        real = q.astype(float)
        windows = {k: (low(top, share), top) for k, top in enumerate(tops[:-1])}
        floors = {k: a for k, (a, b) in windows.items() if a <= b}
        best = {k: [] for k in floors}
        for bound, a, b in self.visit(*bounds):
            least = min(floors.values(), default=np.inf)
            if bound < least:
                break
            scores = self.scores(a, b, q, real)
            at = np.flatnonzero((scores >= least) & (scores <= tops[0]) & (self.label[a:b] != label))
            if not len(at):
                continue
            for k in floors:
                inside = at[(scores[at] >= floors[k]) & (scores[at] <= tops[k])]
                if len(inside):
                    best[k] = self._best(best[k], scores[inside], inside + a, n)
                    if len(best[k]) == n:
                        floors[k] = max(floors[k], -best[k][-1][0])
        return [(k, -s, at) for k, found in best.items() for s, _, at in found]


def low(top: int, share: int) -> int:
    """The least integer score of at least ``share`` per cent of ``top``."""
    return -((-share * top) // 100)


def _search(rows: DataFrame, anchors: DataFrame, cells: Plan, phase: str, n: int, share: int) -> DataFrame:
    """What anchors find in a phase: their place, the window ``k``, score and id, at most ``n`` per block and window."""

    def answers(block: Block, part: pa.RecordBatch) -> pa.RecordBatch:
        x = _unpack(part.column("vec"), cells.books.dims)
        bounds = cells.bounds(x.astype(float))
        places = part.column("row").to_pylist()
        out = []
        for k, (label, limits) in enumerate(zip(part.column("label").to_pylist(), part.column("limits").to_pylist(), strict=True)):
            me = (places[k]["file"], places[k]["index"])
            given = x[k], label, me, limits, n, (bounds[0][k], bounds[1][k])
            found = block.negatives(*given, share) if phase == "windows" else block.positives(*given)
            out += [(*me, w, score, None if block.null[at] else int(block.id[at])) for w, score, at in found]
        columns = zip(*out, strict=True) if out else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        names = ["file", "index", "k", "score", "id"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("block", "slice", "kind")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                part, own = batch.slice(a, b - a), tuple(keys[:2, a].tolist())
                if own != key:
                    key, held, block = own, [], None
                if keys[2, a] == 0:
                    held.append(part)
                    continue
                if block is None and held:
                    block, held = Block(pa.Table.from_batches(held), cells), []
                for at in range(0, part.num_rows if block else 0, BATCH):
                    yield answers(block, part.slice(at, BATCH))

    blocks = int(cells.count.sum()) * cells.slices
    both = _dealt(rows, cells).unionByName(_routed(anchors, cells, phase))
    order = ["block", "slice", "kind"]
    dealt = both.repartition(min(max(blocks, 1), 1 << 16), "block", "slice").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, FOUND)


def _first(found: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each anchor and window, ranked from 1."""
    order = Window.partitionBy("file", "index", "k").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= n)


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    share: int = 80,
    shape: Shape = Shape(),
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """The hard negatives of each anchor and positive, in the columns of ``RESULT``.

    An anchor's positives are its first ``positives`` other rows of the same label by inner product
    (ties: smaller id); their negatives the first ``negatives`` rows of other labels whose score is
    at most the positive's and at least ``share`` per cent of it.
    """
    taking = vectors(rows, anchor, vec_id, vector, label)
    books = fit(taking, shape)
    if books is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    index = coded(taking, books)
    cells = plan(index, books, shape)
    asking = index.where("anchor").select("row", "id", "label", "vec")
    place = ["row"]
    at = F.struct("file", "index").alias("row")

    def limited(limits: DataFrame) -> DataFrame:
        return asking.join(limits, place, "left").withColumn("limits", F.coalesce("limits", F.array().cast("array<long>")))

    none = asking.withColumn("limits", F.array().cast("array<long>"))
    near = materialise(_first(_search(index, none, cells, "home", positives, share), positives))
    least = near.where(F.col("rank") == positives).select(at, F.array("score").alias("limits"))
    rest = _search(index, limited(least), cells, "others", positives, share)
    best = materialise(_first(near.drop("rank").unionByName(rest), positives))
    # the scores in their order, and last the lowest that any window of a positive score reaches
    tops = best.groupBy(at).agg(F.sort_array(F.collect_list("score"), asc=False).alias("tops"))
    least = F.array_min(F.filter("tops", lambda s: s >= 0)).cast("decimal(20,0)")
    lowest = F.ceil(least * share / 100).cast("long")
    windows = tops.select("row", F.concat("tops", F.array(lowest)).alias("limits")).where(lowest.isNotNull())
    reached = asking.join(windows, place)
    found = _first(_search(index, reached, cells, "windows", negatives, share), negatives)
    owners = best.join(asking.select("row.file", "row.index", F.col("id").alias("anchor_id")), ["file", "index"])
    given = owners.select(
        "file", "index", (F.col("rank") - 1).alias("k"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return found.join(given, ["file", "index", "k"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
