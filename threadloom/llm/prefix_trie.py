"""The trie of conversation prefixes, by ROLLUP over positional columns of turn ids.

Turns become ids (hash and word count); a conversation is one row per block of ``WIDTH``
turns: the block's number and key, and its turn ids in ``t0 .. t7``. The key is the node where the block
begins, an XOR of hashes of all earlier turns with their positions, so blocks with the same
history share it. One ROLLUP over the positional columns, within block and key, aggregates
all prefixes of all blocks together; ``grouping_id`` tells each group's depth. A second
ROLLUP, over the nodes, sums whole subtrees of a block; what lies in later blocks is first brought to
their keys by pointer doubling, so the longest conversation costs log2 of its blocks in rounds.

A conversation of any length is never collected: its turns are ranked in cells of ``CELL`` turn
numbers, and hashes are chained block by block, then over groups of ``CELL`` blocks. Ids of the members that end in a
node are hashed as a stream of sorted chunks. Node ids are 128-bit hashes.

Turns without conv_id take no part. Null role and text are empty. Turns are ordered by number (null
first), equal ones by role, then text; repeated rows are turns of their own. Other columns are
ignored. An empty table gives an empty result.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import materialise

WIDTH = 8
CELL = 1024
#: Conversation ids joined to one piece of text before hashing.
CHUNK = 8192
SLOTS = [f"t{i}" for i in range(WIDTH)]
WORD = r"[^\x20\x09-\x0D]+"
_EMPTY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``ia``, ``ib`` (id of role and text) and ``words``."""
    at = F.col(f"`{turn}`").cast("long")
    rows = conversations.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
        at.alias("turn"),
        F.floor(at / CELL).alias("cell"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    of = F.struct("conv_id", "cell")  # a struct is equal also where its cell is null
    counts = rows.groupBy(of.alias("of")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("of.conv_id").orderBy(F.col("of.cell").asc_nulls_first())
    offsets = counts.select(
        "of", F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    order = Window.partitionBy("of").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    ranked = rows.select("turn", "role", "text", of.alias("of")).select("*", F.row_number().over(order).alias("k"))
    return ranked.join(offsets, "of").select(
        "of.conv_id",
        (F.col("before") + F.col("k")).alias("pos"),
        F.xxhash64(F.lit(1), "role", "text").alias("ia"),
        F.xxhash64("text", F.lit(2), "role").alias("ib"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )


def blocks(positioned: DataFrame, conversations: DataFrame) -> DataFrame:
    """Per conversation and block: ``block``, its key ``ka``, ``kb``, ``xa``, ``xb`` (the hash of its own turns) and ``SLOTS``.

    ``positioned`` has ``conv_id``, ``pos`` from 0 without gaps, ``ia``, ``ib``, ``words``;
    ``conversations`` has each ``conv_id`` once, those without turns too.
    """
    block = F.floor(F.col("pos") / WIDTH)
    hashed = positioned.select(
        "conv_id",
        block.alias("block"),
        F.floor(block / CELL).alias("cell"),
        (F.col("pos") % WIDTH).alias("slot"),
        F.xxhash64("pos", "ia", "ib").alias("a"),
        F.xxhash64("ib", "ia", "pos").alias("b"),
        "words",
    )
    parts = [
        F.max(F.when(F.col("slot") == i, F.col(c))).alias(f"{c}{i}") for i in range(WIDTH) for c in ("a", "b", "words")
    ]
    made = (
        hashed.repartition("conv_id", "cell")
        .groupBy("conv_id", "cell", "block")
        .agg(F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"), *parts)
    )
    inside = Window.partitionBy("conv_id", "cell").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    slots = [
        F.when(F.col(f"a{i}").isNotNull(), F.struct(F.col(f"a{i}").alias("a"), F.col(f"b{i}").alias("b"), F.col(f"words{i}").alias("words"))).alias(s)
        for i, s in enumerate(SLOTS)
    ]
    inner = [F.coalesce(F.bit_xor(x).over(inside), F.lit(0)).alias(k) for x, k in (("xa", "ja"), ("xb", "jb"))]
    named = materialise(made.select("conv_id", "cell", "block", "xa", "xb", *inner, *slots))
    cells = named.groupBy("conv_id", "cell").agg(F.bit_xor("xa").alias("ca"), F.bit_xor("xb").alias("cb"))
    earlier = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    outer = [F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(k) for c, k in (("ca", "oa"), ("cb", "ob"))]
    keyed = named.join(cells.select("conv_id", "cell", *outer), ["conv_id", "cell"]).select(
        "conv_id",
        "block",
        F.col("oa").bitwiseXOR(F.col("ja")).alias("ka"),
        F.col("ob").bitwiseXOR(F.col("jb")).alias("kb"),
        "xa",
        "xb",
        *SLOTS,
    )
    none = conversations.select("conv_id").join(positioned.select("conv_id"), "conv_id", "left_anti")
    zero = F.lit(0).cast("long")
    empty = none.select(
        "conv_id",
        *[zero.alias(c) for c in ("block", "ka", "kb", "xa", "xb")],
        *[F.lit(None).cast(keyed.schema[s].dataType).alias(s) for s in SLOTS],
    )
    return materialise(keyed.unionByName(empty))


def _rollup(df: DataFrame, aggregates: str) -> DataFrame:
    """Groups of every prefix: ``block``, ``ka``, ``kb``, the prefix in ``SLOTS``, ``depth`` and ``d`` (in the block)."""
    slots = ", ".join(SLOTS)
    rolled = df.sparkSession.sql(
        f"SELECT block, ka, kb, {slots}, {WIDTH} - bit_count(grouping_id()) AS d, {aggregates} "
        f"FROM {{df}} GROUP BY block, ka, kb, ROLLUP({slots})",
        df=df,
    )
    # a group is a prefix if its last turn is there; the top of a later block is the node that ends the one before
    last = F.get(F.array(*SLOTS), F.col("d") - 1)
    kept = rolled.where(F.when(F.col("d") == 0, F.col("block") == 0).otherwise(last.isNotNull()))
    return kept.select("*", (F.col("block") * WIDTH + F.col("d")).alias("depth"), F.when(F.col("d") > 0, last).alias("last"))


def _folded(key: str, part: str) -> Column:
    at = F.col(key)
    for s in SLOTS:
        at = at.bitwiseXOR(F.coalesce(F.col(f"{s}.{part}"), F.lit(0)))
    return at


def _nodes(made: DataFrame) -> DataFrame:
    """All nodes, with their ids ``a``, ``b`` and their parents' ``pa``, ``pb``."""
    groups = _rollup(made, "min(conv_id) AS conv_id, count(*) AS n_convs")
    named = groups.select("*", _folded("ka", "a").alias("a"), _folded("kb", "b").alias("b"))
    nodes = materialise(
        named.select(
            "block", "ka", "kb", *SLOTS, "d", "depth", "a", "b", "conv_id", "n_convs",
            F.col("a").bitwiseXOR(F.col("last.a")).alias("pa"),
            F.col("b").bitwiseXOR(F.col("last.b")).alias("pb"),
            F.coalesce((F.col("n_convs") - 1) * F.col("last.words"), F.lit(0)).alias("saved"),
        )
    )
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    counted = nodes.join(children.agg(F.count("*").alias("n_children")), ["depth", "a", "b"], "left")
    return materialise(counted.fillna(0, ["n_children"]).withColumn("leaf", (F.col("n_children") == 0).cast("long")))


def _later(nodes: DataFrame) -> DataFrame | None:
    """``depth``, ``a``, ``b`` of nodes that end a block, and the sums of all later blocks below them."""
    last = nodes.agg(F.max("block")).first()[0] or 0
    if last == 0:
        return None
    key = F.struct("block", "ka", "kb")
    sums = [F.sum(c).alias(c) for c in ("leaf", "saved")]
    own = nodes.where("block > 0").groupBy(key.alias("id")).agg(*sums)
    above = nodes.where(F.col("d") == WIDTH).select(
        F.struct((F.col("block") + 1).alias("block"), F.col("a").alias("ka"), F.col("b").alias("kb")).alias("id"),
        F.when(F.col("block") > 0, key).alias("above"),
    )
    total = materialise(own.join(above, "id"))
    step = 1
    while step < last:  # after each round the sums reach twice as far
        reached = total.where(F.col("above").isNotNull())
        add = reached.groupBy(F.col("above").alias("id")).agg(F.sum("leaf").alias("more_leaf"), F.sum("saved").alias("more_saved"))
        jump = total.select(F.col("id").alias("above"), F.col("above").alias("next"))
        total = materialise(
            total.join(add, "id", "left")
            .join(jump, "above", "left")
            .select(
                "id",
                F.col("next").alias("above"),
                *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaf", "saved")],
            )
        )
        step *= 2
    return total.select(
        (F.col("id.block") * WIDTH).alias("depth"),
        F.col("id.ka").alias("a"),
        F.col("id.kb").alias("b"),
        F.col("leaf").alias("later_leaf"),
        F.col("saved").alias("later_saved"),
    )


def _ends(made: DataFrame) -> DataFrame:
    """``depth``, ``a``, ``b`` and ``ends_sha256`` of nodes where conversations end."""
    filled = sum((F.col(s).isNotNull().cast("long") for s in SLOTS), F.lit(0))
    ending = made.groupBy("conv_id").agg(F.sum(filled).alias("depth"), F.bit_xor("xa").alias("a"), F.bit_xor("xb").alias("b"))
    node = ["depth", "a", "b"]
    ordered = ending.select(*node, "conv_id").repartitionByRange(*node, "conv_id").sortWithinPartitions(*node, "conv_id")
    pieces = ordered.mapInArrow(_joined, "depth long, a long, b long, first long, ids string")
    dealt = pieces.repartition(*node).sortWithinPartitions(*node, "first")
    return dealt.mapInArrow(_hashed, "depth long, a long, b long, ends_sha256 string")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of each node as comma-joined pieces of at most ``CHUNK`` ids."""
    names = ["depth", "a", "b", "first", "ids"]
    for batch in batches:
        rows, node, held = [], None, []
        for d, a, b, c in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if held and ((d, a, b) != node or len(held) >= CHUNK):
                rows.append((*node, held[0], ",".join(map(str, held))))
                held = []
            node = (d, a, b)
            held.append(c)
        if held:
            rows.append((*node, held[0], ",".join(map(str, held))))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per node over its pieces in their order; only the hash's state is held."""
    names, node, state = ["depth", "a", "b", "ends_sha256"], None, None
    for batch in batches:
        rows = []
        for d, a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
            if (d, a, b) == node:
                state.update(b",")
            else:
                if node is not None:
                    rows.append((*node, state.hexdigest()))
                node, state = (d, a, b), hashlib.sha256()
            state.update(ids.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, state.hexdigest())], names)


def trie(positioned: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. For the arguments see ``blocks``."""
    made = blocks(positioned, conversations)
    nodes = _nodes(made)
    node = ["depth", "a", "b"]
    later = _later(nodes)
    weighed = nodes
    if later is not None:
        weighed = nodes.join(later, node, "left").withColumns(
            {c: F.col(c) + F.coalesce(f"later_{c}", F.lit(0)) for c in ("leaf", "saved")}
        )
    groups = _rollup(weighed, "sum(leaf) AS n_leaves, sum(saved) AS saved_tokens")
    sums = groups.select("depth", _folded("ka", "a").alias("a"), _folded("kb", "b").alias("b"), "n_leaves", "saved_tokens")
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id")
    )
    slim = nodes.select(*node, "pa", "pb", "conv_id", "n_convs", "n_children")
    return (
        slim.join(sums, node)
        .join(_ends(made), node, "left")
        .join(parents, ["depth", "pa", "pb"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )


def with_shared_heads(own: DataFrame, group: int, head: Column) -> tuple[DataFrame, DataFrame]:
    """Rebuild conversations that share the first turns of their group's first conversation.

    Conversation c begins with the first ``head`` turns (at most 3; a column over ``conv_id``)
    of conversation c - c % ``group``, all of them if it has fewer and none if it is not
    there; then come its own turns after its first ``head``. Returns the arguments of ``trie``.
    """
    counts = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % group
    named = counts.select("conv_id", "n", base.alias("base"), head.cast("long").alias("h"))
    sizes = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    built = materialise(
        named.join(sizes, "base", "left").select(
            "conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")
        )
    )
    heads = own.where((F.col("conv_id") % group == 0) & (F.col("pos") <= 3)).withColumnRenamed("conv_id", "base")
    shared = built.where("taken > 0").join(heads, "base").where("pos <= taken")
    kept = own.join(built, "conv_id").where("pos > h")
    ids = ("ia", "ib", "words")
    positioned = shared.select("conv_id", (F.col("pos") - 1).alias("pos"), *ids).unionByName(
        kept.select("conv_id", (F.col("pos") - 1 - F.col("h") + F.col("taken")).alias("pos"), *ids)
    )
    return materialise(positioned), built
