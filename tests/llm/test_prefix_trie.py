"""The trie of prefixes against a plain version, with long conversations and odd rows."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from threadloom.llm import prefix_trie
from threadloom.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, pos string, block string"


def brute(conversations: dict) -> list[tuple]:
    """All nodes of {conv_id: [(role, text), ..]} by walking every prefix."""
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)

    def below(p):
        return [q for q in members if q[: len(p)] == p]

    def saved(p):
        return (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0

    children = {p: [q for q in members if q and q[:-1] == p] for p in members}
    out = []
    for p, found in members.items():
        ends = sorted(c for c, turns in conversations.items() if tuple(turns) == p)
        out.append((
            min(found), len(p), min(members[p[:-1]]) if p else None, len(found), len(children[p]),
            sum(not children[q] for q in below(p)), sum(map(saved, below(p))),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[1], r[0]))


def rebuilt(rows, group=20):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    head = lambda c: zlib.crc32(str(c).encode()) % 4
    base = lambda c: c - int(math.fmod(c, group))  # noqa: E731  (the remainder of SQL has the sign of c)
    return {c: [*own.get(base(c), [])[: head(c)], *turns[head(c) :]] for c, turns in own.items()}


def by_spark(spark, rows):
    df = spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA)
    own = prefix_trie.turns(df)
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    got = prefix_trie.trie(*prefix_trie.with_shared_heads(own, 20, head))
    return sorted(map(tuple, got.collect()), key=lambda r: (r[1], r[0]))


def some(seed, conversations, longest, words=3):
    rng, rows = random.Random(seed), []
    for c in range(0, conversations):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), " ".join(rng.choices("ab", k=rng.randint(0, words))) or None))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_short_conversations(spark, seed):
    rows = some(seed, 45, 8)
    assert by_spark(spark, rows) == brute(rebuilt(rows))


def test_long_conversations_continue_in_further_blocks(spark, monkeypatch):
    """Conversations of up to 90 turns that share up to 80; cells of 2 blocks, ids joined in twos."""
    monkeypatch.setattr(prefix_trie, "CELL", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK", 2)
    rng, rows = random.Random(5), []
    for c in range(12):
        shared, n = rng.choice([0, 8, 16, 17, 40, 80]), rng.choice([80, 81, 88, 90])
        rows += [(c, t, "user", "s" if t < shared else f"own {c}") for t in range(n)]
    rows += [(c, t, "user", "s") for c in range(20, 26) for t in range(16)]
    assert by_spark(spark, rows) == brute(rebuilt(rows))


def test_odd_rows(spark):
    """No ids, no turn numbers, equal turn numbers, repeated rows, negative and turnless conversations, a very long text."""
    rows = [(None, 1, "user", "gone"), (1, None, None, None), (1, None, None, None), (1, 5, "user", "b"), (1, 5, "assistant", "c")]
    rows += [(0, 0, "user", "w " * 50_000), (20, 3, "user", ""), (21, 1, "user", "only"), (22, 1, "x", "only"), (-3, 2, "user", "n"), (-40, 1, "user", "m")]
    rows += [(c, 0, "user", "hot") for c in range(100, 160)]
    rows += [(c, 0, "user", "alone") for c in range(4001, 4009)]  # without a first conversation some lose their only turn
    want = rebuilt(rows)
    assert any(not turns for turns in want.values())
    assert by_spark(spark, rows) == brute(want)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    own = prefix_trie.turns(df)
    assert prefix_trie.trie(*prefix_trie.with_shared_heads(own, 20, F.lit(1))).count() == 0


def test_query_holds_every_conversation_once(spark, sf):
    nodes = op13_prefix_trie(spark, sf).collect()
    n = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count()
    root = [r for r in nodes if r.depth == 0]
    assert len(root) == 1 and root[0].n_convs == n
    assert root[0].n_leaves == sum(r.n_children == 0 for r in nodes)
