"""Dumps read in splits: every line once and in order, wherever frames and splits end."""

import gzip
import io
import random
import tempfile

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from threadloom import schemas
from threadloom.sources import dumps, readers


def zstd(data, checksum=True):
    return zstandard.ZstdCompressor(write_checksum=checksum).compress(data)


def skippable(n):
    return dumps.ZSTD_SKIPPABLE[3] + n.to_bytes(4, "little") + dumps.ZSTD_FRAME[:1] * n


def lines_in_splits(data: bytes, split: int) -> list[str]:
    reader = dumps.DumpReader([["x", len(data)]], split)
    out = []
    for p in reader.partitions():
        pieces = dumps.contents(io.BytesIO(data), p.start, p.stop, p.size)
        out += [line.decode() for line in dumps.split_lines(pieces, p.start == 0) if line]
    return out


texts = st.lists(st.text(alphabet='ab"{é漢\r ', max_size=12), max_size=30)


@settings(max_examples=300, deadline=None)
@given(texts, st.integers(1, 40), st.integers(1, 120), st.sampled_from(["zstd", "gzip", "plain"]), st.booleans(), st.booleans())
def test_every_line_once(lines, frame, split, codec, ends, extras):
    text = ("\n".join(lines) + ("\n" if ends else "")).encode()
    parts = [text[i : i + frame] for i in range(0, len(text), frame)] or [b""]
    if codec == "zstd":
        data = b"".join((skippable(5) if extras and i % 2 else b"") + zstd(p, i % 3 > 0) for i, p in enumerate(parts))
    elif codec == "gzip":
        data = b"".join(map(gzip.compress, parts)) + (b"\0" * 7 if extras else b"")
    else:
        data = text
    want = [x for line in text.decode().split("\n") for x in line.split("\r") if x]
    assert lines_in_splits(data, split) == want


def test_magic_numbers_inside_frames_are_no_borders():
    rng = random.Random(1)
    noise = [bytes(rng.randrange(256) for _ in range(40)).replace(b"\n", b"").replace(b"\r", b"").hex() for _ in range(50)]
    inner = zstd(b"inner\n") + gzip.compress(b"inner\n") + dumps.ZSTD_FRAME + dumps.GZIP_MEMBER
    for pack in (lambda b: zstandard.ZstdCompressor(level=1).compress(b), lambda b: gzip.compress(b, 0)):
        body = "\n".join(noise).encode() + b"\n" + inner[:30].replace(b"\n", b"").replace(b"\r", b"")
        data = pack(body) + pack(b"\nlast\n")
        at = len(pack(body))
        proves = dumps.is_zstd_border if data.startswith(dumps.ZSTD_FRAME) else dumps.is_gzip_border
        file = io.BytesIO(data)
        borders = [i for i in range(len(data)) if proves(file, i, len(data))]
        assert borders == [0, at] or at in borders and all(data[i:].startswith((dumps.ZSTD_FRAME, dumps.GZIP_MEMBER)) for i in borders)


def test_broken_files_are_errors():
    whole = zstd(b"a\n" * 5000) + zstd(b"b\n" * 5000)
    for data in (whole[:-3], gzip.compress(b"a\n" * 5000)[:-9]):
        with pytest.raises(EOFError):
            lines_in_splits(data, 1 << 20)


@pytest.mark.parametrize("codec", ["zstd", "gzip"])
def test_one_file_is_read_by_many_tasks(spark, sf, codec):
    """As ``read_dump`` reads it, with the same order; and with more than one task."""
    folder = tempfile.mkdtemp(prefix="threadloom-test-")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.selectExpr("to_json(struct(doc_id as id, lang as subreddit, text as body, n_chars as score)) as value", "doc_id")
    made = dumps.write_frames(rows.coalesce(1).sortWithinPartitions("doc_id"), folder, codec, 20_000).collect()
    assert [r.lines for r in made] == [docs.count()]
    split = readers.read_dump(spark, folder, schemas.RAW_COMMENTS, "at", split_bytes=20_000)
    assert split.rdd.getNumPartitions() > 5
    whole = readers.read_dump(spark, folder, schemas.RAW_COMMENTS, "at")
    drop = lambda df: [tuple(r) for r in df.sort("at").drop("at").collect()]
    assert drop(split) == drop(whole) and len(drop(split)) == docs.count()
    tasks = {r.at["block"] for r in split.select("at").collect()}
    assert len(tasks) > 5


def test_large_windows(spark, tmp_path):
    """A window beyond 2**27 cannot be read by the built-in reader."""
    options = zstandard.ZstdCompressionParameters(window_log=28, hash_log=12, chain_log=12, strategy=zstandard.STRATEGY_FAST)
    packer = zstandard.ZstdCompressor(compression_params=options).compressobj()
    data = packer.compress(b'{"id": "a", "score": 3}\n') + packer.flush()
    (tmp_path / "wide.zst").write_bytes(data)
    got = readers.read_dump(spark, str(tmp_path / "*.zst"), schemas.RAW_COMMENTS, split_bytes=1 << 20)
    assert [(r.id, r.score) for r in readers.good_rows(got).collect()] == [("a", 3)]


def test_files_and_patterns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.zst").write_bytes(zstd(b"b\n"))
    (tmp_path / "in" / "a.txt").write_bytes(b"a1\n\t \na2")
    (tmp_path / "in" / "_hidden").write_bytes(b"no\n")
    (tmp_path / "in" / "empty.gz").write_bytes(b"")
    rows = readers.read_lines(spark, str(tmp_path / "in"), "at", split_bytes=4)
    assert [r.value for r in rows.sort("at").collect()] == ["a1", "a2", "b"]
    assert readers.read_lines(spark, [str(tmp_path / "in" / "empty.gz")], split_bytes=4).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_lines(spark, str(tmp_path / "none*"), split_bytes=4)


def test_blank_lines_are_of_any_white_space(spark, tmp_path):
    (tmp_path / "x.txt").write_text("a\n\t\n  　\n\x1c\nb\n")
    for split in (None, 3):
        assert sorted(r.value for r in readers.read_lines(spark, str(tmp_path), split_bytes=split).collect()) == ["a", "b"]
