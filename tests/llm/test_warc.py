import gzip
import hashlib
import io
import json

import pytest

from threadloom.llm import warc
from threadloom.llm.queries import op3_warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


BIG = "<p>Übergröße</p>" * 20


def round_trip(spark, rows, folder, **options):
    streams = warc.write(warc.plan(pages(spark, rows)), f"{folder}/streams", **options)
    made = warc.normalise(streams, f"{folder}/records")
    return streams, made, warc.read(made, str(folder)).collect()


def test_round_trip(spark, tmp_path):
    rows = [(1, "http://a/ü?x=1 2", BIG), (0, None, BIG), (5, "http://b", "small"), (6, "http://c\r\nX: y", "small"),
            (7, "u", None), (None, "v", BIG), (9, "w", ""), (9, "w", "x" * 99), (10, "w", "x" * 99), (11, "t", "y" * 3_000_000)]
    _, _, got = round_trip(spark, rows, tmp_path)
    assert len(got) == len(rows)
    want = sorted((str(p), len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), u or "") for p, u, h in rows)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.url) for r in got) == want
    big = {r.page_id: (r.record_type, r.refers_to) for r in got if r.payload_digest == hashlib.sha256(BIG.encode()).hexdigest()}
    assert big == {0: ("response", None), 1: ("revisit", 0), None: ("revisit", 0)}
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 100)


def test_ids_that_are_no_numbers_are_an_error(spark):
    with pytest.raises(ValueError):
        warc.plan(spark.createDataFrame([("a", "u", "h")], "page_id string, url string, html string"))


def test_members_stand_alone_and_the_index_finds_them(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<html>{i}</html>" * (i + 1)) for i in range(50)]
    streams, made, _ = round_trip(spark, rows, tmp_path, archive_bytes=4000)
    assert streams.count() > 1 and made.selectExpr("sum(records)").first()[0] == 50
    for row in streams.collect():  # one member only
        with open(row.path, "rb") as file:
            data = file.read()
        stream = warc.zlib.decompressobj(wbits=31)
        stream.decompress(data)
        assert stream.eof and not stream.unused_data
    for row in made.collect():
        with open(row.path, "rb") as file:
            data = file.read()
        with open(f"{row.path}.idx") as file:
            entries = [json.loads(line) for line in file]
        at = 0
        for e in entries:
            assert e["offset"] == at
            member = gzip.decompress(data[at : at + e["length"]])
            assert member.startswith(b"WARC/1.1\r\n") and e["id"].encode() in member and member.endswith(b"\r\n\r\n")
            at += e["length"]
        assert at == len(data)


@pytest.mark.parametrize("piece", [1, 7, 1000, 1 << 18])
def test_streams_are_read_in_pieces_of_any_size(monkeypatch, piece):
    monkeypatch.setattr(warc, "_PIECE", piece)
    records = [warc.record(i, "u", b"\r\n\r\n" * i + b"x" * 50 * i, "d") for i in range(6)]
    for data in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        target = io.BytesIO()
        entries = list(warc.normalise_file(io.BytesIO(data), target))
        out = target.getvalue()
        assert [gzip.decompress(out[e["offset"] : e["offset"] + e["length"]]) for e in entries] == records


def test_truncated_archive_is_an_error():
    data = gzip.compress(warc.record(1, "u", b"x" * 1000, "d"))
    with pytest.raises(EOFError):
        list(warc.normalise_file(io.BytesIO(data[:100]), io.BytesIO()))


def test_repeated_rows_leave_one_response(spark, tmp_path):
    _, _, got = round_trip(spark, [(None, "u", BIG)] * 3 + [(4, "u", BIG)] * 3, tmp_path)
    assert sorted((r.record_type, r.page_id, r.refers_to) for r in got if r.page_id == 4) == [
        ("response", 4, None), ("revisit", 4, 4), ("revisit", 4, 4)]
    assert [(r.record_type, r.refers_to) for r in got if r.page_id is None] == [("revisit", 4)] * 3


def test_empty_table(spark, tmp_path):
    assert round_trip(spark, [], tmp_path)[2] == []


def test_extra_columns(spark, tmp_path):
    df = pages(spark, [(1, "u", BIG), (2, "u", BIG)]).selectExpr("*", "'x' as digest", "1 as row", "2 as doc", "3 as first", "'m' as _metadata")
    made = warc.archive_pages(df, str(tmp_path))
    assert sorted(r.record_type for r in warc.read(made, str(tmp_path)).collect()) == ["response", "revisit"]


def test_query_reads_every_page(spark, sf):
    assert op3_warc(spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()
