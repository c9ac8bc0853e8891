"""WARC archives: writing them as one gzip stream, and normalising such streams.

``write`` makes one archive of every few thousand pages: a single gzip stream over all
records, the form that cannot be read at random. ``normalise`` inflates each stream once, from
start to end in small pieces, writes every record as a gzip member of its own, and beside the
archive a sidecar ``.idx``: one JSON line per record with its id, type, uri, offset, length and payload
digest. ``read`` goes through the index: it seeks each member and inflates just that.

Records with equal payloads of at least ``MIN_PAYLOAD`` bytes are written once: the one with
the smallest page id (null last, then the place in the files) is the response, the others are
revisits that name it and carry the digest and length of the full payload.

Every task writes files of new names to the shared folder and reports them; only reported
files are read, so a lost or repeated task leaves nothing wrong (its files stay unread until
the folder is deleted). Memory is one record at most.

A null html is an empty payload, a null url an empty target, a null page id is kept as null.
Repeated rows are records of their own. Other columns are not written.
"""

import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import as_bytes, with_row_id
from threadloom.session import materialise, new_stage, shared_folder

MIN_PAYLOAD = 100
ARCHIVE_BYTES = 1 << 26
LEVEL = 4
_PIECE = 1 << 18
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_DATE = "2020-01-01T00:00:00Z"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI, and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """One record: head, blank line, block, two line ends."""
    block = b"" if revisit else _HTTP + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=_URI)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>",
        ]
    else:
        head.append("Content-Type: application/http; msgtype=response")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URI = "!#$&'()*+,/:;=?@[]~%"


def plan(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Per page what its record will be: id, url, payload, digest, whether it is a revisit, and of which page.
    Page ids are whole numbers; other types are an error."""
    if not isinstance(pages.schema[page_id].dataType, T.IntegralType):
        raise ValueError("page ids must be whole numbers")
    body = F.coalesce(F.col(html), F.lit(""))
    named = with_row_id(pages, page_id=F.col(page_id), url=F.col(url), html=body, digest=F.sha2(body, 256)).drop("doc")
    long_enough = named.where(F.octet_length("html") >= min_payload)
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    firsts = materialise(
        long_enough.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    joined = named.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("row") != F.col("first.row"))
    return joined.select("page_id", "url", "html", "digest", revisit.alias("revisit"), F.col("first.page_id").alias("refers_to"))


def write(planned: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records as monolithic archives; one row per archive: ``path``, ``records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        done, out, packer, size, n = [], None, None, 0, 0

        def close():
            out.write(packer.flush())
            out.close()
            done.append((path, n))

        for batch in batches:
            columns = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2))]
            columns += [batch.column(i).to_pylist() for i in (3, 4, 5)]
            for page, url, payload, digest, revisit, refers_to in zip(*columns, strict=True):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, packer, size, n = system.open_output_stream(path, compression=None), zlib.compressobj(LEVEL, wbits=31), 0, 0
                data = record(page, url, payload, digest, refers_to, revisit)
                out.write(packer.compress(data))
                size, n = size + len(data), n + 1
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield _archives(done)

    return materialise(planned.mapInArrow(run, "path string, records long"))


def _archives(rows: list[tuple[str, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["path", "records"]
    )


class _Stream:
    """The inflated bytes of a gzip file (of one member or several), read in pieces."""

    def __init__(self, file):
        self.file, self.inflate, self.ready = file, zlib.decompressobj(wbits=31), b""

    def _more(self) -> bool:
        data = self.inflate.unconsumed_tail or (self.inflate.unused_data if self.inflate.eof else b"") or self.file.read(_PIECE)
        if not data:
            return False
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(wbits=31)
        self.ready += self.inflate.decompress(data, _PIECE)
        return True

    def head(self) -> bytes | None:
        """The next record's head with its blank line; None at the end."""
        while (end := self.ready.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.ready.strip():
                    raise EOFError("archive ends inside a record's head")
                return None
        head, self.ready = self.ready[: end + 4], self.ready[end + 4 :]
        return head

    def body(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces."""
        while n:
            if not self.ready and not self._more():
                raise EOFError("archive ends inside a record")
            piece, self.ready = self.ready[:n], self.ready[n:]
            n -= len(piece)
            if piece:
                yield piece


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode().strip("\r\n").split("\r\n")[1:]
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)


def normalise_file(source, target) -> Iterator[dict]:
    """Copy a gzip archive record by record, each as its own member; yields index entries."""
    stream, offset = _Stream(source), 0
    while (head := stream.head()) is not None:
        names = fields(head)
        member, length = zlib.compressobj(LEVEL, wbits=31), 0
        for piece in chain([head], stream.body(int(names["Content-Length"]) + 4)):
            data = member.compress(piece)
            target.write(data)
            length += len(data)
        data = member.flush()
        target.write(data)
        length += len(data)
        yield {
            "id": names["WARC-Record-ID"],
            "type": names["WARC-Type"],
            "uri": names.get("WARC-Target-URI", ""),
            "digest": names.get("WARC-Payload-Digest", ""),
            "offset": offset,
            "length": length,
        }
        offset += length


def normalise(archives: DataFrame, folder: str, drop: bool = False) -> DataFrame:
    """Rewrite archives (column ``path``) in ``folder``; one row per new archive: ``path``,
    ``records``. The index of an archive is ``path`` + ".idx". ``drop`` deletes the sources
    once all new archives are complete."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            done = []
            for path in batch.column(0).to_pylist():
                name, n = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                with (
                    system.open_input_stream(path, compression=None) as source,
                    system.open_output_stream(name, compression=None) as target,
                    system.open_output_stream(f"{name}.idx", compression=None) as index,
                ):
                    for entry in normalise_file(source, target):
                        index.write(json.dumps(entry).encode() + b"\n")
                        n += 1
                done.append((name, n))
            yield _archives(done)

    made = materialise(_one_per_task(archives).mapInArrow(run, "path string, records long"))
    if drop:
        archives.select("path").mapInArrow(_delete(folder), "path string").count()
    return made


def _one_per_task(archives: DataFrame) -> DataFrame:
    """The paths dealt to as many tasks as there are archives: rows of a few bytes stand for
    files of many, so partitions must not be chosen by the size of the rows."""
    return archives.select("path").repartition(max(1, min(archives.count(), 1 << 17)))


def _delete(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                if system.get_file_info(path).type != fs.FileType.NotFound:  # a repeated task finds it gone
                    system.delete_file(path)
            yield batch

    return run


RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, archive string, offset long, length long"
)


def read(archives: DataFrame, folder: str) -> DataFrame:
    """One row per record of normalised archives, each read by its index entry.

    Length and digest of a response are those of the payload read; a revisit states them.
    """
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with system.open_input_file(path) as data, system.open_input_stream(f"{path}.idx", compression=None) as index:
                    for line in index.read().splitlines():
                        entry = json.loads(line)
                        data.seek(entry["offset"])
                        rows.append(_row(gzip.decompress(data.read(entry["length"])), path, entry))
                        if len(rows) >= 2000:
                            yield batch_of(rows)
                            rows = []
                yield batch_of(rows)

    def batch_of(rows):
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return _one_per_task(archives).mapInArrow(run, RECORDS)


def _page(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def _row(data: bytes, path: str, entry: dict) -> tuple:
    head, _, rest = data.partition(b"\r\n\r\n")
    names = fields(head + b"\r\n")
    digest = names["WARC-Payload-Digest"].removeprefix("sha256:")
    size, refers_to = int(names["X-Payload-Length"]), None
    if names["WARC-Type"] == "response":
        payload = rest[: int(names["Content-Length"])].partition(b"\r\n\r\n")[2]
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    else:
        refers_to = _page(names["WARC-Refers-To"])
    url = unquote(names["WARC-Target-URI"])
    return _page(names["WARC-Record-ID"]), size, digest, names["WARC-Type"], refers_to, url, path, entry["offset"], entry["length"]


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages as monolithic archives, normalise them and return the new archives."""
    folder = folder or new_stage(pages.sparkSession)
    streams = write(plan(pages), f"{folder}/streams")
    return normalise(streams, f"{folder}/records", drop=True)
