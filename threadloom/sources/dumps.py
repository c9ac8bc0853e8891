"""Compressed dumps as splittable sources, and a writer of dumps that split well.

A ``.zst`` file is a row of frames, a ``.gz`` file a row of members, and each can be
decompressed by itself. ``DumpLines`` deals a file out in byte ranges; a task finds the first
frame or member that begins in its range, reads all that begin there, and owns the lines that
begin in what they hold (but for a line that the range before has to finish). So no index is
needed, the driver looks at file sizes only, and lines may cross frames at any byte.

A place is taken as a border only if it proves to be one: a zstd frame by walking its block
headers to another frame or the end of the file, a gzip member by inflating it up to its
checksum. A file of a single frame is one task; uncompressed files are cut at any byte.
Frames may need windows of up to 2**31 bytes, which the reader's memory must then hold.

The files are opened through ``pyarrow.fs``, so their URIs must be ones that it knows (file, hdfs, s3, gs).
"""

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from threadloom.session import open_uri

SPLIT_BYTES = 64 << 20
LARGEST_WINDOW = 1 << 31
LINES = "file string, block long, line long, value string"
#: Fixed values of the two formats.
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
ZSTD_SKIPPABLE = tuple(bytes([0x50 + i, 0x2A, 0x4D, 0x18]) for i in range(16))
GZIP_MEMBER = b"\x1f\x8b\x08"
_PIECE = 1 << 20
_ROWS = 4096


class _Bytes:
    """A file read forward from a place; ``at`` is the offset of what comes next."""

    def __init__(self, file, at: int = 0):
        self.file, self.at, self.held = file, at, b""
        file.seek(at)

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, fewer at the end of the file."""
        while len(self.held) < n:
            more = self.file.read(max(n - len(self.held), 1 << 12))
            if not more:
                break
            self.held += more
        out, self.held = self.held[:n], self.held[n:]
        self.at += len(out)
        return out

    def skip(self, n: int) -> None:
        self.at += n
        if n <= len(self.held):
            self.held = self.held[n:]
        else:
            self.held = b""
            self.file.seek(self.at)


# --- borders ------------------------------------------------------------------
def zstd_frame_end(file, at: int, size: int) -> int | None:
    """Where the zstd frame (or skippable frame) at ``at`` ends, if its headers are sound."""
    source = _Bytes(file, at)
    magic = source.take(4)
    if magic in ZSTD_SKIPPABLE:
        length = source.take(4)
        end = source.at + struct.unpack("<I", length)[0] if len(length) == 4 else size + 1
        return end if end <= size else None
    flags = source.take(1)
    if magic != ZSTD_FRAME or not flags or flags[0] & 0x08:
        return None
    single, checked = flags[0] & 0x20, flags[0] & 0x04
    content = (1 if single else 0, 2, 4, 8)[flags[0] >> 6]
    source.skip((not single) + (0, 1, 2, 4)[flags[0] & 3] + content)
    while True:
        head = source.take(3)
        if len(head) < 3:
            return None
        value = int.from_bytes(head, "little")
        last, kind, length = value & 1, value >> 1 & 3, value >> 3
        if kind == 3 or (length > 1 << 17 and kind != 1):
            return None
        source.skip(1 if kind == 1 else length)
        if source.at > size:
            return None
        if last:
            end = source.at + (4 if checked else 0)
            return end if end <= size else None


def is_zstd_border(file, at: int, size: int) -> bool:
    end = zstd_frame_end(file, at, size)
    if end is None or end == size:
        return end == size
    following = _Bytes(file, end).take(4)
    return following == ZSTD_FRAME or following in ZSTD_SKIPPABLE


def is_gzip_border(file, at: int, size: int) -> bool:
    """Whether a member begins here: it inflates to its end and its checksum is right."""
    source, inflate = _Bytes(file, at), zlib.decompressobj(wbits=31)
    if source.take(4)[3:] > b"\x1f":  # reserved flags
        return False
    try:
        for _ in _inflated(_Bytes(file, at), inflate):
            pass
    except (zlib.error, EOFError):
        return False
    return True


def _inflated(source: _Bytes, member) -> Iterator[bytes]:
    """The contents of a member, up to its end."""
    while not member.eof:
        data = member.unconsumed_tail or source.take(_PIECE)
        out = member.decompress(data, 4 * _PIECE)
        if not (data or out or member.eof):
            raise EOFError("file ends inside a member")
        yield out


def first_border(file, start: int, stop: int, size: int, magics: tuple[bytes, ...], proves) -> int | None:
    """The first place in [start, stop) where a frame or member begins."""
    source, kept = _Bytes(file, start), b""
    while source.at - len(kept) < stop:
        base = source.at - len(kept)
        more = source.take(_PIECE)
        kept += more
        for at in sorted({a for m in magics for a in _all(kept, m)}):
            if base + at >= stop:
                return None
            if proves(file, base + at, size):
                return base + at
        if not more:
            return None
        kept = kept[-3:]
        file.seek(source.at + len(source.held))  # the proof moved it
    return None


def _all(data: bytes, part: bytes) -> Iterator[int]:
    at = data.find(part)
    while at >= 0:
        yield at
        at = data.find(part, at + 1)


# --- contents -----------------------------------------------------------------
def _zstd_contents(file, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    import zstandard

    while at < size:
        magic = _Bytes(file, at).take(4)
        if magic in ZSTD_SKIPPABLE:
            end = zstd_frame_end(file, at, size)
            if end is None:
                raise EOFError("skippable frame ends beyond the file")
            at = end
            continue
        source = _Bytes(file, at)
        frame = zstandard.ZstdDecompressor(max_window_size=LARGEST_WINDOW).decompressobj()
        while not frame.eof:
            data = source.take(_PIECE)
            if not data:
                raise EOFError("file ends inside a frame")
            yield at, frame.decompress(data)
        at = source.at - len(frame.unused_data)


def _gzip_contents(file, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    while at < size:
        source, member = _Bytes(file, at), zlib.decompressobj(wbits=31)
        for data in _inflated(source, member):
            yield at, data
        at = source.at - len(member.unused_data)
        rest = _Bytes(file, at)
        if not rest.take(1 << 16).strip(b"\0"):  # padding at the end
            return


def _plain_contents(file, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    source = _Bytes(file, at)
    while data := source.take(1 << 16):
        yield source.at - len(data), data


def contents(file, start: int, stop: int, size: int) -> Iterator[tuple[bytes, bool]]:
    """Pieces of a split's text and whether they belong to it; what follows comes after them."""
    magic = _Bytes(file, 0).take(4)
    if magic == ZSTD_FRAME or magic in ZSTD_SKIPPABLE:
        read, magics, proves = _zstd_contents, (ZSTD_FRAME, *ZSTD_SKIPPABLE), is_zstd_border
    elif magic.startswith(GZIP_MEMBER):
        read, magics, proves = _gzip_contents, (GZIP_MEMBER,), is_gzip_border
    else:
        for at, data in _plain_contents(file, start, size):
            own = max(0, min(len(data), stop - at))
            yield data[:own], True
            if own < len(data):
                yield data[own:], False
        return
    first = 0 if start == 0 else first_border(file, start, stop, size, magics, proves)
    if first is not None:
        for at, data in read(file, first, size):
            yield data, at < stop


def split_lines(pieces: Iterator[tuple[bytes, bool]], first: bool) -> Iterator[bytes]:
    """The lines that begin in a split. All but the first split leave their first line to the one
    before; that one reads on until its last line ends. ``\\r`` ends a line as well."""
    carry, skipping = [], not first
    for data, own in pieces:
        if skipping:
            at = data.find(b"\n")
            if not own:  # no line begins in this split
                return
            if at < 0:
                continue
            data, skipping = data[at + 1 :], False
        if not own:
            at = data.find(b"\n")
            carry.append(data if at < 0 else data[:at])
            if at >= 0:
                break
            continue
        *lines, last = data.split(b"\n")
        if lines:
            yield from b"".join([*carry, lines[0]]).split(b"\r")
            for line in lines[1:]:
                yield from line.split(b"\r")
            carry = []
        carry.append(last)
    if carry and not skipping:
        yield from b"".join(carry).split(b"\r")


# --- the source ---------------------------------------------------------------
@dataclass
class Split(InputPartition):
    """The frames of a file that begin in [start, stop)."""

    uri: str
    start: int
    stop: int
    size: int


class DumpLines(DataSource):
    """Lines that are not empty, with their file, the split's first byte and their number in it.

    Options: ``files``, a JSON list of [uri, size], and ``split_bytes``.
    """

    @classmethod
    def name(cls) -> str:
        return "dump_lines"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        return DumpReader(json.loads(self.options["files"]), int(self.options["split_bytes"]))


class DumpReader(DataSourceReader):
    def __init__(self, files: list, split_bytes: int):
        self.files, self.split_bytes = files, split_bytes

    def partitions(self) -> list[Split]:
        splits = [
            Split(uri, at, min(at + self.split_bytes, size), size)
            for uri, size in self.files
            for at in range(0, size, self.split_bytes)
        ]
        return splits or [Split("", 0, 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if not partition.size:
            return
        system, path = open_uri(partition.uri)
        with system.open_input_file(path) as file:
            pieces = contents(file, partition.start, partition.stop, partition.size)
            rows: list[tuple[int, str]] = []
            for number, line in enumerate(split_lines(pieces, partition.start == 0)):
                if line:
                    rows.append((number, line.decode("utf-8", "replace")))
                if len(rows) >= _ROWS:
                    yield _batch(partition, rows)
                    rows = []
            if rows:
                yield _batch(partition, rows)


def _batch(split: Split, rows: list[tuple[int, str]]) -> pa.RecordBatch:
    numbers, values = zip(*rows, strict=True)
    columns = [
        pa.array([split.uri] * len(rows)),
        pa.array([split.start] * len(rows), pa.int64()),
        pa.array(numbers, pa.int64()),
        pa.array(values),
    ]
    return pa.RecordBatch.from_arrays(columns, ["file", "block", "line", "value"])


def files_of(spark: SparkSession, paths) -> list[tuple[str, int]]:
    """URI and size of the files that paths, patterns or folders name, without hidden ones."""
    found: dict[str, int] = {}
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for name in [paths] if isinstance(paths, str) else paths:
        target = hadoop(name)
        system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        waiting = list(system.globStatus(target) or [])
        if not waiting:
            raise FileNotFoundError(name)
        while waiting:
            status = waiting.pop()
            if status.isDirectory():
                inside = system.listStatus(status.getPath())
                waiting += [s for s in inside if not s.getPath().getName().startswith(("_", "."))]
            else:
                found[status.getPath().toUri().toString()] = status.getLen()
    return sorted((uri.replace("file:/", "file:///", 1) if uri[:7] != "file://" else uri, n) for uri, n in found.items())


def read_splits(spark: SparkSession, paths, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The lines of dumps, plain or compressed, with the columns of ``LINES``."""
    spark.dataSource.register(DumpLines)
    found = spark.read.format("dump_lines").option("files", json.dumps(files_of(spark, paths)))
    return found.option("split_bytes", split_bytes).load()


# --- the writer ---------------------------------------------------------------
def write_frames(df: DataFrame, folder: str, codec: str = "zstd", frame_bytes: int = 4 << 20, value: str = "value") -> DataFrame:
    """Write the lines of each partition as one file of frames (or gzip members) of ``frame_bytes``
    of text each, so the file can be read in splits. Frames end at any byte.

    Files are named by the number of their partition, so their order is that of the partitions;
    a file gets its name when it is complete, and a repeated task writes the same file again.
    Returns ``path`` and ``lines``; nothing is written before the result is used.
    """
    if codec not in ("zstd", "gzip"):
        raise ValueError("codec must be zstd or gzip")
    suffix = {"zstd": "zst", "gzip": "gz"}[codec]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_uri(folder)
        system.create_dir(root, recursive=True)
        path = f"{root}/part-{TaskContext.get().partitionId():05d}.{suffix}"
        draft, n, held = f"{root}/_draft-{uuid.uuid4().hex}", 0, bytearray()
        pack = _packer(codec)
        with system.open_output_stream(draft, compression=None) as out:
            for batch in batches:
                for line in batch.column(0).cast(pa.binary()).to_pylist():
                    if line is not None:
                        held += line + b"\n"
                        n += 1
                while len(held) >= frame_bytes:
                    out.write(pack(bytes(held[:frame_bytes])))
                    del held[:frame_bytes]
            if held or not n:
                out.write(pack(bytes(held)))
        system.move(draft, path)
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "lines"])

    return df.select(F.col(value).cast("string")).mapInArrow(run, "path string, lines long")


def _packer(codec: str):
    if codec == "zstd":
        import zstandard

        return zstandard.ZstdCompressor(level=3, write_checksum=True).compress
    return partial(_gzip, level=6)


def _gzip(data: bytes, level: int) -> bytes:
    member = zlib.compressobj(level, wbits=31)
    return member.compress(data) + member.flush()
