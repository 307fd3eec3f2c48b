"""Media columns: content-addressed payloads in tar shards.

A text's UTF-8 bytes, filled up with blanks to a positive multiple of 192, are stored losslessly as the
samples of an 8-bit grey PNG image 192 wide, named by the payload's SHA-256. Images go into tar shards of
bounded size in the shared folder; a shard holds a content once, however many rows carry it. Rows carry
digest, shard, offset and length. When a shard is closed its writer opens it again: a range read of the
header alone fills the metadata columns, a range read of the whole image gives the payload back, from
which the digests and the feature are computed.

A shard is named by its task's attempt, and only rows that a finished task returned point to it; the
shards of a lost executor's attempt are left over and never read. The rows are written once to the shared
folder, so that reading them again stores nothing anew.

Defined cases: null and empty texts give 192 blanks; repeated rows and equal texts give equal values;
very long texts are stored whole; null ids are returned as they are; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.llm.session import pieces, shared_dir, stash, text_of

WIDTH = 192
SHARD_BYTES, SHARD_ROWS = 32 << 20, 20_000
#: Signature, and length, name, fields and checksum of the first chunk.
HEADER_BYTES = 8 + 8 + 13 + 4
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload_of(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.ljust(max(1, -(-len(raw) // WIDTH)) * WIDTH), len(raw)


def _chunk(name: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))


def to_image(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), dtype=np.uint8)  # each line begins with filter 0
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 3)) + _chunk(b"IEND", b"")


def header_of(head: bytes) -> tuple[int, int]:
    """Width and height from the first HEADER_BYTES of an image."""
    if head[:8] != _SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not an image of this store")
    return struct.unpack(">II", head[16:24])


def from_image(image: bytes) -> bytes:
    width, height = header_of(image[:HEADER_BYTES])
    at, data = 8, []
    while at < len(image):
        (size,), name = struct.unpack(">I", image[at : at + 4]), image[at + 4 : at + 8]
        if name == b"IDAT":
            data.append(image[at + 8 : at + 8 + size])
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(data)), dtype=np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("only filter 0 is stored")
    return lines[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Mean and spread of the samples, and which of 64 equal stretches are brighter than the mean."""
    samples = np.frombuffer(payload, dtype=np.uint8)
    sums = np.array([part.mean() for part in np.array_split(samples, 64)])
    bits = int("".join("1" if x > samples.mean() else "0" for x in sums), 2)
    return f"{samples.mean():.4f}:{samples.std():.4f}:{bits:016x}"


class _Shard:
    """A tar file being written: contents by digest, and the rows that wait for it to be closed."""

    def __init__(self, store: fs.FileSystem, folder: str):
        self.store, self.name = store, f"{uuid.uuid4().hex}.tar"
        self.path = f"{folder}/{self.name}"
        self.out = store.open_output_stream(self.path)
        self.size = 0
        self.at: dict[str, tuple[int, int]] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, text: str | None) -> None:
        payload, n = payload_of(text)
        digest = hashlib.sha256(payload).hexdigest()
        if digest not in self.at:
            image = to_image(payload)
            info = tarfile.TarInfo(f"{digest}.png")
            info.size = len(image)
            head = info.tobuf(tarfile.USTAR_FORMAT)
            self.out.write(head + image + b"\0" * (-len(image) % tarfile.BLOCKSIZE))
            self.at[digest] = (self.size + len(head), len(image))
            self.size += len(head) + len(image) + -len(image) % tarfile.BLOCKSIZE
        self.rows.append((doc_id, n, digest))

    def full(self) -> bool:
        return self.size >= SHARD_BYTES or len(self.rows) >= SHARD_ROWS

    def close(self) -> pa.RecordBatch:
        """Finish the file, read it back, and return the rows."""
        self.out.write(b"\0" * (2 * tarfile.BLOCKSIZE))
        self.out.close()
        read: dict[str, tuple] = {}
        with self.store.open_input_file(self.path) as f:
            for digest, (offset, length) in self.at.items():
                f.seek(offset)
                width, height = header_of(f.read(HEADER_BYTES))
                f.seek(offset)
                image = f.read(length)
                payload = from_image(image)
                if hashlib.sha256(payload).hexdigest() != digest or len(payload) != width * height:
                    raise ValueError(f"{self.name}: {digest} was read back with other content")
                read[digest] = (
                    len(payload), digest, zlib.crc32(payload[-16:]), length, hashlib.sha256(image).hexdigest(), feature_of(payload),
                    self.name, offset, width, height,
                )
        columns = list(zip(*[(doc, n, *read[digest]) for doc, n, digest in self.rows], strict=True))
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()),
     ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("shard", pa.string()), ("offset", pa.int64()),
     ("width", pa.int32()), ("height", pa.int32())]
)
_SQL = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string,"
    " feature string, shard string, offset long, width int, height int"
)


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, path = open_store(folder)
    shard = None
    for batch in pieces(batches, 1):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shard = shard or _Shard(store, path)
            shard.add(doc_id, text)
            if shard.full():
                yield shard.close()
                shard = None
    if shard:
        yield shard.close()


def store_documents(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Store every text; rows (doc_id, digests, feature, shard, offset, ...) one for each document."""
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/media/{uuid.uuid4().hex}"
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    source = docs.select(*text_of(docs))
    return stash(source.mapInArrow(lambda b: _write(b, folder), _SQL))
