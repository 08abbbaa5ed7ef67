"""WARC archives: written as one gzip stream, normalised to one gzip member per record, read back by offset.

``write_archives`` rolls rows into archives as a crawler does: each file is one gzip stream, so nothing in it can be
reached without inflating all that stands before. ``normalise`` inflates such a file once, from its first byte to its last,
writes every record as a gzip member of its own and puts a sidecar of offsets beside the archive. On the way it turns
records whose payload another record already has into revisits, so no payload is ever shuffled: what crosses the network is
one slim row per record. ``read_records`` goes by the sidecar and inflates single members.

Archives are files, written by tasks through Arrow's file systems. A task names a file anew on each attempt, and only
names that Spark has committed as rows are read on, so a lost executor or a second attempt leaves at most a file that nobody
mentions. Texts and records pass through in pieces; no record is held whole unless its payload is asked for.

Odd rows: a null payload is empty; a null key gives a record without key; a null URI gives a record without target;
control characters and spaces of a URI are written as %XX. Of rows that share the largest key of their payload, one is the
response. An empty table gives no archives and no rows, a file without bytes
no records. Further columns of any name are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from ..operators.sizing import broadcast_if_small
from .common import small_batches, stored

#: Bytes of records after which a task begins its next archive.
ARCHIVE_BYTES = 256 << 20
#: Payloads below so many bytes are stored again, whatever others hold.
REVISIT_BYTES = 1000
#: Archives of one call are spread over at most so many tasks.
MOST_TASKS = 20_000
_PIECE = 1 << 20
_GZIP = 31  # zlib's window bits for the gzip format

# The version line, the profile of a revisit, and the fields of this module's own.
_VERSION = b"WARC/1.0"
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_KEY, _REFERS_KEY = "X-Row-Key", "X-Refers-To-Row-Key"

_LISTED = pa.schema([("archive", pa.string()), ("record", pa.int64()), ("key", pa.string()), ("bytes", pa.int64()), ("digest", pa.string())])
_LISTED_DDL = "archive string, record long, key string, bytes long, digest string"
_DONE = pa.schema([("archive", pa.string()), ("sidecar", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
_DONE_DDL = "archive string, sidecar string, records long, bytes long"
_PLACED = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string())])
_PLACED_DDL = "archive string, offset long, length long, type string"
_READ = pa.schema([
    ("record_id", pa.string()), ("key", pa.string()), ("uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])
_READ_DDL = (
    "record_id string, key string, uri string, record_type string, refers_to string, payload_bytes long, payload_digest string, "
    "payload binary"
)


def _at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def _record_id() -> str:
    return f"<urn:uuid:{uuid.uuid4()}>"


def _head(fields: list[tuple[str, str]]) -> bytes:
    return b"".join([_VERSION, b"\r\n", *(f"{name}: {value}\r\n".encode() for name, value in fields), b"\r\n"])


def _http_head(n_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()


def _written_uri(uri: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)


# Writing


def write_archives(
    rows: DataFrame, folder: str, key: str, payload: str, uri: str | None = None, date: str = "2000-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Each row as a response record in archives below ``folder``, each of them one gzip stream.

    Gives what was written, stored: archive, number of the record in it, key as text, bytes and SHA-1 of the payload.
    ``key`` has a type that casts to text and back. Where a path stands for a folder of the executors' own machines, other
    executors cannot read on.
    """
    small_batches(rows.sparkSession)
    chosen = rows.select(
        F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{payload}`").cast("string").alias("payload"),
        (F.col(f"`{uri}`").cast("string") if uri else F.lit(None).cast("string")).alias("uri"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _at(folder)
        system.create_dir(base, recursive=True)
        name, sink, packer, held, listed = "", None, None, 0, []

        def close() -> pa.RecordBatch:
            sink.write(packer.flush())
            sink.close()
            return pa.RecordBatch.from_pylist(listed, _LISTED)

        for batch in batches:
            texts = batch.column("payload").fill_null("").cast(pa.binary())
            for k, text, at in zip(batch.column("key").to_pylist(), texts, batch.column("uri").to_pylist(), strict=True):
                if sink is None:
                    file = f"{uuid.uuid4().hex}.warc.gz"
                    name, sink = f"{folder}/{file}", system.open_output_stream(f"{base}/{file}", compression=None)
                    packer, held, listed = zlib.compressobj(1, zlib.DEFLATED, _GZIP), 0, []
                    about = b"software: assaylake\r\nformat: WARC file version 1.0\r\n"
                    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id()), ("WARC-Date", date)]
                    fields += [("Content-Type", "application/warc-fields"), ("Content-Length", str(len(about)))]
                    sink.write(packer.compress(_head(fields) + about + b"\r\n\r\n"))
                data = text.as_py()
                digest, http = hashlib.sha1(data).hexdigest(), _http_head(len(data))
                fields = [("WARC-Type", "response"), ("WARC-Record-ID", _record_id()), ("WARC-Date", date)]
                fields += [("WARC-Target-URI", _written_uri(at))] if at is not None else []
                fields += [(_KEY, k)] if k is not None else []
                fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
                head = _head([*fields, ("Content-Length", str(len(http) + len(data)))])
                for part in (head, http, data, b"\r\n\r\n"):
                    sink.write(packer.compress(part))
                # The record that tells about the archive is its record 0.
                listed.append({"archive": name, "record": len(listed) + 1, "key": k, "bytes": len(data), "digest": digest})
                held += len(head) + len(http) + len(data)
                if held >= archive_bytes:
                    yield close()
                    sink = None
        if sink is not None:
            yield close()

    return stored(chosen.mapInArrow(run, _LISTED_DDL), "warc-listing")


def find_revisits(listing: DataFrame, key_type: str, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """The records to be written as revisits, with the key they refer to: archive, record, refers.

    Of records with equal payloads of ``least_bytes`` or more, the one with the largest key stays; a null key is least.
    Groups are aggregated inside tasks before the shuffle. Those of several records are stored, so that the join back is a
    broadcast if they are few, and one whose hot keys adaptive execution splits if not.
    """
    large = listing.where(F.col("bytes") >= least_bytes)
    order = F.struct(F.col("key").cast(key_type).alias("key"), "archive", "record")
    groups = large.groupBy("digest", "bytes").agg(F.max(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = broadcast_if_small(stored(groups.drop("n"), "warc-groups"))
    own = (F.col("archive") == F.col("first.archive")) & (F.col("record") == F.col("first.record"))
    found = large.drop("key").join(groups, ["digest", "bytes"]).where(~own)
    return found.select("archive", "record", F.col("first.key").cast("string").alias("refers"))


# Reading records off a stream of bytes


class _Stream:
    """Bytes that come in pieces, read by line or by length."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held = pieces, b""

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held += piece
        return True

    def line(self) -> bytes | None:
        """Up to and without the next line feed; None at the end."""
        while (at := self.held.find(b"\n")) < 0:
            if not self._more():
                rest, self.held = self.held, b""
                return rest or None
        found, self.held = self.held[:at], self.held[at + 1 :]
        return found.removesuffix(b"\r")

    def parts(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes, in pieces."""
        while length:
            if not self.held and not self._more():
                raise ValueError("an archive ends within a record")
            part, self.held = self.held[:length], self.held[length:]
            length -= len(part)
            yield part


def _inflated(source, size: int | None = None) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, of which ``size`` bytes are read."""
    unpack, begun = zlib.decompressobj(_GZIP), False
    while data := source.read(_PIECE if size is None else min(_PIECE, size)):
        size, begun = None if size is None else size - len(data), True
        while data:
            if unpack.eof:
                unpack = zlib.decompressobj(_GZIP)
            out = unpack.decompress(data, _PIECE)
            if out:
                yield out
            data = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
    # What the inflater still holds of a piece that filled the output to the brim.
    while not unpack.eof and (out := unpack.decompress(b"", _PIECE)):
        yield out
    if begun and not unpack.eof:
        raise ValueError("an archive ends within a gzip member")


def _records(stream: _Stream) -> Iterator[tuple[list[tuple[str, str]], int]]:
    """The fields of each record and the length of its block, which is to be read off the stream before the next."""
    while (line := stream.line()) is not None:
        if not line:  # two line ends close a record
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields: list[tuple[str, str]] = []
        while line := stream.line():
            if line[:1] in b" \t" and fields:  # a folded line
                fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip().decode('utf-8', 'replace')}")
                continue
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields.append((name.strip(), value.strip()))
        yield fields, int(_field(fields, "Content-Length") or 0)


def _field(fields: list[tuple[str, str]], name: str) -> str | None:
    return next((value for found, value in fields if found.lower() == name.lower()), None)


def _take_http_head(stream: _Stream, length: int) -> tuple[list[bytes], int]:
    """The lines of the HTTP head at the start of a block, and how many bytes of the block follow it."""
    lines: list[bytes] = []
    left = length
    while left > 0:
        before = stream.line()
        if before is None:
            raise ValueError("an archive ends within a record")
        # Lines end with CR LF as this module writes them; a bare LF counts one byte less.
        left -= len(before) + 2
        if not before:
            break
        lines.append(before)
    return lines, max(left, 0)


# Normalising


def normalise(archives: DataFrame, folder: str, revisits: DataFrame | None = None, level: int = 6) -> DataFrame:
    """Every archive of ``archives`` (column ``archive``: path of a gzip file of any members) written anew below ``folder``,
    each record as a member of its own, with a sidecar that has a line of offset, length and type for each record.

    ``revisits`` (archive, record, refers) names the records to be reduced to their heads. Records of other kinds and fields
    unknown to this module are copied. Gives one stored row per archive: archive, sidecar, records, bytes.
    """
    each = archives.select("archive").distinct()
    if revisits is not None:
        # Bounded by the records of one archive, which is closed at a size.
        turned = revisits.groupBy("archive").agg(F.collect_list(F.struct("record", "refers")).alias("turned"))
        each = each.join(turned, "archive", "left")
    else:
        each = each.withColumn("turned", F.lit(None).cast("array<struct<record:long,refers:string>>"))
    each = _spread(stored(each, "warc-archives"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                refers = {t["record"]: t["refers"] for t in row["turned"] or []}
                yield pa.RecordBatch.from_pylist([_normalised(row["archive"], folder, refers, level)], _DONE)

    return stored(each.mapInArrow(run, _DONE_DDL), "warc-done")


def _spread(archives: DataFrame) -> DataFrame:
    """One archive a task: rows are few and small, the work behind each is not."""
    return archives.repartition(max(1, min(archives.count(), MOST_TASKS)))


def _normalised(archive: str, folder: str, refers: dict[int, str | None], level: int) -> dict:
    system, base = _at(folder)
    system.create_dir(base, recursive=True)
    stem = f"{archive.rsplit('/', 1)[-1].removesuffix('.gz').removesuffix('.warc')}-{uuid.uuid4().hex[:12]}.warc.gz"
    source_system, path = _at(archive)
    offset, lines = 0, []
    with source_system.open_input_stream(path, compression=None) as source, system.open_output_stream(f"{base}/{stem}", compression=None) as sink:
        stream = _Stream(_inflated(source))
        for number, (fields, length) in enumerate(_records(stream)):
            packer, size = zlib.compressobj(level, zlib.DEFLATED, _GZIP), 0
            if number in refers:
                head, rest = _take_http_head(stream, length)
                for _ in stream.parts(rest):
                    pass
                block = b"".join(line + b"\r\n" for line in [*head, b""])
                fields, parts = _as_revisit(fields, refers[number], len(block)), iter([block])
            else:
                parts = stream.parts(length)
            for part in chain([_head(fields)], parts, [b"\r\n\r\n", None]):
                packed = packer.flush() if part is None else packer.compress(part)
                sink.write(packed)
                size += len(packed)
            lines.append(json.dumps({"offset": offset, "length": size, "type": _field(fields, "WARC-Type")}))
            offset += size
    with system.open_output_stream(f"{base}/{stem}.idx", compression=None) as sidecar:
        sidecar.write("".join(f"{line}\n" for line in lines).encode())
    return {"archive": f"{folder}/{stem}", "sidecar": f"{folder}/{stem}.idx", "records": len(lines), "bytes": offset}


def _as_revisit(fields: list[tuple[str, str]], refers: str | None, length: int) -> list[tuple[str, str]]:
    kept = [(n, v) for n, v in fields if n.lower() not in ("warc-type", "content-length", "warc-block-digest")]
    own = [("WARC-Profile", _SAME_PAYLOAD), *([(_REFERS_KEY, refers)] if refers is not None else [])]
    return [("WARC-Type", "revisit"), *kept, *own, ("Content-Length", str(length))]


# Reading back


def read_index(done: DataFrame) -> DataFrame:
    """The sidecars of normalised archives as rows: archive, offset, length, type. Filter it to read some records only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _at(row["sidecar"])
                with system.open_input_stream(path, compression=None) as sidecar:
                    lines = _Stream(iter(lambda s=sidecar: s.read(_PIECE) or None, None))
                    found = []
                    while (line := lines.line()) is not None:
                        found.append({"archive": row["archive"], **json.loads(line)})
                        if len(found) == 10_000:
                            yield pa.RecordBatch.from_pylist(found, _PLACED)
                            found = []
                    yield pa.RecordBatch.from_pylist(found, _PLACED)

    return _spread(done.select("archive", "sidecar")).mapInArrow(run, _PLACED_DDL)


def read_records(index: DataFrame, payload: bool = True) -> DataFrame:
    """The response and revisit records at the places that ``index`` names, each inflated on its own.

    The digest of a response's payload is compared with the one in its head; another one is an error, as a digest that does
    not fit its record says that bytes were lost. A revisit has no payload; its bytes and digest are those of the payload it
    stands for. Without ``payload`` the bytes only pass through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        for batch in batches:
            found, held = [], 0
            for row in batch.to_pylist():
                if row["type"] not in ("response", "revisit"):
                    continue
                if row["archive"] != opened:
                    system, path = _at(row["archive"])
                    opened, source = row["archive"], system.open_input_file(path)
                source.seek(row["offset"])
                found.append(_read(_Stream(_inflated(source, row["length"])), payload))
                held += len(found[-1]["payload"] or b"")
                if held >= 4 * _PIECE:
                    yield pa.RecordBatch.from_pylist(found, _READ)
                    found, held = [], 0
            yield pa.RecordBatch.from_pylist(found, _READ)

    return index.select("archive", "offset", "length", "type").mapInArrow(run, _READ_DDL)


def _read(stream: _Stream, keep: bool) -> dict:
    fields, length = next(_records(stream))
    told = (_field(fields, "WARC-Payload-Digest") or "").removeprefix("sha1:").lower() or None
    head, rest = _take_http_head(stream, length)
    http = [tuple(x.strip() for x in line.decode("latin-1").split(":", 1)) for line in head if b":" in line]
    digest, parts = hashlib.sha1(), []
    for part in stream.parts(rest):
        digest.update(part)
        if keep:
            parts.append(part)
    kind = _field(fields, "WARC-Type")
    if kind == "response" and told not in (None, digest.hexdigest()):
        raise ValueError(f"the payload of record {_field(fields, 'WARC-Record-ID')} does not have its digest")
    said = _field(http, "Content-Length")
    return {
        "record_id": _field(fields, "WARC-Record-ID"), "key": _field(fields, _KEY), "uri": _field(fields, "WARC-Target-URI"),
        "record_type": kind, "refers_to": _field(fields, _REFERS_KEY),
        "payload_bytes": rest if kind == "response" else int(said) if said else None,
        "payload_digest": digest.hexdigest() if kind == "response" else told,
        "payload": b"".join(parts) if keep and kind == "response" else None,
    }
