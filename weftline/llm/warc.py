"""WARC archives as a Spark data source.

Reading plans one partition per stretch of a file, parses a record's headers first, and decodes its payload only if the
record passes the pushed predicates and the payload was asked for; else it moves on to the next record. Predicates on
``record_type``, ``record_id`` and ``target_uri`` are pushed down; ``header.<name>`` options ask for any other header
value. Compressed records are gzip members whose extra field ``sl`` holds the member's length, so that unwanted members
are passed over without inflating them; members without it, and plain records, are read too.

Writing makes files of about ``file_bytes``, named by attempt, and a manifest when all tasks are done. Reading goes by the
manifest if there is one, so files of failed attempts are never seen.

Cases: a null payload is an empty one; a revisit carries none. Line breaks and other controls in header values are
percent-encoded. Null header values are left out. Repeated rows give a record each; an empty table gives an empty
manifest. Columns other than those of ``FIELDS`` are refused by the writer.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage,
)

FIELDS = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
    "payload_bytes bigint, headers map<string,string>, payload binary"
)
_OWN = {
    "WARC-Type": "record_type",
    "WARC-Record-ID": "record_id",
    "WARC-Target-URI": "target_uri",
    "WARC-Date": "date",
    "WARC-Refers-To": "refers_to",
}
_STRUCTURAL = {*_OWN, "WARC-Payload-Digest", "WARC-Profile", "Content-Type", "Content-Length"}
MANIFEST = "_manifest.json"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_CONTROLS = re.compile(r"[\x00-\x1f\x7f]")
_EXTRA = struct.Struct("<2sHII")  # 'sl', length of what follows, member bytes, record bytes
_HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff"


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _line(name: str, value) -> str:
    return f"{name}: {_CONTROLS.sub(lambda m: f'%{ord(m[0]):02X}', str(value))}\r\n"


def format_record(row: dict) -> bytes:
    """One record; its block is an HTTP response whose body is the payload, or only its headers for a revisit."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    length = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.0\r\n", *(_line(name, row[c]) for name, c in _OWN.items() if row[c] is not None)]
    if row["payload_digest"] is not None:
        lines.append(_line("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()))
    if revisit:
        lines.append(_line("WARC-Profile", REVISIT_PROFILE))
    lines += [_line(n, v) for n, v in (row["headers"] or []) if v is not None and n not in _STRUCTURAL]
    lines += [_line("Content-Type", "application/http; msgtype=response"), _line("Content-Length", len(block)), "\r\n"]
    return "".join(lines).encode() + block + b"\r\n\r\n"


def member(record: bytes, level: int) -> bytes:
    """A gzip member that says how long it is."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = len(_HEAD) + 2 + _EXTRA.size + len(body) + 8
    fits = max(size, len(record)) < 1 << 32
    extra = _EXTRA.pack(b"sl", 8, size if fits else 0, len(record) if fits else 0)
    end = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    return _HEAD + struct.pack("<H", len(extra)) + extra + body + end


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.level = int(options.get("level", 1))
        self.compress = options.get("compress", "true") == "true"
        self.file_bytes = int(options.get("file_bytes", 256 << 20))
        self.split_bytes = int(options.get("split_bytes", 32 << 20))

    def write(self, iterator):
        files, out, entry = [], None, None
        fs, folder = _filesystem(self.path)
        fs.create_dir(folder, recursive=True)
        for batch in iterator:
            for row in batch.to_pylist():
                record = format_record(row)
                data = member(record, self.level) if self.compress else record
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.compress
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)  # else the name decides
                    entry = {"name": name, "bytes": 0, "starts": [0]}
                elif entry["bytes"] - entry["starts"][-1] >= self.split_bytes:
                    entry["starts"].append(entry["bytes"])
                out.write(data)
                entry["bytes"] += len(data)
                if entry["bytes"] >= self.file_bytes:
                    out.close()
                    files.append(entry)
                    out = None
        if out is not None:
            out.close()
            files.append(entry)
        return Written(files)

    def commit(self, messages):
        fs, folder = _filesystem(self.path)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages):
        """Files of the attempt stay without a manifest and are never read."""


class Stretch(InputPartition):
    def __init__(self, file: str, start: int, stop: int):
        self.file, self.start, self.stop = file, start, stop


class WarcReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path = options["path"].rstrip("/")
        self.columns = [f.name for f in schema.fields]
        self.wanted_headers = {k[7:].lower(): v for k, v in options.items() if k.lower().startswith("header.")}
        self.batch_bytes = int(options.get("batch_bytes", 8 << 20))
        self.with_payload = "payload" in self.columns and options.get("payload", "true") == "true"
        self.tests: list[tuple[str, str, object]] = []
        self.decoded = self.skipped = 0

    def pushFilters(self, filters):
        for f in filters:
            column = getattr(f, "attribute", None)
            plain = column is not None and len(column) == 1 and column[0] in ("record_type", "record_id", "target_uri")
            if plain and isinstance(f, EqualTo):
                self.tests.append((column[0], "in", {f.value}))
            elif plain and isinstance(f, In):
                self.tests.append((column[0], "in", set(f.value)))
            elif plain and isinstance(f, StringStartsWith):
                self.tests.append((column[0], "starts", f.value))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs as pa_fs

        fs, folder = _filesystem(self.path)
        if fs.get_file_info(f"{folder}/{MANIFEST}").type == pa_fs.FileType.File:
            with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
                files = json.loads(f.read())
            ends = [(f["name"], f["starts"], f["bytes"]) for f in files]
        else:
            found = fs.get_file_info(pa_fs.FileSelector(folder))
            ends = [(i.base_name, [0], i.size) for i in sorted(found, key=lambda i: i.path) if i.base_name.endswith((".warc", ".warc.gz"))]
        return [
            Stretch(f"{folder}/{name}", start, stop)
            for name, starts, size in ends
            for start, stop in zip(starts, [*starts[1:], size])
        ] or [Stretch("", 0, 0)]

    def _passes(self, headers: dict) -> bool:
        for column, how, value in self.tests:
            got = headers.get({c: n.lower() for n, c in _OWN.items()}[column])
            if got is None or (got not in value if how == "in" else not got.startswith(value)):
                return False
        return all(headers.get(k) == v for k, v in self.wanted_headers.items())

    def read(self, partition):
        import pyarrow as pa

        if partition.start == partition.stop:
            return
        types = {
            "payload_bytes": pa.int64(), "payload": pa.binary(), "headers": pa.map_(pa.string(), pa.string()),
        }
        schema = pa.schema([(c, types.get(c, pa.string())) for c in self.columns])
        rows, size = [], 0
        fs, _ = _filesystem(self.path)
        with fs.open_input_file(partition.file) as file:
            for headers, names, block in self._records(file, partition):
                row = self._row(headers, names, block)
                rows.append({c: row[c] for c in self.columns})
                size += 200 + len(row["payload"] or b"")
                if size >= self.batch_bytes:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def _row(self, headers, names, block) -> dict:
        row = {column: headers.get(name.lower()) for name, column in _OWN.items()}
        digest = headers.get("warc-payload-digest", "")
        if digest.lower().startswith("sha1:"):
            code = digest[5:]
            row["payload_digest"] = base64.b32decode(code).hex() if len(code) == 32 else code.lower()
        else:
            row["payload_digest"] = None
        head, split, body = block.partition(b"\r\n\r\n") if block else (b"", b"", b"")
        http = block is not None and head.startswith(b"HTTP/")
        length = re.search(rb"(?i)\r\ncontent-length:[ \t]*([0-9]+)", head) if http else None
        row["payload_bytes"] = int(length[1]) if length else None if block is None else len(block)
        carried = self.with_payload and headers.get("warc-type") != "revisit"
        row["payload"] = (body if http else block) if carried else None
        row["headers"] = [(names[k], v) for k, v in headers.items() if names[k] not in _STRUCTURAL]
        return row

    def _records(self, file, part):
        """(headers, their names as written, block) of the wanted records that start inside the stretch."""
        at = part.start
        while at < part.stop:
            file.seek(at)
            start = file.read(4096)
            if start[:2] == b"\x1f\x8b":
                headers, names, block, at = self._member(file, at, start)
            else:
                headers, names, block, at = self._plain(file, at, start)
            if headers is not None:
                yield headers, names, block

    @staticmethod
    def _parse(text: bytes):
        headers, names = {}, {}
        for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
            name, colon, value = line.partition(":")
            if colon:
                headers[name.strip().lower()], names[name.strip().lower()] = value.strip(), name.strip()
        return headers, names

    def _wants(self, headers) -> bool:
        """Whether the block is to be decoded: the record passes, and payload or its length is asked for."""
        return self.with_payload or "payload_bytes" in self.columns

    def _plain(self, file, at, data):
        while (end := data.find(b"\r\n\r\n")) < 0:
            more = file.read(65536)
            if not more:
                raise ValueError(f"record at {at} has no end of headers")
            data += more
        headers, names = self._parse(data[:end])
        length = int(headers["content-length"])
        following = at + end + 4 + length + 4
        if not self._passes(headers):
            return None, None, None, following
        if not self._wants(headers):
            return headers, names, None, following
        block = data[end + 4 : end + 4 + length]
        return headers, names, block + file.read(length - len(block)), following

    def _member(self, file, at, data):
        size, flags, inflate = 0, data[3], zlib.decompressobj(31)
        if flags & 4 and data[12:14] == b"sl":
            size = _EXTRA.unpack_from(data, 12)[2]
        text, more = inflate.decompress(data, 8192), inflate.unconsumed_tail
        read = len(data)

        def grow(step: int) -> bool:
            nonlocal text, more, read
            if inflate.eof:
                return False
            if not more:
                more = file.read(65536)
                read += len(more)
                if not more:
                    raise ValueError(f"member at {at} is cut off")
            text += inflate.decompress(more, step)
            more = inflate.unconsumed_tail
            return True

        while (end := text.find(b"\r\n\r\n")) < 0:
            if not grow(8192):
                raise ValueError(f"member at {at} has no end of headers")
        headers, names = self._parse(text[:end])
        wanted = self._passes(headers)
        need = wanted and self._wants(headers)
        if not need and size:
            return headers if wanted else None, names, None, at + size
        parts = [text[end + 4 :]]
        while not inflate.eof:
            text = b""
            grow(1 << 20)
            if need:
                parts.append(text)
        following = at + read - len(inflate.unused_data)
        if not need:
            return headers if wanted else None, names, None, following
        return headers, names, b"".join(parts)[: int(headers["content-length"])], following


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return FIELDS

    def reader(self, schema):
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite):
        extra = {f.name for f in schema.fields} ^ {f.split()[0] for f in FIELDS.split(", ")}
        if extra:
            raise ValueError(f"columns differ from the record fields: {sorted(extra)}")
        return WarcWriter(self.options)


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
