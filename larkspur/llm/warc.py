"""WARC archives with a two-level capture index.

Tasks write one archive each, a gzip member for every record, straight to shared storage. The
captures are sorted by reversed-host key and cut into compressed blocks of lines; a sparse
directory keeps the first and last key of each block and where it lies. A lookup finds the
index part of a key among the parts' bounds, binary-searches the directory of that part and
the lines of the block, and reads just the byte ranges of its records.

File names carry a fresh id for every attempt, and only names that a finished task returned
are used, so a lost executor leaves nothing but an unread file.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import table
from larkspur.session import durable, scratch_dir

BLOCK_LINES = 3000
DATE = "1970-01-01T00:00:00Z"
#: payloads below this many bytes are stored even if repeated
REVISIT_BYTES = 0

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = 16 + zlib.MAX_WBITS


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: com,example,www)/path?query.

    All parts are percent-encoded, so that no key holds a blank or a line separator.
    """
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return quote(text, safe="/?=&:;,)(%")
    place = quote(",".join(reversed(host.split("."))), safe=",:[]") + (f":{port}" if port else "")
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{place}){quote(rest, safe='/?=&:;,)(%')}"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {quote(url or '', safe='/?=&:;,)(%#@!$*+~[]')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return _member("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
    return packer.compress(data) + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of a record; a wrong length or digest is an error."""
    data = zlib.decompress(member, _GZIP)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']} has a wrong length")
    http, _, payload = block.partition(b"\r\n\r\n")
    inner = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    if fields["WARC-Type"] == "response" and (len(payload) != int(inner["Content-Length"]) or f"sha1:{digest(payload)}" != fields["WARC-Payload-Digest"]):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return fields, inner, payload


def _store(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    if folder.startswith("file:"):
        folder = "file:///" + folder[5:].lstrip("/")
    return arrow_fs.FileSystem.from_uri(folder)


def _page(field: str) -> int | None:
    number = field.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


@dataclass(frozen=True)
class Archive:
    """Where the files are, the captures (key, page_id, file, offset, length) and the block directory."""

    folder: str
    captures: DataFrame
    directory: DataFrame


_CAPTURES = "key string, page_id long, file string, offset long, length long"
_BLOCKS = "part int, block int, first_key string, last_key string, file string, offset long, length long, lines int"


def write(pages: DataFrame, folder: str | None = None, at_least: int = REVISIT_BYTES, block_lines: int = BLOCK_LINES) -> Archive:
    """Writes every row as a record and indexes them.

    Of rows with equal payloads of ``at_least`` bytes the one with the smallest page_id is a
    response, the others are revisits of it; rows that repeat its page_id are responses too.
    A null html is an empty payload, a null url an empty one, a null page_id is last among
    its copies. No pages give no files. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    sums = rows.groupBy("sha", "size").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
    # only payloads that occur again
    again = durable(sums.filter((F.col("copies") > 1) & (F.col("size") >= at_least)).drop("copies"))
    rows = rows.join(again, ["sha", "size"], "left").select("page_id", "url", "payload", "first_id")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        name, out, at = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            found = []
            for page_id, url, body, first in zip(*[c for c in batch.columns]):
                page_id, url, body, first = page_id.as_py(), url.as_py(), body.as_py(), first.as_py()
                revisit = first is not None and first != page_id
                data = record(page_id, url, body, digest(body), first, revisit)
                if out is None:
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    at = out.write(_member(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode()))
                out.write(data)
                found.append((url_key(url), page_id, name, at, len(data)))
                at += len(data)
            columns = list(zip(*found)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    captures = durable(rows.mapInArrow(archive, _CAPTURES))
    return Archive(folder, captures, durable(_index(captures, folder, block_lines)))


def _index(captures: DataFrame, folder: str, block_lines: int) -> DataFrame:
    """Sorted blocks of lines in files, and the directory rows that find them."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        part, held, done = TaskContext.get().partitionId(), [], []
        name, out, at = f"index-{part:06d}-{uuid.uuid4().hex}.cdx.gz", None, 0

        def put(lines):
            nonlocal out, at
            data = _member("".join(f"{k} {json.dumps(v)}\n" for k, v in lines).encode())
            if out is None:
                out = store.open_output_stream(f"{base}/{name}", compression=None)
            out.write(data)
            done.append((part, len(done), lines[0][0], lines[-1][0], name, at, len(data), len(lines)))
            at += len(data)

        for batch in batches:
            for key, *where in zip(*[c.to_pylist() for c in batch.columns]):
                held.append((key, where))
                if len(held) == block_lines:
                    put(held)
                    held = []
        if held:
            put(held)
        if out is not None:
            out.close()
        names = [c.split()[0] for c in _BLOCKS.split(", ")]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32())
        columns = list(zip(*done)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    order = ["key", "page_id", "file", "offset"]
    return captures.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(blocks, _BLOCKS)


def lookup(archive: Archive, keys: DataFrame) -> DataFrame:
    """(key, page_id, file, offset, length) of all captures of the given keys (column ``key``)."""
    # one row for each index part, of which there are as many as shuffle partitions
    bounds = sorted((r["first"], r["last"], r["part"]) for r in archive.directory.groupBy("part").agg(F.min("first_key").alias("first"), F.max("last_key").alias("last")).collect())
    firsts, lasts, parts = [b[0] for b in bounds], [b[1] for b in bounds], [b[2] for b in bounds]

    @F.pandas_udf("array<int>")
    def parts_of(wanted: pd.Series) -> pd.Series:
        return wanted.map(lambda k: parts[bisect.bisect_left(lasts, k) : bisect.bisect_right(firsts, k)])

    asked = keys.select("key").distinct().select("key", F.explode(parts_of("key")).alias("part"))
    folder = archive.folder

    def search(wanted: pd.DataFrame, directory: pd.DataFrame) -> pd.DataFrame:
        directory = directory.sort_values("block")
        first, last = directory["first_key"].tolist(), directory["last_key"].tolist()
        by_block: dict[int, list[str]] = {}
        for key in wanted["key"].tolist():
            for b in range(bisect.bisect_left(last, key), bisect.bisect_right(first, key)):
                by_block.setdefault(b, []).append(key)
        found, files = [], {}
        store, base = _store(folder)
        for b, block_keys in sorted(by_block.items()):
            place = directory.iloc[b]
            data = _read(store, base, files, place["file"], int(place["offset"]), int(place["length"]))
            lines = zlib.decompress(data, _GZIP).decode().removesuffix("\n").split("\n")
            heads = [line.split(" ", 1)[0] for line in lines]
            for key in block_keys:
                for line in lines[bisect.bisect_left(heads, key) : bisect.bisect_right(heads, key)]:
                    found.append((key, *json.loads(line.split(" ", 1)[1])))
        out = pd.DataFrame(found, columns=["key", "page_id", "file", "offset", "length"])
        return out.astype({"page_id": "Int64", "offset": "int64", "length": "int64"})

    return asked.groupBy("part").cogroup(archive.directory.groupBy("part")).applyInPandas(search, _CAPTURES)


def _read(store, base: str, files: dict, name: str, offset: int, length: int) -> bytes:
    if name not in files:
        files.clear()  # reads come in file order
        files[name] = store.open_input_file(f"{base}/{name}")
    return files[name].read_at(length, offset)


def read(archive: Archive, captures: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records at the given byte ranges: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    The payload of a revisit is null: it is that of the record it refers to.
    """
    folder = archive.folder
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        files: dict = {}
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            places = list(zip(*[c.to_pylist() for c in batch.columns]))
            for at in range(0, len(places), 256):
                rows = []
                for name, offset, length in places[at : at + 256]:
                    fields, http, payload = parse(_read(store, base, files, name, offset, length))
                    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
                    body = payload if with_payload and kind == "response" else None
                    sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    rows.append((_page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], int(http["Content-Length"]), sha, kind, _page(refers) if refers else None, body))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    places = captures.select("file", "offset", "length")
    return places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def query(spark, sf_dir):
    archive = write(table(spark, sf_dir, "pages"))
    found = lookup(archive, archive.captures)
    return read(archive, found, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLE_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
f AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{_LETTERS}', 1 + ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS INTEGER) >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), '') AS payload_digest,
  CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""
