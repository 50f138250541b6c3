"""WARC archives: a writer of one gzip member per record and a reader that splits files by bytes.

Reading tasks get byte ranges. A task looks for gzip magic in its range, takes a candidate as a record only if it
decodes from there to a WARC header and its member ends well, owns the records that start inside its range, and
reads past the range's end to finish its last one. The members read from a file must add up to its size in the manifest: what
is damaged or missing raises an error, or is listed by `damage`. Archives are opened through pyarrow's file systems, so the folder
may be on any store that these reach.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.batches import bound_batches
from strataframe.storage import fresh_path, stored

MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
RECORD_FIELDS = "record_id string, page_id long, target_uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, path string, offset long, length long"


@dataclass(frozen=True)
class WarcParams:
    """file_bytes: size at which a writer begins another file. split_bytes: range of a reading task. chunk: bytes read at once.
    least_revisit: payloads shorter than this are always written in full. keep_payload: return contents when reading.
    verify: when reading, store the records and raise ValueError if any byte of a file belongs to none."""

    file_bytes: int = 64 << 20
    split_bytes: int = 8 << 20
    chunk: int = 1 << 20
    least_revisit: int = 1000
    keep_payload: bool = True
    verify: bool = True


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    if urlsplit(uri).scheme:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def _line(value: str) -> str:
    return quote(value, safe="%/:?#[]@!$&'()*+,;=-._~")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """A whole record, uncompressed. refers_to makes it a revisit, without its payload."""
    name = "" if page_id is None else str(page_id)
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {_line(url or '')}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}", "Content-Type: application/http;msgtype=response",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + (payload if refers_to is None else b"")
    head += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def deduplicated(pages: DataFrame, params: WarcParams, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload, sha1, refers_to (of revisits). Payloads are equal when length, SHA-1 and SHA-256 are. A key that is no number is null."""
    payload = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(key).try_cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    size = F.octet_length("payload")
    rows = rows.withColumns({"sha1": F.sha1("payload"), "same": F.when(size >= params.least_revisit, F.unhex(F.sha2("payload", 256)))})
    groups = rows.filter("same IS NOT NULL").groupBy("same", "sha1").agg(F.max("page_id").alias("largest"), F.count("*").alias("c")).filter("c > 1").drop("c")
    # groups has each key once and is written first: both sides of the join are then plain shuffles, whose hot keys
    # adaptive execution splits
    rows = rows.join(stored(groups, "digests"), ["same", "sha1"], "left")
    refers = F.when(F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return rows.select("page_id", "url", "payload", "sha1", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, params: WarcParams = WarcParams(), key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes a record per row of pages into files under folder; returns the manifest (path, size, n_records), written there too.

    Of equal payloads of params.least_revisit bytes at least, the row with the largest page_id is written in full, the
    others as revisits that name it (rows that repeat the largest page_id are all written in full). Null html is an
    empty payload, null urls are empty. Files of a lost or repeated task are not in the manifest and never read.
    """
    bound_batches(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        out, path, size, count, done = None, "", 0, 0, []

        def close() -> None:
            nonlocal out, size, count
            if out is not None:
                out.close()
                store.move(f"{root}/{path}.open", f"{root}/{path}")
                done.append((path, size, count))
            out, size, count = None, 0, 0

        for batch in batches:
            for page_id, link, payload, sha1, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path = f"{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{path}.open", compression=None)
                data = member(record_bytes(page_id, link, payload, sha1, refers))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= params.file_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_pydict({"path": pa.array([d[0] for d in done], pa.string()), "size": pa.array([d[1] for d in done], pa.int64()), "n_records": pa.array([d[2] for d in done], pa.int64())})

    manifest = deduplicated(pages, params, key, url, html).mapInArrow(write, "path string, size long, n_records long")
    manifest.write.parquet(f"{folder}/manifest.parquet")
    return pages.sparkSession.read.parquet(f"{folder}/manifest.parquet")


def _inflate(read, at: int, chunk: int) -> tuple[bytes, int] | None:
    """(contents, length) of the gzip member at `at`; None if there is no whole one."""
    unpack, out, used = zlib.decompressobj(31), [], 0
    try:
        while not unpack.eof:
            data = read(at + used, chunk)
            if not data:
                return None
            out.append(unpack.decompress(data))
            used += len(data)
            if not out[0].startswith(b"WARC/1."[: len(out[0])]):
                return None
    except zlib.error:
        return None
    return b"".join(out), used - len(unpack.unused_data)


def parse_record(data: bytes) -> dict | None:
    """The fields of a record; None if data is no WARC record. Digests of full payloads are checked."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda v: int(v[10:-1]) if v and v.startswith("<urn:page:") and v[10:-1] else None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    sha1 = base64.b32decode(digest).hex() if digest else None
    size = len(payload)
    if fields["warc-type"] == "revisit":
        size = next((int(v) for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:]) if k.lower() == b"content-length"), None)
    elif sha1 and hashlib.sha1(payload).hexdigest() != sha1:
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not have its digest")
    return {
        "record_id": fields.get("warc-record-id"), "page_id": number(fields.get("warc-record-id")), "target_uri": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
        "refers_to": number(fields.get("warc-refers-to")), "payload_bytes": size, "payload_digest": sha1, "payload": payload,
    }


def records_in(read, start: int, end: int, chunk: int = 1 << 20) -> Iterator[dict]:
    """Records that start in [start, end); read(at, n) gives bytes. After a record the next one is tried first."""
    at, held, base = start, b"", start
    while at < end:
        if not base <= at < base + len(held) - len(MAGIC) + 1:
            held, base = read(at, chunk), at
            if len(held) < len(MAGIC):
                return
        hit = held.find(MAGIC, at - base)
        if hit < 0:
            at = base + len(held) - len(MAGIC) + 1
            continue
        at = base + hit
        if at >= end:
            return
        window = (held, base)

        def near(where: int, n: int, window=window) -> bytes:
            own, first = window
            if first <= where < first + len(own):
                return own[where - first : where - first + n]
            return read(where, n)

        got = _inflate(near, at, min(chunk, 1 << 16))
        record = parse_record(got[0]) if got else None
        if record is None:
            at += 1
            continue
        yield record | {"offset": at, "length": got[1]}
        at += got[1]


def read_archives(manifest: DataFrame, folder: str, params: WarcParams = WarcParams()) -> DataFrame:
    """All records of the files of manifest, one row each (RECORD_FIELDS), in ranges of params.split_bytes.

    An empty manifest gives no rows. Damaged records (bytes lost, changed or added, a file shortened) raise ValueError; with
    params.verify false they are left out, and damage() tells of them. A payload that does not have its digest always raises.
    """
    bound_batches(manifest.sparkSession)
    p = params
    ranges = manifest.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(p.split_bytes).cast("long"))).alias("start"))
    total = manifest.agg(F.sum(F.ceil(F.col("size") / p.split_bytes))).first()[0]
    tasks = max(1, min(int(total or 1), 100_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        names = [f.split()[0] for f in RECORD_FIELDS.split(", ")]
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(f"{root}/{path}") as f:

                    def read(at: int, n: int, f=f) -> bytes:
                        f.seek(at)
                        return f.read(n)

                    group, size = [], 0
                    for record in records_in(read, start, start + p.split_bytes, p.chunk):
                        if not p.keep_payload:
                            record["payload"] = None
                        record["path"] = path
                        group.append(record)
                        size += len(record["payload"] or b"") + 200
                        if size > 4 << 20:
                            yield _batch(group, names)
                            group, size = [], 0
                    yield _batch(group, names)

    records = ranges.repartition(tasks, F.xxhash64("path", "start")).mapInArrow(run, RECORD_FIELDS)
    if not p.verify:
        return records
    records = stored(records, "records")
    bad = damage(manifest, records).limit(20).collect()
    if bad:
        raise ValueError("archives are damaged: " + "; ".join(f"{r['path']}: {r['found']} of {r['n_records']} records, {r['bytes']} of {r['size']} bytes" for r in bad))
    return records


def damage(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """(path, size, n_records, found, bytes) of the files whose records read do not make up the whole file."""
    got = records.groupBy("path").agg(F.count("*").alias("found"), F.sum("length").alias("bytes"))
    both = manifest.join(got, "path", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("found", "bytes")})
    return both.filter((F.col("found") != F.col("n_records")) | (F.col("bytes") != F.col("size")))


_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(group: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = [_KINDS[f.split()[1]] for f in RECORD_FIELDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in group], k) for n, k in zip(names, kinds)], names=names)


def archive_folder(spark) -> str:
    return fresh_path(spark, "warc")
