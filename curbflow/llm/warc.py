"""Deterministic sharded WARC writer and its reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.common import map_arrow
from curbflow.session import list_names

MIN_REVISIT_BYTES = 1000
ROLL_BYTES = 32 << 20
SHARD_BYTES = 64 << 20
SAMPLE_ROWS = 20_000
GZIP_LEVEL = 5
MANIFEST = "manifest"

# Fixed values of the WARC 1.1 format.
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MEMBERS = "kind int, id long, url string, sha256 binary, sha1 string, bytes long, member binary, keeper long, keeper_url string"


@dataclass(frozen=True)
class _Target:
    """The folder, opened in a task by whatever file system its address names."""

    uri: str

    def open(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.uri)


def _record_id(page_id: int | None, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page_id}:{sha1}')}>"


def _member(head: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    lines = [WARC_VERSION, *(f"{k}: {v}" for k, v in head), f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", compresslevel=level, mtime=0)


def _clean(value: str) -> str:
    """A header value: control characters would end or split the line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def _head(kind: str, page_id: int | None, url: str | None, sha1: str, block: bytes) -> list[tuple[str, str]]:
    """Headers made anew from the payload; nothing of an earlier archive is taken over."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    own = base64.b32encode(hashlib.sha1(block).digest()).decode()
    return [
        ("WARC-Type", kind), ("WARC-Record-ID", _record_id(page_id, sha1)), ("WARC-Date", _DATE),
        *([("WARC-Target-URI", _clean(url))] if url is not None else []),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{own}"),
        *([("X-Page-ID", str(page_id))] if page_id is not None else []),
    ]


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def _response(page_id: int | None, url: str | None, payload: bytes, sha1: str, level: int) -> bytes:
    block = _http(len(payload)) + payload
    return _member(_head("response", page_id, url, sha1, block), block, level)


def _revisit(page_id, url, size: int, sha1: str, keeper: int | None, keeper_url: str | None, level: int) -> bytes:
    block = _http(size)
    head = _head("revisit", page_id, url, sha1, block) + [
        ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(keeper, sha1)),
        *([("WARC-Refers-To-Target-URI", _clean(keeper_url))] if keeper_url is not None else []),
        *([("X-Refers-To-Page-ID", str(keeper))] if keeper is not None else []),
    ]
    return _member(head, block, level)


def _members(pages: DataFrame, level: int) -> DataFrame:
    """Kind 1: every page as a finished, compressed response record."""
    def over(batches):
        for batch in batches:
            ids, urls, htmls = (batch.column(c).to_pylist() for c in ("id", "url", "html"))
            payloads = [(h or "").encode("utf-8", "surrogatepass") for h in htmls]
            sha1 = [hashlib.sha1(p).hexdigest() for p in payloads]
            n = len(ids)
            yield pa.RecordBatch.from_arrays([
                pa.array([1] * n, pa.int32()), pa.array(ids, pa.int64()), pa.array(urls, pa.string()),
                pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary()), pa.array(sha1, pa.string()),
                pa.array([len(p) for p in payloads], pa.int64()),
                pa.array([_response(*row, level) for row in zip(ids, urls, payloads, sha1)], pa.binary()),
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()),
            ], names=[c.split()[0] for c in MEMBERS.split(", ")])

    return map_arrow(pages, over, MEMBERS)


def _decisions(pages: DataFrame, least: int) -> DataFrame:
    """Kind 0: which pages repeat a payload, and the page that keeps it."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    slim = pages.select("id", "url", F.unhex(F.sha2(payload, 256)).alias("sha256"), F.octet_length(payload).cast("long").alias("bytes"))
    slim = slim.where(F.col("bytes") >= least)
    keepers = slim.groupBy("sha256").agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.struct("id", "url")).alias("k")
    ).where("_n > 1").select("sha256", F.col("k.id").alias("keeper"), F.col("k.url").alias("keeper_url"))
    return slim.join(keepers, "sha256").select(
        F.lit(0).alias("kind"), "id", F.lit(None).cast("string").alias("url"), "sha256", F.lit(None).cast("string").alias("sha1"),
        "bytes", F.lit(None).cast("binary").alias("member"), "keeper", "keeper_url",
    )


def shard_bounds(ids: DataFrame, shards: int, sample_rows: int = SAMPLE_ROWS) -> list[int]:
    """Ids that start the second and later shards: even cuts of a sample by hash, alike on every run."""
    total = ids.where("id is not null").count()
    every = max(1, total // sample_rows)
    sample = [r[0] for r in ids.where("id is not null").where(
        F.pmod(F.xxhash64("id", F.lit(5)), F.lit(every)) == 0
    ).select("id").collect()]
    if shards < 2 or len(sample) < 2:
        return []
    sample.sort()
    return sorted({sample[len(sample) * i // shards] for i in range(1, shards)})


class _Shard:
    """Files of one shard: written under temporary names, renamed when the shard is whole."""

    def __init__(self, target: _Target, shard: int, attempt: str, roll: int):
        self.fs, self.root = target.open()
        self.shard, self.attempt, self.roll = shard, attempt, roll
        self.done: list[dict] = []
        self.out = None

    def _name(self, number: int) -> str:
        return f"part-{self.shard:06d}-{number:05d}.warc.gz"

    def add(self, member: bytes) -> None:
        if self.out is not None and self.size + len(member) > self.roll:
            self._close()
        if self.out is None:
            number = len(self.done)
            self.path = f"{self.root}/_temporary/{self.attempt}-{self._name(number)}"
            self.out, self.size, self.records, self.sum = self.fs.open_output_stream(self.path, compression=None), 0, 0, hashlib.sha256()
            self._write(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMES, self._name(number))}>"), ("WARC-Date", _DATE), ("WARC-Filename", self._name(number)), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", GZIP_LEVEL))
            self.records = 0
        self._write(member)

    def _write(self, member: bytes) -> None:
        self.out.write(member)
        self.sum.update(member)
        self.size += len(member)
        self.records += 1

    def _close(self) -> None:
        self.out.close()
        self.out = None
        self.done.append({"file": self._name(len(self.done)), "temp": self.path, "records": self.records, "bytes": self.size, "sha256": self.sum.hexdigest()})

    def commit(self) -> list[dict]:
        if self.out is not None:
            self._close()
        for entry in self.done:
            final = f"{self.root}/{entry['file']}"
            if self.fs.get_file_info(final).type == pafs.FileType.File:
                self.fs.delete_file(final)  # of an earlier run, or of an attempt that wrote the same bytes
            self.fs.move(entry["temp"], final)
        return self.done


def _writer(target: _Target, roll: int, level: int):
    def over(batches: Iterator[pa.RecordBatch]):
        context = TaskContext.get()
        attempt = f"{context.partitionId()}-{context.taskAttemptId()}"
        shard, files, keeper, seen = None, [], None, None
        for batch in batches:
            for row in batch.to_pylist():
                if shard is None or row["shard"] != shard.shard:
                    files += shard.commit() if shard else []
                    shard, keeper, seen = _Shard(target, row["shard"], attempt, roll), None, None
                here = (row["id"], row["sha256"])
                if row["kind"] == 0:
                    keeper = (here, row["keeper"], row["keeper_url"])
                    continue
                first = seen != here
                seen = here
                if keeper is not None and keeper[0] == here and not (first and row["id"] == keeper[1]):
                    shard.add(_revisit(row["id"], row["url"], row["bytes"], row["sha1"], keeper[1], keeper[2], level))
                else:
                    shard.add(row["member"])
        files += shard.commit() if shard else []
        if files:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[c] for f in files]) for c in ("file", "records", "bytes", "sha256")],
                names=["file", "records", "bytes", "sha256"],
            )

    return over


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    shards: int | None = None, roll_bytes: int = ROLL_BYTES, min_revisit_bytes: int = MIN_REVISIT_BYTES, level: int = GZIP_LEVEL,
) -> DataFrame:
    """Write one record per page to gzipped WARC files under ``path``; returns the manifest.

    Records are compressed where the pages are read and dealt by ranges of ids to ``shards``
    (by default one per 64 MB of payload). In a shard they are sorted by id and payload,
    and a new file starts before it would pass ``roll_bytes`` compressed. Files are written under
    ``_temporary`` with the number of the attempt and renamed when their shard is whole; a repeated
    task writes the same bytes again. The manifest (file, records, bytes, sha256), a Parquet
    table written last, says which files count; those of an earlier run that it doesn't list go. Equal pages and parameters give
    equal files, whatever the partitions.

    Of records with equal payloads (SHA-256) of ``min_revisit_bytes`` or more the one with the
    largest id (null least) is a response, all others revisit it; which they are
    travels as small rows in the same shuffle, not as a join of the payloads. Null html is an
    empty payload; null urls have no target; pages with a null id come first. Among repeated
    rows of that largest id the first is the response. An empty table gives no files.
    """
    spark = pages.sparkSession
    target = _Target(path if "://" in path or not path.startswith("/") else f"file://{path}")
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    if shards is None:
        total = rows.agg(F.sum(F.octet_length("html"))).first()[0] or 0
        shards = max(1, -(-int(total) // SHARD_BYTES))
    bounds = np.array(shard_bounds(rows.select("id"), shards), dtype=np.int64)
    fs, root = target.open()
    fs.create_dir(f"{root}/_temporary", recursive=True)

    def with_shard(batches):
        for batch in batches:
            ids = batch.column("id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            yield batch.append_column("shard", pa.array(np.searchsorted(bounds, ids, side="right"), pa.int32()))

    both = _members(rows, level).unionByName(_decisions(rows, min_revisit_bytes))
    placed = map_arrow(both, with_shard, MEMBERS + ", shard int")
    order = ["shard", F.col("id").asc_nulls_first(), "sha256", "kind", F.col("url").asc_nulls_first()]
    sorted_rows = placed.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions(*order)
    written = map_arrow(sorted_rows, _writer(target, roll_bytes, level), "file string, records long, bytes long, sha256 string")
    earlier = list_names(spark, path)
    written.write.mode("overwrite").parquet(f"{path}/{MANIFEST}")
    fs.delete_dir(f"{root}/_temporary")
    manifest = spark.read.parquet(f"{path}/{MANIFEST}")
    _clear(spark, target, [n for n in earlier if n.endswith(".warc.gz")], manifest)
    return manifest


def _clear(spark: SparkSession, target: _Target, names: list[str], manifest: DataFrame) -> None:
    """Delete files of an earlier run that the manifest doesn't list."""
    if not names:
        return
    left = spark.createDataFrame([(n,) for n in names], "file string").join(manifest.select("file"), "file", "left_anti")
    fs, root = target.open()
    for row in left.toLocalIterator():
        fs.delete_file(f"{root}/{row[0]}")


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:] if line)
    return {k.decode().lower(): v.strip().decode() for k, _, v in pairs}


def iter_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each gzip member of an open file; holds one record at a time."""
    raw, data = zlib.decompressobj(31), b""
    parts: list[bytes] = []
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                if parts or not raw.eof and raw.unconsumed_tail:
                    raise ValueError("the archive ends inside a record")
                return
        parts.append(raw.decompress(data))
        data = b""
        if raw.eof:
            data = raw.unused_data
            head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
            fields = _fields(head)
            yield fields, rest[: int(fields["content-length"])]
            raw, parts = zlib.decompressobj(31), []


class _Summed:
    """An open file whose bytes are digested as they are read."""

    def __init__(self, stream):
        self.stream, self.sum = stream, hashlib.sha256()

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.sum.update(data)
        return data


def _payload(block: bytes) -> tuple[int, bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    return int(_fields(head)["content-length"]), body


def read_warc(spark: SparkSession, path: str, bodies: bool = False) -> DataFrame:
    """Records of all files in the manifest: id, url, type, size and digest of the payload, referred id.

    Files are streamed record by record. The digest and size of a response are computed
    from its body and must agree with its headers; a revisit's come from its headers.
    A file whose bytes differ from its digest in the manifest is an error. ``bodies`` adds the payload itself (null for revisits).
    """
    target = _Target(path if "://" in path or not path.startswith("/") else f"file://{path}")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if bodies:
        names, schema, types = [*names, "payload"], schema + ", payload binary", [*types, pa.binary()]

    def over(batches):
        fs, root = target.open()
        for batch in batches:
            digests = dict(zip(batch.column("file").to_pylist(), batch.column("sha256").to_pylist()))
            for file in digests:
                rows: list[list] = []
                held = 0
                with fs.open_input_stream(f"{root}/{file}", compression=None) as opened:
                    raw = _Summed(opened)
                    for fields, block in iter_records(raw):
                        if fields["warc-type"] == "warcinfo":
                            continue
                        size, body = _payload(block)
                        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        response = fields["warc-type"] == "response"
                        if response and (hashlib.sha1(body).hexdigest() != digest or len(body) != size):
                            raise ValueError(f"{file}: payload and headers of {fields['warc-record-id']} differ")
                        page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                        row = [page and int(page), fields.get("warc-target-uri"), size, digest, fields["warc-type"], refers and int(refers)]
                        rows.append(row + [body if response else None] if bodies else row)
                        held += len(body) if bodies else 0
                        if len(rows) >= 5000 or held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                            rows, held = [], 0
                if raw.sum.hexdigest() != digests[file]:
                    raise ValueError(f"{file} differs from the manifest")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    files = spark.read.parquet(f"{path}/{MANIFEST}").select("file", "sha256")
    count = max(1, files.count())
    return map_arrow(files.repartition(count, "file"), over, schema)
