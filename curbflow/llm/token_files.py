"""Corpora as token ids: one wavelet matrix per file, in ascending order of documents."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbflow.llm.common import map_arrow
from curbflow.llm.tokens import PartEncoder, byte_bpe, shared_encoder
from curbflow.llm.wavelet import WaveletFile, wavelet_bytes
from curbflow.session import delete_path
from curbflow.sources.commits import commit_next, latest

SHARD_BYTES = 32 << 20
FILE_TOKENS = 2 << 20
RANK_ROWS = 4096

_MANIFEST = "file string, shard int, roll int, documents long, tokens long, bytes long, sha256 string"


@dataclass(frozen=True)
class Folder:
    """A folder, opened in a task by whatever file system its address names."""

    uri: str

    @staticmethod
    def at(path: str) -> Folder:
        return Folder(path if "://" in path or not path.startswith("/") else f"file://{path}")

    def open(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.uri)


class _Writer:
    """Files of one shard; each gets its final name only when it is whole."""

    def __init__(self, folder: Folder, file_tokens: int):
        context = TaskContext.get()
        self.fs, self.root = folder.open()
        self.file_tokens = file_tokens
        self.shard, self.attempt = context.partitionId(), context.taskAttemptId()
        self.roll = 0
        self._clear()

    def _clear(self) -> None:
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.tokens: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: int | None, tokens: np.ndarray) -> Iterator[tuple]:
        if self.ids and self.held + len(tokens) > self.file_tokens:
            yield self.close()
        self.ids.append(doc_id)
        self.sizes.append(len(tokens))
        self.tokens.append(tokens)
        self.held += len(tokens)

    def close(self) -> tuple:
        name = f"part-{self.shard:06d}-{self.roll:05d}-{self.attempt}.wm"
        arrays = {
            "ids": np.array([i or 0 for i in self.ids], np.int64), "null_id": np.array([i is None for i in self.ids], np.uint8),
            "sizes": np.array(self.sizes, np.int64),
        }
        digest, size = hashlib.sha256(), 0
        temp, final = f"{self.root}/_temporary/{name}", f"{self.root}/{name}"
        with self.fs.open_output_stream(temp, compression=None) as out:
            for part in wavelet_bytes(np.concatenate(self.tokens), arrays):
                out.write(part)
                digest.update(part)
                size += len(part)
        self.fs.move(temp, final)
        row = (name, self.shard, self.roll, len(self.ids), self.held, size, digest.hexdigest())
        self.roll += 1
        self._clear()
        return row


def _batch(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), schema)], names=[n for n, _ in schema])


_MANIFEST_ARROW = [
    ("file", pa.string()), ("shard", pa.int32()), ("roll", pa.int32()), ("documents", pa.int64()), ("tokens", pa.int64()),
    ("bytes", pa.int64()), ("sha256", pa.string()),
]


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    shard_bytes: int = SHARD_BYTES, file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Encode every text, append ``end_id`` to each and write the ids to ``path``; returns the manifest.

    Documents are dealt by ranges of (id, checksum of the text, row) to shards of about ``shard_bytes`` of
    text, sorted there, encoded as they pass and collected to files of up to ``file_tokens`` ids; a longer document
    has a file of its own. A task holds one file and one batch of texts. Rows of one id, or without one, spread over
    shards, so no id has to fit one task. A file is a wavelet matrix of its ids (see ``wavelet``) with ids and sizes of its
    documents beside it.

    Each run writes a folder of its own. Files get names of their task attempt and lose their temporary place when whole; the
    manifest lists those that count, and a numbered commit then makes the run the current one, so readers see the run before
    or this one, whole. Folders of earlier runs go afterwards.

    Order: ascending ids, rows without an id last; rows of one id by checksum of the text. A null text is an empty one, which
    has the end id only. An empty table gives no file. A text is held whole while it is encoded, and a stretch of it without
    blanks goes to the tokenizer in one piece. Strings of special tokens count as these, as the tokenizer's default has it.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + F.lit(64))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    run = f"run-{uuid.uuid4().hex}"
    folder = Folder.at(f"{path.rstrip('/')}/{run}")
    fs, root = folder.open()
    fs.create_dir(f"{root}/_temporary", recursive=True)
    end = np.array([end_id], np.int32)

    def write(batches):
        writer = _Writer(folder, file_tokens)
        encode = shared_encoder(("files", tokenizer), lambda: PartEncoder(byte_bpe(tokenizer, special_as_text=False), lead=False))
        for batch in batches:
            [(ids, sizes)] = encode(batch.column("text"))
            ends = np.cumsum(sizes)
            done = [
                row for doc_id, start, stop in zip(batch.column("id").to_pylist(), (ends - sizes).tolist(), ends.tolist())
                for row in writer.add(doc_id, np.concatenate([ids[start:stop], end]))
            ]
            if done:
                yield _batch(done, _MANIFEST_ARROW)
        if writer.ids:
            yield _batch([writer.close()], _MANIFEST_ARROW)

    keyed = rows.withColumn("digest", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("id").asc_nulls_last(), F.col("digest").asc(), F.col("row").asc()]
    sorted_rows = keyed.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("id", "text")
    map_arrow(sorted_rows, write, _MANIFEST).write.parquet(f"{path.rstrip('/')}/{run}/manifest")
    fs.delete_dir(f"{root}/_temporary")
    before = latest(spark, path)
    commit_next(spark, path, lambda old: {"run": run, "tokenizer": tokenizer, "end_id": end_id})
    if before is not None:
        delete_path(spark, f"{path.rstrip('/')}/{before[1]['run']}")
    return _manifest(spark, path)[1]


def _manifest(spark: SparkSession, path: str) -> tuple[Folder, DataFrame]:
    """The current run and its files with the number of ids before each.

    The running total is taken within blocks of RANK_ROWS files and over the sums of the blocks, so
    that no task has to see all files.
    """
    found = latest(spark, path)
    if found is None:
        raise ValueError(f"no token files at {path}")
    run = f"{path.rstrip('/')}/{found[1]['run']}"
    files = spark.read.parquet(f"{run}/manifest")
    shards = files.groupBy("shard").agg(F.sum("tokens").alias("_sum")).withColumn("_block", F.floor(F.col("shard") / RANK_ROWS))
    blocks = shards.groupBy("_block").agg(F.sum("_sum").alias("_total"))
    over_blocks = blocks.select("_block", (F.sum("_total").over(Window.orderBy("_block")) - F.col("_total")).alias("_before_block"))
    in_block = F.sum("_sum").over(Window.partitionBy("_block").orderBy("shard")) - F.col("_sum")
    starts = shards.withColumn("_before", in_block).join(over_blocks, "_block").select("shard", (F.col("_before") + F.col("_before_block")).alias("_shard_start"))
    in_shard = F.sum("tokens").over(Window.partitionBy("shard").orderBy("roll")) - F.col("tokens")
    return Folder.at(run), files.withColumn("_in", in_shard).join(starts, "shard").select(
        *files.columns, (F.col("_in") + F.col("_shard_start")).alias("start")
    )


def _open(fs: pafs.FileSystem, path: str) -> tuple[pa.NativeFile, WaveletFile]:
    file = fs.open_input_file(path)
    return file, WaveletFile(lambda at, size: file.read_at(size, at), file.size())


def _per_file(spark: SparkSession, path: str, fn, schema: str, columns: list[tuple[str, pa.DataType]]) -> DataFrame:
    """``fn(fs, path, start, sha256)`` over the files of the current run, each by one task; it yields lists of rows."""
    folder, files = _manifest(spark, path)

    def over(batches):
        fs, root = folder.open()
        for batch in batches:
            for name, start, digest in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "sha256"))):
                for rows in fn(fs, f"{root}/{name}", start, digest):
                    if rows:
                        yield _batch(rows, columns)
                pa.default_memory_pool().release_unused()

    count = max(1, files.count())
    return map_arrow(files.select("file", "start", "sha256").repartition(count, "file"), over, schema)


def read_token_files(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """Per document (doc_id, start, n_tokens, ids_crc32) from the files; with ``ids`` the ids themselves too.

    ``start`` counts the ids of all documents before. A file whose bytes differ from its entry in the
    manifest is an error.
    """
    columns = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
    columns += [("ids", pa.list_(pa.int32()))] if ids else []

    def decode(fs, file, start, digest):
        with fs.open_input_stream(file, compression=None) as stream:
            data = stream.read()
        if hashlib.sha256(data).hexdigest() != digest:
            raise ValueError(f"{file} differs from the manifest")
        view = memoryview(data)
        stored = WaveletFile(lambda at, size: view[at : at + size], len(data))
        tokens = stored.tokens().astype("<u4")
        at, rows = 0, []
        for doc_id, null, size in zip(*(stored.arrays[c].tolist() for c in ("ids", "null_id", "sizes"))):
            own = tokens[at : at + size]
            row = (None if null else doc_id, start + at, size, zlib.crc32(own.tobytes()))
            rows.append((*row, own.astype(np.int32)) if ids else row)
            at += size
            if len(rows) >= 20_000 or ids and len(rows) >= 500:
                yield rows
                rows = []
        yield rows

    return _per_file(spark, path, decode, schema, columns)


def count_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of the given ids stands in the corpus, by two rank questions a file and id."""
    wanted = sorted(set(tokens))

    def count(fs, file, start, digest):
        opened, stored = _open(fs, file)
        with opened:
            yield [(t, stored.count(t)) for t in wanted]

    found = _per_file(spark, path, count, "token long, n long", [("token", pa.int64()), ("n", pa.int64())])
    asked = spark.createDataFrame([(t,) for t in wanted], "token long")
    sums = found.groupBy("token").agg(F.sum("n").alias("n"))
    return asked.join(sums, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, place, corpus_place) of every occurrence of an id, by select; no file is decoded whole."""
    def find(fs, file, start, digest):
        opened, stored = _open(fs, file)
        with opened:
            sizes = stored.arrays["sizes"]
            firsts = np.cumsum(sizes) - sizes
            total = stored.count(token)
            for low in range(0, total, 20_000):
                at = stored.select(token, np.arange(low, min(low + 20_000, total)))
                doc = np.searchsorted(firsts, at, side="right") - 1
                null = stored.arrays["null_id"][doc]
                yield [
                    (None if n else i, p, c) for n, i, p, c in
                    zip(null.tolist(), stored.arrays["ids"][doc].tolist(), (at - firsts[doc]).tolist(), (at + start).tolist())
                ]

    columns = [("doc_id", pa.int64()), ("place", pa.int64()), ("corpus_place", pa.int64())]
    return _per_file(spark, path, find, "doc_id long, place long, corpus_place long", columns)


def tokens_at(spark: SparkSession, path: str, places: list[int]) -> DataFrame:
    """(corpus_place, token) of the given places of the corpus, by access; files without one aren't opened."""
    wanted = np.unique(np.array(places, dtype=np.int64))

    def at(fs, file, start, digest):
        opened, stored = _open(fs, file)
        with opened:
            mine = wanted[(wanted >= start) & (wanted < start + stored.size)]
            yield list(zip(mine.tolist(), stored.access(mine - start).tolist()))

    return _per_file(spark, path, at, "corpus_place long, token long", [("corpus_place", pa.int64()), ("token", pa.int64())])
