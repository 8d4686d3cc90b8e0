"""Which tokens of two tokenizers end together, document by document and over the corpus."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import map_arrow, stage
from curbflow.llm.tokens import PIECE, PartEncoder, byte_bpe, piece_bpe, pieces, shared_encoder
from curbflow.operators import lookup_join

UNIT_BYTES = 3 << 20
BROADCAST_PAIRS = 3_000_000
_SHIFT = 20

_DOC = [
    ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
]
_DOC_SQL = "id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def byte_level_signs() -> dict[str, int]:
    """The byte each sign of a byte-level vocabulary stands for: printable ones stand for themselves, others follow from 256."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


def byte_bpe_bytes(file: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file."""
    with open(file, encoding="utf-8") as source:
        content = json.load(source)
    entries = dict(content["model"]["vocab"])
    signs = byte_level_signs()
    out = [b""] * (1 + max([*entries.values(), *(t["id"] for t in content["added_tokens"])]))
    for entry, i in entries.items():
        out[i] = bytes(signs[c] for c in entry) if all(c in signs for c in entry) else entry.encode()
    for added in content["added_tokens"]:
        out[added["id"]] = added["content"].encode()
    return out


def piece_bpe_bytes(file: str) -> list[bytes]:
    """The bytes of each id of a sentencepiece file; control and unknown pieces have none."""
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=file)
    out = []
    for i in range(processor.get_piece_size()):
        if processor.is_byte(i):
            out.append(bytes([int(processor.id_to_piece(i)[3:-1], 16)]))
        elif processor.is_control(i) or processor.is_unknown(i):
            out.append(b"")
        else:
            out.append(processor.id_to_piece(i).replace("▁", " ").encode())
    return out


class _Side:
    """The vocabulary of one tokenizer as Arrow tables."""

    def __init__(self, entries: list[bytes], inside: str, last: str):
        self.bytes = pa.array(entries, pa.binary())
        self.sizes = pa.array([len(e) for e in entries], pa.int64())
        self.signs = pa.array([f"{i}{mark}" for i in range(len(entries)) for mark in (inside, last)], pa.string())


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _ends(tokens: pa.ListArray, side: _Side) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(ids, their text, byte at which each ends in its text) of lists of ids: a running sum per list."""
    ids, text = pc.list_flatten(tokens), pc.list_parent_indices(tokens)
    running = pc.cumulative_sum(pc.take(side.sizes, ids))
    padded = pa.concat_arrays([pa.array([0], pa.int64()), running])
    before = pc.take(padded, pc.cast(tokens.offsets.slice(0, len(tokens)), pa.int64()))
    return ids, text, pc.subtract(running, pc.take(before, text))


def _spelled(tokens: pa.ListArray, side: _Side) -> pa.Array:
    """The bytes of each list of ids."""
    return pc.binary_join(pa.ListArray.from_arrays(tokens.offsets, pc.take(side.bytes, pc.list_flatten(tokens))), b"")


class Aligner:
    """Aligns stretches of text under two tokenizers."""

    def __init__(self, byte_file: str, piece_file: str):
        self.encode = shared_encoder(("alignment", byte_file, piece_file), lambda: PartEncoder(byte_bpe(byte_file), piece_bpe(piece_file)))
        self.a, self.b = _Side(byte_bpe_bytes(byte_file), ",", "|"), _Side(piece_bpe_bytes(piece_file), ",", ";")
        self.signs = pa.concat_arrays([self.a.signs, self.b.signs])

    def align(self, texts: list[str]) -> tuple[list[np.ndarray], pa.Array, pa.Table]:
        """([right, n_a, n_b, n_links], groups as text, pairs with their number) of every text.

        A text that either tokenizer doesn't spell back has no tokens; ``right`` tells.
        """
        (a_ids, a_sizes), (b_ids, b_sizes) = self.encode(texts)
        a, b = _lists(pa.array(a_ids), a_sizes), _lists(pa.array(b_ids), b_sizes)
        wanted = pa.array([b" " + t.encode("utf-8", "surrogatepass") for t in texts], pa.binary())
        right = pc.and_(pc.equal(_spelled(a, self.a), wanted), pc.equal(_spelled(b, self.b), wanted)).to_numpy(zero_copy_only=False)
        if not right.all():
            kept_a, kept_b = np.repeat(right, a_sizes), np.repeat(right, b_sizes)
            a_sizes, b_sizes = np.where(right, a_sizes, 0), np.where(right, b_sizes, 0)
            a, b = _lists(pa.array(a_ids[kept_a]), a_sizes), _lists(pa.array(b_ids[kept_b]), b_sizes)
        a_flat, a_text, a_end = _ends(a, self.a)
        b_flat, b_text, b_end = _ends(b, self.b)
        left = pa.table({"text": a_text, "end": a_end, "a": a_flat, "a_at": pa.array(np.arange(len(a_flat)))})
        other = pa.table({"text": b_text, "end": b_end, "b": b_flat, "b_at": pa.array(np.arange(len(b_flat)))})
        links = left.join(other, ["text", "end"], join_type="inner", use_threads=False)
        at_a, at_b = (np.zeros(n, bool) for n in (len(a_flat), len(b_flat)))
        at_a[links.column("a_at").to_numpy()] = True
        at_b[links.column("b_at").to_numpy()] = True
        pair = pc.bit_wise_or(pc.shift_left(pc.cast(links.column("a"), pa.int64()), pa.scalar(_SHIFT, pa.int64())), pc.cast(links.column("b"), pa.int64()))
        pairs = pa.table({"text": links.column("text"), "pair": pair}).group_by(["text", "pair"], use_threads=False).aggregate([([], "count_all")])
        n_links = np.bincount(links.column("text").to_numpy(), minlength=len(texts))
        return [right, a_sizes, b_sizes, n_links], self._groups(a_flat, b_flat, at_a, at_b, a_sizes + b_sizes), pairs

    def _groups(self, a: pa.Array, b: pa.Array, a_last: np.ndarray, b_last: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """Per text its groups, each as ids of one side, a bar, ids of the other and a semicolon.

        Both sides have the same groups in the same order, so a token's place in the joint
        sequence is its own place plus the tokens of the other side that go before its group's.
        """
        a_stop, b_stop = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
        b_start = np.concatenate([[0], b_stop])
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        signs = np.empty(len(a) + len(b), np.int64)
        signs[np.arange(len(a)) + b_start[a_group]] = 2 * a.to_numpy().astype(np.int64) + a_last
        signs[np.arange(len(b)) + a_stop[b_group]] = len(self.a.signs) + 2 * b.to_numpy().astype(np.int64) + b_last
        return pc.binary_join(_lists(pc.take(self.signs, pa.array(signs)), sizes), "")


class _Document:
    """What the stretches of a long text add up to."""

    def __init__(self, doc_id: int | None):
        self.id, self.right = doc_id, True
        self.n_a = self.n_b = self.n_links = self.n_groups = 0
        self.sha, self.some = hashlib.sha256(), False
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, right, n_a, n_b, n_links, groups: str, pairs: np.ndarray, times: np.ndarray) -> None:
        self.right &= bool(right)
        if not self.right:
            self.pairs, self.times = [], []
            return
        self.n_a, self.n_b, self.n_links = self.n_a + int(n_a), self.n_b + int(n_b), self.n_links + int(n_links)
        self.n_groups += groups.count("|")
        self.sha.update(((";" if self.some else "") + groups[:-1]).encode())
        self.some = True
        self.pairs.append(pairs)
        self.times.append(times)
        if sum(map(len, self.pairs)) > 1 << 20 and len(self.pairs) > 1:
            self._merge()

    def _merge(self) -> None:
        distinct, where = np.unique(np.concatenate(self.pairs), return_inverse=True)
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, where, np.concatenate(self.times))
        self.pairs, self.times = [distinct], [totals]

    def row(self) -> tuple:
        if not self.right or not self.some:
            return (self.id, 0, 0, 0, 0, "", [], [])
        if len(self.pairs) > 1:
            self._merge()
        return (self.id, self.n_a, self.n_b, self.n_groups, self.n_links, self.sha.hexdigest(), self.pairs[0], self.times[0])


def _aligned(byte_file: str, piece_file: str, stretch: int, unit_bytes: int):
    def over(batches):
        aligner = Aligner(byte_file, piece_file)
        open_docs: list[_Document] = []
        owners: list[int] = []
        units: list[str] = []

        def flush() -> Iterator[pa.RecordBatch]:
            """Align the units collected; all documents but the last, which may go on, are done."""
            nonlocal open_docs, owners, units
            if units:
                counts, groups, pairs = aligner.align(units)
                text, pair, times = (pairs.column(c).to_numpy() for c in ("text", "pair", "count_all"))
                order = np.lexsort((pair, text))
                bounds = np.searchsorted(text[order], np.arange(len(units) + 1))
                pair, times = pair[order], times[order]
                for k, (owner, own) in enumerate(zip(owners, groups.to_pylist())):
                    start, stop = bounds[k], bounds[k + 1]
                    open_docs[owner].add(*(c[k] for c in counts), own, pair[start:stop], times[start:stop])
            owners, units = [], []
            done, open_docs = open_docs[:-1], open_docs[-1:]
            if done:
                yield rows(done)

        def rows(docs: list[_Document]) -> pa.RecordBatch:
            cells = list(zip(*(d.row() for d in docs)))
            plain = [pa.array(c, t) for c, (_, t) in zip(cells[:-2], _DOC[:-2])]
            lists = [_lists(pa.array(np.concatenate([np.asarray(v, np.int64) for v in c])), np.array([len(v) for v in c])) for c in cells[-2:]]
            return pa.RecordBatch.from_arrays([*plain, *lists], names=[n for n, _ in _DOC])

        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                if held >= unit_bytes:
                    yield from flush()
                    held = 0
                open_docs.append(_Document(doc_id))
                held += 64
                for piece in pieces(text, stretch) if text else ():
                    if held >= unit_bytes:
                        yield from flush()
                        held = 0
                    owners.append(len(open_docs) - 1)
                    units.append(piece)
                    held += len(piece)
        yield from flush()
        if open_docs:
            yield rows(open_docs)

    return over


def _partial_counts(batches):
    """(pair, n) of each batch of documents."""
    for batch in batches:
        flat = pa.table({"pair": pc.list_flatten(batch.column("pairs")), "n": pc.list_flatten(batch.column("times"))})
        found = flat.group_by("pair", use_threads=False).aggregate([("n", "sum")])
        yield from found.select(["pair", "n_sum"]).rename_columns(["pair", "n"]).to_batches()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best) of all pairs of the corpus; ``best`` where no pair of its second id has a higher count.

    Batches of documents are counted by themselves first, so a frequent pair costs one row a batch.
    The highest counts have one row per id of the second vocabulary, the bound of their broadcast.
    """
    partial = map_arrow(aligned.select("pairs", "times"), _partial_counts, "pair long, n long")
    counts = stage(partial.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-pairs")
    second = F.col("pair").bitwiseAND((1 << _SHIFT) - 1)
    highest = counts.groupBy(second.alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", second).join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums_of_few(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """n_best and count_sum by the broadcast table of all pairs."""
    held = counts.toArrow()
    pair = held.column("pair").to_numpy()
    order = np.argsort(pair)
    tables = aligned.sparkSession.sparkContext.broadcast(
        (pair[order], held.column("n").to_numpy()[order], held.column("best").to_numpy()[order])
    )

    def over(batches):
        known, n, best = tables.value
        for batch in batches:
            lists = batch.column("pairs")
            at = np.searchsorted(known, pc.list_flatten(lists).to_numpy())
            times = pc.list_flatten(batch.column("times")).to_numpy()
            links = pa.table({
                "row": pc.list_parent_indices(lists), "n_best": pa.array(np.where(best[at], times, 0), pa.int64()),
                "count_sum": pa.array(n[at] * times, pa.int64()),
            })
            sums = links.group_by("row", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
            row = sums.column("row").to_numpy()
            kept = batch.drop_columns(["pairs", "times"])
            for name in ("n_best", "count_sum"):
                values = np.zeros(batch.num_rows, np.int64)
                values[row] = sums.column(f"{name}_sum").to_numpy()
                kept = kept.append_column(name, pa.array(values))
            yield kept

    schema = ", ".join(f"{c} {t}" for c, t in aligned.dtypes if c not in ("pairs", "times"))
    return map_arrow(aligned, over, f"{schema}, n_best bigint, count_sum bigint")


def _sums_of_many(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a join of every document's pairs, salted where a pair is frequent."""
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", "link.*").withColumnRenamed("pairs", "pair")
    found = lookup_join(links, counts, ["pair"], "inner", max_rows=0)
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")
    )
    return aligned.drop("pairs", "times").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])


def align_tokens(
    docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS,
    stretch: int = PIECE, unit_bytes: int = UNIT_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Align the tokens of two tokenizers; returns (documents, pairs).

    A is the byte-level BPE of ``byte_file`` on a blank and the text, B the sentencepiece BPE of ``piece_file``, which sets
    that blank itself. Strings of special tokens are plain text. Bytes at which a token of A and one of B end together cut a
    text into groups; the two tokens are linked.

    1. In each task ids become Arrow lists; flattened ids with their list's index give byte ends by a running sum per
       text, and a hash join on (text, end) gives the links.
    2. Links are counted per text and pair, then per batch, and Spark adds the partial counts of all batches.
    3. The counts go back to the documents: as a broadcast while they are at most ``broadcast_pairs`` pairs (counted first),
       else by a join that salts frequent pairs.

    ``documents``: id, n_a, n_b, n_groups, n_links, groups_sha256 (of `a1,a2|b1;a3|b2,b3`), n_best (links whose count is the
    highest of their id of B, ties included) and count_sum (counts over the links). ``pairs``: a, b, n, best.

    Null and empty texts, and those that either tokenizer doesn't spell back byte for byte, have no tokens: zeros and an empty
    text. Each row of ``docs`` gives one row, repeated ids and rows without an id included. Long texts are worked on in stretches of
    some ``stretch`` characters cut at blanks, where both tokenizers always end a token; a stretch without such a blank stays
    whole; a task holds about ``unit_bytes`` of text at a time. An empty table gives no rows; further columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = map_arrow(rows, _aligned(byte_file, piece_file, stretch, unit_bytes), _DOC_SQL)
    aligned = stage(found.withColumn("row", F.monotonically_increasing_id()), "alignment")
    counts = stage(pair_counts(aligned), "alignment-counts")
    few = counts.count() <= broadcast_pairs
    sums = (_sums_of_few if few else _sums_of_many)(aligned, counts)
    documents = sums.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.col("n_best").cast("bigint"), F.col("count_sum").cast("bigint"), "groups_sha256"
    )
    return documents, counts.select(
        F.shiftright("pair", _SHIFT).alias("a"), F.col("pair").bitwiseAND((1 << _SHIFT) - 1).alias("b"), "n", "best"
    )
