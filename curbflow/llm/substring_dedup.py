"""Repeated passages: recurring phrases, Aho-Corasick automata per shard of documents, exact windows."""

from __future__ import annotations

import hashlib
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import Powers, bound_batches, byte_words, map_arrow, run_sums, stage, utf8, word_hashes
from curbflow.operators.lookup import fits_broadcast

WINDOW = 20
PHRASE = 6
SHARD_BYTES = 8 << 20
BROADCAST_IDS = 2_000_000
_LAST = (1 << 63) - 1
_EMPTY = hashlib.sha256(b"").hexdigest()


# Odd bases of the phrase hash and of the two window hashes.
_PHRASE, _WINDOW, _CHECK = (Powers(b) for b in (0xD6E8FEB86659FD93, 0x5851F42D4C957F2D, 0xA0761D6478BD642F))


def run_hashes(words: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` words."""
    n = len(words) - width + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64)
    starts = np.arange(n)
    total = run_sums(words, starts, starts + width, powers)
    with np.errstate(over="ignore"):
        return (total ^ (total >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)


def anchors(words: np.ndarray, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every phrase, position of the least phrase in every window; the first of equal ones).

    Equal windows have their least phrase at the same place, so a window that
    recurs always shows as a recurring phrase. A sliding minimum in doubling steps.
    """
    hashes = run_hashes(words, phrase, _PHRASE)
    span = window - phrase + 1
    n = len(hashes) - span + 1
    if n < 1:
        return hashes, np.empty(0, dtype=np.int32)
    least, where, reach = hashes, np.arange(len(hashes), dtype=np.int32), 1

    def lower(shift: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        right = least[shift : shift + size] < least[:size]
        return np.where(right, least[shift : shift + size], least[:size]), np.where(right, where[shift : shift + size], where[:size])

    while 2 * reach <= span:
        least, where = lower(reach, len(least) - reach)
        reach *= 2
    return hashes, lower(span - reach, n)[1]


def _phrase_rows(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """(hash, shard, n): the anchors of all documents, counted per batch and shard."""
    def over(batches):
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            found, at = [], []
            for shard, text in zip(shards.tolist(), batch.column("text").to_pylist()):
                hashes, where = anchors(word_hashes(utf8(text)), window, phrase)
                if len(where):
                    found.append(hashes[np.unique(where)])
                    at.append(np.full(len(found[-1]), shard, dtype=np.int32))
            if not found:
                continue
            hashes, at = np.concatenate(found).view(np.int64), np.concatenate(at)
            order = np.lexsort((at, hashes))
            hashes, at = hashes[order], at[order]
            first = np.flatnonzero((np.diff(hashes, prepend=hashes[0] ^ 1) != 0) | (np.diff(at, prepend=-1) != 0))
            n = np.diff(np.append(first, len(hashes))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[first]), pa.array(at[first]), pa.array(n)], names=["hash", "shard", "n"])

    return map_arrow(docs, over, "hash long, shard int, n int")


def _automaton(phrases: list[bytes]):
    """Finds the phrases in a text of words joined by blanks, at word borders only."""
    found = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for p in phrases:
        found.add_word(f" {p.decode('utf-8', 'surrogatepass')} ")
    found.make_automaton()
    return found


def _located(automaton, tokens: list[bytes]) -> np.ndarray:
    """Words at which a phrase of the automaton starts."""
    joined = b" ".join(tokens)
    codes = np.frombuffer(joined, dtype=np.uint8)
    marks = np.zeros(len(tokens), dtype=bool)
    ends = [end - size for end, size in automaton.iter(f" {joined.decode('utf-8', 'surrogatepass')} ")]
    if ends:
        blanks = np.concatenate([[-1], np.flatnonzero(codes == 32)])
        letters = np.concatenate([[0], np.cumsum((codes & 0xC0) != 0x80)])  # places in the text, not in its bytes
        marks[np.searchsorted(letters[blanks + 1], np.array(ends) + 1)] = True
    return marks


def _recurring(table: pa.Table, window: int, phrase: int):
    """(id, salt, hashes of the words, starts of windows that may recur) of a shard's documents that have such windows.

    The phrases of the shard that recur somewhere are compiled to one automaton, which then
    reads every document that holds one of them. Each document is hashed once.
    """
    kind = table.column("kind").to_numpy()
    known = table.column("hash").filter(pa.array(kind == 0))  # before numpy: nulls would make them floats
    recurring = np.unique(known.to_numpy().view(np.uint64))
    if not len(recurring):
        return
    ids, salts = table.column("id").to_pylist(), table.column("salt").to_pylist()
    texts = table.column("text")
    phrases: dict[int, bytes] = {}
    concerned: list[tuple[int, np.ndarray, np.ndarray]] = []
    for row in np.flatnonzero(kind == 1).tolist():
        data = utf8(texts[row].as_py())
        words = word_hashes(data)
        hashes, where = anchors(words, window, phrase)
        chosen = where[np.flatnonzero(np.diff(where, prepend=-1))]  # places only rise
        place = np.minimum(np.searchsorted(recurring, hashes[chosen]), len(recurring) - 1)
        chosen = chosen[recurring[place] == hashes[chosen]]
        if len(chosen):
            concerned.append((row, words, where))
            new = [(p, h) for p, h in zip(chosen.tolist(), hashes[chosen].tolist()) if h not in phrases]
            tokens = data.split() if new else []
            for p, h in new:
                phrases[h] = b" ".join(tokens[p : p + phrase])
    if not concerned:
        return
    automaton = _automaton(list(phrases.values()))
    for row, words, where in concerned:
        marks = _located(automaton, utf8(texts[row].as_py()).split())
        yield ids[row], salts[row], words, np.flatnonzero(marks[where])


def _windows(window: int, phrase: int):
    def shard(table: pa.Table) -> pa.Table:
        own = table.column("shard")[0].as_py()
        ids, salts, starts, first, second = [], [], [], [], []
        for id_, salt, words, at in _recurring(table, window, phrase):
            if len(at):
                ids.append(id_)
                salts.append(salt)
                starts.append(at.astype(np.int32))
                first.append(run_hashes(words, window, _WINDOW)[at].view(np.int64))
                second.append((run_hashes(words, window, _CHECK)[at] >> np.uint64(33)).astype(np.int32))
        sizes = np.array([len(s) for s in starts], np.int64)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        lists = lambda parts, kind: pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts) if parts else np.empty(0, kind)))
        return pa.table({
            "shard": pa.array([own] * len(ids), pa.int32()), "id": pa.array(ids, pa.int64()), "salt": pa.array(salts, pa.int64()),
            "starts": lists(starts, np.int32), "keys": lists(first, np.int64), "checks": lists(second, np.int32),
        })

    return shard


def _kept(window: int):
    def shard(table: pa.Table, firsts: pa.Table) -> pa.Table:
        keep: dict[tuple, list[int]] = {}
        for id_, salt, start in zip(*(firsts.column(c).to_pylist() for c in ("id", "salt", "start"))):
            keep.setdefault((id_, salt), []).append(start)
        kind = table.column("kind").to_numpy()
        ids, salts = table.column("id").to_numpy(), table.column("salt").to_numpy()
        texts, lists = table.column("text"), table.column("starts")
        located = {(ids[row], salts[row]): row for row in np.flatnonzero(kind == 2).tolist()}
        rows = np.flatnonzero(kind == 1).tolist()
        sizes, removed, digests, rests = [], [], [], []
        for row in rows:
            tokens = utf8(texts[row].as_py()).split()
            found = located.get((ids[row], salts[row]))
            gone = None
            if found is not None:
                starts = lists[found].values.to_numpy()
                repeated = np.setdiff1d(starts, np.array(keep.get((ids[row], salts[row]), []), dtype=np.int64))
                step = np.zeros(len(tokens) + window + 1, dtype=np.int32)
                np.add.at(step, repeated, 1)
                np.add.at(step, repeated + window, -1)
                gone = np.cumsum(step)[: len(tokens)] > 0
            some = gone is not None and gone.any()
            rest = b" ".join(compress(tokens, (~gone).tolist()) if some else tokens)
            sizes.append(len(tokens))
            removed.append(int(gone.sum()) if some else 0)
            digests.append(hashlib.sha256(rest).hexdigest())
            rests.append(rest.decode("utf-8", "surrogatepass") if some else None)
        return pa.table({
            "id": pa.array(ids[rows], pa.int64()), "salt": pa.array(salts[rows], pa.int64()), "n_words": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string()), "kept_text": pa.array(rests, pa.string()),
        })

    return shard


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, phrase: int = PHRASE, shards: int | None = None
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept_text) for every row of ``docs``.

    Every word covered by a window of ``window`` consecutive words that also starts earlier
    (smaller id, or further up in the same document) is removed. Windows are judged on the input.
    ``kept_text`` is the rest joined by one blank, or null where nothing was removed.

    1. Equal texts form a class; all but the one with the least id lose every word, if they have a
       window at all, and take no part in the rest.
    2. Each window is anchored by the least hash of its ``phrase``-word phrases, so about one phrase in
       eight words stands for all windows. Anchors that occur twice are the recurring phrases.
    3. Documents are dealt to shards of about SHARD_BYTES. A shard learns which of its phrases recur anywhere,
       compiles them to an Aho-Corasick automaton and streams through it its documents that hold one. So the
       automata together grow with the input, and no document meets an automaton that can't match it.
    4. Windows anchored at located phrases are compared by 95-bit hashes: the first place of each is
       one aggregate. The places located are kept with their document, and in a second streaming of the shards all
       but the first are removed, without locating again.

    Null or blank texts have no words; texts under ``window`` words stay whole. A null id counts as larger
    than all others. Different texts under one id are ordered by a checksum of the text; of equal rows one stays.
    An empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("own_id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST)).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("digest", F.unhex(F.md5("text")))
    slim = stage(rows.select("own_id", "id", "digest", F.octet_length("text").cast("long").alias("bytes")), "repeat-ids")
    classes = slim.groupBy("digest").agg(F.min("id").alias("first_id"))
    copies = stage(slim.join(classes, "digest"), "repeat-classes")
    unlike = copies.where("id = first_id").select("id", "digest").distinct()
    same_id = unlike.groupBy("id").count().where("count > 1").limit(1).count() > 0
    same_row = copies.where("id = first_id").groupBy("id", "digest").count().where("count > 1").limit(1).count() > 0
    salt = F.crc32("digest") if same_id else F.lit(0).cast("bigint")

    later = copies.where("id <> first_id").select("id", "digest")
    later = F.broadcast(later) if fits_broadcast(later, BROADCAST_IDS) else later
    kept = rows.join(later, ["id", "digest"], "left_anti")
    if same_row:
        kept = kept.dropDuplicates(["id", "digest"])
    if shards is None:
        shards = max(1, -(-int(slim.agg(F.sum("bytes")).first()[0] or 0) // SHARD_BYTES))
    dealt = kept.select("id", salt.alias("salt"), "text").withColumn(
        "shard", F.pmod(F.xxhash64("id", "salt"), F.lit(shards)).cast("int")
    )

    held = stage(_phrase_rows(dealt, window, phrase), "repeat-phrases")
    recurring = held.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1").select("hash")
    none = lambda kind: F.lit(None).cast(kind)
    content = held.join(recurring, "hash").select(
        "shard", F.lit(0).alias("kind"), "hash", none("bigint").alias("id"), none("bigint").alias("salt"), none("string").alias("text")
    ).unionByName(dealt.select("shard", F.lit(1).alias("kind"), none("bigint").alias("hash"), "id", "salt", "text"))
    found = stage(content.groupBy("shard").applyInArrow(
        _windows(window, phrase), "shard int, id long, salt long, starts array<int>, keys array<long>, checks array<int>"
    ), "repeat-windows")
    each = found.select("id", "salt", F.explode(F.arrays_zip("starts", "keys", "checks")).alias("w")).select("id", "salt", "w.*")
    firsts = each.groupBy("keys", "checks").agg(F.min(F.struct("id", "salt", F.col("starts").alias("start"))).alias("f")).select("f.*").withColumn(
        "shard", F.pmod(F.xxhash64("id", "salt"), F.lit(shards)).cast("int")
    )
    texts = dealt.select("shard", F.lit(1).alias("kind"), "id", "salt", "text", none("array<int>").alias("starts")).unionByName(
        found.select("shard", F.lit(2).alias("kind"), "id", "salt", none("string").alias("text"), "starts")
    )
    result = texts.groupBy("shard").cogroup(firsts.groupBy("shard")).applyInArrow(
        _kept(window), "id long, salt long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
    result = stage(result, "repeat-kept")
    # every row of the input finds its class; only one row of the first id keeps its words
    by_class = copies.withColumn("salt", salt).groupBy("own_id", "id", "digest", "first_id", "salt").agg(F.count(F.lit(1)).alias("n"))
    joined = by_class.join(
        result.withColumnRenamed("id", "first_id"), ["first_id", "salt"]
    ).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    whole = (F.col("id") == F.col("first_id")) & (F.col("copy") == 1) | (F.col("n_words") < window)
    return joined.select(
        F.col("own_id").alias(id_col), "n_words", F.when(whole, F.col("n_removed")).otherwise(F.col("n_words")).alias("n_removed"),
        F.when(whole, F.col("kept_sha256")).otherwise(F.lit(_EMPTY)).alias("kept_sha256"),
        F.when(whole, F.col("kept_text")).otherwise(F.lit("")).alias("kept_text"),
    )
