"""Language by prediction with partial matching over bytes, under frozen statistics."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import map_arrow

ORDER = 3
NODES = 200_000
CONFIDENT_BYTES = 60
UNDETERMINED = "und"
_CHUNK = 4 << 20
_PIECE = 1 << 20  # letter bytes scored or counted at once: a long text goes in pieces, each behind its 3 bytes before
_DENSE = 4 << 20  # cells of the direct gram table, 16 MB in each worker
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> bytes:
    """Lower-cased letters with one blank between and around their runs; empty if there are none."""
    words = _NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""
    return f" {words} ".encode("utf-8", "surrogatepass") if words else b""


def _grams(data: np.ndarray) -> np.ndarray:
    """Each byte behind its ORDER predecessors, as one 32-bit number."""
    wide = data.astype(np.uint32)
    return (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]


def _padded(data: bytes) -> bytes:
    return b"   " + data


def _pieces(data: bytes):
    """The padded text in pieces of at most _PIECE grams; their grams together are those of the whole."""
    padded = _padded(data)
    for start in range(0, len(data), _PIECE):
        yield padded[start : start + _PIECE + 3]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over the whole texts of ``docs`` (lang, text)."""
    def over(batches):
        held: dict[str, list[bytes]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        sizes: dict[str, int] = {}

        def fold(lang: str) -> None:
            parts = [_grams(np.frombuffer(p, dtype=np.uint8)) for p in held.pop(lang)]
            grams, n = np.unique(np.concatenate(parts), return_counts=True)
            if lang in sums:
                both, at = np.unique(np.concatenate([sums[lang][0], grams]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([sums[lang][1], n])).astype(np.int64)
                grams = both
            sums[lang] = (grams, n)
            sizes[lang] = 0

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for piece in _pieces(letters(text)):
                    held.setdefault(lang, []).append(piece)
                    sizes[lang] = sizes.get(lang, 0) + len(piece)
                    if sizes[lang] >= _CHUNK:
                        fold(lang)
        for lang in list(held):
            fold(lang)
        for lang, (grams, n) in sums.items():
            for start in range(0, len(grams), 50_000):
                part = slice(start, start + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams[part])), pa.array(grams[part].astype(np.int64)), pa.array(n[part].astype(np.int64))],
                    names=["lang", "gram", "n"],
                )

    return map_arrow(docs.select("lang", "text"), over, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ByteTree:
    """Code lengths of the next byte after up to three bytes, escaping to shorter contexts (PPM, method C).

    A context of n observations and d distinct successors gives a seen byte c / (n + d), and d / (n + d)
    to all others, which the next shorter context then tells apart; below the
    empty context all 256 bytes are alike. Nothing is updated while scoring.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = grams, counts
        self.levels = []
        for order in range(ORDER, -1, -1):
            mask = (1 << (8 * (order + 1))) - 1
            keys, at = np.unique(grams & mask, return_inverse=True)
            n = np.bincount(at, weights=counts)
            contexts, of = np.unique(keys >> 8, return_inverse=True)
            total, kinds = np.bincount(of, weights=n), np.bincount(of)
            seen = -np.log2(n / (total[of] + kinds[of]))
            escape = -np.log2(kinds / (total + kinds))
            self.levels.append((keys, seen, contexts, escape))

    def __reduce__(self):
        return ByteTree, (self.grams, self.counts)  # sent as its counts, built again where it is used

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of each gram's last byte."""
        out = np.zeros(len(grams))
        open_ = np.arange(len(grams))
        for order, (keys, seen, contexts, escape) in zip(range(ORDER, -1, -1), self.levels):
            own = grams[open_] & ((1 << (8 * (order + 1))) - 1)
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hit = keys[at] == own
            out[open_[hit]] += seen[at[hit]]
            open_, own = open_[~hit], own[~hit] >> 8
            at = np.minimum(np.searchsorted(contexts, own), len(contexts) - 1)
            known = contexts[at] == own
            out[open_[known]] += escape[at[known]]
        out[open_] += 8.0
        return out


class Scorer:
    """All trees at once: code lengths of known grams from one table, of others computed and remembered."""

    def __init__(self, trees: dict[str, ByteTree]):
        self.given = trees
        self.langs = sorted(trees)
        self.trees = [trees[lang] for lang in self.langs]
        self.grams = np.unique(np.concatenate([t.levels[0][0] for t in self.trees])).astype(np.int64)
        self.table = np.stack([t.bits(self.grams) for t in self.trees], axis=1)
        heads, self.first = np.unique(self.grams >> 16, return_index=True)
        self.slot = np.full(1 << 16, -1, dtype=np.int32)
        self.slot[heads] = np.arange(len(heads))
        tails, self.tail = np.unique(self.grams & 0xFFFF, return_inverse=True)
        self.tail_slot = np.full(1 << 16, -1, dtype=np.int32)
        self.tail_slot[tails] = np.arange(len(tails))
        self.dense = None
        if len(heads) * len(tails) <= _DENSE:
            self.dense = np.full((len(heads), len(tails)), -1, dtype=np.int32)
            self.dense[self.slot[self.grams >> 16], self.tail] = np.arange(len(self.grams))

    def __reduce__(self):
        return Scorer, (self.given,)  # each worker builds its tables once from the trees' counts

    def _place(self, grams: np.ndarray) -> np.ndarray:
        if self.dense is None:
            at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
            return np.where(self.grams[at] == grams, at, -1)
        head, tail = self.slot[grams >> 16], self.tail_slot[grams & 0xFFFF]
        return np.where((head < 0) | (tail < 0), -1, self.dense[head, tail])

    def totals(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text (rows) under each language (columns), _PIECE bytes at a time."""
        out = np.zeros((len(texts), len(self.langs)))
        rows, pieces, size = [], [], 0
        for i, text in enumerate(texts):
            for piece in _pieces(text) if text else [_padded(text)]:
                if pieces and size + len(piece) > _PIECE + 3:
                    self._add(out, rows, pieces)
                    rows, pieces, size = [], [], 0
                rows.append(i)
                pieces.append(piece)
                size += len(piece)
        if pieces:
            self._add(out, rows, pieces)
        return out

    def _add(self, out: np.ndarray, rows: list[int], pieces: list[bytes]) -> None:
        """Add the code lengths of padded pieces to their texts' rows of ``out``."""
        joined = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        lengths = np.array([len(p) for p in pieces])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        grams = _grams(joined).astype(np.int64)
        row = np.repeat(np.array(rows, dtype=np.int64), lengths)[3:]
        inside = np.ones(len(grams), dtype=bool)
        for back in range(1, 4):  # a gram must not reach over the start of its piece
            at = starts[1:] - back
            inside[at[(at >= 0) & (at < len(grams))]] = False
        grams, row = grams[inside], row[inside]
        place = self._place(grams)
        known = place >= 0
        for k in range(len(self.langs)):
            out[:, k] += np.bincount(row[known], weights=self.table[place[known], k], minlength=len(out))
        odd, at = np.unique(grams[~known], return_inverse=True)
        if len(odd):
            for k, tree in enumerate(self.trees):
                out[:, k] += np.bincount(row[~known], weights=tree.bits(odd)[at], minlength=len(out))


def fit_languages(docs: DataFrame, nodes: int = NODES) -> dict[str, ByteTree]:
    """A frozen tree per language from every row of ``docs`` (lang, text) with both present.

    Counting covers all rows and is a map and one sum per gram; the trees keep the ``nodes`` most
    frequent grams of a language (ties by gram), which bounds what the driver collects and the tasks get.
    """
    from pyspark.sql import Window

    counts = gram_counts(docs.where("lang is not null and text is not null"))
    ranked = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    rows = ranked.where(F.col("r") <= nodes).select("lang", "gram", "n").toArrow()
    langs, grams, n = np.array(rows.column("lang").to_pylist()), rows.column("gram").to_numpy(), rows.column("n").to_numpy()
    return {str(lang): ByteTree(grams[langs == lang], n[langs == lang].astype(np.float64)) for lang in np.unique(langs)}


def predict_language(docs: DataFrame, trees: dict[str, ByteTree], keep: list[str]) -> DataFrame:
    """``keep`` columns with lang_pred and score for every row of ``docs``, from ``text`` alone.

    The language with the shortest code for the whole text wins (ties by name). ``score`` is its
    share of the likelihoods, computed from the code lengths a byte over at most CONFIDENT_BYTES
    bytes, as the bytes of a long text aren't independent evidence. Texts that are null or have no letter are ``und``
    with score 0, as are all texts where no tree was learned.
    """
    spark = docs.sparkSession
    scorer = spark.sparkContext.broadcast(Scorer(trees) if trees else None)
    kept = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in keep)

    def over(batches):
        model = scorer.value
        for batch in batches:
            data = [letters(t) for t in batch.column("text").to_pylist()]
            langs, scores = [UNDETERMINED] * len(data), np.zeros(len(data))
            rows = [i for i, d in enumerate(data) if d] if model else []
            if rows:
                bits = model.totals([data[i] for i in rows])
                sizes = np.array([len(data[i]) for i in rows])
                scaled = bits * (np.minimum(sizes, CONFIDENT_BYTES) / sizes)[:, None]
                best = scaled.argmin(axis=1)
                odds = np.exp2(scaled.min(axis=1, keepdims=True) - scaled)
                for i, b, p in zip(rows, best, 1 / odds.sum(axis=1)):
                    langs[i], scores[i] = model.langs[b], p
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    return map_arrow(kept, over, f"{schema}, lang_pred string, score double")


def identify_languages(
    docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", nodes: int = NODES
) -> DataFrame:
    """(id, held_out, lang_pred, score) for every row of ``docs``.

    ``held_out`` is a boolean column of ``docs``; rows where it is true or the language is null teach
    nothing. Language, id and source are never looked at in a prediction. Ids may be
    null or repeated; an empty table gives no rows; further columns are ignored.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), held_out.alias("held_out"))
    trees = fit_languages(rows.where("not held_out").select("lang", "text"), nodes)
    return predict_language(rows, trees, [id_col, "held_out"])
