"""Encoding texts with public tokenizers, part by part, with a bounded table of known parts."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PARTS = 1_000_000
PIECE = 1 << 21
BLOCK_BYTES = 12 << 20
_TOGETHER = 200
_GATHERED = 1 << 18

# White space of any kind, as Python and the tokenizers see it together.
_WHITE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

# A blank between two characters that aren't white space: no token of the two kinds of tokenizer
# used here spans it, for a blank only ever starts a word or belongs to a run of blanks.
_CUT = re.compile("(?<=[^\\s\u180e]) (?=[^\\s\u180e])")
# Texts with a blank at which they can't be cut.
_UNLIKE = rf"[{_WHITE}] | [{_WHITE}]|^ | $|^$"

# Parts that can't stand among others: without a blank first, with another one, with white space at an end.
_NOT_PLAIN = rf"(?s)^[^ ]|^$|^ [{_WHITE}]|[{_WHITE}]$|. "

# Parts, each with a blank before it or not, to (their ids one after the other, number of ids of each).
Encoder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes


def byte_bpe(file: str, special_as_text: bool = True) -> Encoder:
    """Encoder of a byte-level BPE file of the tokenizers library.

    Parts are encoded many in one text, as that is faster, and told apart by the tokens that begin with a blank;
    parts with blanks inside go one by one.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    tokenizer.encode_special_tokens = special_as_text
    opens = np.zeros(tokenizer.get_vocab_size(), bool)
    opens[[i for entry, i in tokenizer.get_vocab().items() if entry.startswith("\u0120")]] = True

    def single(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        some = (parts[at : at + _TOGETHER] for at in range(0, len(parts), _TOGETHER))
        return _flat([e.ids for own in some for e in tokenizer.encode_batch_fast(own, add_special_tokens=False)])

    def encode(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        several = pc.match_substring_regex(parts, _NOT_PLAIN).to_numpy(zero_copy_only=False)
        plain, texts = np.flatnonzero(~several), parts.to_pylist()
        groups = [plain[at : at + _TOGETHER].tolist() for at in range(0, len(plain), _TOGETHER)]
        sizes = np.zeros(len(parts), np.int64)
        found: list[tuple[list[int], np.ndarray]] = []
        alone = np.flatnonzero(several).tolist()
        for group in groups:  # an encoding holds far more than its ids, so one at a time
            ids = np.array(tokenizer.encode_batch_fast(["".join([texts[k] for k in group])], add_special_tokens=False)[0].ids, np.int32)
            starts = np.flatnonzero(opens[ids])
            if len(starts) != len(group):
                alone += group
                continue
            sizes[group] = np.diff(np.append(starts, len(ids)))
            found.append((group, ids))
        if alone:
            ids, own = single([texts[k] for k in alone])
            sizes[alone] = own
            found.append((alone, ids))
        out = np.empty(int(sizes.sum()), np.int32)
        firsts = np.cumsum(sizes) - sizes
        order = np.concatenate([np.array(group, np.int64) for group, _ in found] or [np.empty(0, np.int64)])
        own = sizes[order]
        out[np.repeat(firsts[order] - np.cumsum(own) + own, own) + np.arange(len(out))] = np.concatenate([i for _, i in found] or [np.empty(0, np.int32)])
        return out, sizes

    return encode


def piece_bpe(file: str) -> Encoder:
    """Encoder of a sentencepiece BPE file, which sets the blank before each part by itself."""
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=file)

    def encode(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return _flat(processor.encode([p[1:] for p in parts.to_pylist()], num_threads=1))

    return encode


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A text cut into pieces of about ``size`` characters, all but the first with their blank left out."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


class _Table:
    """Ids of the known parts under one encoder."""

    def __init__(self):
        self.ids = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int32)
        self.sizes = np.empty(0, np.int32)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = (len(self.ids) + np.cumsum(sizes) - sizes).astype(np.int32)
        self.ids, self.starts = np.concatenate([self.ids, ids]), np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the parts one after the other, number of ids of each part); works through some parts at a time."""
        sizes = self.sizes[codes]
        out, at = np.empty(int(sizes.sum(dtype=np.int64)), np.int32), 0
        for start in range(0, len(codes), _GATHERED):
            own = sizes[start : start + _GATHERED]
            total = np.cumsum(own)
            first = np.repeat(self.starts[codes[start : start + _GATHERED]] - total + own, own)
            first += np.arange(len(first), dtype=np.int32)
            out[at : at + len(first)] = self.ids[first]
            at += len(first)
        return out, sizes


class PartEncoder:
    """Encodes texts under several encoders, each part of a text that is known only once.

    A text is cut at single blanks between words; the ids of a text are those of its
    parts one after the other, which tests hold against whole texts. With ``lead`` each text
    is encoded with a blank before it. At most ``most`` parts stay known; then the table starts anew.
    """

    def __init__(self, *encoders: Encoder, lead: bool = True, most: int = PARTS):
        self.encoders, self.lead, self.most = encoders, lead, most
        self._clear()

    def _clear(self) -> None:
        self.known = pa.array([], pa.string())
        self.tables = [_Table() for _ in self.encoders]

    def _coded(self, parts: pa.Array) -> np.ndarray:
        """Numbers of different parts; the unknown ones are encoded, for which others may be forgotten."""
        codes = pc.index_in(parts, value_set=self.known)
        new = parts.filter(pc.is_null(codes)) if codes.null_count else parts.slice(0, 0)
        if len(self.known) + len(new) > self.most and len(self.known):
            self._clear()
            return self._coded(parts)
        numbers = codes.fill_null(-1).to_numpy()
        if len(new):
            numbers = numbers.copy()
            numbers[numbers < 0] = np.arange(len(self.known), len(self.known) + len(new))
            self.known = pa.concat_arrays([self.known, new])
            # without lead only the first part of a text can start with a blank, set below to tell it apart
            spaced = pc.binary_join_element_wise("", new, " ") if self.lead else pc.replace_substring_regex(
                pc.binary_join_element_wise("", new, " "), "^  ", "")
            for table, encode in zip(self.tables, self.encoders):
                table.add(*encode(spaced))
        return numbers

    def _gather(self, codes: np.ndarray, parts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per encoder (ids, number of ids of each text) of texts with so many parts."""
        out = []
        bounds = np.concatenate([[0], np.cumsum(parts)])
        for table in self.tables:
            ids, sizes = table.of(codes)
            running = np.concatenate([[0], np.cumsum(sizes)])
            out.append((ids, running[bounds[1:]] - running[bounds[:-1]]))
        return out

    def _split(self, flat: pa.Array, parts: np.ndarray, opens: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of texts given by their parts, one after the other, and the number of parts of each; ``opens`` if not all begin a text."""
        if not self.lead:
            firsts = np.cumsum(parts) - parts
            firsts = firsts if opens is None else firsts[opens]
            marked = pc.binary_join_element_wise("", flat.take(pa.array(firsts)), " ")
            mask = np.zeros(len(flat), bool)
            mask[firsts] = True
            flat = pc.replace_with_mask(flat, pa.array(mask), marked)
        coded = pc.dictionary_encode(flat)
        return self._gather(self._coded(coded.dictionary)[coded.indices.to_numpy()], parts)

    def _alike(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Texts that can be cut at every blank."""
        lists = pc.split_pattern(texts, " ")
        return self._split(pc.list_flatten(lists), pc.list_value_length(lists).to_numpy().astype(np.int64))

    def _unlike(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Texts with runs of blanks, or long ones: cut piece by piece."""
        cut = [(i, k == 0, piece) for i, text in enumerate(texts) for k, piece in enumerate(pieces(text))]
        ids: list[list[np.ndarray]] = [[] for _ in self.encoders]
        sizes = [np.zeros(len(texts), np.int64) for _ in self.encoders]
        at = 0
        while at < len(cut):  # about PIECE characters at a time
            stop, held = at, 0
            while stop < len(cut) and held < PIECE:
                held += len(cut[stop][2])
                stop += 1
            parts = [_CUT.split(piece) for _, _, piece in cut[at:stop]]
            owner = np.array([i for i, _, _ in cut[at:stop]])
            # the first part of a later piece of a text is like any other
            opens = np.array([first for _, first, _ in cut[at:stop]])
            flat = pa.array(list(chain.from_iterable(parts)), pa.string())
            for k, (found, each) in enumerate(self._split(flat, np.array([len(p) for p in parts]), opens)):
                ids[k].append(found)
                np.add.at(sizes[k], owner, each)
            at = stop
        return [(np.concatenate(i) if i else np.empty(0, np.int32), s) for i, s in zip(ids, sizes)]

    def __call__(self, texts: list[str] | pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per encoder (ids of the texts, one after the other; number of ids of each text)."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        block = np.cumsum(pc.binary_length(texts).to_numpy()) // BLOCK_BYTES if len(texts) else np.zeros(1, np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)]
        parts = [self._encoded(texts.slice(start, stop - start)) for start, stop in zip(cuts, cuts[1:])]
        pa.default_memory_pool().release_unused()
        return [tuple(np.concatenate(arrays) for arrays in zip(*own)) for own in zip(*parts)]

    def _encoded(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        unlike = pc.or_(pc.match_substring_regex(texts, _UNLIKE), pc.greater(pc.binary_length(texts), PIECE))
        if not pc.any(unlike).as_py():
            return self._alike(texts) if len(texts) else self._unlike([])
        other = unlike.to_numpy(zero_copy_only=False)
        slow = self._unlike(texts.filter(unlike).to_pylist())
        if other.all():
            return slow
        fast = self._alike(texts.filter(pc.invert(unlike)))
        out = []
        for (ids_a, sizes_a), (ids_b, sizes_b) in zip(fast, slow):
            sizes = np.empty(len(texts), np.int64)
            sizes[~other], sizes[other] = sizes_a, sizes_b
            mine = np.repeat(other, sizes)
            ids = np.empty(len(mine), np.int32)
            ids[~mine], ids[mine] = ids_a, ids_b
            out.append((ids, sizes))
        return out


_SHARED: dict[tuple, PartEncoder] = {}


def shared_encoder(key: tuple, make: Callable[[], PartEncoder]) -> PartEncoder:
    """One encoder for all tasks of a worker process, which keeps what it knows."""
    if key not in _SHARED:
        _SHARED.clear()
        _SHARED[key] = make()
    return _SHARED[key]
