"""Wavelet matrix of a token sequence in one compressed file: access, rank, select, occurrences.

Tokens are numbered by falling frequency in the sequence; the file holds one bit plane per bit of
these numbers, the highest first, so the first planes are nearly empty. A plane is cut into blocks of BLOCK bits, each a zstandard frame, with the number of set bits before each block beside it, so a
question reads the few blocks it touches. Layout: magic, frames, directory (a zstandard frame of
JSON and arrays), its length, magic.
"""

from __future__ import annotations

import json
import struct
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import zstandard

MAGIC = b"WMTOKEN1"
BLOCK = 1 << 16
LEVEL = 3
CACHED_BLOCKS = 64
_TAIL = struct.Struct("<Q8s")


def ranked(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens by falling frequency, then ascending; the number of each place's token in that list)."""
    counts = np.bincount(tokens) if len(tokens) else np.empty(0, np.int64)
    alphabet = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    number = np.zeros(len(counts), np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
    number[alphabet] = np.arange(len(alphabet))
    return alphabet.astype(np.uint32), number[tokens] if len(tokens) else number


def plane_bits(numbers: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bit planes of ``numbers``: after each plane the sequence is split stably, clear bits first."""
    kind = numbers.dtype.type
    for b in reversed(range(bits)):
        ones = numbers & kind(1 << b) != 0
        yield ones
        if b:
            numbers = np.concatenate([np.compress(~ones, numbers), np.compress(ones, numbers)])


def _frames(ones: np.ndarray, squeeze) -> tuple[list[bytes], np.ndarray, int]:
    """(compressed blocks, set bits before each block, number of clear bits)."""
    counts = [int(np.count_nonzero(ones[s : s + BLOCK])) for s in range(0, len(ones), BLOCK)]
    before = np.cumsum([0, *counts], dtype=np.int64)
    packed = np.packbits(ones)
    step = BLOCK // 8
    return [squeeze(packed[s : s + step].tobytes()) for s in range(0, len(packed), step)], before, len(ones) - int(before[-1])


def wavelet_bytes(tokens: np.ndarray, arrays: dict[str, np.ndarray]) -> Iterator[bytes]:
    """The file of a token sequence, part by part; ``arrays`` travel in its directory."""
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    alphabet, numbers = ranked(tokens)
    bits = max(0, len(alphabet) - 1).bit_length()
    yield MAGIC
    at, offsets, ranks, zeros = len(MAGIC), [], [], []
    for ones in plane_bits(numbers, bits):
        frames, before, clear = _frames(ones, squeeze)
        ends = at + np.cumsum([0, *map(len, frames)], dtype=np.int64)
        offsets.append(ends)
        ranks.append(before)
        zeros.append(clear)
        at = int(ends[-1])
        yield from frames
    stored = {f"_offsets{k}": o for k, o in enumerate(offsets)} | {f"_ranks{k}": r for k, r in enumerate(ranks)}
    stored |= {"_alphabet": alphabet} | arrays
    head = json.dumps({"tokens": len(tokens), "bits": bits, "zeros": zeros, "arrays": [[k, str(v.dtype), len(v)] for k, v in stored.items()]}).encode()
    directory = squeeze(struct.pack("<Q", len(head)) + head + b"".join(np.ascontiguousarray(v).tobytes() for v in stored.values()))
    yield directory
    yield _TAIL.pack(len(directory), MAGIC)


class WaveletFile:
    """A stored sequence, read through ``read(offset, size)`` as far as a question needs it."""

    def __init__(self, read, size: int):
        self._read = read
        if size < len(MAGIC) + _TAIL.size:
            raise ValueError("not a token file")
        length, magic = _TAIL.unpack(read(size - _TAIL.size, _TAIL.size))
        if magic != MAGIC or length > size:
            raise ValueError("not a token file")
        self._open = zstandard.ZstdDecompressor().decompress
        body = self._open(read(size - _TAIL.size - length, length))
        (head_size,) = struct.unpack_from("<Q", body)
        head = json.loads(body[8 : 8 + head_size])
        self.size, self.bits, self.zeros = head["tokens"], head["bits"], head["zeros"]
        self.arrays, at = {}, 8 + head_size
        for name, kind, n in head["arrays"]:
            self.arrays[name] = np.frombuffer(body, np.dtype(kind), n, at)
            at += n * np.dtype(kind).itemsize
        self.alphabet = self.arrays["_alphabet"]
        self._sorted = np.argsort(self.alphabet)
        self._blocks: OrderedDict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = OrderedDict()

    def _bits(self, plane: int, first: int, last: int) -> np.ndarray:
        """Bits of the blocks ``first`` to ``last``, exclusive."""
        offsets = self.arrays[f"_offsets{plane}"]
        data = self._read(int(offsets[first]), int(offsets[last] - offsets[first]))
        base = int(offsets[first])
        raw = b"".join(self._open(data[int(a) - base : int(b) - base]) for a, b in zip(offsets[first:last], offsets[first + 1 : last + 1]))
        end = min(last * BLOCK, self.size)
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=end - first * BLOCK).view(bool)

    def _block(self, plane: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """(bits, set bits up to and with each) of a block; the last few asked for are kept."""
        key = (plane, block)
        if key not in self._blocks:
            ones = self._bits(plane, block, block + 1)
            self._blocks[key] = ones, np.cumsum(ones, dtype=np.int32)
            if len(self._blocks) > CACHED_BLOCKS:
                self._blocks.popitem(last=False)
        self._blocks.move_to_end(key)
        return self._blocks[key]

    def _rank1(self, plane: int, at: np.ndarray) -> np.ndarray:
        """Set bits of a plane before each place."""
        out = np.empty(len(at), np.int64)
        blocks = at // BLOCK
        ranks = self.arrays[f"_ranks{plane}"]
        for block in np.unique(blocks):
            mine = blocks == block
            inside = at[mine] - block * BLOCK
            if not inside.any():
                out[mine] = ranks[block]
                continue
            sums = self._block(plane, int(block))[1]
            out[mine] = ranks[block] + np.where(inside > 0, sums[np.maximum(inside, 1) - 1], 0)
        return out

    def _select(self, plane: int, one: bool, which: np.ndarray) -> np.ndarray:
        """Place of the set (or clear) bit with each number, from 0."""
        ranks = self.arrays[f"_ranks{plane}"]
        if not one:
            ranks = np.minimum(np.arange(len(ranks), dtype=np.int64) * BLOCK, self.size) - ranks
        blocks = np.searchsorted(ranks, which, side="right") - 1
        out = np.empty(len(which), np.int64)
        for block in np.unique(blocks):
            mine = blocks == block
            ones, sums = self._block(plane, int(block))
            sums = sums if one else np.arange(1, len(ones) + 1) - sums
            out[mine] = block * BLOCK + np.searchsorted(sums, which[mine] - ranks[block] + 1)
        return out

    def access(self, at) -> np.ndarray:
        """The tokens at the given places."""
        at = np.array(at, dtype=np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.size):
            raise IndexError("no such place")
        out = np.zeros(len(at), np.uint32)
        for plane in range(self.bits):
            before, after = self._rank1(plane, at), self._rank1(plane, at + 1)
            one = after > before
            out = (out << np.uint32(1)) | one.astype(np.uint32)
            at = np.where(one, self.zeros[plane] + before, at - before)
        return self.alphabet[out]

    def _number(self, token: int) -> int | None:
        at = int(np.searchsorted(self.alphabet, token, sorter=self._sorted)) if len(self.alphabet) else 0
        found = int(self._sorted[at]) if at < len(self.alphabet) else None
        return found if found is not None and self.alphabet[found] == token else None

    def _lowered(self, token: int, at: np.ndarray) -> np.ndarray:
        """Where each boundary of the sequence lies below the last plane, on the path of a token's number."""
        for plane in range(self.bits):
            before = self._rank1(plane, at)
            at = self.zeros[plane] + before if token >> (self.bits - 1 - plane) & 1 else at - before
        return at

    def rank(self, token: int, at) -> np.ndarray:
        """How often ``token`` stands before each place (0 to the size of the sequence)."""
        at = np.array(at, dtype=np.int64)
        number = self._number(token)
        if number is None or not len(at):
            return np.zeros(len(at), np.int64)
        low = self._lowered(number, np.concatenate([[0], at]))
        return low[1:] - low[0]

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        low, high = self.rank(token, [start, self.size if stop is None else stop])
        return int(high - low)

    def select(self, token: int, which) -> np.ndarray:
        """Place of the occurrence of ``token`` with each number, from 0."""
        which = np.array(which, dtype=np.int64)
        if len(which) and (which.min() < 0 or which.max() >= self.count(token)):
            raise IndexError("no such occurrence")
        if not len(which):
            return which
        number = self._number(token)
        at = self._lowered(number, np.zeros(1, np.int64))[0] + which
        for plane in reversed(range(self.bits)):
            one = bool(number >> (self.bits - 1 - plane) & 1)
            at = self._select(plane, one, at - self.zeros[plane] if one else at)
        return at

    def occurrences(self, token: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """All places of ``token`` from ``start`` to ``stop``, exclusive."""
        low, high = self.rank(token, [start, self.size if stop is None else stop])
        return self.select(token, np.arange(low, high))

    def tokens(self) -> np.ndarray:
        """The whole sequence, rebuilt from the last plane upwards."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        numbers = np.zeros(self.size, kind)
        blocks = -(-self.size // BLOCK)
        for plane in reversed(range(self.bits)):
            ones = self._bits(plane, 0, blocks)
            raised = np.empty(self.size, kind)
            raised[np.flatnonzero(~ones)] = numbers[: self.zeros[plane]]
            raised[np.flatnonzero(ones)] = numbers[self.zeros[plane] :] | kind(1 << (self.bits - 1 - plane))
            numbers = raised
        return self.alphabet[numbers] if self.size else self.alphabet
