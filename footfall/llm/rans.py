"""Static range asymmetric numeral coding of 16-bit token ids: one frame per block, many interleaved lanes.

A segment's frequency table is shared by the frames that name it. A frame decodes by itself: symbols go to
lanes in turn, every lane has a 64-bit state, and a lane whose state runs low reads the next 32-bit word.
Checkpoints hold all states and the word position every `EVERY` rounds, so that parts of a frame decode
apart from each other. All numbers are little-endian.

Table:  b"RATB", crc32 of the rest, number of symbols; then symbols (u2) and frequencies (u4), which sum to
2**PROB_BITS.
Frame:  b"RABL", crc32 of the rest, number of ids, lanes, rounds between checkpoints, number of words;
then for each checkpoint its word position (u4) and the states (u8 per lane); then the words (u4).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

PROB_BITS = 20
LANES = 2048
EVERY = 64
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
_HEAD, _HEAD_SIZE = "<4sI", 8
_FRAME, _FRAME_SIZE = "<IIII", 16


class Damaged(ValueError):
    """Bytes that are not what was written."""


def _sealed(magic: bytes, body: bytes) -> bytes:
    return struct.pack(_HEAD, magic, zlib.crc32(body)) + body


def _opened(magic: bytes, data: bytes) -> memoryview:
    if len(data) < _HEAD_SIZE or struct.unpack_from(_HEAD, data)[0] != magic:
        raise Damaged(f"no {magic.decode()} header")
    body = memoryview(data)[_HEAD_SIZE :]
    if zlib.crc32(body) != struct.unpack_from(_HEAD, data)[1]:
        raise Damaged("checksum differs")
    return body


class Table:
    """Frequencies of the symbols that occur, scaled to a power of two; each keeps at least one slot."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray):
        self.symbols, self.freqs = symbols.astype("<u2"), freqs.astype("<u4")
        starts = np.cumsum(self.freqs, dtype=np.uint64) - self.freqs
        size = int(self.symbols.max()) + 1 if len(self.symbols) else 0
        self.freq, self.start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[self.symbols], self.start[self.symbols] = self.freqs, starts

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        counts = np.bincount(ids)
        symbols = np.nonzero(counts)[0]
        if not len(symbols):
            return cls(symbols, symbols)
        total = 1 << PROB_BITS
        freqs = np.maximum(1, counts[symbols] * total // len(ids))
        excess = int(freqs.sum()) - total
        while excess:  # the most frequent give or take what rounding left over
            order = np.argsort(-freqs, kind="stable")
            if excess < 0:
                freqs[order[0]] -= excess
                break
            give = np.minimum(excess, freqs[order] // 4)
            give = np.diff(np.minimum(np.cumsum(give), excess), prepend=0)
            freqs[order] -= give
            excess -= int(give.sum())
        return cls(symbols, freqs)

    def to_bytes(self) -> bytes:
        return _sealed(b"RATB", struct.pack("<I", len(self.symbols)) + self.symbols.tobytes() + self.freqs.tobytes())

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        body = _opened(b"RATB", data)
        (n,) = struct.unpack_from("<I", body)
        return cls(np.frombuffer(body, "<u2", n, 4), np.frombuffer(body, "<u4", n, 4 + 2 * n))

    def slots(self) -> np.ndarray:
        """Symbol of each slot."""
        return np.repeat(self.symbols, self.freqs)


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = EVERY) -> bytes:
    rounds = -(-len(ids) // lanes)
    states = np.full(lanes, LOW, np.uint64)
    words, marks, shift = [], [], np.uint64(63 - PROB_BITS)
    for i in reversed(range(rounds)):
        some = ids[i * lanes : (i + 1) * lanes]
        x, f = states[: len(some)], table.freq[some]
        high = (x >> shift) >= f
        words.append(x[high].astype("<u4"))
        x = np.where(high, x >> WORD, x)
        q = x // f
        states[: len(some)] = (q << np.uint64(PROB_BITS)) + (x - q * f) + table.start[some]
        if i % every == 0:
            marks.append((len(words), states.copy()))
    before = np.cumsum([0, *map(len, words)])
    total = int(before[-1])
    points = b"".join(
        struct.pack("<I", total - int(before[k])) + s.astype("<u8").tobytes() for k, s in reversed(marks)
    )
    head = struct.pack(_FRAME, len(ids), lanes, every, total)
    # Words are read in the opposite order of rounds, in lane order within a round.
    return _sealed(b"RABL", head + points + b"".join(w.tobytes() for w in reversed(words)))


def parts(frame: bytes) -> int:
    """Number of checkpoints, each the start of a part."""
    n, lanes, every, _ = struct.unpack_from(_FRAME, _opened(b"RABL", frame))
    return -(-n // (lanes * every))


def decode(frame: bytes, table: Table, slots: np.ndarray | None = None, part: int | None = None) -> np.ndarray:
    """The ids of a frame, or of one part of it."""
    body = _opened(b"RABL", frame)
    n, lanes, every, total = struct.unpack_from(_FRAME, body)
    slots = table.slots() if slots is None else slots
    count, size = -(-n // (lanes * every)), 4 + 8 * lanes
    words = np.frombuffer(body, "<u4", total, _FRAME_SIZE + count * size)
    chosen = range(count) if part is None else [part]
    first = chosen[0] * every * lanes if chosen else 0
    stop = min(n, (chosen[-1] + 1) * every * lanes) if chosen else 0
    if not chosen:
        return np.zeros(0, np.uint16)
    at = _FRAME_SIZE + chosen[0] * size
    (position,) = struct.unpack_from("<I", body, at)
    states = np.frombuffer(body, "<u8", lanes, at + 4).astype(np.uint64)
    out, mask = np.empty(stop - first, np.uint16), np.uint64((1 << PROB_BITS) - 1)
    for i in range(0, stop - first, lanes):
        x = states[: min(lanes, stop - first - i)]
        slot = x & mask
        found = slots[slot]
        out[i : i + len(x)] = found
        x = table.freq[found] * (x >> np.uint64(PROB_BITS)) + slot - table.start[found]
        low = x < LOW
        k = int(np.count_nonzero(low))
        if k:
            x[low] = (x[low] << WORD) | words[position : position + k]
            position += k
        states[: len(x)] = x
    return out
