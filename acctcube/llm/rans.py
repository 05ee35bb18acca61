"""Range asymmetric numeral system over static tables, many lanes at a time.

Token t of a block belongs to lane ``t % lanes`` at step ``t // lanes``; all lanes of a step are
coded by one set of numpy operations and share one stream of 32-bit words. Encoding goes from the
last step to the first, decoding forwards. A checkpoint holds the lanes' states and the place in
the stream before a step, so that decoding can start there.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"RTK1"
PRECISION = 20
LANES = 1024
BLOCK = 1 << 18
CHECKPOINT = 64  # steps
_LOW = np.uint64(1 << 31)
_32 = np.uint64(32)
_HEAD = struct.Struct("<4sIIIIII")


class Table:
    """Symbols and their frequencies, which sum to 2**PRECISION."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray):
        self.symbols, self.freqs = symbols.astype("<u4"), freqs.astype(np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(self.freqs)[:-1]]).astype(np.uint64)

    @classmethod
    def of(cls, tokens: np.ndarray) -> Table:
        counts = np.bincount(tokens, minlength=1)
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
        whole = 1 << PRECISION
        if len(symbols) > whole:
            raise ValueError("more symbols than the table can hold")
        freqs = np.maximum(1, counts * whole // max(1, counts.sum()))
        # what rounding left over goes to or comes from the most frequent
        order, rest = np.argsort(-freqs, kind="stable"), whole - int(freqs.sum())
        if len(symbols) and rest > 0:
            freqs[order[0]] += rest
        k = 0
        while len(symbols) and rest < 0:
            take = min(-rest, int(freqs[order[k]]) - 1)
            freqs[order[k]] -= take
            rest += take
            k += 1
        return cls(symbols, freqs)

    def to_bytes(self) -> bytes:
        body = np.stack([np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4"), self.freqs.astype("<u4")]).tobytes()
        packed = zlib.compress(body, 6)
        return struct.pack("<II", len(self.symbols), zlib.crc32(packed)) + packed

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        n, crc = struct.unpack_from("<II", data)
        if zlib.crc32(data[8:]) != crc:
            raise ValueError("frequency table is damaged")
        steps, freqs = np.frombuffer(zlib.decompress(data[8:]), "<u4").reshape(2, n)
        return cls(np.cumsum(steps, dtype=np.uint32), freqs)

    def index(self) -> np.ndarray:
        """Index of every symbol, by its value."""
        places = np.zeros(int(self.symbols.max(initial=0)) + 1, np.uint32)
        places[self.symbols] = np.arange(len(self.symbols), dtype=np.uint32)
        return places

    def lookup(self) -> np.ndarray:
        """Index of the symbol at every slot."""
        return np.repeat(np.arange(len(self.freqs), dtype=np.uint32), self.freqs.astype(np.int64))


def encode_block(tokens: np.ndarray, table: Table) -> bytes:
    index = table.index()[tokens]
    freq, start = table.freqs[index], table.starts[index]
    n = len(tokens)
    steps = -(-n // LANES)
    x = np.full(LANES, _LOW, np.uint64)
    words, states, precision, limit = [], [], np.uint64(PRECISION), np.uint64(63 - PRECISION)
    for s in range(steps - 1, -1, -1):
        f, b = freq[s * LANES : (s + 1) * LANES], start[s * LANES : (s + 1) * LANES]
        y = x[: len(f)]
        full = y >= (f << limit)
        words.append(y[full].astype("<u4"))
        y = np.where(full, y >> _32, y)
        q, r = np.divmod(y, f)
        x[: len(f)] = (q << precision) + r + b
        if s % CHECKPOINT == 0:
            states.append(x.copy())
    words.reverse()
    states.reverse()
    ends = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype("<u4")
    places = ends[:-1][::CHECKPOINT] if steps else np.empty(0, "<u4")
    body = b"".join([places.tobytes(), *(s.astype("<u8").tobytes() for s in states), *(w.tobytes() for w in words)])
    return _HEAD.pack(MAGIC, n, LANES, CHECKPOINT, len(states), int(ends[-1]), zlib.crc32(body)) + body


def decode_block(data: bytes, table: Table, lookup: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """Tokens ``first`` to ``last`` of a block, read from the checkpoint before them."""
    magic, n, lanes, every, points, total, crc = _HEAD.unpack_from(data)
    body = memoryview(data)[_HEAD.size :]
    if magic != MAGIC or zlib.crc32(body) != crc:
        raise ValueError("block is damaged")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.empty(0, "<u4")
    places = np.frombuffer(body, "<u4", points)
    words = np.frombuffer(body, "<u4", total, 4 * points + 8 * lanes * points).astype(np.uint64)
    point = first // lanes // every
    x = np.frombuffer(body, "<u8", lanes, 4 * points + 8 * lanes * point).copy()
    at, begin = int(places[point]), point * every
    mask, precision = np.uint64((1 << PRECISION) - 1), np.uint64(PRECISION)
    out = np.empty(min(n, -(-last // lanes) * lanes) - begin * lanes, np.uint32)
    for s in range(begin, -(-last // lanes)):
        k = min(lanes, n - s * lanes)
        y = x[:k]
        slot = y & mask
        symbol = lookup[slot]
        y = table.freqs[symbol] * (y >> precision) + slot - table.starts[symbol]
        low = np.flatnonzero(y < _LOW)
        y[low] = (y[low] << _32) | words[at : at + len(low)]
        at += len(low)
        x[:k] = y
        out[(s - begin) * lanes : (s - begin) * lanes + k] = symbol
    return table.symbols[out[first - begin * lanes : last - begin * lanes]]


def encode_group(tokens: np.ndarray) -> tuple[bytes, list[bytes]]:
    """One table and the independent blocks that share it."""
    table = Table.of(tokens)
    return table.to_bytes(), [encode_block(tokens[i : i + BLOCK], table) for i in range(0, len(tokens), BLOCK)]


def decode_group(table: bytes, blocks: list[bytes]) -> np.ndarray:
    t = Table.from_bytes(table)
    lookup = t.lookup()
    return np.concatenate([np.empty(0, "<u4"), *(decode_block(b, t, lookup) for b in blocks)])
