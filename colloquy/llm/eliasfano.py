"""Elias-Fano sequences in numpy: many accesses or successor searches at a time, over mapped memory.

A sorted sequence keeps the low bits of its values packed, and the high ones in unary: value k sets bit
(high + k). The k-th one is found from a sample of every 16th, then by population counts. Zeros can be far
apart where values crowd, so the k-th zero is searched in the counts of zeros before each word.
"""

from __future__ import annotations

import json
import mmap
from collections import OrderedDict
from collections.abc import Callable
from typing import Any

import numpy as np

U64 = np.uint64
ONES, SAMPLE = U64(0xFFFFFFFFFFFFFFFF), 16


def _pack(lows: np.ndarray, bits: int) -> np.ndarray:
    out = []
    for lo in range(0, len(lows), 1 << 14):
        block = lows[lo : lo + (1 << 14)]
        rows = np.zeros((-(-len(block) // 64) * 64, bits), np.uint8)
        for k in range(bits):
            rows[: len(block), k] = (block >> U64(k)) & U64(1)
        out.append(np.packbits(rows.ravel(), bitorder="little").view(U64))
    return np.concatenate([*out, np.zeros(1, U64)])


_BYTE_ONES = U64(0x0101010101010101)
_BYTE_TOPS = U64(0x8080808080808080)
#: The position of the r-th one of each byte, at 8 * byte + r.
_IN_BYTE = np.array([([k for k in range(8) if byte >> k & 1] + [0] * 8)[r] for byte in range(256) for r in range(8)], np.int64)


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The position of the rank-th one (from 0) of each 64-bit word, by the running counts of its bytes."""
    with np.errstate(over="ignore"):
        x = word - ((word >> U64(1)) & U64(0x5555555555555555))
        x = (x & U64(0x3333333333333333)) + ((x >> U64(2)) & U64(0x3333333333333333))
        sums = ((x + (x >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)) * _BYTE_ONES
        rank = rank.astype(U64)
        shift = np.bitwise_count((((rank * _BYTE_ONES) | _BYTE_TOPS) - sums) & _BYTE_TOPS).astype(U64) << U64(3)
        before = ((sums << U64(8)) >> shift) & U64(0xFF)
    return shift.astype(np.int64) + _IN_BYTE[((((word >> shift) & U64(0xFF)) << U64(3)) + rank - before).astype(np.int64)]


def _select(bits: np.ndarray, sample: np.ndarray, k: np.ndarray) -> np.ndarray:
    start = sample[k // SAMPLE].astype(np.int64)
    left, at = k % SAMPLE, start >> 6
    word = bits[at] & (ONES << (start & 63).astype(U64))
    n = np.bitwise_count(word).astype(np.int64)
    go = np.flatnonzero(left >= n)
    while len(go):
        left[go] -= n[go]
        at[go] += 1
        word[go] = bits[at[go]]
        n[go] = np.bitwise_count(word[go])
        go = go[left[go] >= n[go]]
    return (at << 6) + _select_in_word(word, left)


class EliasFano:
    """A non-decreasing sequence of unsigned values."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray, buckets: int):
        self.n, self.low_bits, self.low, self.high, self.ones, self.zeros, self.buckets = n, low_bits, low, high, ones, zeros, buckets

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, U64)
        n = len(values)
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        buckets = (universe >> bits) + 1
        size = n + buckets + 1
        unary = np.zeros(-(-size // 64) * 64, np.uint8)
        where = (values >> U64(bits)).astype(np.int64) + np.arange(n)
        unary[where] = 1
        low = _pack(values & U64((1 << bits) - 1), bits) if bits else np.zeros(1, U64)
        high = np.append(np.packbits(unary, bitorder="little").view(U64), np.zeros(2, U64))
        kind = np.uint32 if size < 1 << 32 else np.int64
        zeros = np.cumsum(64 - np.bitwise_count(high).astype(np.int64)) - 64 + np.bitwise_count(high)
        return cls(n, bits, low, high, where[::SAMPLE].astype(kind), zeros.astype(kind), buckets)

    def parts(self) -> dict:
        return {"meta": np.array([self.n, self.low_bits, self.buckets], np.int64), "low": self.low, "high": self.high, "ones": self.ones, "zeros": self.zeros}

    @classmethod
    def of(cls, arrays: dict, name: str) -> EliasFano:
        n, bits, buckets = (int(x) for x in arrays[f"{name}.meta"])
        return cls(n, bits, *(arrays[f"{name}.{p}"] for p in ("low", "high", "ones", "zeros")), buckets)

    def _low(self, k: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(k), U64)
        bit = k * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(U64)
        upper = (self.low[word + 1] << U64(1)) << (U64(63) - shift)
        return ((self.low[word] >> shift) | upper) & U64((1 << self.low_bits) - 1)

    def access(self, k: np.ndarray) -> np.ndarray:
        """Values at the positions k."""
        if not len(k):
            return np.zeros(0, U64)
        high = _select(self.high, self.ones, k) - k
        return (high.astype(U64) << U64(self.low_bits)) | self._low(k)

    def _begin(self, bucket: np.ndarray) -> np.ndarray:
        """How many values have a high part below `bucket`."""
        out = np.zeros(len(bucket), np.int64)
        some = np.flatnonzero(bucket > 0)
        if len(some):
            b = bucket[some] - 1
            word = np.searchsorted(self.zeros, b.astype(self.zeros.dtype), side="right") - 1
            out[some] = (word << 6) + _select_in_word(~self.high[word], b - self.zeros[word]) - b
        return out

    def _run(self, bit: np.ndarray) -> np.ndarray:
        """How many ones stand in a row from a bit on, 64 at most."""
        word, shift = bit >> 6, (bit & 63).astype(U64)
        here = (self.high[word] >> shift) | ((self.high[word + 1] << U64(1)) << (U64(63) - shift))
        return np.bitwise_count(here & ~(here + U64(1))).astype(np.int64)

    def find(self, values: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> np.ndarray:
        """Successor search: the position in [lo, hi) that holds each value, or -1."""
        bucket = (values >> U64(self.low_bits)).astype(np.int64)
        out = np.full(len(values), -1, np.int64)
        ask = np.flatnonzero((bucket >= 0) & (bucket < self.buckets)) if self.n else np.zeros(0, np.int64)
        bucket, want = bucket[ask], values[ask] & U64((1 << self.low_bits) - 1)
        low = self._begin(bucket)
        high = low + self._run(low + bucket)
        if len(far := np.flatnonzero(high - low >= 64)):
            high[far] = self._begin(bucket[far] + 1)
        if lo is not None:
            low, high = np.maximum(low, lo[ask]), np.minimum(high, hi[ask])
        open_ = np.flatnonzero(low < high)
        ask, want, low, high = ask[open_], want[open_], low[open_], high[open_]
        go = np.flatnonzero(high - low > 1)
        while len(go):  # the last position whose low bits don't exceed those wanted, or the first of the range
            mid = (low[go] + high[go]) >> 1
            reached = self._low(mid) <= want[go]
            low[go] = np.where(reached, mid, low[go])
            high[go] = np.where(reached, high[go], mid)
            go = go[high[go] - low[go] > 1]
        got = np.flatnonzero(self._low(low) == want)
        out[ask[got]] = low[got]
        return out


# --- files of named arrays -------------------------------------------------------------------------


def flat(arrays: dict) -> dict[str, np.ndarray]:
    out = {}
    for name, value in arrays.items():
        out |= {f"{name}.{p}": a for p, a in value.parts().items()} if isinstance(value, EliasFano) else {name: value}
    return out


def to_bytes(arrays: dict) -> bytes:
    named, at, blobs = {}, 0, []
    for name, a in flat(arrays).items():
        data = np.ascontiguousarray(a).tobytes()
        named[name] = (a.dtype.str, at, len(a))
        blobs.append(data + b"\0" * (-len(data) % 8))
        at += len(blobs[-1])
    head = json.dumps(named).encode()
    head += b" " * (-(len(head) + 8) % 8)
    return len(head).to_bytes(8, "little") + head + b"".join(blobs)


def from_buffer(buffer) -> dict[str, np.ndarray]:
    size = int.from_bytes(buffer[:8], "little")
    return {name: np.frombuffer(buffer, kind, n, 8 + size + at) for name, (kind, at, n) in json.loads(bytes(buffer[8 : 8 + size])).items()}


def save(uri: str, data: bytes) -> None:
    """Writes a file whole or not at all; a second attempt of a task writes the same again."""
    import uuid

    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, path)


def load(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file: mapped where the store is the shared folder itself, read from any other."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    if store.type_name == "local":
        with open(path, "rb") as file:
            return from_buffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
    with store.open_input_stream(path) as source:
        return from_buffer(source.readall())


class Cache:
    """Files that were opened last, `most` at most and, of those that aren't mapped, `most_bytes`; the others are let go."""

    def __init__(self, most: int = 4096, most_bytes: int = 256 << 20):
        self.most, self.most_bytes, self.held, self.bytes = most, most_bytes, OrderedDict(), 0

    def __call__(self, uri: str, made: Callable[[dict[str, np.ndarray]], Any]) -> Any:
        """made(arrays of the file)."""
        if uri in self.held:
            self.held.move_to_end(uri)
            return self.held[uri][0]
        arrays = load(uri)
        size = 0 if uri.startswith("file:") else sum(a.nbytes for a in arrays.values())
        while self.held and (len(self.held) >= self.most or self.bytes + size > self.most_bytes):
            self.bytes -= self.held.popitem(last=False)[1][1]
        self.held[uri], self.bytes = (made(arrays), size), self.bytes + size
        return self.held[uri][0]
