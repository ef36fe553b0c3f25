"""Elias-Fano: a non-decreasing list of numbers in about 2 + log2(largest / count) bits each."""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

#: Every so many ones of the high part a sample of their position is kept for ``select``.
SAMPLE_EVERY = 256
_HEAD = struct.Struct("<QQB")


@dataclass(frozen=True)
class EliasFano:
    """``count`` numbers: the low bits of each packed, the high parts as a unary bit list."""

    count: int
    low_width: int
    low: np.ndarray  # packed bits
    high: np.ndarray  # packed bits: number i sets bit (number >> low_width) + i
    samples: np.ndarray  # position of every SAMPLE_EVERY-th one of the high part

    @classmethod
    def of(cls, numbers: np.ndarray) -> EliasFano:
        numbers = np.asarray(numbers, np.int64)
        n = len(numbers)
        if n and (numbers[0] < 0 or (np.diff(numbers) < 0).any()):
            raise ValueError("numbers must not be negative or fall")
        width = max(0, int(numbers[-1] // n).bit_length() - 1) if n else 0
        low = np.packbits((numbers[:, None] >> np.arange(width) & 1).astype(np.uint8), bitorder="little") if width else np.zeros(0, np.uint8)
        ones = (numbers >> width) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, width, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE_EVERY].astype(np.uint32 if n and ones[-1] < 1 << 32 else np.uint64))

    def _low(self, start: int, stop: int) -> np.ndarray:
        if not self.low_width or stop <= start:
            return np.zeros(max(0, stop - start), np.int64)
        first = start * self.low_width
        bits = np.unpackbits(self.low[first // 8 : (stop * self.low_width + 7) // 8], bitorder="little")
        bits = bits[first % 8 : first % 8 + (stop - start) * self.low_width].reshape(-1, self.low_width)
        return bits.astype(np.int64) @ (1 << np.arange(self.low_width, dtype=np.int64))

    def select(self, index: int) -> int:
        """Number ``index``: from the sample before it, over the high bits up to its one."""
        if not 0 <= index < self.count:
            raise IndexError(index)
        at, left = int(self.samples[index // SAMPLE_EVERY]), index % SAMPLE_EVERY
        byte = at // 8
        left += int(np.bitwise_count(self.high[byte] & ((1 << at % 8) - 1)))
        while True:
            ones = int(np.bitwise_count(self.high[byte]))
            if left < ones:
                break
            left, byte = left - ones, byte + 1
        place = byte * 8 + int(np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little"))[left])
        return (place - index << self.low_width) + int(self._low(index, index + 1)[0])

    def numbers(self) -> np.ndarray:
        """All numbers."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        return (ones - np.arange(self.count) << self.low_width) + self._low(0, self.count)

    def to_bytes(self) -> bytes:
        samples = self.samples.astype("<u8" if self.samples.dtype == np.uint64 else "<u4")
        sizes = struct.pack("<QQQ", len(self.low), len(self.high), samples.itemsize)
        return _HEAD.pack(self.count, len(samples), self.low_width) + sizes + self.low.tobytes() + self.high.tobytes() + samples.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        count, n_samples, width = _HEAD.unpack_from(raw)
        low, high, item = struct.unpack_from("<QQQ", raw, _HEAD.size)
        at = _HEAD.size + 24
        u8 = np.frombuffer(raw, np.uint8)
        samples = np.frombuffer(raw, "<u8" if item == 8 else "<u4", n_samples, at + low + high)
        return cls(count, width, u8[at : at + low], u8[at + low : at + low + high], samples)
