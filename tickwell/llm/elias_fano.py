"""Elias-Fano lists in flat arrays that can be memory-mapped."""

from __future__ import annotations

import os
from urllib.parse import urlparse

import numpy as np

WORD = 64
#: Words of upper bits for each entry of the rank directory.
STRIDE = 8


def local(path: str) -> str:
    """The mounted path of a folder that was named as a path or a file URI."""
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped levels need a mounted shared folder, not {path}")
    return parsed.path


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of `width` bits each, end to end; one spare word lets readers look past the end."""
    words = np.zeros(len(values) * width // WORD + 2, np.uint64)
    if not width or not len(values):
        return words
    at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    np.bitwise_or.at(words, word, values << shift)
    spill = np.flatnonzero(shift.astype(np.int64) + width > WORD)
    np.bitwise_or.at(words, word[spill] + 1, values[spill] >> (np.uint64(WORD) - shift[spill]))
    return words


def unpack(words: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at.astype(np.uint64) * np.uint64(width)
    word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
    low = words[word] >> shift
    # A shift by 64 is undefined, so the upper part moves in two steps.
    high = (words[word + 1] << (np.uint64(63) - shift)) << np.uint64(1)
    mask = np.uint64((1 << width) - 1)
    return (low | high) & mask


def part_of(counts: np.ndarray, number: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In which of eight neighbours the numbered bit lies, and its number there."""
    upto = np.cumsum(counts, axis=1, dtype=np.int16)
    part = (upto <= number[:, None]).sum(axis=1)
    return part, number - np.where(part > 0, upto[rows, part - 1], 0)


def bit_places() -> np.ndarray:
    """Place of the n-th set bit of each byte."""
    table = np.zeros((256, 8), np.int64)
    for byte in range(256):
        bits = [k for k in range(8) if byte >> k & 1]
        table[byte, : len(bits)] = bits
    return table


PLACE = bit_places()


class EliasFano:
    """A sorted list of distinct numbers: low bits packed, high bits in unary."""

    def __init__(self, size: int, width: int, lower: np.ndarray, upper: np.ndarray, zeros: np.ndarray) -> None:
        self.size, self.width, self.lower, self.upper, self.zeros = size, width, lower, upper, zeros

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        """`values`: sorted, below `universe`."""
        size = len(values)
        width = max(0, (universe // max(size, 1)).bit_length() - 1)
        high = (values >> np.uint64(width)).astype(np.int64)
        buckets = ((universe - 1) >> width) + 1 if universe else 1
        bits = size + buckets + 1
        blocks = -(-bits // (WORD * STRIDE)) + 1
        flags = np.zeros(blocks * WORD * STRIDE, np.uint8)
        flags[high + np.arange(size)] = 1
        upper = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(upper).reshape(-1, STRIDE).sum(axis=1, dtype=np.int64)
        zeros = np.concatenate(([0], np.cumsum(WORD * STRIDE - ones)))
        low = values & np.uint64((1 << width) - 1)
        return cls(size, width, pack(low, width), upper, zeros)

    def zero(self, number: np.ndarray) -> np.ndarray:
        """Bit position of the zero with this number."""
        block = np.searchsorted(self.zeros, number, side="right") - 1
        rest = number - self.zeros[block]
        words = ~self.upper.reshape(-1, STRIDE)[block]
        rows = np.arange(len(block))
        word, rest = part_of(np.bitwise_count(words), rest, rows)
        octets = words[rows, word].view(np.uint8).reshape(-1, 8)
        octet, rest = part_of(np.bitwise_count(octets), rest, rows)
        inside = PLACE[octets[rows, octet], rest]
        return block * (WORD * STRIDE) + word * WORD + octet * 8 + inside

    def ones(self, first: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """How many set bits follow from `first` on, where the given buckets begin."""
        word, shift = first >> 6, (first & 63).astype(np.uint64)
        after = self.upper[np.minimum(word + 1, len(self.upper) - 1)]
        # A shift by 64 is undefined, so the next word moves in two steps.
        bits = (self.upper[word] >> shift) | ((after << (np.uint64(63) - shift)) << np.uint64(1))
        run = np.bitwise_count((bits ^ (bits + np.uint64(1))) >> np.uint64(1)).astype(np.int64)
        long = np.flatnonzero(run == 63)
        run[long] = self.zero(bucket[long]) - first[long]
        return run

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value in the list, -1 where it is not in it: the successor, if equal."""
        if not self.size or not len(values):
            return np.full(len(values), -1)
        out = np.empty(len(values), np.int64)
        for at in range(0, len(values), 1 << 16):
            out[at : at + (1 << 16)] = self.find_some(values[at : at + (1 << 16)])
        return out

    def find_some(self, values: np.ndarray) -> np.ndarray:
        high = (values >> np.uint64(self.width)).astype(np.int64)
        low = values & np.uint64((1 << self.width) - 1)
        # Neighbours often share a bucket: its borders are looked up once.
        new = np.concatenate(([True], high[1:] != high[:-1]))
        bucket, owner = high[new], np.cumsum(new) - 1
        first = np.where(bucket > 0, self.zero(np.maximum(bucket - 1, 0)) + 1, 0)
        start = first - bucket
        begin, end = start[owner], (start + self.ones(first, bucket))[owner]
        # Binary search among the low bits of one bucket, all values abreast.
        left, right = begin.copy(), end.copy()
        active = np.flatnonzero(left < right)
        while len(active):
            middle = (left[active] + right[active]) >> 1
            below = unpack(self.lower, self.width, middle) < low[active]
            left[active] = np.where(below, middle + 1, left[active])
            right[active] = np.where(below, right[active], middle)
            active = active[left[active] < right[active]]
        place = np.minimum(left, self.size - 1)
        found = (left < end) & (unpack(self.lower, self.width, place) == low)
        return np.where(found, left, -1)

    def save(self, prefix: str) -> None:
        for name in ("lower", "upper", "zeros"):
            store(f"{prefix}-{name}.npy", getattr(self, name))

    @classmethod
    def load(cls, prefix: str, size: int, width: int) -> EliasFano:
        return cls(size, width, *(mapped(f"{prefix}-{n}.npy") for n in ("lower", "upper", "zeros")))


def mapped(path: str) -> np.ndarray:
    """A stored array, mapped; as a plain array, which is cheaper to index than the mapping's own class."""
    return np.load(path, mmap_mode="r").view(np.ndarray)


def store(path: str, values: np.ndarray) -> None:
    """Under its name only once it is complete, so a task that runs twice does no harm."""
    draft = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
    with open(draft, "wb") as file:
        np.save(file, values)
    os.replace(draft, path)
