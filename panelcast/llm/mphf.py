"""Minimal perfect hash with stored fingerprints, on numpy arrays.

Keys are hashed level by level into bit arrays (the published BBHash scheme): a
key that is alone on its bit stays there, the others go on to the next, smaller
level. The number of set bits before a key's bit is its slot, so n keys get the
slots 0 to n - 1. The slot's stored fingerprint tells foreign keys apart.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC, GAMMA, MAX_LEVELS = b"PCMPHF01", 2.0, 40
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)    # splitmix64, fixed values


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """splitmix64 finaliser of 64-bit keys under a seed."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """``levels``: (offset, size) in bits of each level within ``words``."""

    def __init__(self, levels: list[tuple[int, int]], words: np.ndarray, prints: np.ndarray):
        self.levels, self.words, self.prints = levels, words, prints
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(words) else np.zeros(0, np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct unsigned 64-bit values, already well mixed."""
        levels, bits, left, at = [], [], keys, 0
        for level in range(MAX_LEVELS):
            if not len(left):
                break
            size = max(64, -(-int(GAMMA * len(left)) // 64) * 64)
            spot = (mix(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(spot, minlength=size) == 1
            levels.append((at, size))
            bits.append(alone)
            at += size
            left = left[~alone[spot]]
        if len(left):
            raise ValueError("keys repeat")
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        words = np.packbits(flat, bitorder="little").view(np.uint64) if len(flat) else np.zeros(0, np.uint64)
        found = cls(levels, words, np.zeros(len(keys), np.uint32))
        if len(keys):
            found.prints[found.slot(keys)] = cls.print_of(keys)
        return found

    @staticmethod
    def print_of(keys: np.ndarray) -> np.ndarray:
        return (mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """Slots, -1 where no level has the key's bit. A constant number of probes on average."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (offset, size) in enumerate(self.levels):
            if not len(open_):
                break
            bit = offset + (mix(keys[open_], level) % np.uint64(size)).astype(np.int64)
            word, shift = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> shift & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << shift[hit]) - np.uint64(1)))
            out[open_[hit]] = self.before[bit[hit] >> 6] + below
            open_ = open_[~hit]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 for keys whose fingerprint isn't the stored one."""
        slot = self.slot(keys)
        bad = slot < 0
        bad[~bad] = self.prints[slot[~bad]] != self.print_of(keys[~bad])
        return np.where(bad, -1, slot)

    def to_bytes(self) -> bytes:
        head = struct.pack("<8sIQQ", MAGIC, len(self.levels), len(self.words), len(self.prints))
        return b"".join([head, *(struct.pack("<QQ", *x) for x in self.levels),
                         self.words.astype("<u8").tobytes(), self.prints.astype("<u4").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The hash and the number of bytes it took."""
        magic, n_levels, n_words, n = struct.unpack_from("<8sIQQ", data)
        if magic != MAGIC:
            raise ValueError("not a perfect hash")
        at = struct.calcsize("<8sIQQ")
        levels = [struct.unpack_from("<QQ", data, at + 16 * i) for i in range(n_levels)]
        at += 16 * n_levels
        words = np.frombuffer(data, "<u8", n_words, at).astype(np.uint64)
        prints = np.frombuffer(data, "<u4", n, at + 8 * n_words).astype(np.uint32)
        return cls(levels, words, prints), at + 8 * n_words + 4 * n
