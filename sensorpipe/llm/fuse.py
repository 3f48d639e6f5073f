"""A static filter for sets of 64-bit keys: a binary fuse filter with three slots a key and 8-bit fingerprints."""

from __future__ import annotations

import math
import struct

import numpy as np


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


class BinaryFuse:
    """Holds every key it was built from; another key passes with a chance of 1 in 256."""

    HEAD = "<QII"

    def __init__(self, seed: int, segment: int, segments: int, table: np.ndarray):
        self.seed, self.segment, self.segments, self.table = seed, segment, segments, table

    def _slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Three slots in neighbouring segments, and the fingerprint."""
        h = _mix(keys, self.seed)
        start = ((h >> np.uint64(32)) * np.uint64(self.segment * self.segments)) >> np.uint64(32)
        mask, slots = np.uint64(self.segment - 1), np.empty((3, len(keys)), np.int64)
        for i, shift in enumerate((None, 18, 0)):
            at = start + np.uint64(i * self.segment)
            slots[i] = at if shift is None else at ^ ((h >> np.uint64(shift)) & mask)
        return slots, (h ^ (h >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        """Peel keys that are alone in a slot, round by round, then fill the table in the opposite order."""
        keys = np.unique(np.asarray(keys, np.uint64))
        n = max(len(keys), 2)
        segment = max(4, 1 << int(math.log(n) / math.log(3.33) + 2.25))
        size = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n)) * n
        segments = max(1, math.ceil(size / segment) - 2)
        for seed in range(1, 200):
            made = cls(seed * 0x9E3779B97F4A7C15 % (1 << 64), segment, segments, np.zeros((segments + 2) * segment, np.uint8))
            if made._fill(keys):
                return made
        raise RuntimeError("no seed gave a filter")

    def _fill(self, keys: np.ndarray) -> bool:
        slots, prints = self._slots(keys)
        number = np.arange(len(keys))
        degree = np.bincount(slots.ravel(), minlength=len(self.table))
        inside = np.zeros(len(self.table), np.int64)
        for row in slots:
            np.bitwise_xor.at(inside, row, number)
        rounds, left = [], len(keys)
        while left:
            alone = np.flatnonzero(degree == 1)
            if not len(alone):
                return False
            peeled, first = np.unique(inside[alone], return_index=True)
            rounds.append((peeled, alone[first]))
            for row in slots:
                np.subtract.at(degree, row[peeled], 1)
                np.bitwise_xor.at(inside, row[peeled], peeled)
            left -= len(peeled)
        for peeled, own in reversed(rounds):
            self.table[own] = 0
            self.table[own] = prints[peeled] ^ np.bitwise_xor.reduce(self.table[slots[:, peeled]], axis=0)
        return True

    def contains(self, keys: np.ndarray) -> np.ndarray:
        slots, prints = self._slots(np.asarray(keys, np.uint64))
        return prints == np.bitwise_xor.reduce(self.table[slots], axis=0)

    def to_bytes(self) -> bytes:
        return struct.pack(self.HEAD, self.seed, self.segment, self.segments) + self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> BinaryFuse:
        seed, segment, segments = struct.unpack_from(cls.HEAD, data)
        return cls(seed, segment, segments, np.frombuffer(data, np.uint8, offset=struct.calcsize(cls.HEAD)))
