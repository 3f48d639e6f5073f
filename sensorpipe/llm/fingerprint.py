"""SimHash fingerprints of word shingles, as 64-bit integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SHINGLE = 3
SEED = 42


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than ASCII white space, A-Z in lower case; ``bytes`` methods know ASCII only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def simhash(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """Bit b is set if it is set in over half of the shingle hashes; repeats count, no words give zero."""
    words = words_of(text)
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[size - 1 :] if len(words) >= size else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        block = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def add_fingerprints(text: str, size: int = SHINGLE, seed: int = SEED):
    """A function for ``mapInArrow``: replaces the column ``text`` by ``fingerprint``, a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            found = np.fromiter((simhash(t.as_py(), size, seed) for t in batch.column(at)), np.uint64, batch.num_rows)
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], names=[*names, "fingerprint"])

    return run
