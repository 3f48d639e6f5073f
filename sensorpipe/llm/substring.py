"""Removal of repeated passages: a count-min sketch finds windows that may repeat, an exact pass groups only those.

Documents are packed into chunks of a few megabytes. A chunk sends the sketch what it holds, and gets back one bit for
each cell: whether another chunk holds it too. So the sketch is never whole in one place, and grows with the data.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorpipe.llm.ship import ship
from sensorpipe.session import staged

WINDOW = 20
#: Words in a chunk of a small table, about, and how often that doubles for a large one. A longer document is a chunk of its own.
CHUNK_WORDS = 1 << 20
CHUNK_DOUBLINGS = 2
#: Rows of the sketch. Each has at least as many cells as the texts have bytes, some six to twelve times the windows.
DEPTH = 2
#: Cells that one task merges, as a power of two: of a small table, and of a large one at most.
BLOCK_BITS = 23
MOST_BLOCK_BITS = 25
#: Blocks up to which neither blocks nor chunks grow, as a power of two.
FEW_BLOCKS = 10
_LAST = np.iinfo(np.int64).max
_U = np.uint64


class Plan(NamedTuple):
    window: int
    depth: int
    cell_bits: int
    block_bits: int
    chunk_words: int


def sized(size: int, window: int = WINDOW, depth: int = DEPTH) -> Plan:
    """The sketch for so many bytes of text. Chunks exchange a row with every block, so both grow before rows get short."""
    cell_bits = max(20, int(size).bit_length())
    block_bits = min(max(16, cell_bits - 4), max(BLOCK_BITS, min(MOST_BLOCK_BITS, cell_bits - FEW_BLOCKS)))
    doublings = min(CHUNK_DOUBLINGS, max(0, cell_bits - block_bits - FEW_BLOCKS))
    return Plan(window, depth, cell_bits, block_bits, CHUNK_WORDS << doublings)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mix(left * _U(0x9E3779B97F4A7C15) + right)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` word hashes: runs of 1, 2, 4, ... words are joined as the size needs them."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    run, length, done, at = words, 1, None, 0
    while True:
        if size & length:
            piece = run[at : at + n]
            done = piece if done is None else _join(done, piece)
            at += length
        if length * 2 > size:
            return done
        run = _join(run[:-length], run[length:])
        length *= 2


class Chunk:
    """Some documents: their words one after the other, and the windows that lie within one document."""

    def __init__(self, doc_ids: list, texts: list, window: int):
        self.doc_ids, self.texts, self.window = doc_ids, texts, window

    def words(self) -> Iterator[list[bytes]]:
        """The words of one document after the other."""
        for text in self.texts:
            yield (text or "").encode("utf-8", "surrogatepass").split()

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of each window; sets where the windows are."""
        known: dict[bytes, int] = {}
        numbers = [np.fromiter((known.setdefault(w, len(known)) for w in doc), np.int32, len(doc)) for doc in self.words()]
        counts = np.array([len(n) for n in numbers], np.int64)
        number = np.concatenate(numbers) if numbers else np.empty(0, np.int32)
        many = np.maximum(counts - self.window + 1, 0)
        self.doc = np.repeat(np.arange(len(counts), dtype=np.int32), many)
        inside = np.arange(len(self.doc), dtype=np.int64) - np.repeat(np.cumsum(many) - many, many)
        self.at = inside + np.repeat(np.cumsum(counts) - counts, many)
        if not len(self.at):
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, known)), ">u8").reshape(-1, 2).astype(np.uint64)
        del known, numbers
        return tuple(window_hashes(both[number, i], self.window)[self.at] for i in (0, 1))

    def order(self) -> np.ndarray:
        """The doc_id of each document; null comes after all others."""
        return np.array([_LAST if d is None else d for d in self.doc_ids], np.int64)


def _pack(doc_ids: list, texts: list) -> bytes:
    table = pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "text": pa.array(texts, pa.large_string())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 5))) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes, window: int) -> Chunk:
    table = pa.ipc.open_stream(data).read_all()
    return Chunk(table["doc_id"].to_pylist(), table["text"].to_pylist(), window)


def _cells(hashes: np.ndarray, row: int, plan: Plan) -> np.ndarray:
    """The cell of each window in one row of the sketch."""
    return _mix(hashes + _U(row * 0xD1B54A32D192ED03 % (1 << 64))) >> _U(64 - plan.cell_bits)


def _blocks(cells: np.ndarray, plan: Plan) -> Iterator[tuple[int, slice]]:
    """Sorted cells by the block they are in."""
    block = cells >> _U(plan.block_bits)
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(cells) else []
    for a, b in zip(starts, [*starts[1:], len(cells)]):
        yield int(block[a]), slice(int(a), int(b))


def _plain_bits(n: int, plan: Plan) -> int:
    """How many low bits of each of ``n`` cells of a block are written as they are, in steps of four."""
    return 4 * round(math.log2((1 << plan.block_bits) / n) / 4)


def _write_cells(cells: np.ndarray, plan: Plan) -> bytes:
    """Sorted cells of one block: their number, a mark for each among the steps of their high bits, their low bits.

    A cell takes some two bits more than the logarithm of the gap to the next one, however few a chunk has in a block.
    """
    inside, n = (cells & _U((1 << plan.block_bits) - 1)).astype(np.int64), len(cells)
    low = _plain_bits(n, plan)
    marks = np.zeros(n + ((1 << plan.block_bits) >> low), np.uint8)
    marks[(inside >> low) + np.arange(n)] = 1
    halves = np.zeros((low // 4 * n + 1) // 2 * 2, np.uint8)
    for i in range(low // 4):
        halves[i * n : (i + 1) * n] = inside >> 4 * i & 15
    return np.uint32(n).tobytes() + np.packbits(marks).tobytes() + (halves[::2] | halves[1::2] << 4).tobytes()


def _read_cells(data: bytes, plan: Plan) -> np.ndarray:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    low = _plain_bits(n, plan)
    marks = n + ((1 << plan.block_bits) >> low)
    end = 4 + (marks + 7) // 8
    cells = (np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, end - 4, 4), count=marks)) - np.arange(n)) << low
    packed = np.frombuffer(data, np.uint8, offset=end)
    halves = np.column_stack((packed & 15, packed >> 4)).ravel()
    for i in range(low // 4):
        cells |= halves[i * n : (i + 1) * n].astype(np.int64) << 4 * i
    return cells


_PACKED = "chunk long, data binary"
_SKETCH = "chunk long, sketch_row int, block int, data binary"


def _pack_chunks(batches: Iterator[pa.RecordBatch], chunk_words: int) -> Iterator[pa.RecordBatch]:
    """Documents packed into chunks; a chunk's number holds that of its task, and is fixed once it has been written."""
    chunk = TaskContext.get().partitionId() << 32
    ids, texts, words = [], [], 0

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "data": pa.array([_pack(ids, texts)], pa.binary())})

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            ids.append(doc_id.as_py())
            texts.append(text.as_py())
            words += len(texts[-1] or "") // 6 + 1
            if words >= chunk_words:
                yield close()
                ids, texts, words, chunk = [], [], 0, chunk + 1
    if ids:
        yield close()


def _sketch(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """A chunk's share of the sketch, by row and block."""
    for batch in batches:
        for chunk, data in zip(batch.column("chunk"), batch.column("data")):
            first = _unpack(data.as_py(), plan.window).hashes()[0]
            for row in range(plan.depth):
                cells = np.unique(_cells(first, row, plan))
                out = [(block, _write_cells(cells[part], plan)) for block, part in _blocks(cells, plan)]
                n, columns = len(out), zip(*out) if out else ((), ())
                block, share = columns
                yield pa.RecordBatch.from_pydict(
                    {"chunk": pa.array([chunk.as_py()] * n, pa.int64()), "sketch_row": pa.array([row] * n, pa.int32()), "block": pa.array(block, pa.int32()), "data": pa.array(share, pa.binary())}
                )


def _merge_cells(rows: pd.DataFrame, plan: Plan) -> pd.DataFrame:
    """For each chunk one bit a cell: whether the cell has come from two or more chunks."""
    once, twice = np.zeros(1 << plan.block_bits, bool), np.zeros(1 << plan.block_bits, bool)
    for data in rows["data"]:
        cells = _read_cells(data, plan)
        twice[cells] |= once[cells]
        once[cells] = True
    rows["data"] = [np.packbits(twice[_read_cells(data, plan)]).tobytes() for data in rows["data"]]
    return rows


def _estimated(hashes: np.ndarray, answers: pd.DataFrame, plan: Plan) -> np.ndarray:
    """Windows whose smallest count over the rows of the sketch is two or more."""
    bits = {(r, b): d for r, b, d in zip(answers["sketch_row"], answers["block"], answers["data"])}
    repeated = np.ones(len(hashes), bool)
    for row in range(plan.depth):
        cells, back, counts = np.unique(_cells(hashes, row, plan), return_inverse=True, return_counts=True)
        elsewhere = np.zeros(len(cells), bool)
        for block, part in _blocks(cells, plan):
            n = part.stop - part.start
            elsewhere[part] = np.unpackbits(np.frombuffer(bits[row, block], np.uint8), count=n).astype(bool)
        repeated &= (elsewhere | (counts > 1))[back]
    return repeated


#: What a chunk tells of a window: its hash in 128 bits, its document, and its place in the chunk.
_FIELDS = (("first", "<u8"), ("second", "<u8"), ("doc_id", "<i8"), ("at", "<u4"))
_SIZES = [np.dtype(kind).itemsize for _, kind in _FIELDS]


def _planes(arrays: list[np.ndarray]) -> bytes:
    """Arrays byte plane by byte plane, compressed: the upper bytes of small numbers take no room."""
    raw = b"".join(np.ascontiguousarray(a.astype(kind).view(np.uint8).reshape(len(a), -1).T).tobytes() for a, (_, kind) in zip(arrays, _FIELDS))
    return pa.compress(raw, "zstd", asbytes=True) if raw else b""


def _from_planes(data: bytes, n: int) -> list[np.ndarray]:
    if not n:
        return [np.empty(0, kind) for _, kind in _FIELDS]
    raw, out, at = np.frombuffer(pa.decompress(data, n * sum(_SIZES), "zstd", asbytes=True), np.uint8), [], 0
    for size, (_, kind) in zip(_SIZES, _FIELDS):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).reshape(-1).view(kind))
        at += n * size
    return out


_ASKED = "chunk long, block int, n long, data binary"


def _ask(packed: pd.DataFrame, answers: pd.DataFrame, plan: Plan) -> pd.DataFrame:
    """A chunk's windows that may repeat: the first of each for the exact grouping (block 0 on), the rest as removed."""
    out = []
    for chunk_id, data in zip(packed["chunk"], packed["data"]):
        chunk = _unpack(data, plan.window)
        first, second = chunk.hashes()
        of = np.flatnonzero(_estimated(first, answers, plan))
        doc_id, first, second, at = chunk.order()[chunk.doc[of]], first[of], second[of], chunk.at[of]
        sort = np.lexsort((at, doc_id, second, first))
        first, second, doc_id, at = (x[sort] for x in (first, second, doc_id, at))
        new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])] if len(of) else np.empty(0, bool)
        rest = at[~new]
        out.append((chunk_id, -1, len(rest), np.sort(rest).astype("<u4").tobytes()))
        first, second, doc_id, at = (x[new] for x in (first, second, doc_id, at))
        shift = _U(64 - plan.cell_bits + plan.block_bits) if plan.cell_bits > plan.block_bits else None
        block = (first >> shift).astype(np.int64) if shift is not None else np.zeros(len(first), np.int64)
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else []
        for a, b in zip(starts, [*starts[1:], len(block)]):
            out.append((chunk_id, int(block[a]), int(b - a), _planes([x[a:b] for x in (first, second, doc_id, at)])))
    return pd.DataFrame(out, columns=["chunk", "block", "n", "data"])


def _group(rows: pd.DataFrame) -> pd.DataFrame:
    """Exact grouping of one block: of each chunk the windows that are not the first of their group."""
    if rows["block"].iloc[0] < 0:
        return rows[["chunk", "data"]]
    parts = [_from_planes(d, n) for d, n in zip(rows["data"], rows["n"])]
    first, second, doc_id, at = (np.concatenate(x) for x in zip(*parts))
    chunk = np.repeat(rows["chunk"].to_numpy(), rows["n"].to_numpy())
    sort = np.lexsort((at, chunk, doc_id, second, first))
    later = np.r_[False, (first[sort][1:] == first[sort][:-1]) & (second[sort][1:] == second[sort][:-1])]
    gone, where = chunk[sort][later], at[sort][later].astype("<u4")
    by = np.argsort(gone, kind="stable")
    gone, where = gone[by], where[by]
    starts = np.flatnonzero(np.r_[True, gone[1:] != gone[:-1]]) if len(gone) else []
    out = [(int(gone[a]), where[a:b].tobytes()) for a, b in zip(starts, [*starts[1:], len(gone)])]
    return pd.DataFrame(out, columns=["chunk", "data"])


def _remove(packed: pd.DataFrame, removed: pd.DataFrame, plan: Plan, digest: bool) -> pd.DataFrame:
    """The documents of a chunk without the words that a removed window covers."""
    frames = []
    for data in packed["data"]:
        chunk = _unpack(data, plan.window)
        documents = [len(words) for words in chunk.words()]
        cover = np.zeros(sum(documents) + 1, np.int32)
        for starts in removed["data"]:
            starts = np.frombuffer(starts, "<u4")
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + plan.window, -1)
        gone, begin, rows = np.cumsum(cover) > 0, 0, []
        for doc_id, words in zip(chunk.doc_ids, chunk.words()):
            mask = gone[begin : begin + len(words)]
            n, begin = int(mask.sum()), begin + len(words)
            kept = b" ".join(words if not n else [w for w, g in zip(words, mask.tolist()) if not g])
            rows.append((doc_id, len(words), n, hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "surrogatepass")))
        frames.append(pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept"]).astype({"doc_id": "Int64"}))
    return pd.concat(frames) if frames else pd.DataFrame({"doc_id": pd.array([], "Int64"), "n_words": [], "n_removed": [], "kept": []})


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, depth: int = DEPTH, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: the text without words of windows that start earlier elsewhere.

    A window is ``window`` consecutive words of one row. Earlier means a smaller doc_id, then an earlier start, in the
    input as it is; a null doc_id comes after all others, and of rows with one doc_id each counts as a document of its
    own, in the order of the input. ``kept`` is the remaining words joined by one space, or their SHA-256. Null and empty texts have no words.
    Other columns are not read.

    Windows are one when two hashes of their words, of 64 bits each, agree. The sketch never underestimates a count, so no repeated
    window is lost; what it overestimates, the exact grouping sorts out. A chunk asks for each window once, however
    often it holds it, so a passage that very many documents share does not gather in one task.
    """
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    plan = sized(size, window, depth)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    packed = staged(picked.mapInArrow(lambda batches: _pack_chunks(batches, plan.chunk_words), _PACKED), compression="uncompressed")
    cells = packed.mapInArrow(lambda batches: _sketch(batches, plan), _SKETCH)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        return _merge_cells(rows, plan)

    def ask(parts: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        return _ask(parts, answered, plan)

    def cut(parts: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
        return _remove(parts, gone, plan, digest)

    answers = cells.groupBy("sketch_row", "block").applyInPandas(merge, _SKETCH)
    asked = packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(ask, _ASKED)
    salted = asked.withColumn("salt", F.when(F.col("block") < 0, F.col("chunk")).otherwise(0))
    removed = salted.groupBy("block", "salt").applyInPandas(_group, "chunk long, data binary")
    return packed.groupBy("chunk").cogroup(removed.groupBy("chunk")).applyInPandas(cut, "doc_id long, n_words long, n_removed long, kept string")
