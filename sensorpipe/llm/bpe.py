"""Byte-pair encoding as a transducer with bounded lookahead, and decoding as a state machine.

Tokens of a word leave as soon as no later text can change them. How far ahead that needs to look follows from the
merge list alone (``Merges.lookahead``). Every word goes through the transducer; what it made of short words is
remembered, up to a bound. Tokens leave in pieces, which are hashed and decoded one by one: besides the text itself (and a
normalised copy of a run without white space) memory does not grow with the length of a word or a text.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sensorpipe.llm.ship import ship

# The split pattern and the white space of the vocabulary file's format.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
END = "</w>"
#: Characters that ``str.split`` takes for white space and the format does not.
_NO_SPACE = re.compile("[\x1c-\x1f]")
SLICE = 1 << 16
#: Words, and runs of text, kept with their tokens by each worker: so many, and as many that were in use before these.
REMEMBERED = 100_000
LONG = 256
_NO_RANK = 1 << 62
#: Tokens of a long word that leave together.
PIECE = 1 << 14


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class Merges:
    """A vocabulary with its ordered merges, over token ids."""

    def __init__(self, data: str):
        spec = json.loads(data)
        vocab, model = spec["model"]["vocab"], spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.names = [""] * size
        for name, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = name
        letters = byte_characters()
        self.value = {c: b for b, c in enumerate(letters)}
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + END] for c in letters]
        # Ranks of pairs, and what the merge of a rank makes; a pair without a merge has the rank behind all others.
        self.ranks: dict[int, int] = {}
        self.made: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.ranks.setdefault(left << 32 | right, rank)
            self.made[rank] = made
            if made in self.parts:
                raise ValueError(f"two merges make {a + b}")
            self.parts[made] = (left, right)
        self.lookahead = self._lookahead()
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def _lookahead(self) -> int:
        """How many symbols behind a token can have a say in whether it stays as it is.

        A token changes from the right only if a token x on its right edge is merged with its right neighbour y before
        it is used up inside the token, and that depends on y in turn being left alone until then: a chain of merges of
        ever lower rank. ``reach[x]`` is the longest chain over the merges of x with a right neighbour seen so far,
        ``edge[t]`` the longest over the tokens inside t that end where t ends. Merges are taken in order of rank, so
        what is known of y is what may happen before.
        """
        length = {i: 1 for i in [*self.inner, *self.last]}
        reach: dict[int, int] = {}
        edge: dict[int, int] = {}
        for made, (left, right) in self.parts.items():
            length[made] = length[left] + length[right]
            edge[made] = max(edge.get(right, 0), reach.get(right, 0))
            reach[left] = max(reach.get(left, 0), length[right] + edge[made])
        self.longest = max(length.values())
        return max(max(edge.get(t, 0), reach.get(t, 0)) for t in length)

    def merge(self, symbols: list[int]) -> list[int]:
        """The merges of a word: always the pair of lowest rank, of equal ones the leftmost."""
        rank, none = self.ranks.get, _NO_RANK
        found = [rank(a << 32 | b, none) for a, b in zip(symbols, symbols[1:])]
        while found and (best := min(found)) != none:
            at = found.index(best)
            symbols[at : at + 2] = [self.made[best]]
            del found[at]
            if at:
                found[at - 1] = rank(symbols[at - 1] << 32 | symbols[at], none)
            if at < len(found):
                found[at] = rank(symbols[at] << 32 | symbols[at + 1], none)
        return symbols

    def symbols(self, word: str) -> Iterator[int]:
        """One symbol a byte; the last byte of a word has a symbol of its own."""
        data = word.encode("utf-8", "surrogatepass")
        return chain(map(self.inner.__getitem__, data[:-1]), (self.last[data[-1]],))

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """Tokens of one word of any length, each emitted once ``lookahead`` symbols behind it are known."""
        waiting: list[int] = []
        full = 2 * (self.lookahead + self.longest)
        width, symbols = {}, iter(symbols)
        while True:
            waiting.extend(islice(symbols, full - len(waiting)))
            if len(waiting) < full:
                break
            done = 0
            for token in self.merge(waiting[:]):
                size = width.get(token) or width.setdefault(token, self._width(token))
                if done + size + self.lookahead > len(waiting):
                    break
                yield token
                done += size
            del waiting[:done]
        yield from self.merge(waiting)

    def _width(self, token: int) -> int:
        todo, n = [token], 0
        while todo:
            parts = self.parts.get(todo.pop())
            if parts is None:
                n += 1
            else:
                todo.extend(parts)
        return n


class _Recent:
    """Values by key; when full, those not asked for since the last time it was full are forgotten."""

    def __init__(self):
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        got = self.new.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self.keep(key, got)
        return got

    def keep(self, key: str, value: bytes) -> None:
        if len(self.new) >= REMEMBERED:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Encoder:
    """Texts to token ids, in slices; words seen before are remembered up to a bound."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.words, self.runs = _Recent(), _Recent()

    def _short(self, word: str) -> bytes:
        """Tokens of a word, from the transducer, or as it made them before."""
        got = self.words.get(word)
        if got is None:
            got = array("I", self.merges.stream(self.merges.symbols(word))).tobytes()
            self.words.keep(word, got)
        return got

    def _word(self, word: str) -> Iterator[bytes]:
        """Tokens of a word of any length, in pieces."""
        if len(word) <= LONG:
            yield self._short(word)
            return
        made = self.merges.stream(self.merges.symbols(word))
        while some := array("I", islice(made, PIECE)).tobytes():
            yield some

    def _folded(self, run: str) -> str:
        if run.isascii():
            return run.lower()
        return unicodedata.normalize("NFC", run).replace("Σ", "σ").lower()

    def _plain(self, run: str) -> Iterator[bytes]:
        for word in PATTERN.finditer(self._folded(run)):
            yield from self._word(word[0])

    def _short_run(self, run: str) -> bytes:
        if run.isascii() and run.isalpha():
            # One word, whatever the pattern.
            return self._short(run.lower())
        if "<" in run:
            return b"".join(self._run(run))
        return b"".join(map(self._short, PATTERN.findall(self._folded(run))))

    def _run(self, run: str) -> Iterator[bytes]:
        """Tokens of a run of text without white space."""
        merges, at = self.merges, 0
        if "<" in run and merges.split_special:
            for special in merges.split_special.finditer(run):
                yield from self._plain(run[at : special.start()])
                yield np.array([merges.special[special[0]]], "<u4").tobytes()
                at = special.end()
        yield from self._plain(run[at:])

    def pieces(self, text: str | None) -> Iterator[bytes]:
        """Token ids as little-endian unsigned 32-bit integers, as they leave; a null text has none.

        The text is read in slices that end where white space begins.
        """
        text, at, known = text or "", 0, self.runs
        split = SPACE.split if _NO_SPACE.search(text) else str.split
        while at < len(text):
            blank = SPACE.search(text, at + SLICE) if at + SLICE < len(text) else None
            end = blank.start() if blank else len(text)
            ready = []
            for run in split(text[at:end]):
                got = known.get(run)
                if got is None:
                    if len(run) > LONG:
                        yield b"".join(ready)
                        ready.clear()
                        yield from self._run(run)
                        continue
                    got = self._short_run(run)
                    known.keep(run, got)
                ready.append(got)
            yield b"".join(ready)
            at = end

    def encode(self, text: str | None) -> bytes:
        return b"".join(self.pieces(text))


class Decoder:
    """Ids to text, piece by piece. The state is whether a token came before, and the bytes of an open character.

    ``library``: tokens as they are written in the vocabulary, joined by one space, which is what the format prescribes
    without a decoder. Otherwise the bytes that the tokens stand for, with a space at each word end.
    """

    def __init__(self, merges: Merges, library: bool = True):
        self.merges, self.library, self.started = merges, library, False
        self.bytes = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int], last: bool = False) -> str:
        if self.library:
            names = self.merges.names
            spoken = " ".join([names[i] for i in ids])
            joined = f" {spoken}" if self.started and spoken else spoken
            self.started |= bool(spoken)
            return joined
        out, special = [], set(self.merges.special.values())
        for i in ids:
            name = self.merges.names[i]
            if i in special:
                out.append(self.bytes.decode(name.encode()))
                continue
            data = bytes(self.merges.value[c] for c in name.removesuffix(END))
            out.append(self.bytes.decode(data + b" " * name.endswith(END)))
        return "".join(out) + self.bytes.decode(b"", last)


_ENCODERS: dict[str, Encoder] = {}


def encoder(data: str) -> Encoder:
    """The worker's encoder for a vocabulary, made once."""
    key = hashlib.sha256(data.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Merges(data))
    return _ENCODERS[key]


def _vocabulary(docs: DataFrame, path: str):
    ship(docs.sparkSession)
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _replaced(batch: pa.RecordBatch, column: str, new: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = {n: batch.column(n) for n in batch.schema.names if n != column and n not in new}
    return pa.RecordBatch.from_pydict(kept | new)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the tokens of ``text`` as ``ids`` (array of int) in place of the text; null gives no tokens.

    Other columns stay; one that is named as ``ids`` is replaced. Repeated rows are encoded alike.
    """
    held = _vocabulary(docs, path)
    columns = [c for c in docs.columns if c not in (text, ids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(held.value)
        for batch in batches:
            rows = [np.frombuffer(own.encode(t.as_py()), "<u4").astype(np.int32) for t in batch.column(text)]
            yield _replaced(batch, text, {ids: pa.array(rows, pa.list_(pa.int32()))})

    schema = docs.select(*columns).schema.add(ids, T.ArrayType(T.IntegerType()))
    return docs.select(*columns, text).mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, ids: str = "ids", text: str = "text", library: bool = True) -> DataFrame:
    """``tokens`` with the text of ``ids`` in place of the ids; null ids give an empty text."""
    held = _vocabulary(tokens, path)
    columns = [c for c in tokens.columns if c not in (text, ids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = encoder(held.value).merges
        for batch in batches:
            rows = [Decoder(merges, library).feed(i.as_py() or [], True) for i in batch.column(ids)]
            yield _replaced(batch, ids, {text: pa.array(rows, pa.string())})

    schema = tokens.select(*columns).schema.add(text, T.StringType())
    return tokens.select(*columns, ids).mapInArrow(run, schema)


def _round_trip(own: Encoder, text: str | None, keep: bool) -> tuple[int, str, str, bytes]:
    """Number of tokens, SHA-256 of their ids and of what they decode to, and the ids if they are to be kept.

    Each piece of ids is hashed and handed to the decoder as it leaves.
    """
    n, ids, decoded, state, kept = 0, hashlib.sha256(), hashlib.sha256(), Decoder(own.merges), []
    for piece in own.pieces(text):
        ids.update(piece)
        some = np.frombuffer(piece, "<u4").tolist()
        decoded.update(state.feed(some).encode("utf-8"))
        n += len(some)
        if keep:
            kept.append(piece)
    decoded.update(state.feed([], True).encode("utf-8"))
    return n, ids.hexdigest(), decoded.hexdigest(), b"".join(kept)


def tokens(docs: DataFrame, path: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """``docs`` without the text, with n_tokens, ids_sha256, decoded_sha256 and, ``with_ids``, the tokens as ``ids``.

    The text is encoded, and decoded from the ids again. A null text is empty and has no tokens. Columns that are named
    as the new ones are replaced; others stay; repeated rows are encoded alike.
    """
    held = _vocabulary(docs, path)
    new = T.StructType().add("n_tokens", T.LongType()).add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType())
    if with_ids:
        new.add("ids", T.ArrayType(T.IntegerType()))
    columns = [c for c in docs.columns if c != text and c not in new.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(held.value)
        for batch in batches:
            rows = [_round_trip(own, t.as_py(), with_ids) for t in batch.column(text)]
            made = {
                "n_tokens": pa.array([r[0] for r in rows], pa.int64()),
                "ids_sha256": pa.array([r[1] for r in rows], pa.string()),
                "decoded_sha256": pa.array([r[2] for r in rows], pa.string()),
            }
            if with_ids:
                made["ids"] = pa.array([np.frombuffer(r[3], "<u4").astype(np.int32) for r in rows], pa.list_(pa.int32()))
            yield _replaced(batch, text, made)

    schema = T.StructType([*docs.select(*columns).schema.fields, *new.fields])
    return docs.select(*columns, text).mapInArrow(run, schema)
