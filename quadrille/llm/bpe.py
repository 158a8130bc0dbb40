"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct pieces of a block of texts (for digests, those that are not yet known to the task, which keeps a bounded number) are laid end to end as byte tokens. An inverted index holds, for every
pair that a rank merges, the positions where that pair stands; a heap gives the ranks in order. Each step takes
the lowest rank, merges its positions at once, and enters only the pairs of the touched neighbours anew. If the new
token is part of a pair of a lower rank, which would go first, only the leftmost position within a piece merges in a step. Pieces of
more than LONG bytes have an index of their own, a heap of (rank, position), so they take time in proportion to
their length (and its logarithm). A piece that is a token as a whole keeps that id.

Defined cases: a null text is an empty one (no id); null ids and repeated rows are kept, each row encoded alone; of positions of
one rank the leftmost goes first; an empty table gives an empty result; columns other than the id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import pieces

#: Bytes of text whose new pieces are encoded together; bytes of pieces that one replay takes; distinct pieces that a task keeps, and their characters.
BLOCK_BYTES, REPLAYED, KEPT, KEPT_CHARS = 2 << 20, 1 << 20, 1 << 18, 8 << 20
LONG = 256
_TABLES: dict[str, "MergeTable"] = {}


class MergeTable:
    """Ranks of a vocabulary, and every pair of tokens whose bytes joined are a token."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.size = max(self.ranks.values()) + 1
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        keys, to = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    to.append(rank)
        keys = np.array(keys, np.int64)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.array(to, np.int32)[order]
        least = np.full(self.size, np.iinfo(np.int64).max)
        np.minimum.at(least, self.keys // self.size, self.to)
        np.minimum.at(least, self.keys % self.size, self.to)
        #: Whether every pair with this token has a higher rank than the token's own.
        self.rising = least > np.arange(self.size)

    @classmethod
    def of(cls, path: str) -> "MergeTable":
        if path not in _TABLES:
            _TABLES[path] = cls(path)
        return _TABLES[path]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that merges each pair, -1 if none does."""
        if not len(self.keys):
            return np.full(len(left), -1, np.int32)
        key = left * np.int64(self.size) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], np.int32(-1))

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of every word."""
        out: list[list[int] | None] = [[self.ranks[w]] if w in self.ranks else None for w in words]
        for i, w in enumerate(words):
            if out[i] is None and len(w) > LONG:
                out[i] = self._long(w)
        rest = [i for i, x in enumerate(out) if x is None and words[i]]
        ends = np.cumsum([len(words[i]) for i in rest]) if rest else []
        for run in np.split(np.array(rest, np.int64), np.searchsorted(ends, np.arange(REPLAYED, ends[-1], REPLAYED)) if rest else []):
            run = run.tolist()
            token, bounds = self._replay(np.frombuffer(b"".join([words[i] for i in run]), np.uint8), np.array([len(words[i]) for i in run], np.int64))
            alive = token >= 0
            kept, count = token[alive].tolist(), np.concatenate([[0], np.cumsum(alive)])[bounds].tolist()
            for k, i in enumerate(run):
                out[i] = kept[count[k] : count[k + 1]]
        return [x or [] for x in out]

    def _long(self, word: bytes) -> list[int]:
        """Ids of one long piece; the heap's numbers are a rank and a position."""
        ranks, bytes_of = self.ranks, self.bytes_of
        first = self.single[np.frombuffer(word, np.uint8)]
        start = self.rank(first[:-1], first[1:])
        token, pair, n = first.tolist(), start.tolist() + [-1], len(first)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r << 40) + i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        while heap:
            r, i = divmod(heappop(heap), 1 << 40)
            if pair[i] != r:
                continue
            gone = nxt[i]
            after = nxt[gone]
            token[i], token[gone], pair[gone], nxt[i] = r, -1, -1, after
            pair[i] = -1
            if after < n:
                prv[after] = i
                new = ranks.get(bytes_of[r] + bytes_of[token[after]])
                if new is not None:
                    pair[i] = new
                    heappush(heap, (new << 40) + i)
            before = prv[i]
            if before >= 0:
                new = ranks.get(bytes_of[token[before]] + bytes_of[r])
                pair[before] = -1 if new is None else new
                if new is not None:
                    heappush(heap, (new << 40) + before)
        return [t for t in token if t >= 0]

    def _replay(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        bounds = np.concatenate([[0], np.cumsum(size)])
        token = self.single[data]
        word = np.repeat(np.arange(len(size), dtype=np.int32), size)
        nxt, prv = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        nxt[bounds[1:] - 1] = -1
        prv[bounds[:-1]] = -1
        pair = np.full(n, -1, np.int32)
        index: dict[int, list[np.ndarray]] = {}

        def enter(at: np.ndarray, rank: np.ndarray) -> list[int]:
            """Puts positions under their ranks; gives the ranks that were not there."""
            some = rank >= 0
            at, rank = at[some], rank[some]
            if not len(at):
                return []
            if len(at) == 1:
                groups = [(int(rank[0]), at)]
            else:
                order = np.argsort(rank, kind="stable")
                at, rank = at[order], rank[order]
                cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
                first = [0, *cut.tolist()]
                groups = [(r, at[a:b]) for r, a, b in zip(rank[first].tolist(), first, [*first[1:], len(at)])]
            new = []
            for r, where in groups:
                if r in index:
                    index[r].append(where)
                else:
                    index[r] = [where]
                    new.append(r)
            return new

        at = np.flatnonzero(nxt >= 0).astype(np.int32)
        pair[at] = self.rank(token[at], token[at + 1])
        heap = enter(at, pair[at])
        heapify(heap)
        while heap:
            r = heappop(heap)
            found = index.pop(r)
            at = found[0] if len(found) == 1 else np.concatenate(found)
            at = at[pair[at] == r]
            if len(at) > 1:
                at = np.unique(at)
                if self.rising[r]:  # all but those that share a token with one before
                    touch = np.concatenate([[False], nxt[at[:-1]] == at[1:]])
                    run = np.arange(len(at)) - np.maximum.accumulate(np.where(touch, 0, np.arange(len(at))))
                    at = at[run % 2 == 0]
                    lead = np.ones(len(at), bool)
                else:
                    w = word[at]
                    lead = np.concatenate([[True], w[1:] != w[:-1]])
                if not lead.all():
                    index[r] = [at[~lead]]
                    heappush(heap, r)
                    at = at[lead]
            elif not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            token[at] = r
            token[gone] = -1
            pair[gone] = -1
            nxt[at] = after
            right = after >= 0
            prv[after[right]] = at[right]
            pair[at] = -1
            has = at[right]
            pair[has] = self.rank(token[has], token[after[right]])
            before = prv[at]
            before = before[before >= 0]
            pair[before] = self.rank(token[before], token[nxt[before]])
            touched = np.concatenate([has, before])
            for x in enter(touched, pair[touched]):
                heappush(heap, x)
        return token, bounds


class Codec:
    """Encodes and decodes whole texts with the pieces that a pattern matches."""

    def __init__(self, path: str, pattern: str):
        self.table, self.find = MergeTable.of(path), regex.compile(pattern).findall

    def block(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[list[int]]]:
        """For each text the numbers of its pieces, and the ids of each piece."""
        known: dict[str, int] = {}
        rows = []
        for t in texts:
            rows.append(np.array([known.setdefault(w, len(known)) for w in self.find(t or "")], np.int32))
        return rows, self.table.encode([w.encode() for w in known])

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        rows, ids = self.block(texts)
        return [[x for w in row.tolist() for x in ids[w]] for row in rows]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.table.bytes_of[i] for i in ids])


class Spelled:
    """Distinct pieces, each with its number of ids, these in decimals, and the bytes that they spell. Beyond KEPT pieces or KEPT_CHARS it starts anew."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.many, self.digits, self.back, self.chars = [], [], [], 0

    def rows(self, texts: pa.Array) -> list[np.ndarray]:
        """Numbers of the pieces of each text, which hold until the next call."""
        if len(self.known) > KEPT or self.chars > KEPT_CHARS:
            self._clear()
        known, rows, old = self.known, [], len(self.known)
        for t in texts:
            rows.append(np.array([known.setdefault(w, len(known)) for w in self.codec.find(t.as_py() or "")], np.int32))
        for ids in self.codec.table.encode([w.encode() for w in islice(known, old, None)]):
            self.many.append(len(ids))
            self.digits.append(",".join(map(str, ids)))
            self.back.append(self.codec.decode(ids))
            self.chars += len(self.back[-1])
        return rows


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the token ids of the text."""

    def run(batches):
        codec = Codec(path, pattern)
        for b in pieces(batches):
            ids = codec.encode(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    docs = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text that the ids spell."""

    def run(batches):
        table = MergeTable.of(path)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                texts = [b"".join([table.bytes_of[i] for i in ids or []]).decode(errors="replace") for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    encoded = encoded.select("doc_id", "ids")
    return encoded.mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def digests(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Batches of texts and other columns: these, and the counts and digests of the texts."""
    spelled = Spelled(Codec(path, pattern))
    for b in pieces(batches, most=BLOCK_BYTES):
        n, a, z = [], [], []
        for row in spelled.rows(b.column(0)):
            words = row.tolist()
            n.append(sum([spelled.many[w] for w in words]))
            a.append(hashlib.sha256(",".join([spelled.digits[w] for w in words]).encode()).hexdigest())
            z.append(hashlib.sha256(b"".join([spelled.back[w] for w in words])).hexdigest())
        yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(z, pa.string())], names=[*b.schema.names[1:], "n_tokens", "ids_sha256", "decoded_sha256"])


def digest(docs: DataFrame, path: str, pattern: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Counts and digests of the ids and of the decoded bytes, after the given other columns."""
    kept = ["doc_id", *extra]
    docs = docs.select(docs["text"].cast("string").alias("text"), *kept)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.mapInArrow(lambda batches: digests(batches, path, pattern), f"{schema}, n_tokens long, ids_sha256 string, decoded_sha256 string")
