"""Language-model scoring: causal self-attention over subword ids, in numpy.

Words (A-Z in lower case) are spelled in ids of a public byte-level vocabulary; each text ends in one more id. The
probability of an id is that of its class (CLASSES classes of equal mass) times that of the id within its class.

* Tables, counted over all training texts: how often each id is followed, and preceded, by each class. They give every id its
  embedding (their leading directions), the prior of the next class given the id before, and the id's probability within its class
  given the class before. They grow with the corpus in their counts, with the vocabulary alone in their size.
* Pairs of successive ids, counted over all training texts as packed arrays that tasks of a shuffle merge. The most frequent ones, PAIRS
  at most, are kept: given the id before, a kept pair has its own share of its class (discounted), and what is left goes to the class's
  ids as the table above says. The shares of a class sum to one, whatever is kept.
* One causal attention head over windows of CONTEXT inputs, each an id's embedding and a place, moves the logits of the prior.
  Its weights are fitted on every window of every training text, each block once: the first block by one task, then a quarter
  of the blocks and then the rest by all tasks, each in Adam steps of its own from the weights before, which are averaged at the
  end of the round. A step takes BATCH windows and predicts every place of them, so steps grow with the corpus.

Blocks follow the partitions, and the head's weights are averages over tasks, so clusters of two sizes give scores that differ slightly; counts, base scores
and tables do not depend on that.

Scoring windows overlap by LEAD inputs: each id is scored once, with at least LEAD inputs before it where the text has them;
windows are batched and masked causally. A text trains if crc32(id) mod 10 is not 0.

Texts are spelled once, in blocks of about BLOCK_BYTES, and kept as compressed ids. A block's distinct words meet the counts of
the whole corpus through a shuffle by ranges of their 64-bit hash, packed by block and range, and come back to the block: no
vocabulary of words is broadcast, and no word is a row.

Defined cases: null and empty texts have the end token alone; a null id counts as the empty text and is held
out; repeated rows count and are scored one by one; a very long text is a block of its own (about 60 bytes of memory for each of
its bytes while it is spelled); without training texts every count is 0, the classes are even and the head stays as it began;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import counted_keys, drop, opened, pieces, pressed, stage, texts_of, words_of

BLOCK_BYTES, SLICE = 8 << 20, 1 << 20
CLASSES, WIDTH, CONTEXT, LEAD = 64, 16, 32, 8
BATCH, RUN = 32, 16
ROWS = 1024  # places whose logits are held at once, so that they stay in the cache
#: Strength of the wider distribution in the two tables.
PRIOR = 20
#: Pairs that are kept, what each gives to the wider distribution, and the strength of that besides.
PAIRS, DISCOUNT, PAIR_PRIOR = 1 << 20, 0.7, 2.0
#: Rates of the steps: of the first block, which one task takes; of the next quarter; of the rest.
ROUNDS = (0.01, 0.003, 0.002)
SHIFT = 20  # places of a run of pairs that is sorted: a key of two ids has 44 bits at most
SORTED = 1 << SHIFT
BUCKET = 2 << 20  # words of blocks that meet in a task to be counted
SLOTS = 64  # groups in which the tasks' weights are averaged
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.tril(np.ones((CONTEXT, CONTEXT), np.float32))
_ONES = np.ones((CLASSES, 1), np.float32)
_TWICE = np.full((WIDTH + 1, 1), -2, np.float32)
_TWICE[WIDTH] = 0
_CODERS: dict = {}


def coder(path: str, pattern: str):
    if path not in _CODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _CODERS[path] = tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _CODERS[path]


# --- the model ---------------------------------------------------------------------------------


@dataclass
class Tables:
    """Of every id: class, embedding, log prior of the next class, and log probability within its class for each class before.

    pairs: sorted keys of kept pairs (id before * number of ids + id), and the log probability of each within the class; rest: of each id before and
    class, the log share that goes to the class's ids by `inside`.
    """

    kind: np.ndarray
    near: np.ndarray
    prior: np.ndarray
    inside: np.ndarray
    pairs: tuple[np.ndarray, np.ndarray] | None = None
    rest: np.ndarray | None = None

    def log_inside(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """log probability of ids within their classes, given the ids before."""
        out = np.empty(len(x), np.float32)
        keys, logs = self.pairs or (out[:0], out[:0])
        for lo in range(0, len(x), SORTED):
            a, b = x[lo : lo + SORTED], y[lo : lo + SORTED]
            out[lo : lo + SORTED] = self.inside.take(b * CLASSES + self.kind[a])
            if len(keys):
                out[lo : lo + SORTED] += self.rest.take(a * CLASSES + self.kind[b])
                # in order, so that the search goes through the kept pairs once: the key above, its place below
                key = np.sort((a * len(self.kind) + b).astype(np.uint64) << np.uint64(SHIFT) | np.arange(len(a), dtype=np.uint64))
                place, key = lo + (key & np.uint64(SORTED - 1)).astype(np.int64), (key >> np.uint64(SHIFT)).astype(keys.dtype)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                met = np.flatnonzero(keys[at] == key)
                out[place[met]] = logs[at[met]]
        return out


def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each id, by shares of the count mass in order of count; the id's share of its class."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    mass = (counts + 0.1)[order]
    up = np.cumsum(mass) / mass.sum()
    kind = np.empty(len(counts), np.int64)
    kind[order] = np.minimum((up - mass / mass.sum() / 2) * CLASSES, CLASSES - 1).astype(np.int64)
    return kind, (counts + 0.1) / np.bincount(kind, counts + 0.1, CLASSES)[kind]


def tables_of(counts: np.ndarray, after: np.ndarray, ahead: np.ndarray) -> Tables:
    """counts of ids; after[i, c]: how often class c follows id i; ahead[i, c]: how often it stands before."""
    kind, share = classes_of(counts)
    whole = np.bincount(kind, counts + 0.1, CLASSES) + 0.1
    whole /= whole.sum()
    mixed = lambda n: (n + PRIOR * whole) / (n.sum(1, keepdims=True) + PRIOR)
    prior = np.log(mixed(after)).astype(np.float32)
    of_class = np.zeros((CLASSES, CLASSES))
    np.add.at(of_class, kind, ahead)
    inside = np.log((ahead + PRIOR * share[:, None]) / (of_class[kind] + PRIOR)).astype(np.float32)
    # the leading directions of both tables, each id weighted by its count
    around = np.concatenate([prior - np.log(whole), np.log(mixed(ahead) / whole)], 1)
    weight = np.sqrt(counts + 1)[:, None]
    _, axes = np.linalg.eigh((around * weight).T @ (around * weight))
    near = around @ axes[:, -WIDTH:]
    near /= np.sqrt((near**2 * weight**2).sum(0) / (weight**2).sum()) + 1e-6
    return Tables(kind, near.astype(np.float32), prior, inside)


def with_pairs(t: Tables, after: np.ndarray, keys: np.ndarray, n: np.ndarray) -> Tables:
    """The tables with the counts n of kept pairs; after[i, c] as in tables_of."""
    many = len(t.kind)
    x, y = keys // many, keys % many
    cell = x * CLASSES + t.kind[y]
    kept, kinds = np.bincount(cell, n, many * CLASSES), np.bincount(cell, minlength=many * CLASSES)
    total = after.ravel()
    left = np.maximum(total - kept, 0) + DISCOUNT * kinds + PAIR_PRIOR
    logs = np.log((n - DISCOUNT + left[cell] * np.exp(t.inside[y, t.kind[x]])) / (total[cell] + PAIR_PRIOR))
    small = np.uint32 if many * many < 1 << 32 else np.uint64
    return replace(t, pairs=(keys.astype(small), logs.astype(np.float32)), rest=np.log(left / (total + PAIR_PRIOR)).astype(np.float32).reshape(many, CLASSES))


class Head:
    """One causal attention head: places p, queries with keys and values w, output o and its bias b.

    The weights lie end to end in one array, which a step moves as a whole; `w` has views of it. Inputs, values and what is mixed of them have a last
    column of halves, so that sums over keys and the bias come with the products; what the weights hold for it never moves.
    """

    def __init__(self, tables: Tables, weights: dict[str, np.ndarray] | None = None):
        r = np.random.default_rng(7)
        n = lambda *s: (r.normal(size=s) * 0.1).astype(np.float32)
        self.t = tables
        self.near = np.pad(tables.near, ((0, 0), (0, 1)), constant_values=0.5)
        self.w = weights or {"p": n(CONTEXT, WIDTH), "w": n(WIDTH, 3 * WIDTH) * 2, "o": np.zeros((WIDTH, CLASSES), np.float32), "b": np.zeros(CLASSES, np.float32)}

    @property
    def w(self) -> dict[str, np.ndarray]:
        return self.views

    @w.setter
    def w(self, weights: dict[str, np.ndarray]) -> None:
        self.flat = np.zeros(_PARTS[-1], weights["p"].dtype)
        self.views = _named(self.flat)
        for name, v in weights.items():
            self.views[name][...] = v
        _parts(self.flat)[1][-1, -1] = 1

    def attend(self, x: np.ndarray, low: int = 0, known: np.ndarray | None = None):
        """Windows of inputs; queries from place `low` on. The last value: what the logits of the next class at each of them follow from.

        known: of each id what it gives to queries, keys and values, where the weights no longer move; then the first value begins at `low`.
        """
        many, n = x.shape
        place, to, _ = _parts(self.flat)
        h = self.near.take(x if known is None else x[:, low:], 0)
        at = place[:n] if known is None else place[low:n]
        h = np.add(h, at, out=h if h.dtype == at.dtype else None)
        if known is None:
            qkv = (h.reshape(-1, WIDTH + 1) @ to.T).reshape(many, n, 3 * WIDTH + 1)
        else:
            qkv = known.take(x, 0)
            qkv += place[:n] @ to.T
        a = qkv[:, low:, :WIDTH] @ qkv[..., WIDTH : 2 * WIDTH].transpose(0, 2, 1)
        np.clip(a, -30, 30, out=a)
        np.exp(a, out=a)
        a *= _MASK[low:n, :n]
        mixed = (a @ qkv[..., 2 * WIDTH :]).reshape(-1, WIDTH + 1)
        part = 0.5 / mixed[:, WIDTH:]
        mixed *= part
        return h, qkv, a, part, mixed, (h[:, low - n :] + mixed.reshape(many, n - low, WIDTH + 1)).reshape(-1, WIDTH + 1)

    def mass(self, m: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Exponentials of the logits of the next class, behind inputs x."""
        out = _parts(self.flat)[2]
        z = m @ out.T
        if max(m.max(), -m.min()) * np.abs(out).sum(1).max() > 20:  # else no logit is
            np.clip(z, -20, 20, out=z)
        z += self.t.prior.take(x, 0)
        return np.exp(z, out=z)

    def step(self, x: np.ndarray, y: np.ndarray, low: int, state: dict, rate: float) -> float:
        """One Adam step on the mean negative log-likelihood of the classes y behind the queries; y < 0 is not counted."""
        many, n = x.shape
        h, qkv, a, part, mixed, m = self.attend(x, low)
        _, to, out = _parts(self.flat)
        grown = np.empty_like(self.flat)
        by_place, by_to, by_out = _parts(grown)
        x, y = x[:, low:].ravel(), y.ravel()
        on = y >= 0
        total = np.count_nonzero(on)
        z = self.mass(m, x)
        pick = np.arange(0, z.size, CLASSES)
        pick += y if total == len(y) else np.maximum(y, 0)
        s, at = (z @ _ONES)[:, 0], z.take(pick)
        loss = -float(np.log(at / s + 1e-30) @ on.astype(z.dtype)) / total
        # the slopes by logits are z with s taken off where y is, in shares of s: what follows from z is multiplied, not z
        z.put(pick, at - s)
        s *= total
        share = (on / s).astype(z.dtype, copy=False)[:, None]
        np.matmul(z.T, m * share, out=by_out)
        dm = z @ out
        dm *= share
        # the slopes by attention's weights are in shares of their sums; the values' halves take the mean slope off
        dp = dm * part
        np.matmul(mixed * dp, _TWICE, out=dp[:, WIDTH:])
        dp = dp.reshape(many, n - low, WIDTH + 1)
        da = dp @ qkv[..., 2 * WIDTH :].transpose(0, 2, 1)
        da *= a
        d = np.zeros_like(qkv) if low else np.empty_like(qkv)
        np.matmul(da, qkv[..., WIDTH : 2 * WIDTH], out=d[:, low:, :WIDTH])
        np.matmul(da.transpose(0, 2, 1), qkv[:, low:, :WIDTH], out=d[..., WIDTH : 2 * WIDTH])
        np.matmul(a.transpose(0, 2, 1), dp, out=d[..., 2 * WIDTH :])
        np.matmul(d.reshape(-1, 3 * WIDTH + 1).T, h.reshape(-1, WIDTH + 1), out=by_to)
        one = np.ones(many, d.dtype)
        np.matmul((one @ d.reshape(many, -1)).reshape(n, -1), to, out=by_place[:n])
        by_place[low:n] += (one @ dm.reshape(many, -1)).reshape(n - low, -1)
        by_place[n:] = 0
        self.move(grown, state, rate)
        return loss

    def move(self, grown: np.ndarray, state: dict, rate: float) -> None:
        """Adam on all weights at once, in place; state has the two means by the names of the weights."""
        if "all" not in state:
            state["t"], state["all"] = 0, (np.zeros_like(grown), np.zeros_like(grown))
            state |= {name: tuple(_named(x)[name] for x in state["all"]) for name in self.views}
        t = state["t"] = state["t"] + 1
        m1, m2 = state["all"]
        m1 *= 0.9
        m1 += 0.1 * grown
        grown *= grown
        grown *= 0.01
        m2 *= 0.99
        m2 += grown
        np.sqrt(m2, out=grown)
        grown *= (1 - 0.99**t) ** -0.5
        grown += 1e-8
        np.divide(m1, grown, out=grown)
        grown *= _MOVES
        grown *= rate / (1 - 0.9**t)
        self.flat -= grown

    def known(self) -> np.ndarray:
        """See attend."""
        return self.near @ _parts(self.flat)[1].T

    def log_class(self, x: np.ndarray, y: np.ndarray, low: int = 0, known: np.ndarray | None = None) -> np.ndarray:
        """log probability of the class y behind each query."""
        m, of, y = self.attend(x, low, known)[-1], x[:, low:].ravel(), y.ravel()
        got = np.empty(len(y), m.dtype)
        for lo in range(0, len(y), ROWS):
            z = self.mass(m[lo : lo + ROWS], of[lo : lo + ROWS])
            np.divide(z.take(np.arange(0, z.size, CLASSES) + y[lo : lo + ROWS]), (z @ _ONES)[:, 0], out=got[lo : lo + ROWS])
        return np.log(got, out=got).reshape(len(x), -1)


#: Where the places, the rows of w (turned, with a row for the values' halves) and of o (turned, with b behind) end among the weights.
_PARTS = tuple(np.cumsum([n * (WIDTH + 1) for n in (CONTEXT, 3 * WIDTH + 1, CLASSES)]).tolist())


def _parts(flat: np.ndarray) -> list[np.ndarray]:
    return [flat[a:z].reshape(-1, WIDTH + 1) for a, z in zip((0, *_PARTS), _PARTS)]


def _named(flat: np.ndarray) -> dict[str, np.ndarray]:
    place, to, out = _parts(flat)
    return {"p": place[:, :WIDTH], "w": to[:-1, :WIDTH].T, "o": out[:, :WIDTH].T, "b": out[:, WIDTH]}


#: 1 for weights that steps move, 0 for what stands beside them.
_MOVES = np.zeros(_PARTS[-1], np.float32)
for _v in _named(_MOVES).values():
    _v[...] = 1


def laid_out(size: np.ndarray, step: int = CONTEXT - LEAD) -> tuple[np.ndarray, np.ndarray]:
    """Windows over texts of so many ids: text, and first input within the text."""
    count = 1 + np.maximum(0, -(-(size - CONTEXT) // step))
    text = np.repeat(np.arange(len(size)), count)
    return text, (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * step


def before(ids: np.ndarray, size: np.ndarray, start: int) -> np.ndarray:
    """What stands before each id of texts end to end; start before the first of a text."""
    x = np.empty(len(ids), np.int64)
    x[1:] = ids[:-1]
    x[np.cumsum(size) - size] = start
    return x


def fit(head: Head, ids: np.ndarray, size: np.ndarray, state: dict, rate: float) -> list[float]:
    """Goes once over all windows of the texts and every place of them, in steps of BATCH windows; gives the steps' losses."""
    x, y, ends = before(ids, size, len(head.t.kind) - 1), head.t.kind[ids], np.cumsum(size)
    text, first = laid_out(size, CONTEXT)
    order = np.random.default_rng(len(text)).permutation(len(text))
    first, last = (ends - size)[text[order]] + first[order], ends[text[order]]
    losses = []
    for lo in range(0, len(first), RUN * BATCH):  # windows of RUN steps are laid out at once
        start, end = first[lo : lo + RUN * BATCH, None], last[lo : lo + RUN * BATCH, None]
        at = start + np.arange(CONTEXT)
        inside = at < end
        np.minimum(at, end - 1, out=at)
        xs, ys = x[at], np.where(inside, y[at], -1)
        widest = np.maximum.reduceat((end - start)[:, 0], np.arange(0, len(start), BATCH))
        for k, n in enumerate(np.minimum(widest, CONTEXT).tolist()):
            these = slice(k * BATCH, (k + 1) * BATCH)
            losses.append(head.step(xs[these, :n], ys[these, :n], 0, state, rate))
    return losses


def score(head: Head, ids: np.ndarray, size: np.ndarray, batch: int = 256) -> np.ndarray:
    """log10 probability of every id of texts end to end, each with its end."""
    x, kind, ends = before(ids, size, len(head.t.kind) - 1), head.t.kind, np.cumsum(size)
    y, out, known = kind[ids], np.empty(len(ids), np.float32), head.known()
    text, inner = laid_out(size)
    for low, which in ((0, np.flatnonzero(inner == 0)), (LEAD, np.flatnonzero(inner > 0))):
        first, last = (ends - size)[text[which]] + inner[which], ends[text[which]]
        # windows of like length go together, so that few places are empty
        order = np.argsort(np.minimum(last - first, CONTEXT), kind="stable")
        first, last = first[order], last[order]
        for lo in range(0, len(first), batch):
            end = last[lo : lo + batch, None]
            at = first[lo : lo + batch, None] + np.arange(min(CONTEXT, int((end[:, 0] - first[lo : lo + batch]).max())))
            if (last[lo : lo + batch] - first[lo : lo + batch]).min() >= at.shape[1]:
                to = at[:, low:]
                out[to] = head.log_class(x.take(at), y.take(to), low, known)
            else:
                inside = (at < end)[:, low:]
                at = np.minimum(at, end - 1)
                out[at[:, low:][inside]] = head.log_class(x[at], y[at[:, low:]], low, known)[inside]
    return (out + head.t.log_inside(x, ids)) * np.float32(1 / np.log(10))


# --- words and ids of a block --------------------------------------------------------------------


def spelled(words: list[bytes], encoding) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, each with a space before, end to end; and how many each word has.

    The words are encoded in one call: a piece never goes on past a space, so a word's ids end where its bytes do.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids = np.array(encoding.encode_ordinary((b" " + b" ".join(words)).decode("utf-8", "replace")), np.int64)
    ends = np.cumsum(_lengths(encoding)[ids])
    last = np.cumsum([len(w) + 1 for w in words])
    at = np.searchsorted(ends, last)
    if at[-1] < len(ends) and (ends[at] == last).all():
        return ids, np.diff(at + 1, prepend=0)
    each = [encoding.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in words]  # odd white space or broken bytes
    return np.array([i for x in each for i in x], np.int64), np.array([len(x) for x in each], np.int64)


def _lengths(encoding) -> np.ndarray:
    """How many bytes each id spells."""
    if encoding.name + ".lengths" not in _CODERS:
        _CODERS[encoding.name + ".lengths"] = np.array([len(encoding.decode_single_token_bytes(i)) for i in range(encoding.n_vocab)], np.int64)
    return _CODERS[encoding.name + ".lengths"]


class Block:
    """Texts of one block, slice by slice: the distinct words of each slice, and for each word of a text its number there."""

    def __init__(self, end_id: int):
        self.end, self.hash, self.words, self.parts = end_id, [], [], []
        self.many = 0

    def add(self, texts: pa.Array, docs: pa.Array, held: np.ndarray) -> None:
        data, off = texts_of(texts)
        data = _LOWER[data]
        start, end, doc, word = words_of(data, off)
        found = pa.array(word).dictionary_encode()
        of = found.indices.to_numpy()
        best = np.maximum.accumulate(of) if len(of) else of
        first = np.flatnonzero(np.concatenate([[True], best[1:] > best[:-1]])) if len(of) else of
        raw = data.tobytes()
        self.words += [raw[x:y] for x, y in zip(start[first].tolist(), end[first].tolist())]
        self.hash.append(found.dictionary.to_numpy())
        self.parts.append((of + np.int32(self.many), np.bincount(doc, minlength=len(texts)).astype(np.int32), docs, held))
        self.many += len(first)

    def closed(self, encoding) -> dict:
        """Everything about the block: hashes of its words (sorted) and their training counts, the order of their frequency, ids and sizes of texts.

        Words of texts (of) are places in that order, so that their upper bytes are mostly 0.
        """
        hashes, first, back = np.unique(np.concatenate(self.hash), return_index=True, return_inverse=True)
        of = back[np.concatenate([p[0] for p in self.parts])].astype(np.uint32)
        words, held = (np.concatenate([p[k] for p in self.parts]) for k in (1, 3))
        trains = ~np.repeat(held, words)
        count = np.bincount(of[trains], minlength=len(hashes))
        order = np.argsort(-np.bincount(of, minlength=len(hashes)), kind="stable").astype(np.uint32)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        of = rank[of]
        flat, size = spelled([self.words[i] for i in first[order].tolist()], encoding)
        ids = stream(flat, size, of, words, self.end)
        return {"hash": hashes, "count": count, "order": order, "of": of, "words": words, "held": held, "docs": pa.concat_arrays([p[2] for p in self.parts]), "ids": ids[0], "sizes": ids[1]}


def stream(flat: np.ndarray, size: np.ndarray, of: np.ndarray, words: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts end to end, each with end_id behind, and how many each text has; flat holds the ids of all words, size how many a word has."""
    per, first = size[of], np.cumsum(size) - size
    total, small = int(per.sum()), np.uint16 if end_id < 1 << 16 else np.uint32
    at = np.arange(total) + np.repeat(first[of] - (np.cumsum(per) - per), per)
    upto = np.concatenate([[0], np.cumsum(per)])[np.concatenate([[0], np.cumsum(words)])]
    ids = flat.astype(small)[at] if total else np.zeros(0, small)
    return np.insert(ids, upto[1:], end_id), np.diff(upto) + 1


def packed(values: np.ndarray, ranked: bool = False) -> bytes:
    """Compressed: places by falling frequency for the values (unless they are that), byte by byte, since the upper bytes are then mostly 0."""
    table = values[:0]
    if not ranked:
        n = np.bincount(values)
        table = np.argsort(-n, kind="stable")[: np.count_nonzero(n)].astype(values.dtype)
        rank = np.zeros(len(n), values.dtype)
        rank[table] = np.arange(len(table))
        values = rank[values]
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()
    return len(table).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(table.tobytes() + planes)


def unpacked(data: bytes, kind) -> np.ndarray:
    size, many = np.dtype(kind).itemsize, int.from_bytes(data[:8], "little")
    raw = zstandard.ZstdDecompressor().decompress(data[8:])
    table, planes = np.frombuffer(raw, kind, many), np.frombuffer(raw, np.uint8, offset=many * size)
    values = np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()
    return table[values] if many else values


def _held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0


def spelled_blocks(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Two kinds of rows: blocks (texts' ids, words' places in the block's list, both packed, and how many of each a text has; the list's hashes with
    their counts in training texts, packed, and the order of the list); ids (block null, idx, how often in training texts)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "turn", "idx", "c", "docs", "held", "words", "sizes", "ids", "of", "many", "h", "n", "order"]

    def run(batches):
        encoding, types = coder(path, pattern), {}
        end, per_id = encoding.n_vocab, np.zeros(encoding.n_vocab + 1, np.int64)

        def rows(n, /, **columns):
            return pa.RecordBatch.from_arrays([columns.get(x) if x in columns else pa.nulls(n, t) for x, t in types.items()], names=names)

        def closed(held: Block):
            x, block = held.closed(encoding), uuid.uuid4().int >> 65
            per_id[:] += np.bincount(x["ids"][np.repeat(~x["held"], x["sizes"])], minlength=end + 1)
            one = lambda v, t=None: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v if t is None else pa.array(v, t))
            ids = packed(x["ids"])
            mine = {"docs": one(x["docs"]), "held": one(x["held"], pa.bool_()), "words": one(x["words"], pa.int32()), "sizes": one(x["sizes"], pa.int32())}
            mine |= {k: pa.array([v], pa.binary()) for k, v in zip(("ids", "of", "h", "n", "order"), (ids, packed(x["of"], True), *pressed(x["hash"], x["count"]), packed(x["order"], True)))}
            yield rows(1, block=pa.array([block]), turn=pa.array([zlib.crc32(ids) >> 1], pa.int32()), many=pa.array([len(x["hash"])], pa.int64()), **mine)

        held, size = Block(end), 0
        for b in pieces(batches, most=SLICE):
            if not types:
                types = dict(zip(names, [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(b.column(0).type), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]))
            held.add(b.column(2), b.column(0), b.column(1).to_numpy(zero_copy_only=False))
            size += b.column(2).nbytes
            if size >= BLOCK_BYTES:
                yield from closed(held)
                held, size = Block(end), 0
        if held.parts:
            yield from closed(held)
        k = np.flatnonzero(per_id)
        if len(k):
            yield rows(len(k), idx=pa.array(k.astype(np.int32)), c=pa.array(per_id[k]))

    docs = docs.select("doc_id", _held_out().alias("held"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, f"block long, turn int, idx int, c long, docs array<{kind}>, held array<boolean>, words array<int>, sizes array<int>, ids binary, of binary, many long, h binary, n binary, order binary")


def counted_words(blocks: DataFrame, most: int = BUCKET) -> DataFrame:
    """How often the words of each block stand in all training texts: a written table of block, bucket and c, counts packed in the order of the words' hashes.

    A bucket is a range of hashes with about `most` words of all blocks. Rows without a block have a bucket's sums: n (occurrences) and v (distinct words).
    """
    total = blocks.agg(F.sum("many")).head()[0] or 0
    buckets = max(64, -(-total // most))

    def dealt(batches):
        for b in batches:
            for block, h, n in zip(*b.columns):
                keys, n = opened(h.as_py(), n.as_py())
                bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else bucket
                packs = [pressed(keys[a:z], n[a:z]) for a, z in zip(first.tolist(), [*first[1:].tolist(), len(keys)])]
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()] * len(first), pa.int64()), pa.array(bucket[first]), *[pa.array([p[k] for p in packs], pa.binary()) for k in (0, 1)]], names=["block", "bucket", "h", "n"])

    def met(t: pa.Table) -> pa.Table:
        parts = [opened(h.as_py(), n.as_py()) for h, n in zip(t.column("h"), t.column("n"))]
        keys, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        ends = np.cumsum([len(p[0]) for p in parts])
        for (_, n), z in zip(parts, ends.tolist()):
            sums[which[z - len(n) : z]] += n  # a block has a word once
        each = [packed(sums[which[z - len(n) : z]], True) for (_, n), z in zip(parts, ends.tolist())]
        none, bucket = [None] * len(parts), t.column("bucket")[0].as_py()
        return pa.table({"of_block": pa.array([*t.column("block").to_pylist(), None], pa.int64()), "bucket": pa.array([bucket] * (len(parts) + 1), pa.int64()), "c": pa.array([*each, None], pa.binary()),
                         "n": pa.array([*none, int(sums.sum())], pa.int64()), "v": pa.array([*none, np.count_nonzero(sums)], pa.int64())})

    return stage(blocks.select("block", "h", "n").mapInArrow(dealt, "block long, bucket long, h binary, n binary").groupBy("bucket").applyInArrow(met, "of_block long, bucket long, c binary, n long, v long"))


def _training(b: pa.RecordBatch, small):
    """Ids and sizes of the training texts of each block of a batch with held, sizes and ids."""
    for held, sizes, ids in zip(*(b.column(b.schema.get_field_index(c)) for c in ("held", "sizes", "ids"))):
        size, trains = sizes.values.to_numpy().astype(np.int64), ~held.values.to_numpy(zero_copy_only=False)
        yield unpacked(ids.as_py(), small)[np.repeat(trains, size)].astype(np.int64), size[trains]


def _size_class(n: np.ndarray) -> np.ndarray:
    """Counts in steps of a sixteenth of a doubling: at most 1,024 of them."""
    return np.floor(np.log2(n) * 16).astype(np.int64)


def counted_pairs(blocks: DataFrame, many: int) -> DataFrame:
    """Every pair of successive ids in training texts (id before * many + id) and its count, as counted_keys writes them."""
    small = np.uint16 if many <= 1 << 16 else np.uint32

    def keys_of(batches):
        for b in batches:
            for ids, size in _training(b, small):
                if len(ids):
                    yield (before(ids, size, many - 1) * many + ids).astype(np.uint64)

    return counted_keys(blocks.select("held", "sizes", "ids"), keys_of, max(16, blocks.count()))


def frequent_pairs(blocks: DataFrame, many: int, most: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the most frequent pairs of successive ids in training texts, `most` at most; pairs of one size class are kept or left together."""
    counted = counted_pairs(blocks, many)
    out = _most_frequent(counted, most)
    drop(counted)
    return out


def _most_frequent(counted: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    def sizes_of(batches):
        total = np.zeros(1024, np.int64)
        for b in batches:
            for a, c in zip(b.column(0), b.column(1)):
                total += np.bincount(_size_class(opened(a.as_py(), c.as_py())[1]), minlength=1024)
        s = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(total[s])], names=["s", "n"])

    sizes = np.zeros(1024, np.int64)
    for r in counted.mapInArrow(sizes_of, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).collect():  # 1,024 rows at most
        sizes[r["s"]] = r["n"]
    least = int(np.argmax(np.cumsum(sizes[::-1])[::-1] <= most))  # the least size class from which on there are no more than `most`

    def chosen(batches):
        for b in batches:
            for a, c in zip(b.column(0), b.column(1)):
                keys, n = opened(a.as_py(), c.as_py())
                on = _size_class(n) >= least
                yield pa.RecordBatch.from_arrays([pa.array(keys[on].astype(np.int64)), pa.array(n[on])], names=["key", "n"])

    got = counted.mapInArrow(chosen, "key long, n long").toArrow()  # `most` rows at most
    keys, n = got.column("key").to_numpy(), got.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def tables(blocks: DataFrame, counts: np.ndarray) -> Tables:
    """Summed over the counted pairs of all blocks; as many numbers as ids times classes, whatever the input."""
    kind, n = classes_of(counts)[0], len(counts)
    counted = counted_pairs(blocks, n)

    def run(batches):
        both = np.zeros((2, n * CLASSES), np.int64)
        for b in batches:
            for keys, times in zip(*b.columns):
                keys, times = opened(keys.as_py(), times.as_py())
                x, y = np.divmod(keys.astype(np.int64), n)
                np.add.at(both[0], x * CLASSES + kind[y], times)
                np.add.at(both[1], y * CLASSES + kind[x], times)
        k = np.flatnonzero(both.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (k, both[0][k], both[1][k])], names=["k", "after", "ahead"])

    got = counted.mapInArrow(run, "k long, after long, ahead long").groupBy("k").agg(F.sum("after").alias("after"), F.sum("ahead").alias("ahead")).toArrow()
    out = np.zeros((2, n * CLASSES))
    for i, c in enumerate(("after", "ahead")):
        out[i][got.column("k").to_numpy()] = got.column(c).to_numpy()
    out = out.reshape(2, n, CLASSES)
    pairs = _most_frequent(counted, PAIRS)
    drop(counted)
    return with_pairs(tables_of(counts, *out), out[0], *pairs)


def trained(blocks: DataFrame, table: Tables) -> Head:
    """The head after all rounds; a task's weights count as many times as it has ids."""
    head = Head(table)
    small = np.uint16 if len(table.kind) <= 1 << 16 else np.uint32
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast((table.kind, table.near, table.prior))
    turn = F.col("turn")
    least, quarter = blocks.agg(F.min(turn), F.percentile_approx(turn, 0.25)).head()
    if least is None:
        return head
    for which, rate in zip((turn == least, (turn > least) & (turn <= quarter), (turn > least) & (turn > quarter)), ROUNDS):
        flat = np.concatenate([head.w[k].ravel() for k in head.w])
        shapes = {k: v.shape for k, v in head.w.items()}

        def run(batches, flat=flat, rate=rate):
            kind, near, prior = shared.value
            own, state, n = Head(Tables(kind, near, prior, None), _unflat(flat, shapes)), {}, 0
            for b in batches:
                for ids, size in _training(b, small):
                    if len(size):
                        fit(own, ids, size, state, rate)
                        n += len(ids)
            if n:
                mine = np.concatenate([own.w[k].ravel() for k in own.w])
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % SLOTS], pa.int32()), pa.array([n], pa.int64()), pa.array([mine.tolist()], pa.list_(pa.float64()))], names=["slot", "n", "w"])

        def mean(rows: pa.Table) -> pa.Table:
            n = rows.column("n").to_numpy().astype(np.float64)
            w = np.array([x.values.to_numpy() for x in rows.column("w")])
            return pa.table({"n": pa.array([int(n.sum())], pa.int64()), "w": pa.array([(n @ w / n.sum()).tolist()], pa.list_(pa.float64()))})

        here = blocks.where(which).select("held", "sizes", "ids")
        rows = here.mapInArrow(run, "slot int, n long, w array<double>").groupBy("slot").applyInArrow(mean, "n long, w array<double>").collect()  # SLOTS at most
        if rows:
            total = sum(r["n"] for r in rows)
            head.w = _unflat(sum(np.array(r["w"]) * (r["n"] / total) for r in rows), shapes)
    return head


def _unflat(flat: np.ndarray, shapes: dict[str, tuple]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in shapes.items():
        out[k] = flat[at : at + int(np.prod(s))].reshape(s).astype(np.float32)
        at += int(np.prod(s))
    return out


def scored(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    every = stage(spelled_blocks(docs, path, pattern), compression="zstd")
    n_ids = coder(path, pattern).n_vocab + 1
    counts = np.zeros(n_ids)
    for r in every.where("block is null").groupBy("idx").agg(F.sum("c").alias("c")).collect():  # as many rows as the vocabulary of ids, at most
        counts[r["idx"]] = r["c"]
    blocks = every.where("ids is not null")
    met = counted_words(blocks)
    total = met.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).head()
    ends = int(counts[-1])
    n, v = (total["n"] or 0) + ends, (total["v"] or 0) + (ends > 0)
    table = tables(blocks, counts)
    head = trained(blocks, table)
    # about 800 bytes for each id of the vocabulary and 8 for each kept pair, whatever the input
    model = spark.sparkContext.broadcast((head.w, table))
    floor = np.log10(n + 0.1 * (v + 1))
    small = np.uint16 if n_ids <= 1 << 16 else np.uint32

    def by_head(batches):
        """The blocks with their texts' scores in place of ids and sizes."""
        head = Head(model.value[1], model.value[0])
        for b in batches:
            for k in range(b.num_rows):
                one = b.slice(k, 1)
                ids, size = unpacked(one.column(6)[0].as_py(), small).astype(np.int64), one.column(7)[0].values.to_numpy().astype(np.int64)
                each = np.add.reduceat(score(head, ids, size).astype(np.float64), np.cumsum(size) - size)
                yield pa.RecordBatch.from_arrays([*one.columns[:6], pa.ListArray.from_arrays(pa.array([0, len(each)], pa.int32()), pa.array(each))], names=["block", "docs", "held", "words", "of", "order", "score"])

    def by_words(left, right):
        """A row for each text of a block, with what the counts of its words give."""
        out = []
        each = sorted(zip(right.column("bucket").to_pylist(), right.column("c").to_pylist()))
        for r in range(len(left)):  # one
            get = lambda c: left.column(c)[r]
            count = np.concatenate([np.zeros(0, np.int64), *[unpacked(c, np.int64) for _, c in each]])[unpacked(get("order").as_py(), np.uint32)]
            per, known = np.log10(count + 0.1) - floor, count > 0
            words, of = get("words").values.to_numpy().astype(np.int64), unpacked(get("of").as_py(), np.uint32)
            doc, m = np.repeat(np.arange(len(words)), words), len(words)
            base = np.bincount(doc, per[of], m) + (np.log10(ends + 0.1) - floor)
            known_n = np.bincount(doc, known[of], m).astype(np.int64) + (ends > 0)
            out.append(pa.table([get("docs").values, get("held").values, pa.array(words + 1), pa.array(known_n), pa.array(np.full(m, n, np.int64)), pa.array(base), get("score").values], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out)

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    own = blocks.select("block", "docs", "held", "words", "of", "order", "ids", "sizes").mapInArrow(by_head, f"block long, docs array<{kind}>, held array<boolean>, words array<int>, of binary, order binary, score array<double>")
    return own.groupBy("block").cogroup(met.where("of_block is not null").select("of_block", "bucket", "c").groupBy("of_block")).applyInArrow(by_words, schema)
