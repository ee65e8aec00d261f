"""Language-model scoring with a causal self-attention model in numpy, beside a unigram base.

Base: words and one end for each text, counted over all training documents; a text's base score adds up the
smoothed log10 probabilities. The most frequent words' counts are broadcast (a fixed number of them); all other
words, each at most a small share of all tokens by that choice, are joined with the count table.

Model: words become subword ids of a given tokenizer file. One layer of causal self-attention reads the ids before
an id, and a softmax of two levels gives its probability: of its class, and of its cell in the class, both predicted
from the layer's output. Ids are dealt over classes and cells by their counts over all training documents; some
4,000 have a cell of their own, the rarest share cells by their counts. Weights are learned in numpy from all windows
of all training documents. Windows that follow each other are written as one piece, which holds each id once. Pieces
are dealt over rounds by a hash: in a round each learner goes on from the weights so far, and the learners' weights
are averaged, an id's by how often the learners read it. Learners are as many as the windows ask for, and pieces are
dealt to them and ordered by hashes of doc_id and content, so the weights don't depend on how the input is partitioned. Scoring cuts each text's ids into
overlapping windows: the first half of a window is context only, so every id is scored once, with at least half a
window before it wherever the text has that much. Windows of many texts form one masked batch.

Texts are read twice: once for counts and training windows, once for scores and the words to look up.

Defined cases: a null or empty text is its end alone. Words longer than 64 code points are tokenised in pieces
of 64; very long texts are read whole. Without training documents every count is 0 and all ids are alike. Repeated
rows, and rows that share a doc_id or have none, are scored each for itself; equal texts have equal scores. An empty
table gives no rows. Only doc_id and text are read, whatever else a table holds.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm import tokens
from quillspark.llm.shared import remainder, staged, unstaged

#: The tokenizer file: ranks of byte-level pieces.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the public split pattern of byte-level pair encodings.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Ids scored by a window; it holds as many again before them.
STRIDE = 16
#: Size of the layer, classes, and cells of a class.
WIDTH, CLASSES, CELLS = 16, 64, 64
#: One piece in so many is learned from (1: all); rounds of learning; groups of ids whose weights are averaged together.
EVERY, ROUNDS, GROUPS = 1, 4, 512
#: Windows of a learner in a round, at most and at least half of it wherever there are so many; windows of a piece.
EACH, PIECE = 1 << 17, 16
#: Words whose counts are broadcast; every other word is at most this fraction of the tokens.
HEAD_WORDS = 1 << 16
#: Distinct words that a worker remembers the ids of.
_REMEMBER = 1_600_000
_LONGEST = 64
_U = np.uint64
#: Bytes of ASCII letters, digits and marks, and of the two-byte letters, none of which is a kind of blank.
_PLAIN = np.array([33 <= x <= 126 or x == 195 or 128 <= x <= 191 for x in range(256)])
#: The end of a text among word keys.
END_KEY = _U(0x5DEECE66D1A2B3C4)
#: Logarithms are added up as whole multiples of this, so that no sum depends on its order.
_UNIT = 2.0**-40


class Tokenizer:
    """Subword ids of words, remembered by the words' hashes."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.size = max(table.values()) + 2
        self.end = self.size - 1
        self._encoding = tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})
        self._bytes = np.zeros(self.size, np.int64)
        self._bytes[list(table.values())] = [len(x) for x in table]
        self._forget()

    def _forget(self) -> None:
        self._keys, self._start, self._count, self._flat = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, word: bytes) -> list[int]:
        text = word.decode("utf-8", "replace")
        out: list[int] = []
        for i in range(0, len(text), _LONGEST):
            out += self._encoding.encode_ordinary((" " if i == 0 else "") + text[i : i + _LONGEST])
        return out

    def _encoded(self, b: tokens.Batch, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's number of ids, and all ids. Words that are plain go to the tokenizer as one text, since no piece crosses a blank."""
        raw = b.buf.tobytes()
        words = [raw[i:j] for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
        inside = np.concatenate(([0], np.cumsum(_PLAIN[b.buf])))
        plain = (ends - starts <= _LONGEST) & (inside[ends] - inside[starts] == ends - starts)
        lists: list = [None] * len(words)
        joined = [w for w, p in zip(words, plain.tolist(), strict=True) if p]
        count = np.zeros(len(words), np.int64)
        together = np.zeros(0, np.int32)
        if joined:
            together = self._encoding.encode_to_numpy(" " + b" ".join(joined).decode()).astype(np.int32)
            begin = np.cumsum(self._bytes[together]) - self._bytes[together]
            size = np.array([len(w) + 1 for w in joined])
            count[plain] = np.diff(np.searchsorted(begin, np.append(np.cumsum(size) - size, size.sum())))
        if plain.all():
            return count, together
        for i in np.flatnonzero(~plain):
            lists[i] = self.encode(words[i])
            count[i] = len(lists[i])
        out = np.empty(count.sum(), np.int32)
        out[np.repeat(plain, count)] = together
        out[np.repeat(~plain, count)] = [x for i in np.flatnonzero(~plain) for x in lists[i]]
        return count, out

    def ids(self, b: tokens.Batch, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all words, flat, and each word's number of ids; a place of each distinct word, and which of them
        each word is. keys are hashes of the words as written."""
        distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self._keys) + len(distinct) > _REMEMBER:
            self._forget()
        at = np.searchsorted(self._keys, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self._keys)
        new[inside] = self._keys[at[inside]] != distinct[inside]
        if new.any():
            count, flat = self._encoded(b, starts[first[new]], ends[first[new]])
            start = len(self._flat) + np.cumsum(count) - count
            self._flat = np.concatenate((self._flat, flat))
            place = at[new]  # both are sorted, so the new ones go between the others
            self._keys, self._start, self._count = np.insert(self._keys, place, distinct[new]), np.insert(self._start, place, start), np.insert(self._count, place, count)
            at = np.searchsorted(self._keys, distinct)
        count, start = self._count[at][which], self._start[at][which]
        total = np.cumsum(count)
        flat = np.repeat(start - (total - count), count) + np.arange(total[-1] if len(total) else 0)
        return self._flat[flat], count, first, which


_TOKENIZERS: dict[int, Tokenizer] = {}


def tokenizer_of(ranks: bytes) -> Tokenizer:
    """The tokenizer of this file; a worker keeps one, with the words that it has met."""
    key = hash(ranks)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = Tokenizer(ranks)
    return _TOKENIZERS[key]


@dataclass
class Model:
    """Class, cell and share in the cell of each id, and the weights."""

    cls: np.ndarray
    cell: np.ndarray
    log_share: np.ndarray  # natural logarithms
    weights: dict[str, np.ndarray]


def classed(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, cell and the logarithm of the share in the cell: ids by falling count are dealt out class by class."""
    mass = counts + 0.5
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-mass, kind="stable")] = np.arange(len(counts))
    cls, cell = rank % CLASSES, np.minimum(rank // CLASSES, CELLS - 1)
    place = cls * CELLS + cell
    return cls, cell, np.log(mass / np.bincount(place, mass, CLASSES * CELLS)[place]).astype(np.float32)


def initial(cls: np.ndarray, cell: np.ndarray, counts: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.3 / np.sqrt(shape[-1] / WIDTH)).astype(np.float32)
    mass = np.bincount(cls * CELLS + cell, counts + 0.5, CLASSES * CELLS).reshape(CLASSES, CELLS) + 1e-3
    w = {"e": draw(len(cls) + 1, WIDTH), "p": draw(2 * STRIDE, WIDTH)}  # one more row than ids: what stands before a text
    w |= {name: draw(WIDTH, WIDTH) for name in "qkvo"}
    w |= {"u": draw(WIDTH, CLASSES), "b": np.log(mass.sum(1) / mass.sum()).astype(np.float32)}
    return w | {"g": np.ones((CLASSES, WIDTH), np.float32), "t": draw(WIDTH, CELLS), "c": np.log(mass / mass.sum(1, keepdims=True)).astype(np.float32)}


#: All weights but those of ids.
_DENSE = ("p", "q", "k", "v", "o", "u", "b", "g", "t", "c")
_CAUSAL = np.where(np.arange(2 * STRIDE)[None, :] <= STRIDE + np.arange(STRIDE)[:, None], 0, -1e9).astype(np.float32)
_SEEN = (_CAUSAL == 0).astype(np.float32)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def _sound(total: np.ndarray) -> bool:
    """Whether sums of exponentials are far from what a number can't hold."""
    return bool(total.max(initial=1) < 1e25 and total.min(initial=1) > 1e-25)


def _merged(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Queries' and keys' weights as one product, scaled, and values' and outputs': x asks x, and x is averaged, by 16 columns."""
    return (w["q"] @ w["k"].T) * np.asarray(WIDTH**-0.5, w["q"].dtype), w["v"] @ w["o"]


@np.errstate(over="ignore", invalid="ignore")  # what overflows is computed again
def _attention(q: np.ndarray, x: np.ndarray, part: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of all inputs for each asking one, and their sums. part: windows with inputs that don't exist; there: which of theirs do."""
    ones, masked = np.ones(2 * STRIDE, x.dtype), there[:, None, :]
    for safe in (False, True):
        s = q @ x.transpose(0, 2, 1)
        if safe:  # exponentials would overflow
            s += _CAUSAL.astype(x.dtype)
            s[part] += np.where(masked, 0, -1e9).astype(x.dtype)
            s -= s.max(2, keepdims=True)
        np.exp(s, out=s)
        s *= _SEEN
        if len(part):
            s[part] *= masked
        total = s.reshape(-1, 2 * STRIDE) @ ones
        if safe or _sound(total):
            break
    return s, np.maximum(total, np.asarray(1e-30, x.dtype))  # a row that sees nothing has no target


def _gaps(valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    part = np.flatnonzero(~valid.all(1))
    return part, valid[part]


def _attended(w: dict[str, np.ndarray], x: np.ndarray, gaps: tuple[np.ndarray, np.ndarray]) -> dict[str, np.ndarray]:
    """What the layer gives after each of the last STRIDE inputs of each window (y, with a column of ones as y1), and what it came from. x: rows of e; p's are added in place."""
    x += w["p"]
    now = x[:, STRIDE:].reshape(-1, WIDTH)
    asks, gives = _merged(w)
    q = (now @ asks).reshape(-1, STRIDE, WIDTH)
    a, total = _attention(q, x, *gaps)
    h = (a @ x).reshape(-1, WIDTH)
    inverse = (1 / total)[:, None]
    h *= inverse
    y = h @ gives
    y += now
    y1 = np.ones((len(y), WIDTH + 1), x.dtype)
    y1[:, :WIDTH] = y
    return {"x": x, "now": now, "q": q, "a": a, "inverse": inverse, "h": h, "y": y, "y1": y1, "asks": asks, "gives": gives}


def _classes(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate((w["u"], w["b"][None]))


def forward(w: dict[str, np.ndarray], ids: np.ndarray, valid: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Log probabilities of the classes, and of the cells in the given classes, after each of the last STRIDE inputs of each window."""
    c = _attended(w, np.take(w["e"], ids, axis=0), _gaps(valid))
    cls = cls.reshape(-1)
    return _log_softmax(c["y1"] @ _classes(w)), _log_softmax((c["y"] * w["g"][cls]) @ w["t"] + w["c"][cls]), c


class Scorer:
    """Log probabilities of goals by a model, as forward() gives them, without its tables of all logs."""

    def __init__(self, model: Model):
        self.model, self.classes = model, _classes(model.weights)

    def __call__(self, ids: np.ndarray, valid: np.ndarray, goal: np.ndarray) -> np.ndarray:
        w, goal = self.model.weights, goal.reshape(-1)
        c = _attended(w, np.take(w["e"], ids, axis=0), _gaps(valid))  # take is quicker than indexing
        cls, y = np.take(self.model.cls, goal), c["y"]
        out = _chosen(c["y1"], self.classes, None, cls)
        y *= np.take(w["g"], cls, axis=0)
        out += _chosen(y, w["t"], np.take(w["c"], cls, axis=0), np.take(self.model.cell, goal))
        return (out + np.take(self.model.log_share, goal)).reshape(ids.shape[0], STRIDE)


@np.errstate(over="ignore", invalid="ignore")  # what overflows is computed again
def _chosen(y: np.ndarray, w: np.ndarray, bias: np.ndarray | None, at: np.ndarray) -> np.ndarray:
    """The log softmax of each row of y @ w (+ bias) at one place."""
    place, ones = np.arange(0, len(y) * w.shape[1], w.shape[1]) + at, np.ones(w.shape[1], y.dtype)
    for safe in (False, True):
        x = y @ w
        if bias is not None:
            x += bias
        if safe:  # else no exponential overflows
            x -= x.max(1, keepdims=True)
        out = x.reshape(-1).take(place)
        np.exp(x, out=x)
        total = x @ ones
        if safe or _sound(total):
            break
    return out - np.log(total)


#: Rows that are added up as a group first, for a class and for an id, since sums of groups of any length are slow.
_CLASS_ROWS, _ID_ROWS = 8, 4


def _groups(by: np.ndarray, count: np.ndarray, begin: np.ndarray, number: int, wide: int) -> np.ndarray:
    """Rows in groups of `wide`. by: the rows of all batches in order; count: rows of each sum; begin: where its groups
    begin among all; number of groups. What a sum's last group lacks is the row after a batch's last, which holds 0."""
    rows = np.full(number * wide, by.shape[1])
    rows[np.arange(by.size) + np.repeat(begin * wide - (np.cumsum(count) - count), count)] = by.reshape(-1)
    return rows.reshape(-1, wide)


@dataclass
class _Sums:
    """Rows by what they belong to, in groups; where the groups of those with several begin, which come first, and their end."""

    rows: np.ndarray
    first: np.ndarray
    end: int

    def of(self, x: np.ndarray) -> np.ndarray:
        """The sums of x's rows, whose last is 0."""
        total = np.einsum("gkw->gw", np.take(x, self.rows, axis=0))
        if not len(self.first):
            return total
        return np.concatenate((np.add.reduceat(total[: self.end], self.first, axis=0), total[self.end :]))


@dataclass
class _Goals:
    """Targets of a batch, one row each: class, places of class and cell among all rows' logits, share in the mean loss (0: none); rows by class in groups, and which class each group is of."""

    cls: np.ndarray
    at_class: np.ndarray
    at_cell: np.ndarray
    share: np.ndarray
    rows: np.ndarray
    groups: np.ndarray

    def sums(self, x: np.ndarray) -> np.ndarray:
        """The sums by class of x's rows, whose last is 0."""
        return self.groups @ np.einsum("gkw->gw", np.take(x, self.rows, axis=0))


def _goals(cls: np.ndarray, cell: np.ndarray, scored: np.ndarray, dtype: type) -> list[_Goals]:
    """The goals of batches of one size; all arrays have a row for each batch."""
    size = len(cls)
    share = scored.astype(dtype) / np.maximum(1, scored.sum(1, keepdims=True)).astype(dtype)
    by = np.argsort(cls.astype(np.uint8 if CLASSES <= 256 else np.int64), axis=1, kind="stable")
    count = np.bincount((cls + np.arange(size)[:, None] * CLASSES).reshape(-1), minlength=size * CLASSES)
    number = -(-count // _CLASS_ROWS)
    end = np.cumsum(number)
    rows = _groups(by, count, end - number, end[-1], _CLASS_ROWS)
    groups = np.zeros((CLASSES, len(rows)), dtype)
    groups[np.repeat(np.arange(size * CLASSES) % CLASSES, number), np.arange(len(rows))] = 1
    edge = np.append(0, end[CLASSES - 1 :: CLASSES]).tolist()
    row = np.arange(cls.shape[1])
    at_class, at_cell = cls + row * CLASSES, cell + row * CELLS
    return [_Goals(cls[i], at_class[i], at_cell[i], share[i], rows[a:z], groups[:, a:z]) for i, (a, z) in enumerate(zip(edge[:-1], edge[1:], strict=True))]


@np.errstate(over="ignore", invalid="ignore")  # what overflows is computed again
def _errors(y: np.ndarray, w: np.ndarray, bias: np.ndarray | None, place: np.ndarray, share: np.ndarray, out: np.ndarray) -> tuple[float, np.ndarray]:
    """The loss of a softmax of y @ w (+ bias) at the given places. out: exponentials, less their sum at these places;
    times what is returned beside the loss they are the logits' gradients."""
    flat, ones = out.reshape(-1), np.ones(out.shape[1], y.dtype)
    for safe in (False, True):
        np.matmul(y, w, out=out)
        if bias is not None:
            out += bias
        if safe:
            out -= out.max(1, keepdims=True)
        goal = flat.take(place)
        np.exp(out, out=out)
        total = out @ ones
        if safe or _sound(total):
            break
    flat[place] = flat.take(place) - total
    loss = np.log(total)
    loss -= goal
    return float(loss @ share), share / total


def _backward(w: dict[str, np.ndarray], x: np.ndarray, gaps: tuple[np.ndarray, np.ndarray], goals: _Goals, g: dict[str, np.ndarray]) -> tuple[float, np.ndarray]:
    """Mean loss over the goals, and its gradients for each input, flat, and a row that is 0; those of all other weights are written to g. x is changed."""
    c = _attended(w, x, gaps)
    q, a, h, y, y1 = c["q"], c["a"], c["h"], c["y"], c["y1"]
    n, kind = len(y), x.dtype
    held = np.empty(((n + 1), max(CLASSES, CELLS)), kind).reshape(-1)  # for both softmaxes in turn, so that it stays near
    d, dd = held[: n * CLASSES].reshape(n, CLASSES), held[: (n + 1) * CELLS].reshape(n + 1, CELLS)
    ub = _classes(w)
    loss, scale = _errors(y1, ub, None, goals.at_class, goals.share, d)
    scale = scale[:, None]
    dy = d @ w["u"].T
    dy *= scale
    y1 *= scale
    both = y1.T @ d
    g["u"][...], g["b"][...] = both[:WIDTH], both[WIDTH]
    gate = np.take(w["g"], goals.cls, axis=0)
    gated = y * gate
    more, scale = _errors(gated, w["t"], np.take(w["c"], goals.cls, axis=0), goals.at_cell, goals.share, dd[:n])
    dd[:n] *= scale[:, None]
    dd[n] = 0
    np.matmul(gated.T, dd[:n], out=g["t"])
    g["c"][...] = goals.sums(dd)
    back = dd @ w["t"].T
    gate *= back[:n]
    dy += gate
    back[:n] *= y
    g["g"][...] = goals.sums(back)
    dh = dy @ c["gives"].T
    merged = h.T @ dy
    g["v"][...], g["o"][...] = merged @ w["o"].T, w["v"].T @ merged
    dh *= c["inverse"]
    h *= dh
    mean = h @ np.ones(WIDTH, kind)  # of each row by its attention
    dh = dh.reshape(q.shape)
    ds = dh @ x.transpose(0, 2, 1)
    ds -= mean.reshape(-1, STRIDE, 1)
    ds *= a
    pair, other = np.empty((len(x), 2 * STRIDE, 2 * STRIDE), kind), np.empty((len(x), 2 * STRIDE, WIDTH), kind)
    pair[:, :STRIDE], pair[:, STRIDE:] = a, ds
    other[:, :STRIDE], other[:, STRIDE:] = dh, q
    dx = np.empty((x.size // WIDTH + 1, WIDTH), kind)
    dx[-1] = 0
    each = dx[:-1].reshape(x.shape)
    np.matmul(pair.transpose(0, 2, 1), other, out=each)
    dq = (ds @ x).reshape(-1, WIDTH)
    merged = c["now"].T @ dq
    merged *= np.asarray(WIDTH**-0.5, kind)
    g["q"][...], g["k"][...] = merged @ w["k"], merged.T @ w["q"]
    dy += dq @ c["asks"].T
    each[:, STRIDE:] += dy.reshape(q.shape)
    np.add.reduce(each, axis=0, out=g["p"])
    return loss + more, dx


def _zeros(w: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """All weights but ids' as one array of zeros, and each one's part of it."""
    at = np.cumsum([0, *(w[name].size for name in _DENSE)])
    flat = np.zeros(at[-1], w["e"].dtype)
    return flat, {name: flat[a:z].reshape(w[name].shape) for name, a, z in zip(_DENSE, at[:-1], at[1:], strict=True)}


def gradients(w: dict[str, np.ndarray], ids: np.ndarray, valid: np.ndarray, cls: np.ndarray, cell: np.ndarray, scored: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over the scored inputs and its gradients; e's come for each input."""
    _, g = _zeros(w)
    goals = _goals(cls.reshape(1, -1), cell.reshape(1, -1), scored.reshape(1, -1), w["e"].dtype)[0]
    loss, e = _backward(w, np.take(w["e"], ids, axis=0), _gaps(valid), goals, g)
    return loss, g | {"e": e[:-1].reshape(*ids.shape, WIDTH)}


def _batches(windows: np.ndarray, cls: np.ndarray, cell: np.ndarray, batch: int, dtype: type, together: int = 32) -> Iterator[tuple]:
    """Batches of windows in a seeded order: their number; their distinct ids, which of these each input is, and
    sums by them; the windows' gaps; the goals. What needs no weights is done for many batches at once."""
    size, order = len(cls), np.random.default_rng(len(windows)).permutation(len(windows))
    whole = len(order) // batch * batch
    spans = [(a, min(whole, a + together * batch), batch) for a in range(0, whole, together * batch)]
    for a, z, n in [*spans, *([(whole, len(order), len(order) - whole)] if whole < len(order) else [])]:
        rows = windows[order[a:z]]
        ids, target = rows[:, : 2 * STRIDE], rows[:, 2 * STRIDE :]
        valid, scored = ids >= 0, target >= 0
        shape = ((z - a) // n, n * STRIDE)
        goals = _goals(np.where(scored, cls[target], 0).reshape(shape), np.where(scored, cell[target], 0).reshape(shape), scored.reshape(shape), dtype)
        flat = np.where(valid, ids, size).reshape(shape[0], -1).astype(np.uint16 if size < 1 << 16 else np.int64)  # sorted by digits where they are short
        by = np.argsort(flat, axis=1, kind="stable")
        flat = np.take_along_axis(flat, by, axis=1)
        new = np.ones(flat.shape, bool)
        np.not_equal(flat[:, 1:], flat[:, :-1], out=new[:, 1:])
        first = np.flatnonzero(new)
        count, owner = np.diff(np.append(first, new.size)), first // flat.shape[1]
        number = -(-count // _ID_ROWS)
        dealt = np.argsort((2 * owner + (number == 1)).astype(np.uint16), kind="stable")  # in each batch those of several groups first
        rank = np.empty(len(first), np.int64)
        rank[dealt] = np.arange(len(first))
        edge = np.searchsorted(owner, np.arange(shape[0] + 1))
        which = np.empty(flat.shape, np.int64)
        np.put_along_axis(which, by, np.repeat(rank - edge[owner], count).reshape(flat.shape), axis=1)
        ids, number = flat.reshape(-1)[first[dealt]].astype(np.int64), number[dealt]
        begin = np.cumsum(number) - number
        groups = _groups(by, count, begin[rank], number.sum(), _ID_ROWS)
        at, several = np.append(begin, number.sum()), edge[:-1] + np.bincount(owner[np.flatnonzero(number[rank] > 1)], minlength=shape[0])
        part = np.flatnonzero(~valid.all(1))
        gaps = np.searchsorted(part, np.arange(shape[0] + 1) * n)
        for i in range(shape[0]):
            j, m, k = edge[i], several[i], edge[i + 1]
            own = part[gaps[i] : gaps[i + 1]]
            yield n, ids[j:k], which[i].reshape(n, -1), _Sums(groups[at[j] : at[k]], begin[j:m] - at[j], at[m] - at[j]), (own - i * n, valid[own]), goals[i]


def learn(w: dict[str, np.ndarray], seen: dict[str, np.ndarray], cls: np.ndarray, cell: np.ndarray, windows: np.ndarray, batch: int = 64, rate: float = 0.05) -> float:
    """Changes w and seen in place, and returns the mean loss. windows: rows of 2 * STRIDE inputs and STRIDE targets; -1 is no input or no target. Adagrad, seeded order."""
    (dense, now), (dense_seen, parts), (x, g) = (_zeros(w) for _ in range(3))  # all weights but ids' step as one
    for held, given in ((now, w), (parts, seen)):
        for name in _DENSE:
            held[name][...] = given[name]
    total = 0.0
    for n, ids, which, sums, gaps, goals in _batches(windows, cls, cell, batch, w["e"].dtype):
        own = np.take(w["e"], ids, axis=0)
        loss, e = _backward(now, np.take(own, which, axis=0), gaps, goals, g)
        total += loss * n
        step = sums.of(e)
        held = np.take(seen["e"], ids, axis=0)
        held += step * step
        seen["e"][ids] = held
        np.sqrt(held, out=held)
        step *= rate
        step /= held
        own -= step
        w["e"][ids] = own
        dense_seen += x * x
        x *= rate
        x /= np.sqrt(dense_seen)
        dense -= x
    for held, given in ((w, now), (seen, parts)):
        for name in _DENSE:
            held[name][...] = given[name]
    return total / max(1, len(windows))


def text_ids(t: Tokenizer, b: tokens.Batch) -> tuple[np.ndarray, np.ndarray, tuple]:
    """All texts' ids with an end after each, flat; where each text begins (n + 1 values); and the texts' first words, a
    folded hash of each distinct word, and which of them each word is."""
    starts, ends, first = b.words(tokens.PLAIN)
    flat, count, place, which = t.ids(b, starts, ends, b.hashes(starts, ends, fold=False))
    order = np.argsort(place)  # hashes are taken in reading order
    folded = np.empty(len(place), _U)
    folded[order] = b.hashes(starts[place[order]], ends[place[order]], fold=True)
    total = np.concatenate(([0], np.cumsum(count)))
    at = total[first] + np.arange(b.n + 1)
    out = np.full(at[-1], t.end, np.int32)
    inside = np.ones(len(out), bool)
    inside[at[1:] - 1] = False
    out[inside] = flat
    return out, at, (first, folded, which)


def windowed(ids: np.ndarray, at: np.ndarray, size: int, only=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of texts, or those that only(text, number) picks: inputs, which of them exist, places of the targets (-1: none), and the windows' texts.

    The input before a text's first id is `size`; a window's targets are the ids after its last STRIDE inputs.
    """
    length = np.diff(at)
    number = -(-length // STRIDE)
    text = np.repeat(np.arange(len(length)), number)
    k = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    if only is not None:
        picked = only(text, k)
        text, k = text[picked], k[picked]
    place = (k * STRIDE - STRIDE)[:, None] + np.arange(2 * STRIDE)[None, :]  # input at place p is the id p - 1
    valid = (place >= 0) & (place < length[text][:, None])
    flat = at[text][:, None] + place - 1
    inputs = np.where(place == 0, size, ids[np.clip(flat, 0, len(ids) - 1)])
    target = np.where(valid[:, STRIDE:], flat[:, STRIDE:] + 1, -1)
    return np.where(valid, inputs, size), valid, target, text


def scores(scorer: Scorer, ids: np.ndarray, at: np.ndarray, batch: int = 512) -> np.ndarray:
    """log10 probability of each text."""
    size = len(scorer.model.cls)
    out = np.zeros(len(at) - 1)
    step = max(1, batch)
    cuts = [0]
    windows = np.cumsum(-(-np.diff(at) // STRIDE))
    while cuts[-1] < len(out):  # some texts at a time, a long one in parts
        done = windows[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(windows, done + 8 * step, side="right"))))
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        inputs, valid, target, text = windowed(ids[at[a] : at[z]], at[a : z + 1] - at[a], size)
        for i in range(0, len(inputs), step):
            place = target[i : i + step]
            scored = place >= 0
            goal = ids[at[a] + np.where(scored, place, 0)]
            got = scorer(inputs[i : i + step], valid[i : i + step], goal)
            out[a:z] += np.bincount(text[i : i + step], (got * scored).sum(1, dtype=np.float64), z - a)
    return out / np.log(10)


_GATHERED = "kind int, round int, key long, n long, windows binary"


def _gathering(ranks, every: int, rounds: int):
    """Counts of words (kind 0) and of subword ids (kind 1) of a partition, and its pieces to learn from (kind 2; n: windows)."""

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer_of(ranks.value)
        ids, parts, gathered, chosen, n_chosen = np.zeros(t.size, np.int64), [], 0, [], 0

        def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            none = np.zeros(len(keys), np.int32)
            return pa.RecordBatch.from_arrays([pa.array(none + kind), pa.array(none), pa.array(tokens.signed(keys)), pa.array(n.astype(np.int64)), pa.nulls(len(keys), pa.binary())], names)

        def merged() -> pa.RecordBatch:
            keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return rows(0, keys, np.bincount(where, np.concatenate([n for _, n in parts])))

        def packed() -> pa.RecordBatch:
            flat, length, seeds = (np.concatenate(x) for x in zip(*chosen, strict=True))
            own, n = (tokens.mix(seeds) % _U(rounds)).astype(np.int32), len(length)
            off = np.concatenate(([0], np.cumsum(length * flat.itemsize))).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(off), pa.py_buffer(flat.tobytes())])
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, 2, np.int32)), pa.array(own), pa.array(tokens.signed(seeds)), pa.array(-(-(length - STRIDE - 1) // STRIDE)), data], names)

        names = ["kind", "round", "key", "n", "windows"]
        for batch in it:
            seeds = batch.column("seed").to_numpy().view(_U)
            for i, b in tokens.batches(batch.column("text")):
                flat, at, (_, folded, which) = text_ids(t, b)
                ids += np.bincount(flat, minlength=t.size)
                parts.append((np.append(folded, END_KEY), np.append(np.bincount(which, minlength=len(folded)), b.n)))
                gathered += len(folded)
                chosen.append(pieces(t.size, flat, at, seeds[i : i + b.n], every))
                n_chosen += len(chosen[-1][0])
                if gathered > 1_500_000:
                    yield merged()
                    parts, gathered = [], 0
                if n_chosen > 4_000_000:
                    yield packed()
                    chosen, n_chosen = [], 0
        if parts:
            yield merged()
        if n_chosen:
            yield packed()
        held = np.flatnonzero(ids)
        yield rows(1, held.astype(_U), ids[held])

    return step


def _kind(size: int) -> type:
    return np.uint16 if size + 2 <= 1 << 16 else np.int32


def pieces(size: int, ids: np.ndarray, at: np.ndarray, seeds: np.ndarray, every: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts, or one piece in `every`, in pieces of PIECE windows: the pieces' ids flat, their lengths, and a hash of
    each by the text's seed and what it holds, so that pieces of one hash are alike.

    A piece has the STRIDE + 1 ids before its first target (before a text: size + 1, and last `size`), then its targets.
    """
    length, step = np.diff(at), STRIDE * PIECE
    number = -(-length // step)
    text = np.repeat(np.arange(len(length)), number)
    k = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    if every > 1:
        picked = tokens.mix(seeds[text] + tokens.mix(k.astype(_U))) % _U(every) == 0
        text, k = text[picked], k[picked]
    n = np.minimum(step, length[text] - k * step) + STRIDE + 1
    first = np.cumsum(n) - n
    inside = np.arange(n.sum()) - np.repeat(first, n)
    place = np.repeat(k * step - STRIDE - 1, n) + inside
    flat = np.where(place >= 0, ids[np.maximum(np.repeat(at[text], n) + place, 0)], np.where(place == -1, size, size + 1))
    content = tokens.mix(flat.astype(_U) * tokens.mix(inside.astype(_U) + _U(1)))
    total = np.add.reduceat(content, first) if len(first) else np.zeros(0, _U)
    return flat.astype(_kind(size)), n, tokens.mix(tokens.mix(seeds[text] ^ _U(0xA5A5A5A5)) + total)


def unpacked(size: int, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The windows of pieces, in order: rows of 2 * STRIDE inputs and STRIDE targets; -1 is no input or no target."""
    number = -(-(lengths - STRIDE - 1) // STRIDE)
    piece = np.repeat(np.arange(len(lengths)), number)
    k = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    inside = (k * STRIDE)[:, None] + np.arange(3 * STRIDE)[None, :]
    inside[:, 2 * STRIDE :] -= STRIDE - 1
    end = lengths[piece][:, None] - (np.arange(3 * STRIDE) < 2 * STRIDE)  # a piece's last id is a target only
    out = flat[np.minimum((np.cumsum(lengths) - lengths)[piece][:, None] + inside, max(0, len(flat) - 1))].astype(np.int32)
    out[(inside >= end) | (out > size)] = -1
    return out


def training_windows(size: int, ids: np.ndarray, at: np.ndarray, seeds: np.ndarray, every: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of the pieces, and the hash of each one's piece."""
    flat, lengths, keys = pieces(size, ids, at, seeds, every)
    return unpacked(size, flat, lengths), np.repeat(keys, -(-(lengths - STRIDE - 1) // STRIDE))


_CHANGES = "part int, learner int, ids binary, n binary, change binary"


def _flat(w: dict[str, np.ndarray], seen: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([x[name].reshape(-1) for x in (w, seen) for name in _DENSE])


def _learning(start, piece: int | None):
    """What each learner's windows change: of ids (part = id modulo GROUPS) and of all other weights (part GROUPS)."""

    def changes(learner: int, windows: np.ndarray) -> pa.RecordBatch:
        cls, cell, w0, seen0 = start.value
        w, seen = ({name: x.copy() for name, x in held.items()} for held in (w0, seen0))
        loss = learn(w, seen, cls, cell, windows)
        n = np.bincount(np.where(windows[:, : 2 * STRIDE] >= 0, windows[:, : 2 * STRIDE], len(cls)).reshape(-1), minlength=len(w["e"]))
        held = np.flatnonzero(n)
        held = held[np.argsort(held % GROUPS, kind="stable")]
        change = np.concatenate((w["e"][held] - w0["e"][held], seen["e"][held] - seen0["e"][held]), axis=1)
        part = held % GROUPS
        at = np.flatnonzero(np.diff(part, prepend=-1))
        rows = [(int(part[a]), learner, held[a:z].astype(np.int32), n[held[a:z]], change[a:z]) for a, z in zip(at, np.append(at[1:], len(held)), strict=True)]
        rows.append((GROUPS, learner, np.zeros(1, np.int32), np.array([len(windows)]), np.append(_flat(w, seen) - _flat(w0, seen0), np.float32(loss))))
        return _packed(rows)

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = None, []
        for batch in it:
            learners = batch.column("learner").to_numpy()
            data = batch.column("windows")
            cuts = np.append(np.flatnonzero(np.diff(learners, prepend=-1)), len(learners))
            for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if own is not None and learners[a] != own:
                    yield changes(own, np.concatenate(held))
                    held = []
                own = int(learners[a])
                rows = data.slice(a, z - a).to_pylist()
                if piece is None:
                    held.append(np.frombuffer(b"".join(rows), np.int32).reshape(-1, 3 * STRIDE))
                else:
                    flat = np.frombuffer(b"".join(rows), _kind(piece))
                    held.append(unpacked(piece, flat, np.array([len(r) for r in rows]) // flat.itemsize))
        if held:
            yield changes(own, np.concatenate(held))

    return step


def _packed(rows: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [*(pa.array([r[k] for r in rows], pa.int32()) for k in (0, 1)), *(pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (2, 3, 4))]
    return pa.RecordBatch.from_arrays(columns, ["part", "learner", "ids", "n", "change"])


def _averaging(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The learners' mean change of each id, weighted by the times that they read it. Rows come sorted by part and
    learner, so sums don't depend on the order of arrival; a part is done when the next one begins."""
    own, sums = None, None

    def mean() -> pa.RecordBatch:
        ids, n, change = sums
        return _packed([(own, 0, ids, n, (change / n[:, None]).astype(np.float32))])

    for batch in it:
        for part, _, ids, n, change in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids, n = np.frombuffer(ids, np.int32), np.frombuffer(n, np.int64)
            change = np.frombuffer(change, np.float32).reshape(len(ids), -1) * n[:, None].astype(np.float64)
            if part != own:
                if own is not None:
                    yield mean()
                own, sums = part, (ids, n, change)
                continue
            all_ids = np.union1d(sums[0], ids)
            both = (all_ids, np.zeros(len(all_ids), np.int64), np.zeros((len(all_ids), change.shape[1])))
            for i, m, x in (sums, (ids, n, change)):
                at = np.searchsorted(all_ids, i)
                both[1][at] += m
                both[2][at] += x
            sums = both
    if own is not None:
        yield mean()


def trained(windows: DataFrame, id_counts: np.ndarray, rounds: int = ROUNDS, each: int = EACH) -> tuple[Model, list[tuple[int, float]]]:
    """The model after one pass over the training windows (round, key, windows), and each round's number of windows and
    mean loss. Where there is a column n, each row is a piece of so many windows.

    The learners' number follows the windows' number alone, and windows are dealt to them and ordered by their hashes,
    so neither the input's partitions nor the order of arrival changes the weights.
    """
    cls, cell, log_share = classed(id_counts)
    w = initial(cls, cell, id_counts)
    seen = {name: np.full_like(x, 1e-6) for name, x in w.items()}
    done = []
    packed = "n" in windows.columns
    number = windows.agg(F.sum("n")).first()[0] if packed else windows.count()
    learners = 1 << max(0, int(np.ceil(np.log2(max(1, number or 0) / rounds / each))))
    for k in range(rounds):
        start = windows.sparkSession.sparkContext.broadcast((cls, cell, w, seen))
        dealt = windows.where(F.col("round") == k).select(F.pmod(F.xxhash64("key"), F.lit(learners)).cast("int").alias("learner"), "key", "windows")
        dealt = dealt.repartitionById(learners, F.col("learner")).sortWithinPartitions("learner", "key").select("learner", "windows")
        changes = dealt.mapInArrow(_learning(start, len(cls) if packed else None), _CHANGES)
        rows = changes.repartition("part").sortWithinPartitions("part", "learner").mapInArrow(_averaging, _CHANGES).collect()  # no more than the model's weights
        w, seen = ({name: x.copy() for name, x in held.items()} for held in (w, seen))
        for r in rows:
            change = np.frombuffer(r.change, np.float32)
            if r.part < GROUPS:
                ids, change = np.frombuffer(r.ids, np.int32), change.reshape(-1, 2 * WIDTH)
                w["e"][ids] += change[:, :WIDTH]
                seen["e"][ids] += change[:, WIDTH:]
                continue
            done.append((int(np.frombuffer(r.n, np.int64)[0]), float(change[-1])))
            at = 0
            for held in (w, seen):
                for name in _DENSE:
                    held[name] += change[at : at + held[name].size].reshape(held[name].shape)
                    at += held[name].size
        start.unpersist()
    return Model(cls, cell, log_share, w), done


def scored(documents: DataFrame, tokenizer: str = TOKENIZER, every: int = EVERY, head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = documents.sparkSession
    with open(tokenizer, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    source = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), (remainder("doc_id", 5) == 1).alias("held_out"))
    train = source.where("not held_out").select("text", F.xxhash64("doc_id").alias("seed"))
    gathered = staged(train.mapInArrow(_gathering(ranks, every, ROUNDS), _GATHERED), "lm-gathered", "kind", "round")
    counts = staged(gathered.where("kind < 2").groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")
    words = counts.where("kind = 0").select("key", "n")
    total, distinct = (x or 0 for x in words.agg(F.sum("n"), F.count(F.lit(1))).first())
    head = np.array(words.orderBy(F.desc("n"), "key").limit(head_words).collect() or np.zeros((0, 2)), np.int64).reshape(-1, 2)
    head = head[np.argsort(head[:, 0].view(_U))]
    id_counts = np.zeros(tokenizer_of(ranks.value).size)
    for r in counts.where("kind = 1").collect():  # no more rows than the tokenizer has ids
        id_counts[r.key] = r.n
    model = spark.sparkContext.broadcast(trained(gathered.where("kind = 2"), id_counts)[0])
    unstaged(gathered)
    floor = total + 0.5 * (distinct + 1)
    units = lambda n: np.rint(np.log10((n + 0.5) / floor) / _UNIT).astype(np.int64)
    shared = spark.sparkContext.broadcast((head[:, 0].view(_U), units(head[:, 1])))

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, scorer, (known, worth) = tokenizer_of(ranks.value), Scorer(model.value), shared.value
        for batch in it:
            columns: dict[str, list] = {"n_tokens": [], "head_known": [], "head_units": [], "score": []}
            rest_n, rest_keys, rest_k = [], [], []
            for _, b in tokens.batches(batch.column("text")):
                ids, begin, (first, folded, which) = text_ids(t, b)
                folded, which = np.append(folded, END_KEY), np.insert(which, first[1:], len(folded))  # with each text's end
                edge = first + np.arange(b.n + 1)
                at = np.searchsorted(known, folded)
                inside = at < len(known)
                inside[inside] = known[at[inside]] == folded[inside]
                sums = [np.concatenate(([0], np.cumsum(x[which]))) for x in (inside.astype(np.int64), np.where(inside, worth[np.where(inside, at, 0)], 0) if len(known) else np.zeros(len(at), np.int64))]
                known_here, units_here = (x[edge[1:]] - x[edge[:-1]] for x in sums)
                columns["n_tokens"].append(np.diff(edge))
                columns["head_known"].append(known_here)
                columns["head_units"].append(units_here)
                columns["score"].append(scores(scorer, ids, begin))
                away = np.flatnonzero(~inside[which])
                keys, owner = folded[which[away]], tokens.owners(edge)[away]
                order = np.lexsort((keys, owner))
                keys, owner = keys[order], owner[order]
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
                place = np.flatnonzero(new)
                rest_n.append(np.bincount(owner[place], minlength=b.n))
                rest_keys.append(keys[place])
                rest_k.append(np.diff(np.append(place, len(keys))))
            if not rest_n:
                continue
            off = pa.array(np.concatenate(([0], np.cumsum(np.concatenate(rest_n)))), pa.int32())
            pairs = pa.StructArray.from_arrays([pa.array(tokens.signed(np.concatenate(rest_keys))), pa.array(np.concatenate(rest_k).astype(np.int32))], names=["key", "k"])
            values = [pa.array(np.concatenate(x).astype(float if n == "score" else np.int64)) for n, x in columns.items()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *values, pa.ListArray.from_arrays(off, pairs)], ["doc_id", "held_out", *columns, "rest"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = source.mapInArrow(step, f"doc_id {kind}, held_out boolean, n_tokens long, head_known long, head_units long, score double, rest array<struct<key:long,k:int>>")
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "lm-rows")  # written, so the numbers stay
    rest = rows.select("row", F.explode("rest").alias("r")).select("row", "r.key", "r.k").join(words, "key", "left").select("row", "k", F.coalesce("n", F.lit(0)).alias("n"))
    worth = F.rint(F.log10((F.col("n") + 0.5) / F.lit(float(floor))) / F.lit(_UNIT)).cast("long")
    parts = rest.groupBy("row").agg(F.sum(F.col("k") * worth).alias("rest_units"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("rest_known"))
    out = rows.drop("rest").join(parts, "row", "left")
    base = (F.col("head_units") + F.coalesce("rest_units", F.lit(0))) * F.lit(_UNIT)
    return out.select("doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
