"""Language-model scores of documents: a causal self-attention model over subword ids, trained in numpy.

One pass over the training documents counts their words; the words' counts give exact counts of subwords and of
subword pairs inside words. A second pass cuts every training document into consecutive windows, the same that
scoring uses: every subword is a target once in a round, and every pair across a word border is counted. An outcome
is one of the most frequent subwords, the end, or a rare subword (which then has its share of these); it is
predicted in two steps, its group and its slot in the group. The model adds one block of self-attention, with a
bias for each distance, and a feed-forward layer to the log probabilities of the pairs. It is trained on all windows
in shards: each trains on its own rows, and the shards' weights are averaged after every round.

A text is scored in windows of `WINDOW` inputs of which the last `STEP` are scored, so each subword is scored once,
with at least WINDOW - STEP inputs before it; all windows of some texts go through the model as one batch
with the causal mask. The base score uses the words' counts: frequent words by a table of at most
`frequent` words that travels with the tasks, all others by a join.

Scale: counts are grouped with partial aggregation; the hot words are in the table, so the join has no hot key.
The model has a fixed size, at most `max_shards` sets of weights are added up, and what training reads
grows with the corpus: the windows are written once, dealt over the shards, as rows of the pair model's table.

Defined cases: a null or empty text has the end as its only token; a null doc_id is hashed as an empty text;
repeated rows are scored alike, and each counts; with no training documents all counts are zero and the
model is uniform over its classes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqflow.llm.common import written

WINDOW, STEP = 20, 15
BACK = WINDOW - STEP
DIM, HIDDEN = 16, 32
GROUPS, SLOTS = 32, 32  # outcomes are predicted in two steps: the group, and the slot in it
INPUTS = GROUPS * SLOTS  # input rows (start, rare, frequent subwords); as many outcomes (end, rare, frequent subwords)
PIECE_WINDOWS = 32  # windows of a text that are kept in one row
CHUNK = 32  # targets of a group that are multiplied together
BATCH_WINDOWS = 48  # that a step of training takes
LEAD = 1 << 10  # added to the row of what starts a word or ends a text
PIECE = 256  # longer words are encoded in pieces of so many characters
WORDS_KEPT = 300_000  # words whose subwords a worker remembers
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: the tokenizer's own split
LN10 = float(np.log(10))


class Subwords:
    """Words to subword ids; remembers words, up to a bound."""

    def __init__(self, ranks: dict[bytes, int]):
        self.coder = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.lead = np.zeros(self.size, bool)
        self.lead[[i for t, i in ranks.items() if t[:1] == b" "]] = True

    def encode(self, word: bytes) -> list[int]:
        text = " " + word.decode("utf-8", "replace")
        if len(text) <= PIECE:
            return self.coder.encode_ordinary(text)
        return [i for a in range(0, len(text), PIECE) for i in self.coder.encode_ordinary(text[a:a + PIECE])]

    def encode_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """`encode` of each word: all subwords in a row, and how many each has. Short words go as one text, which the coder
        splits before every space: a subword that starts with a space starts a word. Where that doesn't add up, each is
        encoded by itself."""
        if max(map(len, words), default=0) < PIECE:
            ids = np.array(self.coder.encode_ordinary(" " + b" ".join(words).decode("utf-8", "replace")), np.int32)
            starts = np.flatnonzero(self.lead[ids])
            if len(starts) == len(words):
                return ids, np.diff(starts, append=len(ids))
        each = [self.encode(w) for w in words]
        size = np.array([len(x) for x in each], np.int64)
        return np.fromiter(chain.from_iterable(each), np.int32, size.sum()), size


def read_ranks(path: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}


_MADE: dict[str, Subwords] = {}


def _subwords(shared) -> Subwords:
    """One coder for each worker process; shared: broadcast of a key and the ranks."""
    key, ranks = shared.value
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Subwords(ranks)
    return _MADE[key]


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


# ---------------------------------------------------------------- counts and windows of the training documents


def gather(docs: DataFrame) -> DataFrame:
    """Rows (kind, s, n) of the training documents: kind 0 a word and its count in a task, 2 a number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        n_docs = 0

        def batch(kind: int, s: list[bytes], n: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(s), kind, np.int8)), pa.array(s, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=["kind", "s", "n"])

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("t")):
                if is_held_out(doc_id):
                    continue
                counts.update(_words(text.as_py()))
                n_docs += 1
            if len(counts) > 400_000:
                yield batch(0, list(counts), list(counts.values()))
                counts.clear()
        if counts:
            yield batch(0, list(counts), list(counts.values()))
        yield batch(2, [b""], [n_docs])

    return written(docs.mapInArrow(run, "kind tinyint, s string, n long"), "lm-gathered", batch_rows=1000)


def cut_pieces(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, number in the text, length) of the pieces of texts of so many subwords. A piece holds BACK + 1 codes and then its targets, at most
    PIECE_WINDOWS windows of them; the next piece repeats the last BACK + 1 codes."""
    span = PIECE_WINDOWS * STEP
    pieces = (size + span) // span  # of size + 1 targets
    text = np.repeat(np.arange(len(size)), pieces)
    number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return text, number, np.minimum(span, size[text] + 1 - number * span) + BACK + 1


def training_pieces(docs: DataFrame, shared, classes: Classes) -> DataFrame:
    """(key, codes) of all training documents: `cut_pieces` of their codes, row + LEAD if it starts a word or ends the text."""
    n = len(classes.row) - 2
    code = classes.row.astype(np.int16)
    code[[i for t, i in shared.value[1].items() if t[:1] == b" "]] += LEAD
    code[n + 1] = LEAD  # the end: row 0, as the start
    table = docs.sparkSession.sparkContext.broadcast(code)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, lex = table.value, _Lexicon(_subwords(shared), {})
        for part in _megabytes(batches):
            ids = part.column("doc_id").to_pylist()
            mine = [i for i, d in enumerate(ids) if not is_held_out(d)]
            texts = [_words(part.column("t")[i].as_py()) for i in mine]
            _, _, _, each, subs = _encoded(texts, lex)
            size = np.bincount(np.repeat(np.arange(len(mine)), [len(x) for x in texts]), each, len(mine)).astype(np.int64)
            length = size + BACK + 2
            at = np.cumsum(length) - length
            stream = np.zeros(int(length.sum()), np.int16)  # the start
            stream[at + length - 1] = code[n + 1]
            stream[np.repeat(at + BACK + 1 - (np.cumsum(size) - size), size) + np.arange(len(subs))] = code[subs]
            text, number, long = cut_pieces(size)
            first = at[text] + number * (PIECE_WINDOWS * STEP)
            ends = np.cumsum(long)
            flat = stream[np.repeat(first - (ends - long), long) + np.arange(long.sum())]
            keys = [zlib.crc32(b"%d-%d" % (ids[mine[t]] or 0, k)) for t, k in zip(text.tolist(), number.tolist())]
            codes = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), codes], names=["key", "codes"])

    return docs.mapInArrow(run, "key long, codes array<smallint>")


def cut_windows(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Windows of some pieces: (input rows (n, WINDOW), rows of the targets (n, STEP), -1 where there is none)."""
    codes = b.column("codes")
    size = pc.list_value_length(codes).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.append(codes.flatten().to_numpy(zero_copy_only=False), np.zeros(WINDOW, np.int16)) % LEAD
    wins = -(-(size - BACK - 1) // STEP)
    end, k = np.cumsum(size), np.arange(wins.sum()) - np.repeat(np.cumsum(wins) - wins, wins)
    first = np.repeat(end - size, wins) + STEP * k
    at = first[:, None] + np.arange(WINDOW + 1)
    y = np.where(at[:, BACK + 1:] < np.repeat(end, wins)[:, None], flat[at[:, BACK + 1:]], np.int16(-1))
    return flat[at[:, :WINDOW]], y


def pair_counts(words: DataFrame, shared) -> DataFrame:
    """(a, b, n): how often subword b follows a inside words; a = -1: b starts a word; b = -1: a ends one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, total = _subwords(shared), Counter()
        for b in batches:
            flat, size = coder.encode_all(b.column("word").cast(pa.binary()).to_pylist())
            flat, n = flat.astype(np.int64), b.column("c").to_numpy(zero_copy_only=False)
            end = np.cumsum(size)
            code = np.concatenate([flat[:-1] * (1 << 32) + flat[1:] + 1, flat[end - size] + 1 - (1 << 32), flat[end - 1] << 32])
            inner = np.ones(max(len(flat) - 1, 0), bool)
            inner[end[:-1] - 1] = False
            weight = np.concatenate([np.repeat(n, size)[:-1] * inner, n, n])
            code, of = np.unique(code, return_inverse=True)
            sums = np.bincount(of, weight)
            total.update(dict(zip(code[sums > 0].tolist(), sums[sums > 0].astype(np.int64).tolist())))
        code = np.array(list(total), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array((code >> 32).astype(np.int32)), pa.array(((code & 0xFFFFFFFF) - 1).astype(np.int32)), pa.array(list(total.values()), pa.int64())], names=["a", "b", "n"])

    return words.mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


class Classes:
    """Rows and outcomes of the subword ids, and the pair model the network starts from.

    Row: what the input of a position looks up (0 the start, 1 a rare subword, or one of the frequent ones). Outcome: the
    same ids as what comes next (the end in place of the start), numbered by frequency; `SLOTS` outcomes in a row are a
    group. A rare subword has its smoothed share of the rare ones.
    """

    def __init__(self, size: int, unigram: np.ndarray):
        order = np.argsort(-unigram, kind="stable")
        top = order[:INPUTS - 2]
        self.row = np.ones(size + 2, np.int32)  # of the ids, then of the start and the end
        self.row[top] = np.arange(2, 2 + len(top))
        self.row[size] = 0
        rest = np.ones(size, bool)
        rest[top] = False
        self.rare = np.zeros(size + 2, np.float32)  # log share of a rare subword among them
        self.rare[:size][rest] = np.log((unigram[rest] + 1.0) / (unigram[rest] + 1.0).sum())
        self.mass = np.ones(INPUTS)  # of the outcomes, by row
        self.mass[2:2 + len(top)] += unigram[top]
        self.mass[1] += unigram[rest].sum()
        self.by_mass = np.argsort(-self.mass, kind="stable")  # outcome number -> row
        self.number = np.empty(INPUTS, np.int32)
        self.number[self.by_mass] = np.arange(INPUTS)
        entry = self.row.copy()
        entry[size + 1] = 0
        self.outcome = self.number[entry]  # of the ids; the start's isn't used

    def fit_pairs(self, within: np.ndarray, first: np.ndarray, last: np.ndarray, across: np.ndarray, n_docs: int) -> None:
        """Counts, all by rows (the end at 0): within: of pairs inside words; first: of what starts a word; last: of what ends
        one; across: of pairs from one word to the next, in the spans."""
        start = first.astype(float).copy()
        start[0] += n_docs
        start = (start + 0.5 * self.mass / self.mass.sum()) / (start.sum() + 0.5)
        inner = (within.sum(0) + 0.5 * self.mass / self.mass.sum()) / (within.sum() + 0.5)
        n, kinds = within.sum(1, keepdims=True), (within > 0).sum(1, keepdims=True) + 1e-3
        p = (within + kinds * inner) / (n + kinds)  # Witten-Bell
        ends = (last[:, None] + 0.5) / (n + last[:, None] + 1)  # of words
        n, kinds = across.sum(1, keepdims=True), (across > 0).sum(1, keepdims=True) + 1e-3
        p = (1 - ends) * p + ends * (across + kinds * start) / (n + kinds)
        p[0] = start
        p = p[:, self.by_mass].reshape(INPUTS, GROUPS, SLOTS)
        of_group = p.sum(2)
        self.group = np.log(of_group).astype(np.float32)  # (row, group)
        self.slot = np.ascontiguousarray(np.log(p / of_group[:, :, None]).astype(np.float32).transpose(1, 0, 2))  # (group, row, slot)


# ---------------------------------------------------------------- the network

_I, _J = np.arange(STEP)[:, None] + BACK, np.arange(WINDOW)[None, :]
_AGE = np.clip(_I - _J, 0, WINDOW - 1)
_FUTURE = _J > _I


def new_weights(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {"E": (INPUTS, DIM), "q": (DIM, DIM), "k": (DIM, DIM), "v": (DIM, DIM), "age": (WINDOW,), "w1": (DIM, HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN, DIM)}
    w = {n: (rng.standard_normal(s) * (0.3 if n == "E" else 0.0 if len(s) == 1 else s[0] ** -0.5)).astype(np.float32) for n, s in shapes.items()}
    zeros = {"wg": (DIM, GROUPS), "bg": (GROUPS,), "ws": (GROUPS, DIM, SLOTS), "bs": (GROUPS, SLOTS)}
    return w | {n: np.zeros(s, np.float32) for n, s in zeros.items()}


def _softmax(lo: np.ndarray) -> np.ndarray:
    """Of the last axis. Rows' sums are a product with ones; rows' greatest are only looked for where exponentials could
    leave the range without."""
    ones = np.ones(lo.shape[-1], lo.dtype)
    with np.errstate(over="ignore"):
        z = np.exp(lo)
    total = z @ ones
    if not (total.min(initial=1) > 1e-20 and total.max(initial=1) < 1e20):
        z = np.exp(lo - lo.max(-1, keepdims=True))
        total = z @ ones
    z *= (1 / total)[..., None]
    return z


def gradients(w: dict[str, np.ndarray], group: np.ndarray, slot: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss of windows x (B, WINDOW input rows) with outcomes y (B, STEP; -1: not counted), and its gradients.
    group, slot: the pair model's log probabilities."""
    kind, c = w["E"].dtype, w["E"].dtype.type(DIM ** -0.5)
    xq, t, flat = x[:, BACK:], y.ravel(), lambda m: m.reshape(-1, m.shape[-1])
    e, kv = np.take(w["E"], x, axis=0), np.hstack([w["k"], w["v"]])
    eq = np.ascontiguousarray(e[:, BACK:])
    q, both = (flat(eq) @ (w["q"] * c)).reshape(eq.shape), (flat(e) @ kv).reshape(len(x), WINDOW, 2 * DIM)
    k, v = both[:, :, :DIM], both[:, :, DIM:]
    s = q @ k.transpose(0, 2, 1)
    s += np.where(_FUTURE, kind.type(-1e9), w["age"][_AGE])
    p = _softmax(s)
    # from here on, what counts, in the order of its group
    tg = np.where(t >= 0, t // SLOTS, GROUPS).astype(np.uint8)
    order = np.argsort(tg, kind="stable")
    ends = np.searchsorted(tg[order], np.arange(GROUPS + 1)).tolist()
    order = order[:ends[-1]]
    row, tg, ts = np.take(xq.ravel(), order), np.take(tg, order), np.take(t, order) % SLOTS
    h = np.take(flat(eq + p @ v), order, axis=0)
    a = h @ w["w1"]
    a += w["b1"]
    np.maximum(a, 0, out=a)
    h2 = h + a @ w["w2"]
    n, at, ones = max(len(order), 1), np.arange(len(order)) * SLOTS, np.ones(len(order), kind)

    def slope(lo: np.ndarray, goal: np.ndarray) -> tuple[float, np.ndarray]:
        z = _softmax(lo)
        i, cells = at + goal, z.reshape(-1)
        hit = cells[i]
        cells[i] = hit - 1
        z *= kind.type(1 / n)
        return -float(np.log(hit + 1e-30).sum()) / n, z

    lo = h2 @ w["wg"]
    lo += np.take(group, row, axis=0)
    lo += w["bg"]
    loss, z = slope(lo, tg)
    g = {"wg": h2.T @ z, "bg": ones @ z, "ws": np.zeros_like(w["ws"]), "bs": np.zeros_like(w["bs"])}
    d2 = z @ w["wg"].T
    # a group's targets in chunks of CHUNK, so that all groups are multiplied at once
    size = np.diff(ends)
    chunks = -(-size // CHUNK)
    of = np.repeat(np.arange(GROUPS), chunks)
    place = np.arange(len(order)) + np.repeat((np.cumsum(chunks) - chunks) * CHUNK - ends[:-1], size)
    h_in, z_in = np.zeros((len(of), CHUNK, DIM), kind), np.zeros((len(of), CHUNK, SLOTS), kind)
    flat(h_in)[place] = h2
    lo = np.take(flat(slot), tg.astype(np.int32) * INPUTS + row, axis=0)
    lo += np.take(flat(h_in @ w["ws"][of] + w["bs"][of, None]), place, axis=0)
    more, z = slope(lo, ts)
    flat(z_in)[place] = z
    d2 += np.take(flat(z_in @ w["ws"].transpose(0, 2, 1)[of]), place, axis=0)
    for j, (first, end) in enumerate(zip(ends, ends[1:])):
        if end > first:
            np.matmul(h2[first:end].T, z[first:end], out=g["ws"][j])
            np.matmul(ones[first:end], z[first:end], out=g["bs"][j])
    g["w2"] = a.T @ d2
    da = d2 @ w["w2"].T
    da *= (a > 0).astype(kind)
    g["w1"], g["b1"] = h.T @ da, ones @ da
    d2 += da @ w["w1"].T
    dh = np.zeros_like(eq)
    flat(dh)[order] = d2
    ds = dh @ v.transpose(0, 2, 1)
    ds -= np.einsum("bij,bij->bi", ds, p)[..., None]
    ds *= p
    g["age"] = np.bincount(_AGE.ravel(), np.where(_FUTURE, 0, ds.sum(0)).ravel(), WINDOW).astype(kind)
    dq, d_both = flat(ds @ k) * c, np.empty_like(both)
    np.matmul(ds.transpose(0, 2, 1), q, out=d_both[:, :, :DIM])
    np.matmul(p.transpose(0, 2, 1), dh, out=d_both[:, :, DIM:])
    g["q"], (g["k"], g["v"]) = flat(eq).T @ dq, np.hsplit(flat(e).T @ flat(d_both), 2)
    de = (flat(d_both) @ kv.T).reshape(e.shape)
    dh += (dq @ w["q"].T).reshape(dh.shape)
    de[:, BACK:] += dh
    g["E"] = _add_rows(flat(de), x.ravel())
    return loss + more, g


def _add_rows(rows: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Sums of the rows by their number in `of`, below INPUTS."""
    order = np.argsort(of, kind="stable")
    own = np.take(of, order)
    first = np.flatnonzero(np.diff(own, prepend=-1))
    out = np.zeros((INPUTS, rows.shape[1]), rows.dtype)
    if len(own):
        out[own[first]] = np.add.reduceat(np.take(rows, order, axis=0), first, axis=0)
    return out


def train(w: dict[str, np.ndarray], group: np.ndarray, slot: np.ndarray, windows: Iterator[tuple[np.ndarray, np.ndarray]], rate: float) -> tuple[dict[str, np.ndarray], int]:
    """Adam over batches of windows; the new weights and the number of windows."""
    flat = np.concatenate([v.ravel() for v in w.values()])
    ends = np.cumsum([v.size for v in w.values()])
    w = {k: own.reshape(v.shape) for (k, v), own in zip(w.items(), np.split(flat, ends[:-1]))}  # parts of `flat`
    m, s = np.zeros_like(flat), np.zeros_like(flat)
    n = step = 0
    for x, y in windows:
        _, g = gradients(w, group, slot, x, y)
        d = np.concatenate([g[k].ravel() for k in w])
        step, n = step + 1, n + len(x)
        m += 0.1 * (d - m)
        d *= d
        d -= s
        d *= 0.01
        s += d
        root = np.sqrt(s, out=d)
        root *= (1 - 0.99 ** step) ** -0.5
        root += 1e-6
        flat -= rate / (1 - 0.9 ** step) * m / root
    return w, n


class Network:
    """Trained weights as tables, for scoring."""

    def __init__(self, w: dict[str, np.ndarray], classes: Classes):
        self.e, self.w, self.classes = w["E"], w, classes
        self.q, self.k = w["E"] @ w["q"] * np.float32(DIM ** -0.5), w["E"] @ w["k"]
        self.v = np.hstack([w["E"] @ w["v"], np.ones((INPUTS, 1), np.float32)])  # the last column adds up the weights
        self.mask = np.where(_FUTURE, np.float32(-1e9), w["age"][_AGE])
        self.ones = np.ones(SLOTS, np.float32)
        # no score can exceed this, so its exponential is finite where the bound is below 80
        self.bound = float(np.linalg.norm(self.q, axis=1).max() * np.linalg.norm(self.k, axis=1).max() + w["age"].max())
        self.group = classes.group + w["bg"]
        self.slot = classes.slot + w["bs"][:, None, :]

    def log_probs(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Natural log probability of each text; ids: the subwords of all texts in a row, size: of each."""
        c, n = self.classes, len(size)
        last = len(c.row) - 1
        wins = (size + STEP) // STEP  # of size + 1 targets, the end being one
        length = wins * STEP + BACK + 1
        at = np.cumsum(length) - length
        stream = np.full(int(length.sum()), last, np.int32)  # the end, and after it what isn't counted
        stream[(at[:, None] + np.arange(BACK + 1)).ravel()] = last - 1  # the start, also as what comes before a text
        stream[np.repeat(at + BACK + 1 - (np.cumsum(size) - size), size) + np.arange(len(ids))] = ids
        row, outcome, rare = np.take(c.row, stream), np.take(c.outcome, stream), np.take(c.rare, stream)
        first = np.repeat(at, wins) + STEP * (np.arange(wins.sum()) - np.repeat(np.cumsum(wins) - wins, wins))
        left = np.repeat(size + 1, wins) - (first - np.repeat(at, wins))  # targets from here to the end
        text = np.repeat(np.arange(n), wins)
        out = np.zeros(n)
        for a in range(0, len(first), 4096):
            f, rest = first[a:a + 4096], left[a:a + 4096]
            h = np.empty((len(f), STEP, DIM), np.float32)
            for i in range(0, len(f), 64):  # small batches stay in the processor's cache
                h[i:i + 64] = self._hidden(row[f[i:i + 64, None] + _J[0]])
            live = np.arange(STEP) < rest[:, None]
            goal = (f[:, None] + np.arange(BACK + 1, WINDOW + 1))[live]
            lp = self._outcomes(h[live], row[goal - 1], outcome[goal]) + rare[goal]
            out += np.bincount(np.repeat(text[a:a + 4096], np.minimum(rest, STEP)), lp, n)
        return out

    def _hidden(self, x: np.ndarray) -> np.ndarray:
        """(B, STEP, DIM): what attention and the feed-forward layer make of the scored positions."""
        xq = x[:, BACK:]
        s = np.take(self.q, xq, axis=0) @ np.take(self.k, x, axis=0).transpose(0, 2, 1)
        s += self.mask
        if self.bound > 80:
            np.minimum(s, 60, out=s)
        np.exp(s, out=s)
        mixed = s @ np.take(self.v, x, axis=0)
        h = mixed[:, :, :DIM] / mixed[:, :, DIM:]
        h += np.take(self.e, xq, axis=0)
        flat = h.reshape(-1, DIM)
        a = flat @ self.w["w1"]
        a += self.w["b1"]
        np.maximum(a, 0, out=a)
        flat += a @ self.w["w2"]
        return h

    def _outcomes(self, h: np.ndarray, row: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Log probability of each outcome: of its group, and of its slot there."""
        out = np.empty(len(h), np.float32)
        place = np.arange(1024)

        def log_softmax(lo: np.ndarray, goal: np.ndarray) -> np.ndarray:
            picked = lo[place[:len(lo)], goal]
            np.exp(np.minimum(lo, 60, out=lo), out=lo)
            return picked - np.log(lo @ self.ones)

        group, slot = y // SLOTS, y % SLOTS
        for a in range(0, len(h), 1024):
            b = slice(a, a + 1024)
            lo = h[b] @ self.w["wg"]
            lo += np.take(self.group, row[b], axis=0)
            out[b] = log_softmax(lo, group[b])
        order = np.argsort(group.astype(np.uint8), kind="stable")
        ends = np.searchsorted(group[order], np.arange(GROUPS + 1))
        for j in range(GROUPS):
            for a in range(ends[j], ends[j + 1], 1024):
                own = order[a:min(a + 1024, ends[j + 1])]
                lo = np.take(h, own, axis=0) @ self.w["ws"][j]
                lo += np.take(self.slot[j], np.take(row, own), axis=0)
                out[own] += log_softmax(lo, np.take(slot, own))
        return out


# ---------------------------------------------------------------- jobs


def across_counts(pieces: DataFrame) -> np.ndarray:
    """Counts of (row, row of the next) where the next starts a word or ends the text, in all pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(INPUTS * INPUTS, np.int64)
        for b in batches:
            codes = b.column("codes")
            size = pc.list_value_length(codes).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = codes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            n = np.flatnonzero((place > BACK) & (flat >= LEAD))  # the targets: each once
            cell, times = np.unique(flat[n - 1] % LEAD * INPUTS + flat[n] % LEAD, return_counts=True)
            total[cell] += times
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    got = pieces.select("codes").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most INPUTS ** 2
    out = np.zeros(INPUTS * INPUTS, np.float32)
    out[got["cell"].to_numpy()] = got["n"].to_numpy()
    return out.reshape(INPUTS, INPUTS)


def fit_classes(words: DataFrame, docs: DataFrame, n_docs: int, shared, size: int, per_shard: int, max_shards: int) -> tuple[Classes, DataFrame, int]:
    """The classes, the pieces of all training documents, dealt in shards, and the number of their targets."""
    spark = words.sparkSession
    pairs = written(pair_counts(words, shared), "lm-pairs")
    got = pairs.where("b >= 0").groupBy("b").agg(F.sum("n").alias("n")).toArrow()  # at most one row for each subword of the tokenizer
    unigram = np.zeros(size)
    unigram[got["b"].to_numpy()] = got["n"].to_numpy()
    classes = Classes(size, unigram)
    ids = pa.table({"id": np.arange(size, dtype=np.int32), "row": classes.row[:size].astype(np.int32)})
    maps = F.broadcast(spark.createDataFrame(ids))  # a row for each subword of the tokenizer
    joined = pairs.join(maps.select(F.col("id").alias("a"), "row"), "a", "left").join(maps.select(F.col("id").alias("b"), F.col("row").alias("entry")), "b", "left")
    cells = joined.select(F.coalesce("row", F.lit(INPUTS)).alias("row"), F.coalesce("entry", F.lit(INPUTS)).alias("entry"), "n")
    cells = cells.groupBy("row", "entry").agg(F.sum("n").alias("n")).toArrow()  # at most (INPUTS + 1) ** 2
    count = np.zeros((INPUTS + 1, INPUTS + 1), np.float32)
    count[cells["row"].to_numpy(), cells["entry"].to_numpy()] = cells["n"].to_numpy()
    within, first, last = count[:INPUTS, :INPUTS], count[INPUTS, :INPUTS], count[:INPUTS, INPUTS]
    targets = int(unigram.sum()) + n_docs
    shards = max(1, min(max_shards, -(-targets // (STEP * per_shard))))
    pieces = training_pieces(docs, shared, classes).withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
    pieces = written(pieces.repartition(shards, "shard").sortWithinPartitions("shard", "key", "codes"), "lm-pieces", batch_rows=1000)
    classes.fit_pairs(within, first, last, across_counts(pieces), n_docs)
    return classes, pieces, targets


def _blocks(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """(shard, its rows in blocks), for rows in which a shard's stand together, however they are cut into batches."""

    def runs() -> Iterator[tuple[int, pa.RecordBatch]]:
        for b in batches:
            shard = b.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            yield from ((int(shard[a]), b.slice(a, e - a)) for a, e in zip(cuts, cuts[1:]) if e > a)

    def blocks(own: Iterator[tuple[int, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, b in own:
            while b.num_rows:
                held.append(b.slice(0, rows - n))
                n, b = n + held[-1].num_rows, b.slice(held[-1].num_rows)
                if n == rows:
                    yield pa.concat_batches(held)
                    held, n = [], 0
        if held:
            yield pa.concat_batches(held)

    for shard, own in groupby(runs(), key=lambda x: x[0]):
        yield shard, blocks(own)


def fit_network(pieces: DataFrame, n: int, classes: Classes, rounds: int, least: int, rate: float) -> dict[str, np.ndarray]:
    """pieces: of a written table, in which the rows of a shard stand together; n: about how many windows they hold."""
    spark = pieces.sparkSession
    w = new_weights()
    names = list(w)
    table = spark.sparkContext.broadcast((classes.number, classes.group, classes.slot))
    rounds = max(rounds, min(4 * rounds, -(-least // max(n, 1))))  # a small corpus is gone through more often
    for turn in range(rounds if n else 0):
        now = spark.sparkContext.broadcast(w)

        def run(batches: Iterator[pa.RecordBatch], now=now, turn=turn, rounds=rounds) -> Iterator[pa.RecordBatch]:
            number, group, slot = table.value

            def parts(shard: int, blocks: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for i, b in enumerate(blocks):
                    x, y = cut_windows(b)
                    y = np.where(y >= 0, number[y], -1)
                    order = np.random.default_rng((turn, shard, i)).permutation(len(x))  # windows of a text lie apart
                    for a in range(0, len(x), BATCH_WINDOWS):
                        own = order[a:a + BATCH_WINDOWS]
                        yield x[own], y[own]

            for shard, blocks in _blocks(batches):
                new, n = train(now.value, group, slot, parts(shard, blocks), rate * (1 - 0.8 * turn / rounds))
                flat = np.concatenate([new[k].ravel() for k in names]) * np.float32(n)
                yield pa.RecordBatch.from_arrays([pa.array([shard % 16], pa.int32()), pa.array([shard], pa.int32()), pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())], names=["part", "shard", "n", "w"])

        def add(t: pa.Table) -> pa.Table:
            t = t.sort_by("shard")
            total = np.sum([np.frombuffer(w.as_buffer(), np.float32) for w in t["w"]], axis=0)
            return pa.table([pa.array([sum(t["n"].to_pylist())], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["n", "w"])

        # the shards' weights are added up before they reach the driver: 16 rows
        got = pieces.mapInArrow(run, "part int, shard int, n long, w binary").groupBy("part").applyInArrow(add, "n long, w binary").collect()
        total = sum(r["n"] for r in got)
        flat, at = np.sum([np.frombuffer(r["w"], np.float32) for r in got if r["n"]], axis=0) / np.float32(total), 0
        for k in names:
            w[k] = flat[at:at + w[k].size].reshape(w[k].shape)
            at += w[k].size
        now.unpersist()
    return w


def frequent_words(words: DataFrame, most: int) -> tuple[DataFrame, float]:
    """(the words above a count, that count): as many as fit in `most`, by a histogram of the counts' logarithms."""
    level = F.floor(F.log2("c") * 8)
    hist = sorted(((r["l"], r["count"]) for r in words.groupBy(level.alias("l")).count().collect()), reverse=True)
    taken, least = 0, float("inf")
    for l, n in hist:
        if taken + n > most:
            break
        taken, least = taken + n, l
    return words.where(level >= F.lit(float(least))), least


def score_documents(docs: DataFrame, *, tokenizer: str = "/opt/tokenizers/byte_bpe_50k.tiktoken", id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = 2, least_windows: int = 150_000, per_shard: int = 20_000, max_shards: int = 256,
                    rate: float = 0.01, frequent: int = 1 << 17) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    ranks = read_ranks(tokenizer)  # a file of fixed size, read on the driver
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, ranks))
    size = max(ranks.values()) + 1
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))

    found = gather(rows)
    words = written(found.where("kind = 0").groupBy(F.col("s").alias("word")).agg(F.sum("n").alias("c")), "lm-words")
    n_docs = int(found.where("kind = 2").agg(F.sum("n")).first()[0] or 0)
    n_words, kinds = words.agg(F.sum("c"), F.count(F.lit(1))).first()
    total, kinds = int(n_words or 0) + n_docs, int(kinds) + (n_docs > 0)
    classes, pieces, n_targets = fit_classes(words, rows, n_docs, shared, size, per_shard, max_shards)
    weights = fit_network(pieces, -(-n_targets // STEP), classes, rounds, least_windows, rate)

    often, least = frequent_words(words, frequent)
    often = often.toArrow()  # at most `frequent` rows
    model = spark.sparkContext.broadcast((Network(weights, classes), dict(zip(often["word"].cast(pa.binary()).to_pylist(), often["c"].to_pylist()))))
    del often
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, known double, score double, words array<string>, times array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, counts = model.value
        lexicon = _Lexicon(_subwords(shared), counts)
        row = TaskContext.get().partitionId() << 36
        for b in _megabytes(batches):
            yield _score_batch(b, net, lexicon, row, n_docs)
            row += b.num_rows

    scored = written(rows.mapInArrow(run, schema), "lm-scored", batch_rows=1000)
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    rare = rare.join(words.where(F.floor(F.log2("c") * 8) < F.lit(float(least))), "word")
    rare = written(rare.groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("logs")), "lm-rare")
    out = scored.drop("words", "times").join(rare, "row", "left")
    known = F.col("known") + F.coalesce("logs", F.lit(0.0))
    base = known - F.col("n_tokens") * F.log10(F.lit(float(total + kinds + 1)))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
                      F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


class _Lexicon:
    """Numbers words; knows their subwords and, for frequent words, their counts. Forgets all when it is full."""

    def __init__(self, coder: Subwords, counts: dict[bytes, int]):
        self.coder, self.counts = coder, counts
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.ids = np.empty(0, np.int32)  # the subwords of all words in a row
        self.start, self.size, self.count = (np.empty(0, np.int64) for _ in range(3))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        number = self.number
        if len(number) > WORDS_KEPT:
            self.clear()
            number = self.number
        new = list(set(words).difference(number))
        if new:
            number.update(zip(new, range(len(self.words), len(self.words) + len(new))))
            self.words += new
            ids, size = self.coder.encode_all(new)
            count = np.fromiter((self.counts.get(w, 0) for w in new), np.int64, len(new))
            self.ids, self.size, self.count = np.append(self.ids, ids), np.append(self.size, size), np.append(self.count, count)
            self.start = np.cumsum(self.size) - self.size
        return np.fromiter(map(number.__getitem__, words), np.int32, len(words))


def _megabytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with about a megabyte of text at a time."""
    for b in batches:
        a, size = 0, 0
        for i, n in enumerate(pc.binary_length(pc.fill_null(b.column("t"), "")).to_pylist()):
            size += n
            if size >= 1 << 20 or i == b.num_rows - 1:
                yield b.slice(a, i + 1 - a)
                a, size = i + 1, 0


def _encoded(each_doc: list[list[bytes]], lex: _Lexicon) -> tuple[np.ndarray, ...]:
    """Of some texts' words: their numbers, the numbers in use, where each word's is among these, how many subwords
    each has; and all texts' subwords in a row."""
    flat = lex.numbers(list(chain.from_iterable(each_doc)))
    used = np.flatnonzero(np.bincount(flat, minlength=len(lex.words)))
    place = np.empty(len(lex.words), np.int32)
    place[used] = np.arange(len(used))
    each = np.take(lex.size, flat)
    where = np.repeat(np.take(lex.start, flat) - (np.cumsum(each) - each), each)
    where += np.arange(len(where))
    return flat, used, place[flat], each, np.take(lex.ids, where)


def _score_batch(b: pa.RecordBatch, net: Network, lex: _Lexicon, row: int, n_docs: int) -> pa.RecordBatch:
    ids = b.column("doc_id").to_pylist()
    each_doc = [_words(t.as_py()) for t in b.column("t")]
    n_words = np.array([len(x) for x in each_doc])
    flat, used, at, each, stream = _encoded(each_doc, lex)
    of = np.repeat(np.arange(len(ids)), n_words)
    score = net.log_probs(stream, np.bincount(of, each, len(ids)).astype(np.int64)) / LN10
    count = lex.count[used]
    known = np.bincount(of, np.log10(count + 1.0)[at], len(ids)) + np.log10(n_docs + 1.0)
    seen = (count > 0)[at]
    n_known = np.bincount(of, seen, len(ids)).astype(np.int64) + (n_docs > 0)
    # other words go to a join: (document, word) pairs and how often
    pair, times = np.unique(of[~seen] * np.int64(len(lex.words)) + flat[~seen], return_counts=True)
    doc = pair // max(len(lex.words), 1)
    ends = pa.array(np.searchsorted(doc, np.arange(len(ids) + 1)).astype(np.int32))
    words = pa.array([lex.words[k] for k in (pair % max(len(lex.words), 1)).tolist()], pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([
        pa.array(np.arange(row, row + len(ids))), b.column("doc_id"), pa.array([is_held_out(i) for i in ids]), pa.array(n_words + 1), pa.array(n_known),
        pa.array(known), pa.array(score), pa.ListArray.from_arrays(ends, words), pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))],
        names=["row", "doc_id", "held_out", "n_tokens", "n_known", "known", "score", "words", "times"])
