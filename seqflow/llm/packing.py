"""Pack tokenized documents into training sequences by sum-of-squares online packing.

A document is its token ids and one end token. Runs of `capacity` ids fill sequences of their own; the rest of a document
goes, in the order of arrival, into an open window or a new one: a level array counts the open windows by the ids they
hold, and the rest goes where the sum of the squared counts becomes least (ties: the fullest window). When
`max_open` windows are open, and at the end of a shard, the fullest windows are filled up with pieces cut from the
emptiest; the ids that are left at the end go into sequences whose lengths are powers of two, which need
no padding. So no sequence is padded.

Scale: one pass without a shuffle. A shard is an input partition; a task holds one batch of texts, at most `max_open`
windows of ids and a bounded table of encoded words. Sequence ids hold the partition's number, so a task that is run again
after a lost executor gives the same rows.

Defined cases: a null text is empty, and an empty document is its end token alone; documents with a null or a
repeated id are packed like any other; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seqflow.llm.common import short_batches
from seqflow.llm.word_ids import encode, word_ids

ID = 4  # bytes
TEXT_BYTES, OUT_BYTES, OUT_ROWS = 8 << 20, 4 << 20, 5000


class Windows:
    """Open windows of up to `capacity` ids; `done` takes the pieces of a closed one.

    A piece is (document, start, ids as bytes). `twice[h]` is two times the number of open windows with
    h ids; full ones are not counted, and the last entry, -1, makes the rule below hold for them, too: moving
    a window from h to g changes the sum of squares by twice[g] - twice[h] + 2, opening one at g by twice[g] + 1.
    """

    def __init__(self, capacity: int, max_open: int, done) -> None:
        self.capacity, self.max_open, self.done, self.open = capacity, max_open, done, 0
        self.twice = np.zeros(capacity + 1, np.int64)
        self.twice[capacity] = -1
        self.at: dict[int, list[list[tuple]]] = defaultdict(list)

    def level(self, size: int) -> int:
        """The level of the window that takes `size` ids; 0: a new one."""
        new = self.twice[size] + 1
        if self.open and size < self.capacity:
            held = self.twice[self.capacity - size:0:-1]  # from the fullest that has room
            change = np.where(held > 0, self.twice[self.capacity:size:-1] - held + 2, new + 1)
            best = int(change.argmin())
            if change[best] <= new:
                return self.capacity - size - best
        return 0

    def place(self, piece: tuple) -> None:
        size = len(piece[2]) // ID
        level = self.level(size)
        window = self._take(level) if level else []
        window.append(piece)
        self._put(level + size, window)
        if self.open > self.max_open:
            self.settle(self.max_open // 2)

    def _take(self, level: int) -> list[tuple]:
        self.twice[level] -= 2
        self.open -= 1
        return self.at[level].pop()

    def _put(self, level: int, window: list[tuple]) -> None:
        if level == self.capacity:
            self.done(window)
        elif level:
            self.twice[level] += 2
            self.open += 1
            self.at[level].append(window)

    def settle(self, left: int) -> None:
        """Fills the fullest windows with pieces cut from the emptiest, until at most `left` (1 or more) are open."""
        order = [(h, w) for h in sorted(self.at, reverse=True) for w in self.at[h]]
        self.at.clear()
        self.twice[:self.capacity], self.open = 0, 0
        first, last = 0, len(order) - 1
        while last - first + 1 > left:
            (level, window), (low, giver) = order[first], order[last]
            room = self.capacity - level
            document, start, ids = giver.pop()
            size = min(room, len(ids) // ID)
            window.append((document, start, ids[:size * ID]))
            if size * ID < len(ids):
                giver.append((document, start + size, ids[size * ID:]))
            order[first], order[last] = (level + size, window), (low - size, giver)
            if level + size == self.capacity:
                self.done(window)
                first += 1
            if low == size:
                last -= 1
        for level, window in order[first:last + 1]:
            self._put(level, window)

    def finish(self) -> None:
        """Closes all windows: the last one's ids go into sequences of 2**k ids, the longest first."""
        if not self.open:
            return
        self.settle(1)
        rest = [w for windows in self.at.values() for w in windows]
        pieces = [p for w in rest for p in w][::-1]
        left = sum(len(p[2]) for p in pieces) // ID
        while left:
            room, window = 1 << left.bit_length() - 1, []
            left -= room
            while room:
                document, start, ids = pieces.pop()
                size = min(room, len(ids) // ID)
                window.append((document, start, ids[:size * ID]))
                room -= size
                if size * ID < len(ids):
                    pieces.append((document, start + size, ids[size * ID:]))
            self.done(window)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows from, to, of about TEXT_BYTES of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        n = max(1, int(np.searchsorted(ends[at:] - (ends[at - 1] if at else 0), TEXT_BYTES, "right")))
        yield at, at + n
        at += n


def _shard(batches: Iterator[pa.RecordBatch], schema: pa.Schema, spec: str, capacity: int, end: int, max_open: int) -> Iterator[pa.RecordBatch]:
    base, made = TaskContext.get().partitionId() << 32, 0
    rows: list[list] = [[] for _ in schema]
    held = 0

    def done(window: list[tuple]) -> None:
        nonlocal made, held
        tokens, offset = sum(len(p[2]) for p in window) // ID, 0
        for (doc, doc_tokens), start, ids in window:
            size = len(ids) // ID
            for column, x in zip(rows, (doc, start, size, ids, doc_tokens, base + made, offset, tokens), strict=True):
                column.append(x)
            offset, held = offset + size, held + len(ids)
        made += 1

    def flush() -> pa.RecordBatch:
        nonlocal held
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)
        held = 0
        for c in rows:
            c.clear()
        return out

    windows, words = Windows(capacity, max_open, done), word_ids(spec)
    tail = np.array([end], "<u4").tobytes()
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1)
        for a, b in _slices(texts):
            ids, bounds = encode(texts[a:b], words)
            for i in range(b - a):
                own = ids[bounds[i]:bounds[i + 1]].tobytes() + tail
                n = len(own) // ID
                doc = (keys[a + i], n)
                whole = n - n % capacity
                for start in range(0, whole, capacity):
                    done([(doc, start, own[start * ID:(start + capacity) * ID])])
                    if held >= OUT_BYTES:
                        yield flush()
                if whole < n:
                    windows.place((doc, whole, own[whole * ID:]))
                if held >= OUT_BYTES or len(rows[0]) >= OUT_ROWS:
                    yield flush()
    windows.finish()
    if rows[0]:
        yield flush()


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 2, max_open: int = 1024,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: the document's key, `start` and `length` of the piece in its document, `ids` (little-endian
    unsigned 32-bit numbers), `doc_tokens` with the end token, `sequence_id`, `offset` in the sequence and
    `sequence_tokens` (`capacity` or a power of two). `tokenizer`: path of the file on the driver, which hands its
    text, of fixed size, to the tasks."""
    short_batches(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType)] + [
        T.StructField(n, T.BinaryType() if n == "ids" else T.LongType(), False)
        for n in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens")])
    arrow = to_arrow_schema(schema)
    kept = docs.select(F.col(key), F.col(text).cast("string"))
    return kept.mapInArrow(lambda batches: _shard(batches, arrow, spec, capacity, end, max_open), schema)
