"""Phrases whose words occur together, by vertical partitioning of the suffix tree over words (the way of ERA).

A suffix is a word and up to three that follow it in its piece. Suffixes are grouped by word prefixes that fit a memory
budget: a prefix with more than `budget` / 4 occurrences is listed and extended by one more word (one with half as many may
be); all others are dealt by a hash to as many groups as keep a group's expected load at half the budget. Each group gets its suffixes from
every chunk of the corpus, builds its subtrees, cut at the greatest phrase length, from the sorted suffixes and reads each
node's count off the totals of the leaves below it. A listed prefix has leaves in several groups, whose totals are
added; counts of single words are the word counts. Scores, cuts and the rule on longer phrases are joins over the nodes.

Scale: the corpus is split and coded once, into chunks of numbers with a word list of their own; suffixes end at words
that are too rare to be in a phrase, as told by a table of `BITS` hashed bits (a rare word that it lets through costs
work, nothing else). Chunks count equal suffixes before the shuffle and send each group one compressed row, so no
single language, word or word pair meets in one task: whatever occurs too often is listed and dealt by a longer
prefix. The list, the only thing handed to all tasks, has at most `listed` prefixes; for larger corpora the
limit rises with their number of words, so give groups more memory there. The last ranking has at most 8 * `top`
rows a language.

Defined cases: a null text is empty, a null language is 'und'; documents and pieces without words give nothing; repeated rows
count each time; ties are in the order of the phrases; very long texts are coded like any other; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqflow.llm.common import short_batches, written

DEPTH = 4  # words of the longest phrase
CHUNK_BYTES, HELD_CHUNKS = 6 << 20, 3
BITS = 1 << 22
CHUNK = "lang string, words array<string>, counts array<long>, codes binary, n long"
PART = "group int, lang string, size int, data binary"
NODE = "lang string, phrase string, size int, f long, shared boolean"
STOP = "."  # stands for every sign that ends a piece, so no word holds it
LISTS = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("codes", pa.binary()), ("n", pa.int64())])


def _coded(lang: str, texts: list[pa.Array]) -> pa.RecordBatch:
    """A chunk: its distinct words, how often each occurs, and the texts as numbers of words from 1, 0 between pieces."""
    whole = pa.concat_arrays(texts)  # a copy: ascii_lower reads slices from the start of their buffer
    whole = pc.replace_substring(pc.ascii_lower(whole), "\t", " ")
    whole = pc.replace_substring_regex(whole, r"[.,;:!?\x0a-\x0d]+", f" {STOP} ")
    whole = pc.binary_join_element_wise(whole, pa.scalar(STOP, pa.large_string()), pa.scalar(" ", pa.large_string()))
    coded = pc.split_pattern(whole, " ").flatten().dictionary_encode()
    words = coded.dictionary.to_numpy(zero_copy_only=False)
    mark = (words != "") & (words != STOP)
    number = np.cumsum(mark).astype(np.int64) * mark
    number[words == ""] = -1
    codes = number[coded.indices.to_numpy(zero_copy_only=False)]
    codes = codes[codes >= 0].astype("<u4")
    counts = np.bincount(codes, minlength=int(mark.sum()) + 1)[1:]
    return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([words[mark].tolist()], LISTS.field(1).type), pa.array([counts], LISTS.field(2).type),
                                       pa.array([codes.tobytes()]), pa.array([int(counts.sum())])], schema=LISTS)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[pa.Array]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        langs = batch.column(0)
        for lang in pc.unique(langs).to_pylist():
            for a in range(0, batch.num_rows, 256):
                texts = pc.filter(batch.column(1)[a:a + 256], pc.equal(langs[a:a + 256], lang)).cast(pa.large_string())
                if not len(texts):
                    continue
                held.setdefault(lang, []).append(texts)
                size[lang] = size.get(lang, 0) + texts.nbytes
                if size[lang] >= CHUNK_BYTES or sum(size.values()) >= HELD_CHUNKS * CHUNK_BYTES:
                    most = max(size, key=size.get)
                    del size[most]
                    yield _coded(most, held.pop(most))
                    pa.default_memory_pool().release_unused()
    for lang in held:
        yield _coded(lang, held[lang])


def _bit(lang: Column, word: Column) -> Column:
    return F.pmod(F.crc32(F.concat_ws("\0", lang, word)), F.lit(BITS))


def _bits(words: DataFrame) -> bytes:
    """One bit for each hash of a (lang, word): BITS bits, whatever the number of words."""
    at = words.select(_bit(F.col("lang"), F.col("phrase")).alias("b"))
    rows = at.groupBy(F.floor(F.col("b") / 32).cast("int").alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 32 as int))")).alias("bits")).collect()
    out = np.zeros(BITS // 32, "<u4")
    for r in rows:
        out[r["i"]] = r["bits"]
    return out.tobytes()


class Listed:
    """The listed prefixes: for each language and depth, (number of the prefix one word shorter, last word) -> number."""

    def __init__(self) -> None:
        self.langs: dict[str, list[dict[tuple[int, str], int]]] = {}

    def add(self, lang: str, phrase: str) -> None:
        words, parent = phrase.split(" "), 0
        levels = self.langs.setdefault(lang, [{} for _ in range(DEPTH)])
        for d, word in enumerate(words[:-1]):
            parent = levels[d][parent, word]
        levels[len(words) - 1][parent, words[-1]] = len(levels[len(words) - 1])


class Suffixes:
    """The suffixes of a chunk that have two words or more, all of them perhaps frequent."""

    def __init__(self, lang: str, words: list[str], codes: bytes, bits: np.ndarray, listed: Listed) -> None:
        self.lang, tag = lang, lang.encode() + b"\0"
        at = np.fromiter((zlib.crc32(tag + w.encode()) for w in words), np.int64, len(words)) % BITS
        kept = np.flatnonzero(bits[at // 32] >> (at % 32).astype(np.uint32) & 1)
        kept = np.array(sorted(kept.tolist(), key=words.__getitem__), np.int64)  # neighbours share beginnings and compress well
        self.words = [STOP] + [words[i] for i in kept.tolist()]
        number = np.zeros(len(words) + 1, np.int32)
        number[kept + 1] = np.arange(1, len(kept) + 1)
        codes = np.concatenate((number[np.frombuffer(codes, "<u4")], np.zeros(DEPTH, np.int32)))
        n = len(codes) - DEPTH
        levels = [codes[:n]]
        for d in range(1, DEPTH):
            levels.append(codes[d:n + d] * (levels[-1] > 0))
        two = levels[1] > 0
        self.at = [w[two] for w in levels]
        self.base = len(self.words)
        self.levels = listed.langs.get(lang, [])

    def count(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Distinct suffixes, sorted, and how often each occurs."""
        b = self.base
        first, rest = (self.at[d].astype(np.int64) * b + self.at[d + 1] for d in (0, 2))
        known = None
        if b ** DEPTH >= 1 << 63:
            known, first = np.unique(first, return_inverse=True)
        keys = first * (b * b) + rest
        del first, rest
        keys.sort()
        ends = np.flatnonzero(np.concatenate((keys[1:] != keys[:-1], [True]))) if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[ends], np.diff(np.concatenate(([-1], ends)))
        first, rest = keys // (b * b), keys % (b * b)
        if known is not None:
            first = known[first]
        return [w.astype(np.int32) for w in (first // b, first % b, rest // b, rest % b)], counts.astype(np.int32)

    def matched(self, at: list[np.ndarray]) -> Iterator[np.ndarray]:
        """For depth 1, 2, ...: the number of each suffix's listed prefix of so many words, -1 without."""
        number = {w: i for i, w in enumerate(self.words)} if self.levels else {}
        parent = np.zeros(len(at[0]), np.int64)
        for level, w in zip(self.levels, at, strict=False):
            here = sorted((p * self.base + number[word], i) for (p, word), i in level.items() if word in number)
            keys = np.array([k for k, _ in here] + [1 << 62], np.int64)
            values = np.array([i for _, i in here] + [-1], np.int64)
            key = np.where(parent >= 0, parent * self.base + w, -1)
            place = np.searchsorted(keys, key)
            parent = np.where(keys[place] == key, values[place], -1)
            yield parent


def _suffixes(batch: pa.RecordBatch, bits: np.ndarray, listed: Listed) -> Iterator[Suffixes]:
    for i in range(batch.num_rows):
        yield Suffixes(batch.column(0)[i].as_py(), batch.column(1)[i].values.to_numpy(zero_copy_only=False).tolist(), batch.column(2)[i].as_py(), bits, listed)


def _extended(chunks: DataFrame, bits: bytes, listed: Listed, depth: int, share: float) -> DataFrame:
    """Prefixes of `depth` words that extend a listed one by a word, with their occurrences in chunks where they are more
    than `share` of the words. What the other chunks hold of a prefix is at most that share of all words."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, "<u4")
        for batch in batches:
            for s, n in zip(_suffixes(batch, table, listed), batch.column("n").to_pylist(), strict=True):
                numbers = list(s.matched(s.at))[:depth - 1]
                if len(numbers) < depth - 1:
                    continue
                on = np.flatnonzero((numbers[-1] >= 0) & (s.at[depth - 1] > 0))
                keys, first, counts = np.unique(numbers[-1][on] * s.base + s.at[depth - 1][on], return_index=True, return_counts=True)
                often = counts > share * n
                keys, first, counts = keys[often], first[often], counts[often]
                at = [w[on[first]].tolist() for w in s.at[:depth]]
                phrases = [" ".join([s.words[c] for c in row]) for row in zip(*at, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([s.lang] * len(keys), pa.string()), pa.array(phrases, pa.string()), pa.array(counts)], schema=schema)

    out = chunks.select("lang", "words", "codes", "n").mapInArrow(run, "lang string, phrase string, f long")
    return out.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _planes(a: np.ndarray) -> bytes:
    """32-bit numbers byte by byte: first all lowest bytes, and so on."""
    return np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _parts(batches: Iterator[pa.RecordBatch], bits: bytes, listed: Listed, groups: int) -> Iterator[pa.RecordBatch]:
    """A row per group and chunk: the chunk's suffixes whose prefix belongs to the group, with their counts."""
    table, pack = np.frombuffer(bits, "<u4"), zstandard.ZstdCompressor(level=3)
    schema = pa.schema([("group", pa.int32()), ("lang", pa.string()), ("size", pa.int32()), ("data", pa.binary())])
    for batch in batches:
        for s in _suffixes(batch, table, listed):
            at, counts = s.count()
            depth = np.ones(len(counts), np.uint8)
            for number in s.matched(at):
                depth += number >= 0
            depth = np.minimum(depth, DEPTH)
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, 13) for w in s.words), np.uint64, s.base)
            h = np.full(len(counts), xxhash.xxh64_intdigest(s.lang, 13), np.uint64)
            for d, w in enumerate(at):
                h = np.where(d < depth, (h ^ hashes[w]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(d + 1), h)
            group = (h >> np.uint64(11)) % np.uint64(groups)
            order = np.argsort(group, kind="stable")
            group = group[order]
            at, counts, depth = [w[order] for w in at], counts[order], depth[order]
            begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)
            rows: list[list] = [[], [], [], []]
            for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(group)], strict=False):
                used = np.zeros(s.base, bool)
                for w in at:
                    used[w[a:b]] = True
                used[0] = False
                number = np.cumsum(used) * used
                words = STOP.join([s.words[i] for i in np.flatnonzero(used).tolist()]).encode()
                data = b"".join([_planes(number[w[a:b]]) for w in at] + [_planes(counts[a:b]), depth[a:b].tobytes(), words])
                for column, x in zip(rows, (int(group[a]), s.lang, b - a, pack.compress(data)), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)


def _subtrees(parts: pa.Table, least: int) -> pa.Table:
    """The nodes of a group's subtrees with at least `least` occurrences, and this group's share of listed prefixes."""
    unpack, number, langs = zstandard.ZstdDecompressor(), {STOP: 0}, {}
    columns: list[list[np.ndarray]] = [[] for _ in range(DEPTH + 3)]
    for lang, n, data in zip(*(parts.column(c).to_pylist() for c in ("lang", "size", "data")), strict=True):
        data = unpack.decompress(data)
        raw, words = np.frombuffer(data, np.uint8, n * (4 * (DEPTH + 1) + 1)), data[n * (4 * (DEPTH + 1) + 1):]
        own = np.array([0] + [number.setdefault(w, len(number)) for w in words.decode().split(STOP)], np.int32)
        for d in range(DEPTH + 1):
            numbers = np.ascontiguousarray(raw[4 * n * d:4 * n * (d + 1)].reshape(4, n).T).view("<u4").ravel()
            columns[d].append(own[numbers] if d < DEPTH else numbers)
        columns[DEPTH + 1].append(raw[-n:])
        columns[DEPTH + 2].append(np.full(n, langs.setdefault(lang, len(langs)), np.int32))
    *at, counts, depth, lang = (np.concatenate(columns.pop(0)) for _ in range(DEPTH + 3))
    base, names, words = len(number), list(langs), list(number)
    order = np.lexsort((at[2].astype(np.int64) * base + at[3], (lang.astype(np.int64) * base + at[0]) * base + at[1]))
    at, counts, depth, lang = [w[order] for w in at], counts[order], depth[order], lang[order]
    out: list[list] = [[], [], [], [], []]
    new = np.concatenate(([True], (lang[1:] != lang[:-1]) | (at[0][1:] != at[0][:-1]))) if len(lang) else np.zeros(0, bool)
    for size in range(2, DEPTH + 1):
        new[1:] |= at[size - 1][1:] != at[size - 1][:-1]
        begin = np.flatnonzero(new)
        if not len(begin):
            break
        totals = np.add.reduceat(counts, begin, dtype=np.int64)
        shared = depth[begin] > size
        on = (shared | (totals >= least)) & (at[size - 1][begin] > 0)
        begin, totals, shared = begin[on], totals[on], shared[on]
        out[0] += [names[i] for i in lang[begin].tolist()]
        out[1] += [" ".join([words[c] for c in row]) for row in zip(*(w[begin].tolist() for w in at[:size]), strict=True)]
        out[2] += [size] * len(begin)
        out[3] += totals.tolist()
        out[4] += shared.tolist()
    kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.bool_())
    return pa.table([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["lang", "phrase", "size", "f", "shared"])


def phrase_counts(docs: DataFrame, least: int, budget: int = 1 << 21, listed: int = 1 << 18, text: str = "text",
                  lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of all phrases of 1 to 4 words with at least `least` occurrences, (lang, n))."""
    spark = docs.sparkSession
    short_batches(spark)
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    chunks = written(texts.mapInArrow(_chunks, CHUNK), "phrases-chunks")
    totals = written(chunks.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"), "phrases-totals")
    pairs = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    words = pairs.groupBy("lang", F.col("x.words").alias("phrase")).agg(F.sum("x.counts").alias("f")).where(F.col("f") >= least)
    words = written(words.select("lang", "phrase", F.lit(1).alias("size"), "f"), "phrases-words")

    n = totals.agg(F.sum("n")).first()[0] or 0
    limit = max(budget // 4, DEPTH * n // listed, 2)
    bits, plan, found = _bits(words), Listed(), words.where(F.col("f") > limit)
    for depth in range(1, DEPTH):
        if depth > 1:  # of a prefix above the limit, more than half of it is found
            found = _extended(chunks, bits, plan, depth, limit / 2 / n).where(F.col("f") > limit / 2)
        most = found.select("lang", "phrase").collect()  # at most 2 * n / limit rows
        for r in most:
            plan.add(*r)
        if not most:
            break
    groups = max(1, -(-2 * (words.agg(F.sum("f")).first()[0] or 0) // budget))  # a suffix begins with a frequent word
    parts = chunks.select("lang", "words", "codes").mapInArrow(lambda b: _parts(b, bits, plan, groups), PART)
    nodes = parts.groupBy("group").applyInArrow(lambda t: _subtrees(t, least), NODE)
    nodes = written(nodes, "phrases-subtrees")
    whole = nodes.where("shared").groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    nodes = words.unionByName(nodes.where("not shared").drop("shared")).unionByName(whole)
    return written(nodes, "phrases-nodes"), totals


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, scale: int = 2_000_000, cover: int = 80,
                 budget: int = 1 << 21, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases. `cover`: a phrase goes if a longer
    candidate that holds it has at least so many percent of its occurrences."""
    nodes, totals = phrase_counts(docs, least, budget, text=text, lang=lang)
    split = F.split("phrase", " ", -1)
    part = lambda a, n: F.concat_ws(" ", F.slice(split, a, n))
    cands = nodes.where("size > 1")
    cuts = cands.select("lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    left = nodes.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = nodes.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr(f"cast({scale} as decimal(18,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = cuts.withColumn("cut", F.struct(score.alias("score"), "k", "l", "r")).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))
    inside = cands.where("size > 2").select("lang", "f", F.explode(F.array(part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))  # the words of a candidate's part are a candidate, too
    kept = best.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(20,0)") < cover * F.col("a").cast("decimal(20,0)")))
    kept = kept.select("lang", "phrase", "a", F.col("cut.score").alias("score"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    for salts in (64, 8):
        w = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
        kept = kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    w = Window.partitionBy("lang").orderBy(*order)
    kept = kept.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH piece AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda w: w <> '') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
      FROM documents))
), word AS (
  SELECT lang, piece, words, unnest(generate_series(1, len(words))) AS i FROM piece WHERE len(words) > 0
), gram AS (
  SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM word, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE i + size - 1 <= len(words) GROUP BY ALL
), total AS (
  SELECT lang, sum(f) AS n FROM gram WHERE size = 1 GROUP BY lang
), cand AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM gram WHERE size > 1 AND f >= 30
), cut AS (
  SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM cand)
), scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f), c.k) AS place
  FROM cut c JOIN gram x ON x.lang = c.lang AND x.phrase = c.first JOIN gram y ON y.lang = c.lang AND y.phrase = c.rest
), inside AS (
  SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(generate_series(1, size - n + 1)) AS i FROM (SELECT *, unnest(generate_series(2, size - 1)) AS n FROM cand WHERE size > 2)) GROUP BY ALL
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE s.place = 1 AND (i.longer IS NULL OR 100 * i.longer < 80 * s.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT k.lang, k.rank, k.phrase, CAST(k.a AS BIGINT) AS a, CAST(k.l AS BIGINT) AS l, CAST(k.r AS BIGINT) AS r, CAST(t.n AS BIGINT) AS n, k.score
FROM ranked k JOIN total t ON t.lang = k.lang WHERE k.rank <= 2000
"""
