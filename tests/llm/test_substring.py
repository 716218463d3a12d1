import random
from collections import defaultdict

import xxhash

from seqflow.llm import substring

from .data import documents, edge_rows, prose


def run(spark, rows, **options):
    out = substring.dedup_substrings(documents(spark, rows), **options)
    return [(r["doc_id"], r["text"], r["_seqflow_cut"]["text"], r["_seqflow_cut"]["spans"], list(r["_seqflow_cut"]["kept_in"])) for r in out.collect()]


def sample():
    rng = random.Random(8)
    rows = edge_rows()
    passages = [prose(rng, 70) for _ in range(6)]
    for i in range(60):
        parts = [prose(rng, rng.randint(30, 90)), prose(rng, rng.randint(30, 90))]
        if i % 2:
            parts.insert(1, passages[i % 6])
        rows.append((i, ("  " if i % 3 else "") + "\n".join(parts), "en", "s", 0))
    return rows


def grams(text, n):
    w = text.split()
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}


def test_repeated_passages_stay_once(spark):
    rows = sample()
    seen, touched = {}, set()
    for doc_id, old, new, spans, kept_in in sorted((x for x in run(spark, rows) if x[0] is not None and x[0] < 900), key=lambda x: x[0]):
        for g in grams(new, 50):
            assert g not in seen
            seen[g] = doc_id
        if spans:
            touched.add(doc_id)
            assert kept_in and max(kept_in) < doc_id and len(new) < len(old)
            assert len(old.split()) - len(new.split()) <= 70  # nothing but the passage
        else:
            assert new == old
    assert touched == {i for i in range(60) if i % 2 and i >= 6}


def test_defined_cases(spark):
    got = {x[0]: x for x in run(spark, sample())}
    for doc_id in (None, 900, 901, 902, 903, 906):
        assert got[doc_id][1] == got[doc_id][2] and got[doc_id][3] == 0
    assert len(got[904][2].split()) < 200  # one word over and over: the first stretch stays
    assert run(spark, []) == []


def test_shuffled_texts_give_the_same(spark):
    rows = sample()
    assert sorted(run(spark, rows), key=repr) == sorted(run(spark, rows, broadcast_places=0), key=repr)


def test_cuts_resist_insertions():
    rng = random.Random(4)
    for _ in range(30):
        body = prose(rng, 200).encode()
        a, b = substring.cut_points([body, b"some words put before " + body])
        shift = len(b) and len(b"some words put before ")
        same = {x + shift for x in a} & set(b)
        assert len(same) >= 0.8 * len(a)
    for t in ("", "x" * 1000, "é" * 500, "a b"):
        ends = substring.cut_points([t.encode()])[0]
        assert ends == sorted(set(ends)) and (ends[-1] == len(t.encode()) if t else not ends)
        assert b"".join(t.encode()[s:e] for s, e in zip([0, *ends], ends)).decode() == t


def plain_cuts(t):
    """The ends of the chunks, byte by byte."""
    def hash_at(i):
        return sum((xxhash.xxh32_intdigest(t[i - k:i - k + 1], 6) & 0xFFFF if t[i - k] else 0) << k for k in range(16) if i >= k) & 0xFFFF

    white = b" \t\n\r\x0b\x0c"
    ends, last = [], 0
    while last < len(t):
        cut = next((c for c in range(last + 16, len(t) + 1) if t[c - 1] in white and hash_at(c - 1) < 65536 // 3), len(t))
        while cut - last > 96:
            places = [c for c in range(last + 16, last + 97) if t[c - 1] in white] or [c for c in range(last + 16, last + 97) if t[c] & 0xC0 != 0x80]
            last = min(places, key=lambda c: (hash_at(c - 1), c))
            ends.append(last)
        ends.append(cut)
        last = cut
    return ends


def plain_dedup(rows, min_words):
    """(doc_id, text left, spans removed, kept in) by a dictionary of all windows."""
    texts = {i: t.encode() for i, t in rows if i is not None and t}
    windows, at = {}, defaultdict(list)
    for i, t in texts.items():
        ends = plain_cuts(t)
        starts = [0, *ends[:-1]]
        windows[i] = list(zip(starts, ends[1:])) if len(ends) > 1 else [(0, ends[0])]
        for s, e in windows[i]:
            at[t[s:e]].append((i, s))
    out = set()
    for i, text in rows:
        t, covered, kept = (text or "").encode(), [], {}
        for s, e in windows.get(i, []):
            first = min(at[t[s:e]])
            if first != (i, s):
                if covered and s <= covered[-1][1]:
                    covered[-1][1] = e
                else:
                    covered.append([s, e])
                kept.setdefault(covered[-1][0], set()).add(first[0])
        covered = [x for x in covered if len(t[x[0]:x[1]].split()) >= min_words]
        left = bytes(c for k, c in enumerate(t) if not any(s <= k < e for s, e in covered)).decode()
        out.add((i, left if text is not None else None, len(covered), tuple(sorted(set().union(*(kept[s] for s, _ in covered))))))
    return out


def monotone_rows():
    """Texts that share passages without a cut by hash: one or two words, or letters, over and over."""
    rng = random.Random(11)
    words = ["zz", "mirror", "lantern", "oak"]
    rows = []
    for i in range(40):
        a, b = words[i % 4], words[(i // 4) % 4]
        rows.append((i, " ".join([prose(rng, rng.randint(20, 60)), " ".join([a, b] * 30), prose(rng, rng.randint(20, 60))]), "en", "s", 0))
    return rows + [(50, "é" * 700, "en", "s", 0), (51, "ab" + "é" * 500, "en", "s", 0), (52, "word " * 300 + "x" * 400, "en", "s", 0)]


def test_equals_a_plain_version(spark):
    base = [r for r in sample() if r[0] is None or len(r[1] or "") < 20_000]
    for rows in (base, monotone_rows()):
        for min_words in (20, 1):
            got = {(i, new, spans, tuple(kept)) for i, _, new, spans, kept in run(spark, rows, min_words=min_words)}
            assert got == plain_dedup([(r[0], r[1]) for r in rows], min_words)


def test_passages_without_a_cut_by_hash_are_found(spark):
    met = set()
    for doc_id, old, new, spans, _ in sorted(x for x in run(spark, monotone_rows()) if x[0] < 40):
        kind = frozenset(old.split()) & {"zz", "mirror", "lantern", "oak"}
        if kind in met:
            assert spans and len(old.split()) - len(new.split()) >= 40
        met.add(kind)
