import random

from seqflow.llm import decontaminate
from seqflow.llm.decontaminate import edits_within, normal

from .data import documents, edge_rows, prose


def edits(p, t):
    row, best = list(range(len(p) + 1)), len(p)
    for c in t:
        new = [0]
        for i in range(1, len(p) + 1):
            new.append(min(row[i - 1] + (p[i - 1] != c), row[i] + 1, new[i - 1] + 1))
        row, best = new, min(best, new[-1])
    return best


def change(rng, p, n):
    s = list(p)
    for _ in range(n):
        k = rng.randrange(len(s))
        x = rng.random()
        if x < 0.3:
            s.pop(k)
        elif x < 0.6:
            s.insert(k, rng.choice("aeiou "))
        else:
            s[k] = rng.choice("xyz")
    return "".join(s)


def test_banded_alignment_matches_full_alignment():
    rng = random.Random(1)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(8, 40))).encode()
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 50)))
        if rng.random() < 0.6:
            t = t[:len(t) // 2] + change(rng, p.decode(), rng.randint(0, 4)) + t[len(t) // 2:]
        e, d = rng.randint(0, 8), edits(p, t.encode())
        assert edits_within(p, t.encode(), e) == (d if d <= e else None)


def sample(spark, planted=True):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(15, 40))) for i in range(12)]
    rows = edge_rows()
    for i in range(40):
        text = prose(rng, rng.randint(20, 200))
        if i % 4 == 0 and planted:
            item = items[i // 4 % 12][1]
            text += " " + (change(rng, item, max(1, int(0.04 * len(item)))) if i % 8 else item.upper().replace(" ", "\n", 3)) + " " + prose(rng, 10)
        rows.append((i, text, "en", "s", 0))
    bench = spark.createDataFrame(items + [(50, None), (51, ""), (52, "short"), (0, items[0][1])], "item_id long, text string")
    return rows, items, bench


def test_leaks_match_brute_force(spark):
    rows, items, bench = sample(spark)
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.find_leaks(documents(spark, rows), bench).collect()}
    exp = {}
    for r in rows:
        if r[1] and len(r[1]) < 5000:
            for i, item in items:
                p = normal(item)
                if len(p) <= 256 and (d := edits(p, normal(r[1]))) <= min(int(0.1 * len(p)), (len(p) - 8) // 8):
                    exp[r[0], i] = d
    assert exp and {k: v for k, v in got.items() if len(normal(items[k[1]][1])) <= 256} == exp


def test_blocks_of_items_give_the_same(spark):
    rows, _, bench = sample(spark)
    docs = documents(spark, rows)
    one, many = (sorted(decontaminate.find_leaks(docs, bench, block_bytes=b).collect()) for b in (1 << 22, 600))
    assert one == many and one
    left = decontaminate.clean_documents(docs, bench, block_bytes=600)
    assert left.columns == docs.columns
    assert sorted(map(repr, (r["doc_id"] for r in left.collect()))) == sorted(repr(r[0]) for r in rows if r[0] not in {x["doc_id"] for x in one})


def test_parts_of_long_items_and_empty_tables(spark):
    rng = random.Random(6)
    long = prose(rng, 200)
    bench = spark.createDataFrame([(1, long)], "item_id long, text string")
    docs = documents(spark, [(1, prose(rng, 30) + " " + long[300:800] + " " + prose(rng, 30), "en", "s", 0), (2, prose(rng, 300), "en", "s", 0)])
    assert [r["doc_id"] for r in decontaminate.find_leaks(docs, bench).collect()] == [1]
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.clean_documents(docs, bench.limit(0)).count() == 2
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
