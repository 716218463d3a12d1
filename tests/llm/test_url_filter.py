import random

import numpy as np

from seqflow.llm import url_filter
from seqflow.llm.queries import URL_RULES


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS rule", "'z' AS t", "1 AS html")


def plain(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    best = (None, None)
    for verdict, rule in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best[0] is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *best


def urls():
    rng = random.Random(1)
    out = ["http://a.com", "http://A.COM/", "HTTP://www.Example.com/en/x", "http://x.www.example.com/en/", "http://example.com/EN/", "http://notcom/", "http://com/a",
           "http://x.net/es/1#f", "http://x.net/es", "http://x.net?/es/", "x.com/a", "", None, "://", "a://b://c.com/d", "http://ü.com/é?x", "http://e.net/fr/\nq", "http://" + "a" * 5000 + ".com/"]
    for i in range(400):
        good = rng.random() < 0.5
        name = rng.choice(["news", "story", "read", "paper"]) if good else rng.choice(["spam", "pills", "win", "casino"])
        out.append(f"http://{name}{rng.randint(1, 99)}.{'site.com' if good else 'example.com'}/{'de' if good else 'en'}/{rng.randint(1, 999)}")
        out.append(f"http://{name}{rng.randint(1, 99)}.other.org/xx/{rng.randint(1, 999)}")
    return out


def test_hosts_rules_and_method(spark):
    rows = [(i, u) for i, u in enumerate(urls())] + [(None, "http://a.com/")] * 2
    got = url_filter.filter_urls(frame(spark, rows), URL_RULES).collect()
    by_id = {r["page_id"]: r for r in got}
    assert len(got) == len(rows)
    right = total = 0
    for i, u in rows:
        host, path, rule, verdict = plain(u)
        r = by_id[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")
        if host.endswith("other.org"):
            total += 1
            right += r["verdict"] == ("block" if any(w in host for w in ("spam", "pills", "win", "casino")) else "allow")
    assert right >= 0.9 * total


def test_model_is_normalised():
    rng = np.random.default_rng(0)
    counts = np.zeros(url_filter.CELLS)
    counts[rng.integers(0, url_filter.CELLS, 3000)] = rng.integers(1, 9, 3000)
    p = np.exp(url_filter.log_model(counts, 2)).reshape(-1, url_filter.SYMBOLS)
    seen = p[rng.integers(0, len(p), 500)]
    assert np.allclose(seen.sum(1) - seen[:, 0] * (np.isclose(seen.sum(1), 1 + 1 / (url_filter.SYMBOLS - 1))), 1, atol=0.03)


def test_one_class_and_empty(spark):
    one = url_filter.filter_urls(frame(spark, [(1, "http://a.com/"), (2, "http://b.org/x"), (3, None)]), URL_RULES).collect()
    assert {r["page_id"]: r["verdict"] for r in one} == {1: "allow", 2: "allow", 3: "allow"}
    assert url_filter.filter_urls(frame(spark, []), URL_RULES).count() == 0
