"""Components, embeddings and url verdicts against plain versions."""

import random

import numpy as np
import pytest
from plain import groups
from pyspark.sql import functions as F

from marketloom.llm import embeddings, urls
from marketloom.llm.components import components


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)]
    edges += [(500, x) for x in range(501, 600)] + [(7, 7), (700, 700)]
    got = {r.node: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = groups({x for e in edges for x in e}, edges)
    assert all(want[n] == c for n, c in got.items())
    assert all(n in got or want[n] == n for n in want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    centers = rng.standard_normal((30, 16))
    dense = rng.standard_normal(16) + 0.05 * rng.standard_normal((90, 16))  # wider than the window
    near = (centers[:, None] + 0.12 * rng.standard_normal((30, 6, 16))).reshape(-1, 16)
    x = np.concatenate([dense, near, near[:20]])
    label = np.concatenate([np.zeros(90, int), rng.integers(0, 3, len(near)), np.zeros(20, int)])
    rows = [(int(i), [float(v) for v in r], int(c), 1, "x") for i, (r, c) in enumerate(zip(x, label, strict=True))]
    bad = [(1000, None, 0), (1001, [0.0] * 16, 0), (1002, [None] * 16, 0), (1003, [float("nan")] * 16, 0),
           (1004, [float("inf")] * 16, 1), (1005, list(map(float, x[0])), None), (1006, [], 0), (None, list(map(float, x[0])), 0)]
    df = spark.createDataFrame([*rows, *((*b, 1, "x") for b in bad)],
                               "vec_id long, embedding array<double>, label int, rep long, unit string")
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, window=16, block=32).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = (u @ u.T >= embeddings.COSINE) & (label[:, None] == label[None])
    np.fill_diagonal(hit, False)
    want = groups(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(hit), strict=True)])
    found = sum(got[i].n_links for i in range(len(x)))
    assert found >= 0.99 * hit.sum() and all(got[i].n_links <= hit[i].sum() for i in range(len(x)))
    assert all(got[i].component_id == want[i] and got[i].kept == (want[i] == i) for i in range(len(x)))
    assert all(got[b[0]].n_links == 0 and got[b[0]].kept and got[b[0]].component_id == b[0] for b in bad)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def plain_ranks(links, trust, distrust):
    hosts = set(trust) | {h for e in links for h in e}
    out, into = {h: 0 for h in hosts}, {h: 0 for h in hosts}
    for (a, b), n in links.items():
        out[a] += n
        into[b] += n
    t0, d0 = ({h: (1 - urls.DAMPING) * s.get(h, 0) for h in hosts} for s in (trust, distrust))
    t, d = dict(t0), dict(d0)
    for _ in range(urls.STEPS):
        t2, d2 = dict(t0), dict(d0)
        for (a, b), n in links.items():
            t2[b] += urls.DAMPING * n / out[a] * t[a]
            d2[a] += urls.DAMPING * n / into[b] * d[b]
        t, d = t2, d2
    return t, d


def test_urls_spread_trust_and_distrust(spark):
    rng = random.Random(3)
    hosts = [f"h{i}.org" for i in range(8)] + ["good.com", "www.example.com", "bad.net", "x.example.com"]
    pages = [(i, f"http://{rng.choice(hosts).upper()}{rng.choice(['/en/', '/es/', '/fr/a?b', '', '#x'])}", "".join(
        f"<a HREF = 'https://{rng.choice(hosts)}/p'>" for _ in range(rng.randrange(4)))) for i in range(200)]
    pages += [(900, None, "<a href=//h1.org>"), (901, "no host", None), (902, "http://", None), (902, "http://", None)]
    pages += [(950 + i, f"http://evil.net/{'es' if i else 'it'}/", "") for i in range(6)]
    df = spark.createDataFrame([(*p, "clash", 1) for p in pages], "page_id long, url string, html string, host string, trust int")
    got = {r.page_id: r for r in urls.judged(df).collect()}
    links, trust, distrust, count = {}, {}, {}, {}
    for r in urls.parsed(df).collect():
        if r.host:
            count[r.host] = count.get(r.host, 0) + 1
            trust[r.host] = trust.get(r.host, 0) + (r.ruled == "allow")
            distrust[r.host] = distrust.get(r.host, 0) + (r.ruled == "block")
            for x in set(r.links) - {r.host}:
                links[r.host, x] = links.get((r.host, x), 0) + 1
    share = lambda s: {h: v / count[h] for h, v in s.items()}
    t, d = plain_ranks(links, share(trust), share(distrust))
    verdicts = set()
    for r in got.values():
        if r.host:
            assert r.trust == pytest.approx(t[r.host]) and r.distrust == pytest.approx(d[r.host])
        if r.rule is None:
            blocked = bool(r.host) and d[r.host] > t[r.host] and d[r.host] > (1 - urls.DAMPING) * urls.SHARE
            assert r.verdict == ("block" if blocked else "allow")
            verdicts.add(r.verdict)
    assert verdicts == {"allow", "block"}
    assert (got[900].host, got[900].verdict, got[902].host) == ("", "allow", "")


def test_url_rules(spark):
    urls_ = {
        "http://a.example.com/en/x": ("example.com/en/", "block"), "http://www.EXAMPLE.com/en/": ("www.example.com/en/", "allow"),
        "https://q.com/": ("com/", "allow"), "https://q.com": (None, "allow"), "http://n.net/es/1": ("net/es/", "block"),
        "http://net/fr/?u": ("net/fr/", "block"), "http://xnet/fr/": (None, "allow"), "http://n.net/esx": (None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls_)], "page_id long, url string, html string")
    rows = urls.judged(df).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in rows if r.rule] == [v for v in urls_.values() if v[0]]
    assert [r.rule for r in rows] == [v[0] for v in urls_.values()]
    assert urls.judged(df.limit(0)).select(F.count("page_id")).first()[0] == 0
