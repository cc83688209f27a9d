"""Host ranks against plain PageRank, and groups of any size against plain minimum covariance determinants."""

import os
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

from matchloom.llm import quality_rules as Q
from matchloom.llm import queries, url_filter
from matchloom.session import store

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_ranks(seeds, edges, spread):
    """Trust and distrust of every host, in floating point."""
    hosts = sorted(set(seeds) | {h for e in edges for h in e[:2]})
    found = []
    for way in (0, 1):
        seed = {h: seeds.get(h, (0, 0))[way] for h in hosts}
        refuse = {h: seeds.get(h, (0, 0))[1 - way] for h in hosts}
        out = defaultdict(list)
        for a, b, n in edges:
            out[(a, b)[way]].append(((b, a)[way], n))
        rank, whole = dict(seed), sum(seed.values())
        for _ in range(spread.rounds):
            taken = dict.fromkeys(hosts, 0.0)
            for a, targets in out.items():
                links = sum(n for _, n in targets)
                for b, n in targets:
                    taken[b] += spread.damping * rank[a] * n / links * (1 - refuse[b])
            back = 1 - sum(taken.values()) / whole if whole else 0
            rank = {h: taken[h] + seed[h] * back for h in hosts}
        found.append(rank)
    return {h: (found[0][h], found[1][h]) for h in hosts}


@pytest.mark.parametrize("seed", [1, 2])
def test_hosts_are_judged_by_plain_page_rank(spark, seed):
    rng = np.random.default_rng(seed)
    pages, edges, counts = [], defaultdict(int), defaultdict(lambda: [0, 0])
    names = [f"h{i}.com" for i in range(40)]
    for i in range(600):
        host = names[min(int(rng.integers(40)), int(rng.integers(40)))]
        path = ["/fr/", "/de/", "/x/"][rng.choice(3, p=[0.1, 0.1, 0.8]) if int(host[1:-4]) % 4 == 0 else 2]
        links = [] if int(host[1:-4]) % 7 == 3 else [names[0] if rng.random() < 0.2 else names[rng.integers(40)] for _ in range(rng.integers(0, 3))]
        pages.append((i, f"http://{host}{path}{i}", "".join(f'<a href="https://{h}/">t</a>' for h in links)))
        for h in links:
            edges[host, h] += h != host
        if path != "/x/":
            counts[host][path == "/de/"] += 1
    seeds = {h: (a / (a + b), b / (a + b)) for h, (a, b) in counts.items()}
    links = [(a, b, n) for (a, b), n in edges.items() if n]
    spread = url_filter.Spread()
    want = plain_ranks(seeds, links, spread)
    start = spark.createDataFrame([(h, *map(float, seeds.get(h, (0, 0)))) for h in names], "host string, trust double, distrust double")
    ranks = {r.host: (r.trust / url_filter.MASS, r.distrust / url_filter.MASS) for r in url_filter.propagate(start, spark.createDataFrame(links, "src string, dst string, n long"), spread).collect()}
    for h in names:
        assert ranks[h] == pytest.approx(want.get(h, (0, 0)), abs=1e-5)
    for way in (0, 1):
        assert sum(r[way] for r in ranks.values()) == pytest.approx(sum(s[way] for s in seeds.values()), abs=1e-5)
    found = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).filter("rule IS NULL").collect()
    least = spread.limit * (1 - spread.damping)
    verdicts = {h: "block" if d > least and d > spread.factor * t else "allow" for h, (t, d) in want.items()}
    assert {r.host: r.verdict for r in found} == {r.host: verdicts.get(r.host, "allow") for r in found}
    assert len(set(verdicts.values())) == 2


def plain_estimates(groups, x):
    """Means and covariances of all groups by the same concentration steps, in numpy."""
    keys = sorted({(g, s) for g, s in groups} | {(g, Q.ALL) for g, _ in groups} | {(Q.ALL, Q.ALL)})
    rows = {k: x[[all(a in (b, Q.ALL) for a, b in zip(k, g, strict=True)) for g in groups]] for k in keys}
    floors = np.array([[Q.floor_moment(max(i, j), min(i, j)) for j in range(Q.D)] for i in range(Q.D)])

    def moments(v, scale):
        return v.mean(0), scale * np.cov(v.T, bias=True).reshape(Q.D, Q.D) + floors

    def robust(v):
        low, mid, high = (np.sort(v, 0)[-(-len(v) * q // 4) - 1] for q in (1, 2, 3))
        return mid, np.diag(((high - low) / 1.349) ** 2) + floors

    def mix(raw):
        out = {(Q.ALL, Q.ALL): raw[Q.ALL, Q.ALL]}
        for k in sorted(keys, key=lambda k: k[1] != Q.ALL):
            if k != (Q.ALL, Q.ALL):
                wide = out[(k[0], Q.ALL) if k[1] != Q.ALL else (Q.ALL, Q.ALL)]
                own = len(rows[k]) / (len(rows[k]) + Q.PRIOR)
                out[k] = tuple(own * a + (1 - own) * b for a, b in zip(raw[k], wide, strict=True))
        return out

    def away(v, e):
        return np.einsum("ij,jk,ik->i", v - e[0], np.linalg.inv(e[1]), v - e[0])

    trials = [mix({k: f(v) for k, v in rows.items()}) for f in (robust, lambda v: moments(v, 1.0))]
    for _ in range(Q.STEPS):
        last = [np.linalg.slogdet(e[1])[1] for t in trials for e in t.values()]
        for n, now in enumerate(trials):
            raw = {}
            for k, v in rows.items():
                near = np.floor(np.log1p(away(v, now[k])) * 64)
                limit = np.sort(near)[int(np.ceil(len(v) * Q.KEPT)) - 1]
                raw[k] = moments(v[near <= limit], Q.consistency(Q.KEPT, Q.D))
            trials[n] = mix(raw)
        if np.abs(np.array(last) - [np.linalg.slogdet(e[1])[1] for t in trials for e in t.values()]).max() <= Q.TOLERANCE:
            break
    best = {k: min(trials, key=lambda t: np.linalg.slogdet(t[k][1])[1])[k] for k in keys}
    return np.array([away(x[i : i + 1], best[g])[0] for i, g in enumerate(groups)])


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")
def test_distances_equal_plain_estimates(spark):
    docs = queries.table(spark, FOLDER, "documents").select("doc_id", "text", "lang", "source")
    judged = Q.judge(store(Q.measure(docs).drop("text"), "quality")).collect()
    x = np.array([[r[f"__x{i}"] for i in range(Q.D)] for r in judged]) / Q.UNIT
    want = plain_estimates([(r.g_lang, r.g_source) for r in judged], x)
    assert np.allclose([r["__distance"] for r in judged], want, rtol=1e-3, atol=1e-3)


def test_verdicts_do_not_jump_with_the_size_of_a_group(spark):
    rng = np.random.default_rng(3)
    plain = lambda: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(100))
    junk = " ".join(w.upper() + "#$%&" * 4 for w in plain().split())
    docs, odd = [(i, plain(), "en", "big", 0) for i in range(400)], []
    for n in (1, 2, 20, 63, 64, 65, 300):
        group = [(len(docs) + i, plain(), f"l{n}", "s", 0) for i in range(n - 1)]
        odd.append(100_000 + n)
        docs += [*group, (odd[-1], junk, f"l{n}", "s", 0)]
    found = {r.doc_id: r.kept for r in Q.assess(spark.createDataFrame(docs, DOCS)).collect()}
    assert [found[k] for k in odd] == [False] * len(odd)
    assert sum(not v for v in found.values()) <= len(odd) + 0.02 * len(docs)
