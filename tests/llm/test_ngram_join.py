"""The n-gram Jaccard join beside plain set operations."""

import random

import numpy as np
import pytest

from matchloom.llm import components, near_copies, ngram_join

DOCS = "doc_id long, text string, fp long, n long, label long, path string, key long, component string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, 1, 2, 3, "x", 4, "y") for k, t in rows], DOCS)


def plain(rows, words=3, share=(9, 10), empty_alike=False):
    """(doc_id, n_shingles, component_id), over all pairs of rows."""
    sets = []
    for _, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
        w = [x for part in w.split("\n") for p in part.split("\r") for q in p.split("\t") for x in q.split(" ") if x]
        sets.append(frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            linked = (a or b) and len(a & b) * share[1] >= len(a | b) * share[0] or (empty_alike and not a and not b)
            if linked and find(i) != find(j):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    own = lambda i, key: key if not sets[i] and not empty_alike else least.get(find(i))
    return sorted(((key, len(sets[i]), own(i, key)) for i, (key, _) in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def family(rng, size, length, edits, vocabulary=400):
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(length)]
    for _ in range(size):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = [f"v{rng.randrange(10_000)}"]
        yield " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    notice = " ".join(f"n{i}" for i in range(40))
    texts = [t for size, length, edits in ((60, 120, 4), (40, 60, 2), (25, 200, 12), (8, 9, 1)) for t in family(rng, size, length, edits)]
    texts += [f"{' '.join(f'u{rng.randrange(10**6)}' for _ in range(rng.randint(0, 60)))} {notice}" for _ in range(60)]
    texts += ["x y"] * 3 + ["A b C d", "a B c D", "", None, "\x0b \x0c", " ".join(f"k{i}" for i in range(20_000))]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("words", "share", "block"), [(3, (9, 10), 256), (3, (9, 10), 7), (5, (4, 5), 5)])
def test_equals_plain_comparison(spark, monkeypatch, words, share, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = corpus(words * block)
    assert found(ngram_join.join_documents(frame(spark, rows), words, share)) == plain(rows, words, share)


def test_without_a_common_order_or_memory_of_copies(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "COMMON", 10**9)
    monkeypatch.setattr(ngram_join, "REMEMBERED", 1)
    rows = corpus(11)
    assert found(ngram_join.join_documents(frame(spark, rows))) == plain(rows)


def test_null_and_repeated_keys(spark):
    long = " ".join(f"a{i}" for i in range(50))
    rows = [(None, long), (None, long + " b"), (7, "p q r s"), (7, "p q r s"), (7, long + " c"), (None, "only here now"), (None, "only here now"), (3, ""), (3, None), (None, "")]
    assert found(ngram_join.join_documents(frame(spark, rows))) == plain(rows)
    assert ngram_join.join_documents(frame(spark, [])).count() == 0


def test_near_copies_keep_one_of_each_group(spark):
    rows = corpus(5) + [(None, "without a key"), (None, "without a key")]
    docs = frame(spark, rows)
    expected = {c for k, _, c in plain(rows, 5, (4, 5), empty_alike=True) if k is not None}
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    keys = [r.doc_id for r in kept.collect()]
    assert sorted(k for k in keys if k is not None) == sorted(expected) and keys.count(None) == 2
    assert near_copies.keep_one(frame(spark, [])).count() == 0


def test_near_copies_are_linked_by_fingerprints_and_checked(spark):
    rng = random.Random(8)
    paths = []
    for _ in range(12):
        base = [rng.getrandbits(63) for _ in range(400)]
        paths += [np.array(sorted(base[: 400 - k]), "u8") for k in (0, 1, 2)]
    few = [rng.getrandbits(63) for _ in range(9)]  # the seven hashes in both sets are no four fifths of all
    paths += [np.array(sorted(few[:8]), "u8"), np.array(sorted(few[:7] + few[8:]), "u8")]
    sets = spark.createDataFrame([(i, len(p), bytearray(p.tobytes())) for i, p in enumerate(paths)], "fp long, n long, path binary")
    links = {frozenset((r.u, r.v)) for r in near_copies.fingerprint_links(sets).collect()}
    assert links and all(max(x) // 3 == min(x) // 3 and max(x) < 36 for x in links)
    pairs = spark.createDataFrame([(36, 37), (0, 1), (0, 3)], "u long, v long")
    assert [tuple(r) for r in near_copies.alike_pairs(pairs, sets).collect()] == [(0, 1)]
    joined = {frozenset((r.u, r.v)) for r in ngram_join.alike_links(sets, near_copies.SHARE, near_copies.fingerprint_links).collect()}
    assert links <= joined and all(max(x) // 3 == min(x) // 3 for x in joined)


def test_trees_give_each_pair_once():
    rng = random.Random(1)
    for _ in range(60):
        share = rng.choice([(9, 10), (4, 5), (1, 2)])
        bases = [[rng.randrange(300) for _ in range(rng.randint(1, 40))] for _ in range(4)]
        paths = []
        for _ in range(rng.randint(2, 25)):
            some = list(rng.choice(bases))
            for _ in range(rng.randint(0, 3)):
                some[rng.randrange(len(some))] = rng.randrange(300)
            paths.append(np.unique(np.array(some, dtype="u8")))
        n, label, group = (np.array([f(p) for p in paths]) for f in (len, lambda p: rng.randrange(6), lambda p: rng.randrange(9)))
        pairs = [(i, int(j)) for i, others in ngram_join.tree_pairs(paths, n, label, group, share) for j in others]
        alike = lambda a, b: len(a & b) * share[1] >= len(a | b) * share[0]
        sets = [set(p.tolist()) for p in paths]
        expected = {frozenset((i, j)) for i in range(len(paths)) for j in range(i) if label[i] != label[j] and group[i] != group[j] and alike(sets[i], sets[j])}
        assert len(pairs) == len(set(map(frozenset, pairs))) and set(map(frozenset, pairs)) == expected
        short = [p[: ngram_join.prefix_size(len(p), share)] for p in paths]
        maybe = []
        for key in {int(x) for p in short for x in p}:
            here = [i for i, p in enumerate(short) if key in p]
            found = ngram_join.tree_pairs([short[i] for i in here], n[here], label[here], group[here], share, key)
            maybe += [frozenset((here[i], here[int(j)])) for i, others in found for j in others]
        assert len(maybe) == len(set(maybe)) and expected <= set(maybe)


def test_sets_without_a_partner_in_reach_leave_their_bucket(spark):
    rng = random.Random(3)
    for num, den in ((9, 10), (4, 5), (1, 1)):
        rows = []
        for fp in range(400):
            n = rng.randint(1, 60)
            rows.append((rng.randrange(60), fp, n, rng.randrange(n - -(-n * num // den) + 1), rng.randrange(5), rng.randrange(7)))
        frame = spark.createDataFrame(rows, "key long, fp long, n long, at int, label long, grp long")
        found = [tuple(r) for r in ngram_join.within_reach(frame, (num, den)).select("key", "fp", "n", "label", "grp").collect()]
        may = lambda x, y: x[0] == y[0] and x[4] != y[4] and x[5] != y[5] and min(x[2] - x[3], y[2] - y[3]) * (num + den) >= (x[2] + y[2]) * num
        needed = {x[:3] + x[4:] for x in rows for y in rows if may(x, y)}
        assert needed and needed <= set(found) and len(found) == len(set(found)) < len(rows)


def test_classes_of_a_bucket_are_spread_once(spark):
    """The rows were spread over their classes twice: to find the classes with a partner, and to take the rows there."""
    frame = spark.range(0, 200).selectExpr("id % 20 key", "id fp", "10 + id % 7 n", "0 at", "id label", "id grp")
    found = ngram_join.within_reach(frame, (4, 5))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
    assert found.count() == found.distinct().count() == 200


def test_sets_that_share_little_with_each_of_many_leave_before_they_are_spread(spark, monkeypatch):
    """Each meets others by single shingles, more of them in larger tables; only near copies parted by their groups go on."""
    rng = random.Random(5)
    seen = []
    reach = ngram_join.within_reach

    def counted(rows, share):
        seen.append({r["fp"] for r in rows.collect()})
        return reach(rows, share)

    monkeypatch.setattr(ngram_join, "within_reach", counted)
    share = (4, 5)
    sets = {}
    for fp in range(200):  # 1 to 100 are rare and met by a few sets each, what follows is a set's own
        sets[fp] = sorted([fp % 100 + 1, *rng.sample(range(10**6 * (fp + 1), 10**6 * (fp + 1) + 10**5), 99)])
    base = sorted(rng.sample(range(10**12, 2 * 10**12), 100))
    many = {900: base, 901: sorted([*base[:95], *range(1000, 1005)]), 902: sorted([*base[:94], *range(1002, 1008)])}
    for near in (many, {}):
        rows = [(fp, len(x), np.array(x, "<u8").tobytes()) for fp, x in (sets | near).items()]
        given = spark.createDataFrame(rows, "fp long, n long, path binary")
        whole = ngram_join.prefix_rows(given, share).collect()
        assert all(sum(r["fp"] == fp for r in whole) == 30 for fp in near) and all((r["at"] is None) or r["at"] <= 20 for r in whole)
        # As if no group had compared anything: every set its own label and group.
        about = ngram_join.prefix_rows(given, share).join(given.select("fp", "n"), "fp").selectExpr("key", "fp", "n", "at", "sure", "fp label", "fp grp")
        mixed = about.join(ngram_join.of_several(about, ["key"]), "key", "left_semi")
        assert {r["fp"] for r in mixed.collect()} >= set(sets)
        assert {r["fp"] for r in ngram_join.in_enough(mixed, share).collect()} == set(near)
        links = ngram_join.alike_links(given, share)
        linked = components.components(links).collect()
        assert {(r.node, r.component) for r in linked} == {(fp, 900) for fp in near}
        assert not seen.pop() & set(sets)


def test_sets_in_enough_buckets_include_all_alike_ones(spark):
    """Against all pairs, with shingles that are common, and so have no rows beyond the prefix."""
    rng = random.Random(9)
    high = int(ngram_join.LAST)
    for share in ((4, 5), (9, 10)):
        num, den = share
        sets = []
        for _ in range(30):
            n = rng.randint(1, 90)
            base = rng.sample(range(1, 10**6), n) + rng.sample(range(high, high + 300), rng.randint(0, n))
            for _ in range(rng.randint(1, 4)):
                some = set(rng.sample(base, max(1, round(len(base) * rng.uniform(0.85, 1)))))
                sets.append(sorted(some | set(rng.sample(range(1, 2000), rng.randint(0, 3))) | set(rng.sample(range(high, high + 300), rng.randint(0, 3)))))
        rows = [(fp, len(x), np.array(x, "<u8").tobytes()) for fp, x in enumerate(sets)]
        given = spark.createDataFrame(rows, "fp long, n long, path binary")
        about = ngram_join.prefix_rows(given, share).join(given.select("fp", "n"), "fp").selectExpr("key", "fp", "n", "at", "sure", "fp % 5 label", "fp % 3 grp")
        mixed = about.join(ngram_join.of_several(about, ["key"]), "key", "left_semi")
        found = {r["fp"] for r in ngram_join.in_enough(mixed, share).collect()}
        alike = lambda x, y: len(set(x) & set(y)) * den >= len(set(x) | set(y)) * num
        needed = {i for i, x in enumerate(sets) for j, y in enumerate(sets) if i % 5 != j % 5 and i % 3 != j % 3 and alike(x, y)}
        assert needed and needed <= found
