import random

import numpy as np

from tabspark.llm import near_dedup as nd


def words(r, n):
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def brute(docs, k, percent):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    ids = sorted(sets)
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus():
    r = random.Random(3)
    docs = [(i, " ".join(words(r, r.randint(0, 120)))) for i in range(100, 160)]
    base = words(r, 150)
    for i in range(60):  # near copies at many distances, so that groups are chains and stars
        w = list(base)
        for _ in range(r.randint(0, 9)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        docs.append((200 + i, " ".join(w)))
    chain = words(r, 100)
    for i in range(25):
        docs.append((300 + i, "\t".join(chain).upper() if i % 2 else "\n".join(chain)))
        chain = chain[2:] + words(r, 2)
    docs += [(400 + i, "same few words") for i in range(5)] + [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "é one"), (506, "É one")]
    return docs


def test_groups_match_brute_force(spark):
    docs = corpus()
    for k in (4, 5):
        got = {r.doc_id: r for r in nd.groups(spark.createDataFrame(docs, "doc_id long, text string"), words=k).collect()}
        want = brute(docs, k, 80)
        assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_edges_of_the_table(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 3), (1, "a b c d e f", 3), (None, "a b c d e f", 3), (7, "a b c d e f", 0)], "doc_id long, text string, component_id int")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in nd.groups(df, words=4).collect())
    assert got == [(-1, 3, -1, True), (1, 3, 1, True), (1, 3, 1, True), (7, 3, 1, False)]
    assert nd.groups(df.limit(0)).count() == 0


def plain_super_minhash(elements, slots):
    """The published loop, one element at a time, with the same random numbers."""
    h = [np.inf] * slots
    for e in elements:
        p = list(range(slots))
        for j in range(slots):
            u = int(nd.mix64(np.array([e], np.uint64) ^ nd.mix64(np.array([j], np.uint64)))[0])
            k = j + u % (slots - j)
            p[j], p[k] = p[k], p[j]
            h[p[j]] = min(h[p[j]], j + (u >> 11) * 2.0**-53)
    return h


def test_signature_is_super_minhash():
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 3, 40, 400)]
    for got, s in zip(nd.super_minhash(sets, 16), sets, strict=True):
        assert got.tolist() == plain_super_minhash(s, 16)


def test_estimate_is_near_the_similarity():
    r = np.random.default_rng(6)
    x = np.unique(r.integers(0, 2**63, 500).astype(np.uint64))
    a, b = x[:450], x[50:]
    s = nd.super_minhash([a, b])
    assert abs((s[0] == s[1]).mean() - 400 / 500) < 0.1


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(1000, 999)], "a long, b long").repartition(7)
    got = {r.a: r.b for r in nd.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 1000: 999}


def test_blocks_are_bounded_by_members(spark, monkeypatch):
    r = np.random.default_rng(7)
    sets = [(i, sorted({int(x) for x in r.choice(12, 6, replace=False)})) for i in range(40)]
    members = spark.createDataFrame([(1, i, 6, i) for i, _ in sets] + [(2, 0, 6, 5), (2, 1, 6, 5)], "band long, rep long, n int, comp long")
    held = spark.createDataFrame(sets, "id long, shingles array<long>")
    assert [(x.band, x.blocks) for x in nd._open(members).collect()] == [(1, 1)]
    linked = [(b, a) for a, x in sets for b, y in sets if a < b and 100 * len({*x} & {*y}) >= 60 * len({*x} | {*y})]
    want = {x.a: x.b for x in nd.components(spark.createDataFrame(linked, "a long, b long")).collect()}
    assert len(want) > 5
    for n in (10, 3):
        monkeypatch.setattr(nd, "MEMBERS", n)
        assert nd._open(members).first().blocks == -(-40 // n)
        assert {x.a: x.b for x in nd.components(nd._across(members, held, 60)).collect()} == want
