import random
import re
from collections import Counter

from tabspark.llm import decontam as dc


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def multiset(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(docs, items, percent=80):
    """The best similarity over all item-sized windows, for every document and item."""
    out = {}
    for d, t in docs:
        w = words(t)
        for i, u in items:
            v = words(u)
            if not v or not w or d is None or i is None:
                continue
            k, n = min(5, len(v)), min(len(v), len(w))
            want, best = multiset(v, k), 0
            for s in range(len(w) - n + 1):
                have = multiset(w[s : s + n], k)
                common = sum((have & want).values())
                total = sum((have | want).values())
                if 100 * common >= percent * total:
                    best = max(best, common / total)
            if best:
                out[d, i] = best
    return out


def corpus():
    r = random.Random(8)
    some = lambda n: [r.choice("ab") + str(r.randrange(300)) for _ in range(n)]
    items = [(i, " ".join(some(r.randint(12, 60)))) for i in range(25)] + [(30, "short one here"), (31, ""), (32, None), (33, "x y x y x y x y x y x y x y"), (None, "null id of an item with words")]
    items.append((40, items[3][1].upper() + "!"))
    docs = [(i, " ".join(some(r.randint(0, 200)))) for i in range(40)]
    for i in range(120):
        w = some(r.randint(0, 80))
        for _ in range(r.randint(1, 3)):
            v = words(items[r.randrange(25)][1])
            for _ in range(r.randint(0, 2)):
                kind, at = r.randrange(3), r.randrange(len(v))
                v = v[:at] + ([] if kind == 0 else ["new"] if kind == 1 else ["new", v[at]]) + v[at + 1 :]
            at = r.randint(0, len(w))
            w = w[:at] + v + w[at:]
        docs.append((100 + i, ", ".join(w).title()))
    return docs + [(300, "A short, ONE here."), (301, None), (302, ""), (303, "x y " * 9), (None, items[2][1]), (304, items[4][1]), (304, items[4][1])], items


def test_leaks_match_brute_force(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in dc.leaks(df, bench).collect()}
    want = brute(docs, items)
    assert set(got) == set(want) and len(want) > 60
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert dc.clean(df, bench).count() == sum(d is None or all(k[0] != d for k in want) for d, _ in docs)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert dc.leaks(df.limit(0), bench).count() == dc.leaks(df, bench.limit(0)).count() == 0
    assert [(r.doc_id, r.item_id, r.similarity, r.first_word) for r in dc.leaks(df, bench).collect()] == [(1, 1, 1.0, 0)]
    assert dc.clean(df, bench.limit(0)).count() == 1


def test_parts_in_another_order(spark):
    r = random.Random(11)
    some = lambda n: [f"w{r.randrange(4000)}" for _ in range(n)]
    items = [(i, " ".join(some(r.randint(50, 90)))) for i in range(12)] + [(20, " ".join(["a b c"] * 15))]
    docs = []
    for i, t in items:
        w = words(t)
        for parts in (2, 3):
            size = -(-len(w) // parts)
            swapped = sum([w[a : a + size] for a in range(0, len(w), size)][::-1], [])
            docs.append((len(docs), " ".join(some(60) + swapped + some(60))))
        docs.append((len(docs), " ".join(some(60) + w[:20] + some(100) + w + some(7) + w[-20:])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): x for x in dc.leaks(df, bench).collect()}
    want = brute(docs, items)
    assert set(got) == set(want) and sum(d % 3 < 2 for d, _ in want) > 12
    texts = dict(items)
    for (d, i), x in got.items():
        assert abs(x.similarity - want[d, i]) < 1e-9
        v, w = words(texts[i]), words(docs[d][1])
        have = lambda s: multiset(w[s : s + len(v)], 5)
        alike = [s for s in range(len(w) - len(v) + 1) if abs(sum((have(s) & multiset(v, 5)).values()) / sum((have(s) | multiset(v, 5)).values()) - want[d, i]) < 1e-9]
        assert x.first_word == alike[0]


def test_texts_that_share_an_id(spark):
    item = " ".join(f"w{n}" for n in range(30))
    df = spark.createDataFrame([(1, "x " * 40 + item), (1, "y " * 20 + " ".join(item.split()[:28]))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [(x.similarity, x.first_word) for x in dc.leaks(df, bench).collect()] == [(1.0, 40)]
