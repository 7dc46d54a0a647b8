import math
import random
import re
from collections import Counter

from tabspark.llm import lexical_search as search

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, top=10):
    cut = lambda t: Counter(TERM.findall((t or "").translate(LOW)))
    docs = [(key, cut(t)) for key, t in docs]
    n_docs, in_all = sum(bool(c) for _, c in docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked: dict = {}
    for item, t in items:
        asked.setdefault(item, set()).update(cut(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for key, c in docs:
            m = 10 + (90 * c.total() * n_docs) // in_all if in_all else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, key is None, key or 0, key))
        out += [(item, rank, key, -s) for rank, (s, _, _, key) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def made(seed, n_docs=120, n_items=25):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Été", "ÉTÉ", "x-y", "naïve", "日本", "A1"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choices(words, k=n))
    docs = [(k, text(rng.randint(0, 40))) for k in range(n_docs)]
    docs += [(k, docs[3][1]) for k in range(n_docs, n_docs + 30)] + [(5, docs[5][1]), (None, docs[7][1]), (None, docs[7][1]), (500, None), (501, ""), (502, " .;- "), (503, "w1 " * 20_000)]
    items = [(k, text(rng.randint(1, 25))) for k in range(n_items)]
    items += [(900, None), (901, "..."), (902, "unheard of"), (903, items[0][1]), (4, "w1 w2"), (None, "w3 w4 w5")]
    return docs, items


def test_terms():
    assert search.terms("Ab-aB ÉÉ_éé 日本x\x00y") == Counter({"ab".encode(): 2, "ÉÉ".encode(): 1, "éé".encode(): 1, "日本x".encode(): 1, b"y": 1})
    assert not search.terms(None) and not search.terms("") and not search.terms(" _-\x7f")


def test_dag_gives_every_items_terms():
    rng = random.Random(5)
    base = [[f"t{k}" for k in rng.sample(range(50), 12)] for _ in range(6)]
    items = [sorted(set(rng.choice(base) + [f"t{k}" for k in rng.sample(range(80), 5)])) for _ in range(40)] + [[], ["only"], sorted(f"t{k}" for k in range(80))]
    for paired in (8, 48):
        names, nodes, parts = search.mined(items, paired)
        whole = [[n] for n in names]
        for a, b in nodes:
            assert max(a, b) < len(whole)
            whole.append(whole[a] + whole[b])
        assert [sorted(t for s in part for t in whole[s]) for part in parts] == items
        assert sum(map(len, parts)) + len(nodes) < sum(map(len, items))
    assert search.mined([]) == ([], [], [])


def test_search_equals_brute_force(spark):
    for seed in (1, 2):
        docs, items = made(seed)
        d = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, term string, n int").repartition(5)
        b = spark.createDataFrame([(k, t, 0) for k, t in items], "item_id long, text string, block int")
        want = brute(docs, items)
        assert rows(search.search(d, b)) == want
        assert rows(search.search(d, b, block_terms=40, cells=500)) == want  # several blocks of items, slices of few documents


def test_search_other_keys_and_empty_tables(spark):
    d = spark.createDataFrame([("b", "one two"), ("a", "two one"), ("c", "three")], "name string, body string")
    b = spark.createDataFrame([("i", "One!")], "item_id string, text string")
    found = search.search(d, b, key="name", text="body", top=1)
    assert [(r.item_id, r.rank, r.doc_id) for r in found.collect()] == [("i", 1, "a")]
    none, nothing = d.limit(0), b.limit(0)
    assert not search.search(none, b, key="name", text="body").collect()
    assert not search.search(d, nothing, key="name", text="body").collect()
    assert not search.search(none, nothing, key="name", text="body").collect()
