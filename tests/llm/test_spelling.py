import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from tabspark.llm import spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(docs, letters=6, damage=199):
    out = Counter()
    for key, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= letters:
                out[run] += 1
    return out


def edits(word, letters):
    cut = [(word[:k], word[k:]) for k in range(len(word) + 1)]
    return {a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in letters} | {a + c + b for a, b in cut for c in letters} - {word}


def brute_variants(n, times=5):
    letters = set("".join(n))
    near = {w: (edits(w, letters) - {w}) & n.keys() for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: f for w, f in best.items() if n[f] >= times * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_occurrences(spark):
    rng = random.Random(3)
    words = ["Absolute", "ÀBSOLÜTE", "naïveté", "shorts", "short", "×multi÷ply", "Ünder", "straße", "longer"]
    docs = [(k, rng.choice([" ", "1", "_", "日"]).join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(300)]
    docs += [(None, "Absolute absolute"), (7, None), (8, ""), (9, "z" * 100_000), docs[0]]
    df = spark.createDataFrame([(k, t, 0, "x") for k, t in docs], "doc_id long, text string, n int, word string")
    for damage in (199, 3, None):
        found = spelling.vocabulary(spelling.occurrences(df, damage=damage), 1)
        assert {r.word: r.n for r in found.collect()} == brute_words(docs, damage=damage)
    assert not spelling.vocabulary(spelling.occurrences(df.limit(0))).collect()


def test_vectors_and_search():
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abcdeé", k=rng.randint(3, 7))) for _ in range(500)})
    vec = spelling.vectors(words)
    assert [list(v) for v in vec[:50]] == [[sum(ord(c) % spelling.GROUPS == g for c in w) for g in range(spelling.GROUPS)] for w in words[:50]]
    order = np.lexsort(vec.T[::-1])
    got = {(int(q), int(order[m])) for who, lo, hi in spelling.reached(vec[order], vec) for q in who for m in range(lo, hi)}
    over = vec[:, None, :] - vec[None, :, :]
    budget = (np.maximum(over, 0).sum(2) <= 1) & (np.maximum(-over, 0).sum(2) <= 1)
    assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(budget), strict=True)}


def test_verified():
    rng = random.Random(4)
    words = [w for n in (5, 6, 38, 39, 40, 41, 42, 60) for _ in range(6) for w in ["".join(rng.choices("ab", k=n))]]
    words += [w[:k] + w[k + 1 :] for w in words for k in (0, len(w) // 2, len(w) - 1)] + [w[:2] + "c" + w[3:] for w in words] + ["", "a"]
    i, j = (x.ravel() for x in np.meshgrid(range(len(words)), range(len(words))))
    known = spelling.Words(words)
    got = spelling.verified(known, i, known, j)
    want = [words[b] in edits(words[a], "abc") and words[a] != words[b] for a, b in zip(i, j, strict=True)]
    assert got.tolist() == want == [spelling.one_apart(words[a], words[b]) for a, b in zip(i, j, strict=True)]


def test_variants_equal_brute_force(spark):
    rng = random.Random(11)
    base = ["".join(rng.choices("abcdenostuéà", k=rng.randint(6, 12))) for _ in range(60)]
    n = Counter()
    for w in base:
        n[w] += rng.choice([5, 30, 200, 5000])
        for _ in range(8):
            k = rng.randrange(len(w))
            n[w[:k] + rng.choice(["", "x", w[k] + "e"]) + w[k + 1 :]] += rng.choice([5, 5, 6, 25, 40])
    n |= Counter({"a" * k: 5 ** (k - 5) for k in range(6, 13)})  # a chain of forms, one leaf beside the other
    n |= Counter({"b" * k + "c" + "b" * (9 - k): 7 for k in range(10)})  # many words with one vector
    n |= Counter({"q" * 50: 50, "q" * 51: 300, "q" * 49 + "r": 5})
    df = spark.createDataFrame([(w, k, "x") for w, k in n.items()], "word string, n long, shard string").repartition(4)
    want = brute_variants(n)
    assert rows(spelling.variants(df)) == want
    assert rows(spelling.variants(df, shard=20, members=15, questions=25)) == want  # several levels, every shard in blocks
    assert any(r[1] and r[2] != r[1] for r in want)
    assert not spelling.variants(df.limit(0)).collect()


def test_roots_follow_to_the_last(spark):
    pairs = [(f"w{k}", f"w{k + 1}") for k in range(9)] + [("x", "w4"), ("y", "z")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(pairs, "word string, form string")).collect()}
    assert got == {w: "z" if w == "y" else "w9" for w, _ in pairs}


def test_query_words_from_texts(spark):
    rng = random.Random(2)
    docs = [(k, " ".join(rng.choices(["colour", "color", "flavour", "colours", "honour", "honors"], weights=[60, 9, 20, 3, 4, 4], k=80))) for k in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    n = Counter({w: k for w, k in brute_words(docs).items() if k >= 5})
    assert rows(spelling.variants(spelling.vocabulary(spelling.occurrences(df, damage=199)))) == brute_variants(n)
    assert defaultdict(int, n)["colour"]
