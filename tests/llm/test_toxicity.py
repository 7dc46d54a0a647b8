import itertools
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tabspark.llm import toxicity as tx

WORDS = Counter({"idiot": 30, "stupid": 30, "moron": 30, "the": 500, "river": 80, "was": 300, "wide": 60, "and": 300, "calm": 50, "today": 40})


def test_counts_are_those_of_a_loop():
    want = Counter()
    for w, n in WORDS.items():
        c = [27] * 3 + list(tx.codes(w)) + [28]
        for a, b, d, e in zip(c, c[1:], c[2:], c[3:]):
            want[((a * 29 + b) * 29 + d) * 29 + e] += n
    got = tx.count_grams(WORDS)
    assert {int(k): int(got[k]) for k in np.flatnonzero(got)} == dict(want)


def test_probabilities_sum_to_one():
    p = np.exp(tx.CharModel(tx.count_grams(WORDS)).log_p.reshape(-1, 29))
    assert np.allclose(p.sum(1), 1, atol=1e-4)


def test_decoding_is_the_best_path():
    m = tx.CharModel(tx.count_grams(WORDS))

    def brute(token):
        best, before, places = None, "", []
        for c in token:
            if c.isalpha():
                o = [(c, 0.0)] if c != before else [(c, tx.KEEP), ("", tx.DROP)]
            elif c in tx.SEPARATORS:
                o = [("", tx.DROP)]
            else:
                o = [(x, tx.READ - np.log(len(tx.LEET[c]))) for x in tx.LEET[c]] + [(c, tx.READ)] + ([("", tx.DROP)] if c == before else [])
            places.append(o)
            before = c
        for path in itertools.product(*places):
            text = "".join(x for x, _ in path)
            s = [27] * 3 + list(tx.codes(text)) + [28]
            total = sum(c for _, c in path) + sum(float(m.log_p[((a * 29 + b) * 29 + d) * 29 + e]) for a, b, d, e in zip(s, s[1:], s[2:], s[3:]))
            if best is None or total > best[0] + 1e-4:
                best = (total, text)
        return best[1]

    for token in ("1d10t", "5tup1d", "m0r0n", "iiddiioott", "s-t.u_p-i-d", "r1ver", "m00oron"):
        assert m.decode(token) == brute(token)
    reader = tx.Reader(m)
    assert reader.restore("The 1D10T was s t u p i d, mooorrron 12345 $tup1d!!") == "the idiot was stupid, moron 12345 stupid"


def test_held_out_documents_and_edges(spark):
    r = random.Random(5)
    plain = lambda: " ".join(r.choice(["the", "river", "was", "wide", "and", "calm", "today"]) for _ in range(r.randint(3, 40)))
    bad = lambda: plain() + " " + r.choice(["idiot", "stupid", "moron"]) + " " + plain()
    docs = [(i, bad() if i % 4 == 0 else plain()) for i in range(240)] + [(1000, "the river was 1d10t wide"), (1001, "the calm m0r0n and s.t.u.p.i.d"), (1002, None), (1003, ""), (None, "the river"), (1004, "the r1ver 2024 was w1de")]
    df = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)] + [(None, 1), (2, None)], "doc_id long, toxic int")
    got = {x.doc_id: x for x in tx.score(df, tx.train(df, labels, F.lit(True))).collect()}
    assert all(got[i].predicted == (i % 4 == 0) for i in range(240))
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003, 1004, None)] == [1, 1, 0, 0, 0, 0]
    assert tx.score(df.limit(0), tx.train(df, labels.limit(0), F.lit(True))).count() == 0


def test_spaced_runs_hold_several_words():
    known = WORDS + Counter({"a": 200, "y": 80, "you": 150, "are": 150, "man": 50})
    m = tx.CharModel(tx.count_grams(known))
    reader = tx.Reader(m)

    def brute(run):
        letters, best = run.split(" "), None
        for ends in itertools.product((False, True), repeat=len(letters) - 1):
            words = "".join(c + " " * e for c, e in zip(letters, [*ends, False])).split()
            total = sum(tx.DROP if e else tx.KEEP for e in ends)
            for w in words:
                s = [27] * 3 + list(tx.codes(w)) + [28]
                total += sum(float(m.log_p[((a * 29 + b) * 29 + d) * 29 + e]) for a, b, d, e in zip(s, s[1:], s[2:], s[3:]))
            if best is None or total > best[0]:
                best = (total, " ".join(words))
        return best[1]

    for run in ("a s t u p i d", "y o u s t u p i d", "i d i o t a", "a r i v e r"):
        assert m.decode(run) == brute(run)
    assert reader.restore("you are a s t u p i d man") == "you are a stupid man"
    assert reader.restore("y o u  i.d.i.o.t a 5 t u p 1 d, 1 2 3!") == "you idiot a stupid, 123"
    assert {"stupid", "a"} <= {w for t in reader.tokens("You are A S-T-U-P-I-D man") for w in reader.words(t)}
    assert {"moron", "stupid"} <= {w for t in reader.tokens("m o r o n s t u p i d !") for w in reader.words(t)}
    long = " ".join("stupid" * 3000)
    assert set(m.decode(long).split()) == {"stupid"}


def test_spaced_word_after_a_one_letter_word_scores(spark):
    r = random.Random(6)
    plain = lambda: " ".join(r.choice(["the", "river", "was", "a", "wide", "and", "calm", "today"]) for _ in range(r.randint(3, 40)))
    docs = [(i, plain() + (" stupid " if i % 4 == 0 else " ") + plain()) for i in range(160)] + [(1000, "the river was a s t u p i d calm"), (1001, "c a l m s t u p i d"), (1002, "the river was a c a l m today")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)], "doc_id long, toxic int")
    got = {x.doc_id: x.predicted for x in tx.score(df, tx.train(df, labels, F.lit(True))).collect()}
    assert [got[i] for i in (1000, 1001, 1002)] == [1, 1, 0]


def test_many_stars_are_bounded():
    import time
    reader = tx.Reader(tx.CharModel(tx.count_grams(WORDS)))
    start = time.time()
    assert reader.read("st*pid") == "stupid" and reader.read("m*r*n") == "moron"
    assert reader.read("stu" + "*" * 10_000 + "pid") == "stupid"  # a divider, no letters
    assert reader.read("*".join("stupid" * 200)) == reader.read("_".join("stupid" * 200))
    reader.read("a*****b"), reader.read("a*****b")
    assert time.time() - start < 20


def test_trains_alike_with_and_without_arrow(spark):
    r = random.Random(7)
    plain = lambda: " ".join(r.choice(["the", "river", "was", "wide", "and", "calm", "today"]) for _ in range(r.randint(3, 20)))
    docs = [(i, plain() + (" m0r0n " if i % 4 == 0 else " ") + plain()) for i in range(80)] + [(200, ""), (201, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)] + [(200, 0), (201, 1)], "doc_id long, toxic int")
    key, got = "spark.sql.execution.arrow.pyspark.enabled", {}
    before = spark.conf.get(key)
    try:
        for arrow in ("true", "false"):  # a session need not collect by Arrow
            spark.conf.set(key, arrow)
            got[arrow] = {x.doc_id: (x.score, x.predicted) for x in tx.score(df, tx.train(df, labels, F.lit(True))).collect()}
    finally:
        spark.conf.set(key, before)
    assert got["true"] == got["false"]
    assert all(got["false"][i][1] == (i % 4 == 0) for i in range(80))
