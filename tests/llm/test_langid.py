import random

import numpy as np
from pyspark.sql import functions as F

from tabspark.llm import langid as li


def test_gradient_matches_differences():
    net = li.Network(["a", "b", "c"], seed=3)
    ids, inside = net.pad([b"abc", b"z", b"\xc3\xa9t\xc3\xa9"])
    label = np.array([0, 2, 1])
    _, g = net.gradient(ids, inside, label)
    r = np.random.default_rng(0)
    for name, value in net.p.items():
        at = tuple(r.integers(0, s) for s in value.shape) if name != "embed" else (ord("z"), 2)
        old = value[at]
        value[at] = old + 1e-5
        up = net.gradient(ids, inside, label)[0]
        value[at] = old - 1e-5
        down = net.gradient(ids, inside, label)[0]
        value[at] = old
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-6, name


def test_padding_and_batches_do_not_matter():
    net = li.Network(["a", "b"], seed=1)
    one = li.Predictor(net)(["abc def", "é"])
    assert np.allclose([s for _, s in li.Predictor(net)(["abc def", "x " * 50 + "longerwordsthanbefore", "é"])][::2], [s for _, s in one])


def test_fast_labels_are_those_of_the_network():
    net, words = li.Network(["a", "b", "c"], seed=2), [b"abc", b"z", b"\xc3\xa9t\xc3\xa9", b"abd", b"x" * 40]
    ids, inside = net.pad(words)
    sums, counts = net.label(words)
    assert np.allclose(sums, (net.forward(ids, inside)[0] * inside[..., None]).sum(1), atol=1e-4) and counts.tolist() == inside.sum(1).tolist()


def test_held_out_accuracy_and_edges(spark):
    r = random.Random(1)
    parts = {"xx": ["the", "ing", "and", "er"], "yy": ["der", "sch", "ung", "ein"]}
    text = lambda x: " ".join(r.choice(parts[x]) + r.choice(parts[x]) for _ in range(r.randint(3, 30)))
    docs = [(i, text(x), x, "s") for i in range(200) for x in [("xx", "yy")[i % 2]]] + [(900, None, "xx", None), (901, "12 !", None, "s"), (None, "thethe", "xx", "s"), (902, "", "yy", "s"), (903, "the" * 500, None, "s")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, score string")
    net = li.train(df, F.col("doc_id") % 4 != 2, per_language=40, words_per_language=800)
    got = {x.doc_id: x for x in li.predict(df, net).collect()}
    held = [i for i in range(200) if i % 4 == 2]
    assert sum(got[i].lang_pred == ("xx", "yy")[i % 2] for i in held) >= 0.98 * len(held)
    assert {got[i].lang_pred for i in (900, 901, 902)} == {"und"} and got[903].lang_pred == "xx"
    assert all(0 <= x.score <= 1 for x in got.values())
    assert li.predict(df.limit(0), net).count() == 0
    assert {x.lang_pred for x in li.predict(df, li.train(df.limit(0), F.lit(True))).collect()} == {"und"}


def test_runs_without_a_letter_are_no_words():
    assert li.pieces("½ ² 12 _ ٣ abc x²") == ["abc", "x²"]


def test_small_languages_give_all_their_words_and_the_sum_is_bounded(spark, monkeypatch):
    taken = {}

    def fit(self, words, labels):
        taken["n"] = [labels.count(k) for k in range(len(self.languages))]
        return self

    monkeypatch.setattr(li.Network, "fit", fit)
    word = lambda k: "".join(chr(97 + int(c)) for c in str(k + 10_000))
    docs = [(k, " ".join(word(100 * k + j) for j in range(100)), "large") for k in range(60)] + [(1000 + k, " ".join(word(j) for j in range(200)), "rare") for k in range(3)]
    df = spark.createDataFrame([*docs, docs[0]], "doc_id long, text string, lang string")
    li.train(df, F.lit(True), per_language=20, words_per_language=500)
    assert taken["n"] == [500, 500]  # three documents of 200 words give 500 of them
    li.train(df, F.lit(True), per_language=20, words_per_language=500, words_in_all=400)
    assert taken["n"] == [100, 100]
    plan = df.select("doc_id", "lang")
    assert plan.count() == 64
