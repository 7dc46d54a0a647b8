import itertools
import random
import re

import numpy as np

from tabspark.llm import quality as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines, dup = text.split("\n"), 0
    for i, line in enumerate(lines):
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def texts():
    r = random.Random(2)
    out = [None, "", "\n\n", "a", "a b c a b c", "x\xa0y z", "é\té\té\té", "a\na\n \n \na", "#|<> &&"]
    for _ in range(60):
        out.append("".join(r.choice(["a", "b", "c ", "d ", "\n", " ", "#", "é", "x y "]) for _ in range(r.randint(1, 400))))
    return out


def test_base_figures_match_brute_force():
    for t in texts():
        assert q.measure(t)[2] == brute(t)


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(1)
    field = q.Field()
    field.emit, field.step, field.start, field.trained = r.normal(size=field.emit.shape), r.normal(size=(2, 2)), r.normal(size=2), True
    for n in (1, 2, 7):
        bits = r.integers(0, 2**16, n).tolist()
        e = field.unpack(np.array(bits)) @ field.emit
        score = lambda p: field.start[p[0]] + sum(e[i, s] for i, s in enumerate(p)) + sum(field.step[a, b] for a, b in itertools.pairwise(p))
        assert field.viterbi(bits) == list(max(itertools.product((0, 1), repeat=n), key=score))


PROSE = "The old road went along the river and nobody knew where it ended, so they walked on."
NOISE = "BUY%%% NOW### CHEAP$$$ DEAL*** CLICK&&& HERE### FREE%%% MONEY$$$"


def test_trained_field_keeps_prose_and_drops_noise(spark):
    r = random.Random(4)
    prose = lambda: "\n".join(" ".join(r.sample(PROSE.split(), 14)) + "." for _ in range(8))
    noise = lambda: "\n".join(" ".join(r.sample(NOISE.split(), 8)) for _ in range(12))
    docs = [(i, noise() if i % 4 == 0 else prose(), "en") for i in range(120)] + [(None, None, "x"), (900, "", None), (0, prose(), "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 80)] + [(None, 1), (3, None)], "doc_id long, quality int")
    field = q.train(df, labels)
    got = q.assess(df, field).collect()
    assert all(g.kept == (g.doc_id is not None and g.doc_id % 4 != 0) for g in got if g.doc_id not in (0, 900))
    assert {g.kept for g in got if g.doc_id in (900, None)} == {False}
    assert q.keep(df, field).columns == df.columns and q.keep(df, field).count() == sum(g.kept for g in got)
    assert q.assess(df.limit(0), field).count() == 0
    plain = q.train(df, labels.limit(0))
    assert all(g.content_share == 1 for g in q.assess(df.where("doc_id < 100"), plain).collect())
