import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tabspark.llm import token_counts as tc

SCHEMA = "op string, doc_id long, source string, lang string, version string, n_tokens long, seq long, docs string"


@pytest.mark.parametrize("compact_every", [0, 2])
def test_random_batches_match_a_replay(spark, tmp_dir, compact_every):
    r, rollup, state, loose = random.Random(1), tc.Rollup(spark, f"{tmp_dir}/r", 3, compact_every), {}, []
    for b in range(5 if compact_every else 4):
        rows = [(r.choice(["insert", "revise", "delete"]), r.choice([*range(12), None]), r.choice(["a", "b", None]), r.choice(["en", None]), r.choice(["v1", "v2", None]), r.choice([1, 5, None]), r.randrange(5), "x") for _ in range(40)]
        df = spark.createDataFrame(rows, SCHEMA)
        assert rollup.commit(f"b{b}", df)
        assert not rollup.commit(f"b{b}", df)
        best = {}
        low = lambda x: (x is not None, x)
        for op, d, s, g, v, n, q, _ in rows:
            if d is None:
                loose += [((s, g, v), 1 if op == "insert" else -1, n or 0)] * (op != "revise")
                continue
            rank = (q, op == "delete", n or 0, low(s), low(g))
            if (d, v) not in best or rank > best[d, v][0]:
                best[d, v] = (rank, None if op == "delete" else (s, g, n or 0))
        state |= {k: x for k, (_, x) in best.items()}
        want = {}
        for (d, v), x in state.items():
            if x:
                a, t = want.get((x[0], x[1], v), (0, 0))
                want[x[0], x[1], v] = (a + 1, t + x[2])
        for g, sign, n in loose:
            a, t = want.get(g, (0, 0))
            want[g] = (a + sign, t + sign * n)
        assert {(x.source, x.lang, x.version): (x.docs, x.tokens) for x in rollup.totals().collect()} == {k: v for k, v in want.items() if v != (0, 0)}


def test_compaction_folds_logs_and_lookups_read_touched_buckets(spark, tmp_dir):
    rollup = tc.Rollup(spark, f"{tmp_dir}/r", buckets=4, compact_every=0)
    batch = lambda ids, op, n: spark.createDataFrame([(op, i, "a", "en", "v1", n, 0, "x") for i in ids], SCHEMA)
    assert not rollup.compact()
    total = lambda: [(x.docs, x.tokens) for x in rollup.totals().collect()]
    rollup.commit("one", batch(range(20), "insert", 5))
    rollup.commit("two", batch(range(5), "delete", 0))
    assert rollup.compact() and not rollup.compact() and total() == [(15, 75)]
    state = rollup._read("log", rollup.schema)
    assert sorted(x.doc_id for x in state.collect()) == list(range(5, 20))   # what is deleted is not kept
    rollup.commit("three", batch([7], "revise", 6))
    assert total() == [(15, 76)] and not rollup.commit("one", batch(range(20), "insert", 5))
    (touched,) = spark.read.schema(rollup.schema).parquet(f"{tmp_dir}/r/log/{rollup.commits()[-1][2]}").collect()
    plan = state.where(state.bucket.isin([touched.bucket]))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert len(os.listdir(f"{tmp_dir}/r/log")) == 3
    assert rollup.compact() and total() == [(15, 76)]
    assert len(os.listdir(f"{tmp_dir}/r/log")) == 1   # what the compaction before had replaced is gone
    # a compaction that died before its file was there is not seen
    fs = rollup.fs
    rollup.commit("four", batch([30], "insert", 1))
    rollup.fs = type("Broken", (), {"listStatus": lambda self, p: fs.listStatus(p)})()
    with pytest.raises(AttributeError):
        rollup.compact()
    rollup.fs = fs
    assert total() == [(16, 77)] and rollup.compact() and total() == [(16, 77)]
    with pytest.raises(ValueError):
        rollup.commit("odd", batch([1], "insert", 1).withColumn("doc_id", F.lit("1")))


def test_ids_of_a_real_tokenizer(spark):
    import tiktoken.load

    from tabspark.llm import bpe
    texts = ["Hello, wörld! 123\n\n  x", "", None, "a" * 500]
    df = spark.createDataFrame([(i, t, "s" if i else None, "en") for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string")
    ranks = tiktoken.load.load_tiktoken_bpe(str(bpe.public_tokenizers.path(bpe.VOCABULARY)))
    known = tiktoken.Encoding("t", pat_str=bpe.public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {x.doc_id: (x.source, x.lang, x.version, x.n_tokens) for x in tc.counted_ids(df).collect()}
    assert got == {i: ("s" if i else None, "en", "byte_bpe_multi_50k", len(known.encode(t or ""))) for i, t in enumerate(texts)}


def test_failed_attempt_is_not_seen(spark, tmp_dir, monkeypatch):
    rollup = tc.Rollup(spark, f"{tmp_dir}/r")
    df = spark.createDataFrame([("insert", 1, "a", "en", "v1", 3, 0, "x"), ("insert", 1, "a", "en", "v1", 3, 0, "x")], SCHEMA)
    assert rollup.totals().count() == 0 and rollup.commit("empty", df.limit(0))
    fs = rollup.fs
    rollup.fs = type("Broken", (), {"listStatus": lambda self, p: fs.listStatus(p)})()
    try:
        rollup.commit("one", df)
        raise RuntimeError("must fail")
    except AttributeError:
        rollup.fs = fs
    assert rollup.totals().count() == 0
    assert rollup.commit("one", df) and [(x.docs, x.tokens) for x in rollup.totals().collect()] == [(1, 3)]


def test_counts(spark):
    df = spark.createDataFrame([(1, "a1 b-c\té ", "s", "en"), (2, None, None, None)], "doc_id long, text string, source string, lang string")
    got = {(x.doc_id, x.version): x.n_tokens for x in tc.counted(df).collect()}
    assert got == {(1, "words.v1"): 3, (1, "pieces.v1"): 5, (2, "words.v1"): 0, (2, "pieces.v1"): 0}
    assert tc.counted(df).where(F.col("doc_id") > 5).count() == 0
