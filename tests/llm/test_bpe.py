import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from tabspark.llm import bpe

LINES = open(P.path(bpe.VOCABULARY), "rb").read().splitlines()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, LINES)}
OWN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})

TEXTS = ["", " ", "a", "Hello world's don't  x\n\n\ty ", "a\x1cb \x1c\x1d x", "naïve ½ ² 12³ ªº", "日本語 テスト 123", "a b c", "😀😀 x",
         "a" * 3000, "ab" * 700, " " * 900, "1" * 777, "!?" * 400 + " end", "́é ‘q’ – €5", "x\r\n\r\n  y", "".join(random.Random(1).choices("etaoinshrdlu", k=2500))]


def ids_of(pieces):
    return [int(i) for p in pieces for i in p[1].split(",")]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_those_of_tiktoken(text):
    got = ids_of(next(bpe.Encoder()([text])))
    assert got == OWN.encode_ordinary(text)
    assert bpe.codec().decode(got).decode() == text


def test_random_texts_match():
    r = random.Random(7)
    texts = ["".join(r.choices("abcdefghijklmnopqrstuvwxyzéèßñ  \n'.,0123456789ABC　中", k=r.randint(0, 400))) for _ in range(300)]
    for text, pieces in zip(texts, bpe.Encoder()(texts), strict=True):
        assert ids_of(pieces) == OWN.encode_ordinary(text)


def test_table_edge_cases(spark):
    rows = [(1, "the cat", 5), (1, "the cat", 6), (None, None, 7), (2, "", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = bpe.encode(df, digests=True).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 0), (1, 2), (1, 2), (2, 0)]
    assert {r.ids_sha256 for r in got if r.n_tokens == 0} == {hashlib.sha256(b"").hexdigest()}
    back = bpe.decode(bpe.encode(df)).collect()
    assert sorted(r.text for r in back) == ["", "", "the cat", "the cat"]
    assert bpe.encode(df.limit(0)).count() == 0
