"""Toxicity: noisy-channel restoration of disguised words, then a score of the restored text.

A token with digits or symbols among its letters, long repetitions, or letters spaced out one by one is a
lattice: each place offers its possible letters (leetspeak, a letter, nothing for separators and repeated
letters) with channel probabilities; a star may be any letter in a token with at most STARS of them, which
bounds the lattice, and separates in others. Viterbi decoding under a character language model (four-grams of
a-z, one class for all other letters, and word ends) picks the reading. Spaced letters are one lattice
with their separators, each of which is nothing or a word end, so that a run may hold several words. The
model counts the words of the whole corpus. Plain words have one reading, themselves.

Restored words give features (the word, its first four, five and six letters, hashed); a logistic
regression over those that go with the label is trained on a bounded sample, ``toxic`` and ``clean``
documents with least hash of their id. The score is its probability.

Defined results: null and empty texts have the score of no features; without labels of both kinds all
scores are 0; repeated rows score alike; an empty table gives an empty one. Scores read the text only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import text_slices

TOXIC, CLEAN, BUCKETS, MAX_FEATURES = 2500, 5000, 1 << 20, 8192
ORDER, SYMBOLS = 4, 29  # a-z, other, start, end
START = (27 * SYMBOLS + 27) * SYMBOLS + 27
# What each symbol may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
SEPARATORS = "._-*`"
STARS = 5  # stars of a token that may each be a letter; in a token with more, stars only separate
KEEP, DROP, READ, WILD = np.log(0.6), np.log(0.4), np.log(0.5), np.log(0.4 / 26)
_TOKEN = re.compile(r"[^\s,;:/\"'()\[\]{}<>#%&=?~^]+")
_SPACED = re.compile(r"(?<!\S)(?:[^\s.,*_-](?:[ .*_-]{1,2})){2,}[^\s.,*_-](?![^\s.,;:!?])")
_APART = re.compile(r"[ .*_-]+")
_RUN, _PAIR = re.compile(r"(.)\1\1"), re.compile(r"(.)\1")
_LUT = bytes([i - 97 if 97 <= i < 123 else 26 for i in range(256)])


def codes(word: str) -> bytes:
    return word.encode("ascii", "replace").translate(_LUT)


def count_grams(words: Counter) -> np.ndarray:
    """Four-gram counts of words (each with three starts before and an end after it)."""
    flat = np.frombuffer(b"".join(b"\x1b\x1b\x1b" + codes(w) + b"\x1c" for w in words), np.uint8).astype(np.int64)
    n = np.fromiter((len(w) + 4 for w in words), np.int64, len(words))
    gram = ((flat[:-3] * SYMBOLS + flat[1:-2]) * SYMBOLS + flat[2:-1]) * SYMBOLS + flat[3:]
    weight = np.repeat(np.fromiter(words.values(), np.float64, len(words)), n)[: len(gram)]
    last = np.cumsum(n)[:, None] - np.array([1, 2, 3])  # grams that would start in a word's last three places
    weight[last[last < len(gram)]] = 0
    return np.bincount(gram, weight, SYMBOLS**ORDER)


class CharModel:
    """log P(letter | three before), four-grams backed by shorter ones."""

    def __init__(self, grams: np.ndarray) -> None:
        count = grams.reshape(-1, SYMBOLS)
        p = np.full((1, SYMBOLS), 1 / SYMBOLS)
        for order in range(1, ORDER + 1):  # each order leans on the one below with the weight of five counts
            now = count.reshape(-1, SYMBOLS ** (order - 1), SYMBOLS).sum(0)
            p = (now + 5 * np.tile(p, (SYMBOLS ** (order - 1) // len(p), 1))) / (now.sum(1, keepdims=True) + 5)
        self.log_p = np.log(p).astype(np.float32).ravel()

    def decode(self, token: str) -> str:
        """The likeliest reading of a token's lattice. A space is nothing or a word end."""
        paths: dict = {START: (0.0, None)}
        before, wild = "", token.count("*") <= STARS
        for c in token:
            if c == " ":
                offers = [("", KEEP), (" ", DROP)]
            elif c.isalpha():
                offers = [(c, 0.0)] if c != before else [(c, KEEP), ("", DROP)]
            elif c in SEPARATORS:
                offers = [("", DROP), *([(x, WILD) for x in "abcdefghijklmnopqrstuvwxyz"] if c == "*" and wild else [])]
            else:
                offers = [(x, READ - np.log(len(LEET[c]))) for x in LEET.get(c, "")] + [(c, READ)]
                if c == before:
                    offers.append(("", DROP))
            again, then = c == before, {}
            before = before if c == " " else c
            for state, (score, text) in paths.items():
                for x, cost in offers:
                    if state == START and (x == " " or (not x and again and c not in SEPARATORS)):
                        continue  # no empty word, and a word's first letter repeats nothing
                    new, total = state, score + cost
                    if x == " ":
                        total += float(self.log_p[state * SYMBOLS + 28])
                        new = START
                    elif x:
                        code = codes(x)[0]
                        total += float(self.log_p[state * SYMBOLS + code])
                        new = (state * SYMBOLS + code) % SYMBOLS**3
                    old = then.get(new)
                    if old is None or total > old[0]:
                        then[new] = (total, (text, x) if x else text)
            paths = then

        def letters(text: tuple | None) -> str:
            out = []
            while text:
                text, x = text
                out.append(x)
            return "".join(out[::-1])

        return max((score + float(self.log_p[s * SYMBOLS + 28]), letters(text)) for s, (score, text) in paths.items())[1]


def noisy(token: str) -> bool:
    """Whether a token is more than one reading: letters with digits or symbols, or repetition."""
    if token.isalpha():
        return len(_PAIR.findall(token)) > 1 or bool(_RUN.search(token))
    return any(map(str.isalpha, token))


def trimmed(token: str) -> str:
    """Without symbols around it, but for a sign that may be its first or last letter."""
    t = token.rstrip(".!|*+-_@`")
    while t.endswith("$$"):
        t = t.rstrip("$")
    return t.lstrip(".!|*+-_`") if not t.startswith("$$") else t.lstrip("$")


class Reader:
    """Restored words of texts; what a distinct token reads as is kept."""

    def __init__(self, model: CharModel) -> None:
        self.model, self.known = model, {}

    def read(self, token: str) -> str:
        t = trimmed(token)
        if not noisy(t):
            return t
        if len(self.known) > 100_000:
            self.known.clear()
        if t not in self.known:
            self.known[t] = self.model.decode(t)
        return self.known[t]

    def read_run(self, run: str) -> str:
        """The words that letters spaced out (one space between them) read as."""
        while (t := trimmed(run).strip()) != run:
            run = t
        return self.model.decode(run) if any(map(str.isalpha, run)) else run.replace(" ", "")

    def words(self, token: str) -> set[str]:
        """All words that one of ``tokens`` stands for: its reading's, and itself."""
        if " " in token:
            return {*self.read_run(token).split(), trimmed(token.replace(" ", ""))}
        return {self.read(token), trimmed(token)}

    def tokens(self, text: str) -> set[str]:
        text = text.lower()
        return {*_TOKEN.findall(text), *(_APART.sub(" ", m) for m in _SPACED.findall(text))}

    def restore(self, text: str) -> str:
        """The text with each disguised token replaced by its reading, lower case."""
        text, out, end = text.lower(), [], 0
        for m in _SPACED.finditer(text):
            out += [_TOKEN.sub(lambda t: self.read(t[0]), text[end : m.start()]), self.read_run(_APART.sub(" ", m[0]))]
            end = m.end()
        return "".join([*out, _TOKEN.sub(lambda t: self.read(t[0]), text[end:])])


def hashed(word: str) -> list[int]:
    """Buckets of a restored word's features."""
    raw = word.encode("utf-8")
    return [zlib.crc32(b"w" + raw) % BUCKETS, *(zlib.crc32(b"p" + word[:n].encode("utf-8")) % BUCKETS for n in (4, 5, 6) if len(word) >= n)]


class Scorer:
    """Logistic regression over the chosen buckets."""

    def __init__(self, model: CharModel) -> None:
        self.reader, self.weight, self.bias = Reader(model), {}, None
        self.known: dict[str, tuple[int, ...]] = {}

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, rounds: int = 300) -> Scorer:
        """docs: each document's distinct buckets."""
        n1, n0 = labels.sum(), (1 - labels).sum()
        if not n1 or not n0:
            return self
        row, col = np.repeat(np.arange(len(docs)), list(map(len, docs))), np.concatenate(docs)
        c1, c0 = (np.bincount(col, labels[row] == y, BUCKETS) for y in (1, 0))
        odds = np.log((c1 + 0.5) / (n1 + 1)) - np.log((c0 + 0.5) / (n0 + 1))
        rank = np.where((c1 >= 3) & (odds > 1), odds * np.sqrt(c1), 0)
        chosen = np.sort(np.argsort(-rank, kind="stable")[:MAX_FEATURES])
        chosen = chosen[rank[chosen] > 0]
        place = np.full(BUCKETS, -1)
        place[chosen] = np.arange(len(chosen))
        use = place[col] >= 0
        row, col = row[use], place[col[use]]
        w, b = np.zeros(len(chosen)), -1.0
        m, v, g0 = np.zeros(len(w) + 1), np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        share = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
        for t in range(1, rounds + 1):
            p = 1 / (1 + np.exp(-(b + np.bincount(row, w[col], len(docs)))))
            error = (p - labels) * share
            g0[:-1], g0[-1] = np.bincount(col, error[row], len(w)) + 2e-5 * w, error.sum()
            m, v = 0.9 * m + 0.1 * g0, 0.99 * v + 0.01 * g0**2
            step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
            w, b = np.maximum(w - step[:-1], 0), b - step[-1]
        self.weight, self.bias = {int(k): float(x) for k, x in zip(chosen, w, strict=True) if x > 0.01}, float(b)
        return self

    def parts(self, token: str) -> tuple[int, ...]:
        return tuple(sorted({k for x in self.reader.words(token) for k in hashed(x) if k in self.weight}))

    def __call__(self, text: str | None) -> float:
        if self.bias is None:
            return 0.0
        own = self.reader.tokens(text or "")
        if len(self.known) > 400_000:
            self.known.clear()
        found: set[int] = set()
        for t in own:
            got = self.known.get(t)
            if got is None:
                got = self.known[t] = self.parts(t)
            found.update(got)
        return float(1 / (1 + np.exp(-(self.bias + sum(self.weight[k] for k in sorted(found))))))


def char_model(df: DataFrame, text: str = "text") -> CharModel:
    """Four-gram counts over every row, summed by Spark; at most SYMBOLS ** ORDER of them exist."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS**ORDER)
        for batch in batches:
            texts = [t for t in batch["text"] if t]
            for part in text_slices(texts):
                words = Counter(re.findall(r"[^\W\d_]+", " ".join(texts[part]).lower()))
                if words:
                    total += count_grams(words)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"gram": at.astype(np.int32), "n": total[at].astype(np.int64)})

    rows = df.select(F.col(text).alias("text")).mapInPandas(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    grams = np.zeros(SYMBOLS**ORDER)
    grams[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    return CharModel(grams)


def train(documents: DataFrame, labels: DataFrame, use: Column, toxic: int = TOXIC, clean: int = CLEAN) -> Scorer:
    """The scorer; ``use`` tells by doc_id which labels may be learned from. At most toxic + clean ids are
    broadcast, and their documents' buckets collected."""
    scorer = Scorer(char_model(documents))
    reader = scorer.reader
    known = labels.where(use & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, toxic), (0, clean))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for t in batch["text"]:
                own = {k for x in reader.tokens(t) for w in reader.words(x) for k in hashed(w)}
                found.append(np.array(sorted(own), np.int32))
            yield pd.DataFrame({"toxic": batch["toxic"], "buckets": found})

    rows = documents.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
    got = rows.select("toxic", "text").mapInPandas(run, "toxic int, buckets array<int>").toArrow().to_pandas()  # by Arrow in any session: numbers, not objects
    if not len(got):
        return scorer
    # in an order of their own, so that sums do not depend on which task came first
    rows = sorted(zip(got["toxic"].tolist(), map(bytes, got["buckets"]), got["buckets"], strict=True), key=lambda r: r[:2])
    return scorer.fit([r[2] for r in rows], np.array([r[0] for r in rows], np.float64))


def score(df: DataFrame, scorer: Scorer, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, score, predicted (1 from 0.5 on)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = [scorer(t) for t in batch["text"]]
            yield pd.DataFrame({key: batch["key"].astype(object), "score": p, "predicted": [int(x >= 0.5) for x in p]})

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, f"`{key}` {kind}, score double, predicted int")
