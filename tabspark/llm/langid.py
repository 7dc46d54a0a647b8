"""Language ID: a bidirectional gated recurrent network over bytes.

The network reads each word (a run of letters, lower case, between two boundary bytes) byte by byte in both
directions and gives every position a distribution over the languages. A document's log probabilities
are the means over all its positions; its score is the best language's share. Words are read on their own,
so equal words of a text are labelled once and weigh as often as they occur; whole texts count.

Trained in numpy by backpropagation through time (Adam) on words of a bounded sample of documents:
``per_language`` documents of each language in the order of a hash of their id, ``words_per_language`` words
of each, ``words_in_all`` words over all languages.

Defined results: null text, empty text or text without a letter: ``und`` with score 0; without any
language to learn from, also every other text; ties go to the first language by name; repeated rows are
predicted alike; an empty table gives an empty one. Only key and text are read for predictions.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.llm.common import written

PER_LANGUAGE, WORDS, WORDS_IN_ALL, HIDDEN, EMBED = 1500, 20_000, 2_000_000, 12, 8
_WORD = re.compile(r"[^\W\d_]+")
_PIECE = 40  # bytes of a word that are read at once; a longer word is read in such pieces, all of them


class Network:
    """Two GRUs over bytes (one backward) and a softmax at each position."""

    def __init__(self, languages: list[str], seed: int = 0) -> None:
        r = np.random.default_rng(seed)
        self.languages, n = languages, len(languages)
        self.p = {"embed": r.normal(0, 0.3, (257, EMBED)), "out": r.normal(0, 0.2, (2 * HIDDEN, n)), "bias": np.zeros(n)}
        for d in "fb":
            self.p |= {f"{d}x": r.normal(0, EMBED**-0.5, (EMBED, 3 * HIDDEN)), f"{d}h": r.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN)), f"{d}c": np.zeros(3 * HIDDEN)}

    @staticmethod
    def pad(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Byte ids, 256 as boundary at both ends and as padding, and which positions count."""
        width = max(map(len, words)) + 2
        ids = np.full((len(words), width), 256)
        for k, w in enumerate(words):
            ids[k, 1 : len(w) + 1] = np.frombuffer(w, np.uint8)
        n = np.array([len(w) + 2 for w in words])
        return ids, np.arange(width) < n[:, None]

    def _run(self, d: str, ids: np.ndarray, inside: np.ndarray, keep: bool):
        table = self.p["embed"] @ self.p[f"{d}x"] + self.p[f"{d}c"]
        steps = range(ids.shape[1]) if d == "f" else range(ids.shape[1] - 1, -1, -1)
        h = np.zeros((len(ids), HIDDEN))
        out, tape = np.zeros((*ids.shape, HIDDEN)), []
        for t in steps:
            x, r = table[ids[:, t]], h @ self.p[f"{d}h"]
            gate = 1 / (1 + np.exp(-(x[:, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])))
            z, q = gate[:, :HIDDEN], gate[:, HIDDEN:]
            cand = np.tanh(x[:, 2 * HIDDEN :] + q * r[:, 2 * HIDDEN :])
            on = inside[:, t, None]
            new = np.where(on, z * h + (1 - z) * cand, h)
            if keep:
                tape.append((t, h, z, q, cand, r[:, 2 * HIDDEN :], on))
            h = out[:, t] = new
        return out, tape

    def forward(self, ids: np.ndarray, inside: np.ndarray, keep: bool = False):
        (f, tf), (b, tb) = self._run("f", ids, inside, keep), self._run("b", ids, inside, keep)
        both = np.concatenate([f, b], 2)
        logit = both @ self.p["out"] + self.p["bias"]
        logit -= logit.max(2, keepdims=True)
        return logit - np.log(np.exp(logit).sum(2, keepdims=True)), both, (tf, tb)

    def gradient(self, ids: np.ndarray, inside: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over positions and its gradient, back through all time steps."""
        log_p, both, tapes = self.forward(ids, inside, True)
        count = inside.sum()
        loss = -(log_p[np.arange(len(ids)), :, label] * inside).sum() / count
        top = np.exp(log_p)
        top[np.arange(len(ids)), :, label] -= 1
        top *= inside[..., None] / count
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"], g["bias"] = np.tensordot(both, top, ((0, 1), (0, 1))), top.sum((0, 1))
        back = top @ self.p["out"].T
        for d, tape, part in (("f", tapes[0], back[..., :HIDDEN]), ("b", tapes[1], back[..., HIDDEN:])):
            dh = np.zeros((len(ids), HIDDEN))
            table = np.zeros((257, 3 * HIDDEN))
            for t, h, z, q, cand, r, on in reversed(tape):
                dh = dh + part[:, t]
                live = dh * on
                d_cand = live * (1 - z) * (1 - cand**2)
                d_gate = np.concatenate([live * (h - cand) * z * (1 - z), d_cand * r * q * (1 - q)], 1)
                d_in, d_rec = np.concatenate([d_gate, d_cand], 1), np.concatenate([d_gate, d_cand * q], 1)
                np.add.at(table, ids[:, t], d_in)
                g[f"{d}h"] += h.T @ d_rec
                dh = np.where(on, live * z, dh) + d_rec @ self.p[f"{d}h"].T
            g[f"{d}c"] += table.sum(0)
            g[f"{d}x"] += self.p["embed"].T @ table
            g["embed"] += table @ self.p[f"{d}x"].T
        return loss, g

    def fit(self, words: list[bytes], labels: list[int], epochs: int = 3, batch: int = 256, rate: float = 0.015, seed: int = 0) -> Network:
        r = np.random.default_rng(seed)
        label, size = np.array(labels), np.array(list(map(len, words)))
        mean, var = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step, total = 0, max(1, epochs * -(-len(words) // batch))
        for _ in range(epochs):
            order = np.lexsort((r.random(len(words)), size))  # words of like length together
            for k in r.permutation(range(0, len(words), batch)):
                rows = order[k : k + batch]
                _, g = self.gradient(*self.pad([words[i] for i in rows]), label[rows])
                step += 1
                now = rate * (1 - 0.9 * step / total)
                for name, value in g.items():
                    mean[name] = 0.9 * mean[name] + 0.1 * value
                    var[name] = 0.999 * var[name] + 0.001 * value**2
                    self.p[name] -= now * (mean[name] / (1 - 0.9**step)) / (np.sqrt(var[name] / (1 - 0.999**step)) + 1e-8)
        return self

    def label(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Per word the sum over its positions of the log probabilities, and the number of positions. The
        same network as ``forward``, in single precision and for words of one length at a time."""
        p = {k: v.astype(np.float32) for k, v in self.p.items()}
        size = np.fromiter(map(len, words), np.int64, len(words))
        sums = np.zeros((len(words), len(self.languages)))
        for n in np.unique(size):
            rows = np.flatnonzero(size == n)
            for k in range(0, len(rows), 1024):
                own = rows[k : k + 1024]
                ids = np.full((n + 2, len(own)), 256)
                ids[1:-1] = np.frombuffer(b"".join([words[i] for i in own]), np.uint8).reshape(len(own), n).T
                both = np.empty((n + 2, len(own), 2 * HIDDEN), np.float32)
                for d, part, steps in (("f", both[..., :HIDDEN], range(n + 2)), ("b", both[..., HIDDEN:], range(n + 1, -1, -1))):
                    table = p["embed"] @ p[f"{d}x"] + p[f"{d}c"]
                    table[:, : 2 * HIDDEN] *= 0.5
                    again = p[f"{d}h"].copy()
                    again[:, : 2 * HIDDEN] *= 0.5
                    h = np.zeros((len(own), HIDDEN), np.float32)
                    for t in steps:
                        x, r = table[ids[t]], h @ again
                        gate = np.tanh(x[:, : 2 * HIDDEN] + r[:, : 2 * HIDDEN])  # 2 * sigmoid - 1
                        gate += 1
                        gate *= 0.5
                        cand = np.tanh(x[:, 2 * HIDDEN :] + gate[:, HIDDEN:] * r[:, 2 * HIDDEN :])
                        h = cand + gate[:, :HIDDEN] * (h - cand)
                        part[t] = h
                logit = both @ p["out"] + p["bias"]
                logit -= logit.max(2, keepdims=True)
                sums[own] = (logit - np.log(np.exp(logit).sum(2, keepdims=True))).sum(0)
        return sums, size + 2


def pieces(text: str) -> list[str]:
    found = _WORD.findall(text.lower())  # signs such as ½ count as word characters: a run needs a letter
    return [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


def _cut(word: str) -> list[bytes]:
    raw = word.encode("utf-8")
    return [raw[i : i + _PIECE] for i in range(0, len(raw), _PIECE)]


class Predictor:
    def __init__(self, network: Network) -> None:
        self.network, self.number = network, {}
        self.sums = np.zeros((0, len(network.languages)))

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if len(self.number) > 400_000:
            self.number, self.sums = {}, self.sums[:0]
        counts = [Counter(pieces(t or "")) for t in texts]
        new = [w for w in dict.fromkeys(w for c in counts for w in c) if w not in self.number]
        if new and self.network.languages:
            parts = [(k, p) for k, w in enumerate(new) for p in _cut(w)]
            sums, n = self.network.label([p for _, p in parts])
            own = np.zeros((len(new), sums.shape[1] + 1))
            np.add.at(own, [k for k, _ in parts], np.c_[sums, n])
            self.sums = np.concatenate([self.sums, own]) if len(self.sums) else own
            self.number |= {w: k + len(self.number) for k, w in enumerate(new)}
        out = []
        for c in counts:
            if not c or not self.network.languages:
                out.append(("und", 0.0))
                continue
            rows = self.sums[np.fromiter(map(self.number.__getitem__, c), np.int64, len(c))]
            total = np.fromiter(c.values(), np.float64, len(c)) @ rows
            mean = total[:-1] / total[-1]
            share = np.exp(mean - mean.max())
            best = int(share.argmax())
            out.append((self.network.languages[best], float(share[best] / share.sum())))
        return out


def train(df: DataFrame, use: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE,
          words_per_language: int = WORDS, words_in_all: int = WORDS_IN_ALL) -> Network:
    """The network trained on rows where ``use`` holds: of each language the ``per_language`` documents whose id
    has the least hash, and of each of these its share of twice ``words_per_language`` words, drawn by hash: a
    language with few documents gives more words of each. All languages together give ``words_in_all`` words
    at most, so what reaches the driver is bounded however many languages there are."""
    known = df.where(use).select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null and text is not null and id is not null")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ids = known.select("id", "lang").withColumn("place", F.row_number().over(first)).where(F.col("place") <= per_language)
    ids = written(ids.groupBy("lang", "id").agg(F.min("place").alias("place")), "sample")
    languages = sorted(r["lang"] for r in ids.where("place = 1").select("lang").distinct().limit(words_in_all).collect())
    if not languages:
        return Network([])
    words_per_language = max(1, min(words_per_language, words_in_all // (2 * len(languages))))
    share = ids.groupBy("lang").agg(F.ceil(F.lit(2 * words_per_language) / F.count("*")).cast("int").alias("each"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = []
            for i, t, each in zip(batch["id"], batch["text"], batch["each"], strict=True):
                own = pieces(t)
                words.append([own[j] for j in np.random.default_rng(zlib.crc32(str(i).encode())).permutation(len(own))[:each]])
            yield pd.DataFrame({"lang": batch["lang"], "words": words})

    chosen = known.join(ids.join(share, "lang").select("id", "lang", "each"), ["id", "lang"]).select("id", "lang", "text", "each")
    found = chosen.mapInPandas(run, "lang string, words array<string>").toPandas()
    r, words, labels = np.random.default_rng(0), [], []
    for k, name in enumerate(languages):
        own = sorted(w for row in found["words"][found["lang"] == name] for w in row)
        own = [p for w in (own[i] for i in r.permutation(len(own))[:words_per_language]) for p in _cut(w)]
        words += own
        labels += [k] * len(own)
    network = Network(languages)
    return network.fit(words, labels) if words else network


def predict(df: DataFrame, network: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, lang_pred, score."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Predictor(network)
        for batch in batches:
            texts, rows = batch["text"].tolist(), []
            for k in range(0, len(texts), 500):
                rows += model(texts[k : k + 500])
            yield pd.DataFrame({key: batch["key"].astype(object), "lang_pred": [x for x, _ in rows], "score": [s for _, s in rows]})

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, f"`{key}` {kind}, lang_pred string, score double")
