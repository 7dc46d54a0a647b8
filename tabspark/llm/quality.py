"""Quality rules: a linear-chain conditional random field over a document's lines.

Each line has a few yes/no features (size, capitals, symbols, repetition, ending). The field labels the
line sequence content or boilerplate by Viterbi decoding; a document whose words lie in content lines to
less than ``min_share`` is rejected, and so is one that fails the base rules (under 50 words, or over half
of its words inside three-word windows that the text repeats).

The field is trained by maximum likelihood (forward-backward, Adam) on a bounded sample of labelled
documents, ``per_class`` of either quality in the order of a hash of their id and ``segments`` segments of 64
lines of these, by hash: lines take the label of their document. Without both classes every line counts as content.

Defined results: null or empty text has no words and fails the base rules; repeated rows are judged
alike; equal path scores are decided for content; an empty table gives an empty one. ``assess`` reads key
and text only; ``keep`` passes all columns of its input through.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CAPITALS, _DIGIT = re.compile("[A-ZÀ-ÖØ-Þ]{2,}"), re.compile(r"\d")
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT, MIN_SHARE, PER_CLASS, SEGMENTS = 50, 50, 0.5, 4000, 40_000
FEATURES = ("always", "blank", "words 1-2", "words 3-9", "words 10+", "mostly capitals", "symbols", "many symbols", "digits",
            "shouts", "same word again", "few distinct words", "earlier line", "sentence end", "long words", "short words")
_SEGMENT = 64  # lines of a training sequence; longer documents give several
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
VERDICT = "content_share double, kept boolean, line_labels string"


def line_features(line: str, words: list[str], earlier: bool) -> int:
    """The features of a line as bits, in the order of FEATURES."""
    n = len(words)
    if not n:
        return 1 | 2
    bits = 1 | (4 if n <= 2 else 8 if n <= 9 else 16)
    chars = sum(map(len, words))
    symbols = sum(map(line.count, SYMBOLS))
    if 2 * len(_CAPITALS.findall(line)) > n:
        bits |= 32
    if symbols:
        bits |= 64 | (128 if 5 * symbols > n else 0)
    if _DIGIT.search(line):
        bits |= 256
    if 4 * line.count("!") > n:
        bits |= 512
    if n > 2:
        if 5 * sum(map(eq, words, words[1:])) > n:
            bits |= 1024
        if n >= 8 and 5 * len(set(words)) < 2 * n:
            bits |= 2048
    if earlier:
        bits |= 4096
    if words[-1][-1] in ".!?:;\"')…":
        bits |= 8192
    if chars > 12 * n:
        bits |= 16384
    elif chars < 3 * n:
        bits |= 32768
    return bits


def measure(text: str | None) -> tuple[list[int], list[int], tuple[int, int, int, int, int, bool]]:
    """Line features, words per line, and the base figures of a text."""
    text = text or ""
    seen: set[str] = set()
    bits, sizes, words, again = [], [], [], 0
    for line in text.split("\n"):
        own = _WORD.findall(line)
        earlier = bool(own) and line in seen
        again += earlier
        seen.add(line)
        bits.append(line_features(line, own, earlier))
        sizes.append(len(own))
        words += own
    repeated = repeat_words(words)
    base = (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), again, repeated)
    return bits, sizes, (*base, len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT * len(words))


def repeat_words(words: list[str]) -> int:
    """Words that lie in a three-word window which occurs twice or more."""
    if len(words) < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words])
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:  # three numbers would not fit into 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(number) + ids[2:]
    order = window.argsort()
    same = np.diff(window[order]) == 0
    often = np.zeros(len(window), bool)
    often[order[1:][same]] = often[order[:-1][same]] = True
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : len(words) - 2 + k] |= often
    return int(inside.sum())


class Field:
    """A linear-chain conditional random field with two states, 0 content and 1 boilerplate."""

    def __init__(self) -> None:
        self.emit, self.step, self.start = np.zeros((len(FEATURES), 2)), np.zeros((2, 2)), np.zeros(2)
        self.trained = False
        self.scores: dict[int, tuple[float, float]] = {}

    @staticmethod
    def unpack(bits: np.ndarray) -> np.ndarray:
        return ((bits[..., None] >> np.arange(len(FEATURES))) & 1).astype(np.float64)

    def fit(self, sequences: list[tuple[list[int], int]], rounds: int = 120, penalty: float = 1e-3) -> Field:
        """sequences: line features and the label of all lines. Classes weigh alike."""
        parts = [(bits[k : k + _SEGMENT], y) for bits, y in sequences for k in range(0, len(bits), _SEGMENT)]
        if len({y for _, y in parts}) < 2:
            return self
        n = np.array([len(b) for b, _ in parts])
        y = np.array([y for _, y in parts])
        bits = np.zeros((len(parts), n.max()), np.int64)
        for k, (b, _) in enumerate(parts):
            bits[k, : len(b)] = b
        patterns, which = np.unique(bits, return_inverse=True)
        which = which.reshape(bits.shape)
        x = self.unpack(patterns)
        inside = np.arange(n.max()) < n[:, None]
        lines = np.bincount(y, weights=n, minlength=2)
        weight = (len(parts) / lines.sum()) * (lines.sum() / (2 * lines))[y] / len(parts)
        shape = [self.emit.shape, self.step.shape, self.start.shape]
        theta = np.zeros(sum(int(np.prod(s)) for s in shape))
        mean, var = np.zeros_like(theta), np.zeros_like(theta)
        every = np.arange(len(parts))
        for t in range(1, rounds + 1):
            emit, step, start = (a.reshape(s) for a, s in zip(np.split(theta, np.cumsum([np.prod(s) for s in shape])[:-1].astype(int)), shape, strict=True))
            score = (x @ emit)[which]
            # forward and backward passes over all sequences at once, in logs
            forward, backward = np.empty_like(score), np.zeros_like(score)
            forward[:, 0] = score[:, 0] + start
            for i in range(1, score.shape[1]):
                forward[:, i] = np.logaddexp(forward[:, i - 1, :1] + step[0], forward[:, i - 1, 1:] + step[1]) + score[:, i]
            for i in range(score.shape[1] - 2, -1, -1):
                ahead = score[:, i + 1] + backward[:, i + 1]
                back = np.logaddexp(step[:, 0] + ahead[:, :1], step[:, 1] + ahead[:, 1:])
                backward[:, i] = np.where(inside[:, i + 1, None], back, 0)
            z = np.logaddexp(*forward[every, n - 1].T)
            belief = np.exp(forward + backward - z[:, None, None]) * inside[..., None] * weight[:, None, None]
            truth = np.zeros_like(belief)
            truth[every, :, y] = inside * weight[:, None]
            gap = truth - belief
            by_pattern = np.stack([np.bincount(which.ravel(), gap[..., s].ravel(), len(patterns)) for s in (0, 1)], 1)
            pair = np.zeros((2, 2))
            if score.shape[1] > 1:
                for a in (0, 1):
                    for b in (0, 1):
                        p = np.exp(forward[:, :-1, a] + step[a, b] + score[:, 1:, b] + backward[:, 1:, b] - z[:, None])
                        pair[a, b] = (((y[:, None] == a) * (a == b) - p) * inside[:, 1:] * weight[:, None]).sum()
            grad = np.concatenate([(x.T @ by_pattern).ravel(), pair.ravel(), gap[:, 0].sum(0)]) - penalty * theta
            mean, var = 0.9 * mean + 0.1 * grad, 0.99 * var + 0.01 * grad**2
            theta = theta + 0.15 * (mean / (1 - 0.9**t)) / (np.sqrt(var / (1 - 0.99**t)) + 1e-8)
        self.emit, self.step, self.start = (a.reshape(s) for a, s in zip(np.split(theta, np.cumsum([np.prod(s) for s in shape])[:-1].astype(int)), shape, strict=True))
        self.trained = True
        return self

    def viterbi(self, bits: list[int]) -> list[int]:
        """The best label sequence; equal scores go to content."""
        if not self.trained:
            return [0] * len(bits)
        (aa, ab), (ba, bb) = self.step.tolist()
        come: list[tuple[int, int]] = []
        c = d = 0.0
        for i, b in enumerate(bits):
            if b not in self.scores:
                self.scores[b] = tuple((self.unpack(np.array(b)) @ self.emit).tolist())
            e, f = self.scores[b]
            if not i:
                c, d = self.start[0] + e, self.start[1] + f
                continue
            come.append((0 if c + aa >= d + ba else 1, 0 if c + ab >= d + bb else 1))
            c, d = max(c + aa, d + ba) + e, max(c + ab, d + bb) + f
        state = 0 if c >= d else 1
        out = [state]
        for pair in reversed(come):
            state = pair[state]
            out.append(state)
        return out[::-1]


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, segments: int = SEGMENTS) -> Field:
    """The field trained on at most ``per_class`` documents of each quality (0 or 1), those whose id has the
    least hash, and of their segments of 64 lines on at most ``segments`` a class, by hash. Ids of the sample
    are broadcast: 2 * per_class rows at most; 2 * segments segments at most reach the driver."""
    order = F.xxhash64("doc_id")
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", "quality")
    chosen = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(per_class) for q in (0, 1)]
    sample = F.broadcast(chosen[0].union(chosen[1]).groupBy("doc_id").agg(F.min("quality").alias("quality")))
    rows = documents.select("doc_id", "text").where("text is not null").join(sample, "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, quality, text in zip(batch["id"], batch["quality"], batch["text"], strict=True):
                bits = measure(text)[0]
                out += [(quality, zlib.crc32(f"{i}:{k}".encode()), bits[k : k + _SEGMENT]) for k in range(0, len(bits), _SEGMENT)]
            yield pd.DataFrame(out, columns=["quality", "place", "bits"])

    cut = rows.select(F.col("doc_id").cast("string").alias("id"), "quality", "text").mapInPandas(run, "quality int, place long, bits array<int>")
    of = Window.partitionBy("quality").orderBy("place", "bits")
    found = cut.withColumn("rank", F.row_number().over(of)).where(F.col("rank") <= segments).select("quality", "bits").toPandas()
    pairs = sorted((list(map(int, b)), 1 - int(q)) for b, q in zip(found["bits"], found["quality"], strict=True))
    return Field().fit(pairs)


def judge(field: Field, text: str | None, min_share: float = MIN_SHARE) -> tuple[tuple, tuple[float, bool, str]]:
    bits, sizes, base = measure(text)
    states = field.viterbi(bits)
    share = sum(s for s, y in zip(sizes, states, strict=True) if not y) / base[0] if base[0] else 0.0
    return base, (share, not base[5] and share >= min_share, "".join(map("CB".__getitem__, states)))


def assess(df: DataFrame, field: Field, key: str = "doc_id", text: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """Per row: the key, the base figures, content_share, kept, and a label C or B for each line."""
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {BASE}, {VERDICT}"
    names = [c.split(" ")[0] for c in f"{BASE}, {VERDICT}".split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(*base, *verdict) for base, verdict in (judge(field, t, min_share) for t in batch["text"])]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, key, batch["key"].astype(object))
            yield out

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, schema)


def keep(df: DataFrame, field: Field, text: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``df`` whose document is kept, all columns as they are."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            yield batch.filter(pa.array([judge(field, t, min_share)[1][1] for t in batch.column(text).to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)
