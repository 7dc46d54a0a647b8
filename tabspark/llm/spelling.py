"""Spelling variants: words one letter apart, found by a trie over letter counts.

Letters are dealt into ``GROUPS`` groups, and a word's vector says how many letters of each group it has. The
trie's level k branches on the k-th count. An inserted letter raises one count by one, a deleted letter
lowers one, a replaced letter does at most one of each; so a search that may spend one surplus and one
deficit on its way down reaches every leaf that can hold a near word. Words of the leaf are then compared
letter by letter.

How it runs on Spark: the first levels of the trie are the key of a shard (none for a small vocabulary, one
more for each 2.5 times as many words). A word goes to its own shard as a member, and to every shard within
its budget as a question; shards without members drop out. Shards with many members or questions are dealt
into blocks, a group for every pair of blocks, so a task holds ``MEMBERS`` members and ``QUESTIONS``
questions at most, about, and compares ``CHUNK`` pairs at a time. In a task the rest of the trie is searched
depth first; each node takes all questions that still have the budget for it (`reached`). What leaves a
task is one row per question: how many near words, and the best of them.

Defined results: null texts have no words; a null document id reads as empty in the rule that deletes
letters; repeated rows count each time; an empty table gives an empty result. Only key and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import written

GROUPS = 11
LETTERS, OCCURRENCES, TIMES = 6, 5, 5  # least letters and occurrences of a word, how much more often a form occurs
SHARD, MEMBERS, QUESTIONS = 40_000, 15_000, 40_000
CHUNK, WIDTH = 50_000, 40  # pairs compared at a time, longest word compared in a matrix


def occurrences(df: DataFrame, key: str = "doc_id", text: str = "text", letters: int = LETTERS, damage: int | None = None) -> DataFrame:
    """Words with their number of occurrences: (word, n), n of a part of the rows each, to be summed.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, of ``letters`` code points
    or more. With ``damage``, a run whose crc32 of ``<key>:<run>`` that number divides loses the code point
    at crc32 modulo its length first."""
    runs = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % letters)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for batch in batches:
            for doc, body in zip(batch["id"], batch["text"], strict=True):
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(runs.findall((body or "").encode("utf-8").lower())).items():
                    if damage and not (h := zlib.crc32(word, seed)) % damage:
                        whole = word.decode()
                        at = h % len(whole)
                        word = (whole[:at] + whole[at + 1 :]).encode() if len(whole) > letters else b""
                    found[word] += n
                if len(found) > 400_000:
                    yield rows(found)
                    found.clear()
        yield rows(found)

    def rows(found: Counter) -> pd.DataFrame:
        found.pop(b"", None)
        return pd.DataFrame({"word": pd.Series([w.decode() for w in found], dtype=object), "n": pd.Series(list(found.values()), dtype="int64")})

    return df.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text")).mapInPandas(run, "word string, n long")


def vectors(words: list[str]) -> np.ndarray:
    """Letter counts by group, a row per word."""
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    cell = np.repeat(np.arange(len(words)), sizes) * GROUPS + codes % GROUPS
    return np.bincount(cell, minlength=len(words) * GROUPS).reshape(len(words), GROUPS)


def one_apart(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


class Words:
    """Words as a padded matrix of code points, for comparing many pairs at once."""

    def __init__(self, words: list[str]) -> None:
        self.words, self.size = words, np.array([len(w) for w in words], np.int64)
        short = [w if len(w) <= WIDTH else "" for w in words]
        self.codes = np.frombuffer("".join(w.ljust(WIDTH + 1, "\0") for w in short).encode("utf-32-le"), np.uint32).reshape(len(words), WIDTH + 1)


def verified(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """For pairs of a's words i with b's words j, whether they are one apart."""
    out = np.zeros(len(i), bool)
    long = np.maximum(a.size[i], b.size[j]) > WIDTH
    for k in np.flatnonzero(long):
        out[k] = one_apart(a.words[i[k]], b.words[j[k]])
    for lag in (-1, 0, 1):
        at = np.flatnonzero(~long & (a.size[i] - b.size[j] == lag))
        if not len(at):
            continue
        x, y = a.codes[i[at]], b.codes[j[at]]
        differ = x != y
        if lag == 0:
            out[at] = differ.sum(1) == 1
            continue
        if lag < 0:
            x, y = y, x  # x is the longer one; from the first difference on it must run one behind
        rest = np.arange(WIDTH) >= differ.argmax(1)[:, None]
        out[at] = ~((x[:, 1:] != y[:, :-1]) & rest).any(1)
    return out


def reached(members: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
    """Depth-first search of the trie over ``members`` (vectors in lexicographic order) for all vectors of
    ``asked`` together: (questions, lo, hi) for each leaf, whose words are members lo to hi."""
    if not len(members) or not len(asked):
        return
    nobody = np.zeros(len(asked), np.int64)
    stack = [(0, len(members), 0, np.arange(len(asked)), nobody, nobody)]
    while stack:
        lo, hi, level, who, surplus, deficit = stack.pop()
        same = level if (members[lo] != members[hi - 1]).any() else GROUPS  # below here only one path is left
        if same == GROUPS:
            over = asked[who, level:] - members[lo, level:]
            more, less = surplus + np.maximum(over, 0).sum(1), deficit + np.maximum(-over, 0).sum(1)
            left = who[(more <= 1) & (less <= 1)]
            if len(left):
                yield left, lo, hi
            continue
        counts = members[lo:hi, level]
        cuts = np.flatnonzero(np.diff(counts)) + 1
        for start, end in zip([0, *cuts], [*cuts, hi - lo], strict=True):
            over = asked[who, level] - counts[start]
            more, less = surplus + np.maximum(over, 0), deficit + np.maximum(-over, 0)
            left = (more <= 1) & (less <= 1)
            if left.any():
                stack.append((lo + int(start), lo + int(end), level + 1, who[left], more[left], less[left]))


def _pairs(members: Words, order: np.ndarray, vectors_: np.ndarray, asked: Words, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs (question, member), some at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def check():
        i, j = (np.concatenate(x) for x in zip(*held, strict=True))
        for start in range(0, len(i), CHUNK):
            part = slice(start, start + CHUNK)
            good = verified(asked, i[part], members, j[part])
            yield i[part][good], j[part][good]
        held.clear()

    for who, lo, hi in reached(vectors_, wanted):
        step = max(1, CHUNK // (hi - lo))
        for start in range(0, len(who), step):
            some = who[start : start + step]
            held.append((np.repeat(some, hi - lo), np.tile(order[lo:hi], len(some))))
            n += len(held[-1][0])
            if n >= CHUNK:
                yield from check()
                n = 0
    if held:
        yield from check()


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    """Of a group of members and questions: per question with a near member its word, how many, the best."""
    here = group[group["member"]]
    words, n = here["word"].tolist(), here["n"].to_numpy(np.int64)
    asked = group.loc[~group["member"], "word"].tolist()
    out = pd.DataFrame({"word": [], "n_near": [], "best_n": [], "best": []}).astype({"word": object, "best": object})
    if not words or not asked:
        return out
    counts, place = vectors(words), np.empty(len(words), np.int64)
    order = np.lexsort(counts.T[::-1])
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    n_near, best = np.zeros(len(asked), np.int64), np.full(len(asked), -1, np.int64)
    for i, j in _pairs(Words(words), order, counts[order], Words(asked), vectors(asked)):
        np.add.at(n_near, i, 1)
        i, j = np.concatenate([i, np.flatnonzero(best >= 0)]), np.concatenate([j, best[best >= 0]])
        by = np.lexsort((place[j], -n[j], i))
        i, j = i[by], j[by]
        first = np.flatnonzero(np.diff(i, prepend=-1))
        best[i[first]] = j[first]
    at = np.flatnonzero(n_near)
    text = lambda x: pd.Series(x, dtype=object)
    return pd.DataFrame({"word": text([asked[k] for k in at]), "n_near": n_near[at], "best_n": n[best[at]], "best": text([words[k] for k in best[at]])})


def _dealt(vocabulary: DataFrame, levels: int) -> DataFrame:
    """Every word as a member of its shard and as a question to each shard that its budget reaches."""
    steps = [np.zeros(levels, np.int64)]
    for i in range(levels):
        up = np.eye(levels, dtype=np.int64)[i]
        steps += [up, -up] + [up - np.eye(levels, dtype=np.int64)[j] for j in range(levels) if j != i]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            words, n = np.array(batch["word"].tolist(), object), batch["n"].to_numpy(np.int64)
            prefix = vectors(words.tolist())[:, :levels]
            for step in steps:
                ok = (prefix + step >= 0).all(1)
                shard = [".".join(map(str, row)) for row in (prefix + step)[ok].tolist()]
                for member in (False,) if step.any() else (False, True):
                    yield pd.DataFrame({"shard": pd.Series(shard, dtype=object), "member": member, "word": pd.Series(words[ok], dtype=object), "n": n[ok]})

    return vocabulary.select("word", "n").mapInPandas(run, "shard string, member boolean, word string, n long")


def near_words(vocabulary: DataFrame, shard: int = SHARD, members: int = MEMBERS, questions: int = QUESTIONS) -> DataFrame:
    """Of (word, n), distinct words: per word with near words n_near, best_n and best (largest n, ties to
    the smallest in code-point order)."""
    levels, left = 0, vocabulary.count() / shard
    while left > 1 and levels < GROUPS:
        levels, left = levels + 1, left / 2.5
    rows = written(_dealt(vocabulary, levels), "dealt")
    sizes = rows.groupBy("shard").agg(F.count_if("member").alias("m"), F.count_if(~F.col("member")).alias("q")).where("m > 0")
    blocks = sizes.select("shard", F.ceil(F.col("m") / members).cast("int").alias("mb"), F.greatest(F.ceil(F.col("q") / questions), F.lit(1)).cast("int").alias("qb"))
    own, other = F.when(F.col("member"), F.col("mb")).otherwise(F.col("qb")), F.when(F.col("member"), F.col("qb")).otherwise(F.col("mb"))
    mine = F.pmod(F.xxhash64("word"), own).cast("int")
    dealt = rows.join(blocks, "shard").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
    dealt = dealt.withColumns({"i": F.when(F.col("member"), F.col("mine")).otherwise(F.col("other")), "j": F.when(F.col("member"), F.col("other")).otherwise(F.col("mine"))})
    # dealt anew by block: rows that a join left dealt by shard would stay so, all blocks of a shard in one task
    dealt = dealt.select("shard", "i", "j", "member", "word", "n").repartition("shard", "i", "j")
    found = dealt.groupBy("shard", "i", "j").applyInPandas(_compare, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """Of (word, form): the word that following forms from word ends at. Forms must not run in circles."""
    up = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not up.where("moved").isEmpty():
        on = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = up.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        up = written(step, "roots")
    return up.select("word", "root")


def variants(vocabulary: DataFrame, times: int = TIMES, **bounds: int) -> DataFrame:
    """Of (word, n), distinct words: word, form, root, n, n_near, form_n. A form is the near word of largest
    n, ties to the smallest, if it occurs ``times`` as often; root follows forms to the last."""
    near = near_words(vocabulary, **bounds)
    fits = F.col("best_n") >= times * F.col("n")
    with_form = vocabulary.join(near, "word", "left").select(
        "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best_n")).alias("form_n"))
    with_form = written(with_form, "forms")
    last = roots(with_form.where("form is not null"))
    return with_form.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def vocabulary(found: DataFrame, least: int = OCCURRENCES) -> DataFrame:
    """Distinct words that occur ``least`` times or more: (word, n)."""
    return written(found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "vocabulary")
