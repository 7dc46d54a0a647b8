"""Near-duplicate groups: SuperMinHash signatures, banding, verification on full shingle sets, union-find.

A document's set is its distinct word shingles (ASCII lower case, words are runs between ASCII white
space; with fewer words than a shingle the whole sequence is one). Documents whose Jaccard similarity is
at least the threshold are linked; a group is a connected component of these links.

How it runs:
1. One pass makes set size, a 128-bit key of the set and the band keys of its SuperMinHash signature.
2. Equal sets (exact copies among them) become one class before anything is paired.
3. Band keys that several classes share are buckets. Members are compared with the leader of their
   bucket, the member that shares most bands, not all with all. A bucket that then holds one component
   is done. What others hold apart is compared in full, in pairs of blocks of bounded size, and only
   links that join two components leave a block.
4. A pair counts only if the full sets reach the threshold; partitions contract their links by
   union-find, and joins hook what is left to the smallest id.

With 252 slots in 42 bands of 6, two sets at similarity 0.8 share a band with probability 1 - 3e-6, at
0.9 with 1 - 3e-14. Shingles are 64-bit hashes: two shingles of a pair collide with probability about
1e-11.

Defined results: null or empty text has an empty set, is linked with nothing and is its own component;
rows that share an id are one document; a null id has a null component and stays; an empty table gives an
empty one. Only key and text are read, so other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import mix64, text_slices, written

SHINGLE, SIMILARITY, SLOTS, ROWS = 5, 80, 252, 6
BLOCK, MEMBERS = 150_000, 1_500  # set elements and members in a block of a band, about
_CHUNK = 60_000  # set elements whose signatures are made together


class Shingles:
    """Distinct shingle hashes of texts, as sorted arrays of uint64."""

    def __init__(self, words: int) -> None:
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        cut = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z, only ASCII white space
        if len(self.known) > 400_000:
            self.known.clear()
        got = list(map(self.known.get, cut))
        if None in got:
            for k, w in enumerate(cut):
                if got[k] is None:
                    got[k] = self.known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.array(got, np.uint64)
        if not len(hashes):
            return hashes
        k = min(self.words, len(hashes))
        out = np.full(len(hashes) - k + 1, np.uint64(k))
        for i in range(k):
            out = mix64(out ^ hashes[i : len(hashes) - k + 1 + i])
        return np.unique(out)


def super_minhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures (rows) of non-empty sets of uint64, slots <= 256.

    Each element draws a random permutation of the slots step by step; at step j it offers j plus a
    uniform number to the permutation's j-th slot, and a slot keeps the least offer. All elements go
    through step j together; a document stops once every slot holds less than j + 1, which no later
    step can undercut.
    """
    signature = np.full((len(sets), slots), np.inf)
    flat = signature.reshape(-1)
    element = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    permutation = None
    for j in range(slots):
        draw = mix64(element ^ mix64(np.array([j], np.uint64)))
        k = j + (draw % np.uint64(slots - j)).astype(np.int64)
        value = j + (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        every = np.arange(len(element))
        slot = k if permutation is None else permutation[every, k].astype(np.int64)
        np.minimum.at(flat, doc * slots + slot, value)
        short = (signature.max(1) >= j + 1)[doc]
        if not short.any():
            break
        if permutation is None:
            kept = np.flatnonzero(short)
            permutation = np.tile(np.arange(slots, dtype=np.uint8), (len(kept), 1))
        else:
            kept = np.flatnonzero(short) if not short.all() else every
            permutation = permutation[kept] if len(kept) < len(every) else permutation
        element, doc, k = element[kept], doc[kept], k[kept]
        permutation[np.arange(len(kept)), k] = permutation[:, j]
    return signature


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` slots; keys of different bands differ."""
    raw = signature.view(np.uint64).reshape(len(signature), -1, rows)
    out = np.tile(np.arange(raw.shape[1], dtype=np.uint64), (len(raw), 1))
    for i in range(rows):
        out = mix64(out ^ raw[:, :, i])
    return out.view(np.int64)


def signatures(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE, slots: int = SLOTS,
               rows: int = ROWS) -> DataFrame:
    """Per row: id, n_shingles, set_key (null for an empty set), bands (array of long)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(words)
        for batch in batches:
            ids, texts = batch["id"].tolist(), [t or "" for t in batch["text"]]
            for part in text_slices(texts):
                sets = [shingles(t) for t in texts[part]]
                keys = [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets]
                made: list = [np.empty(0, np.int64)] * len(sets)
                full = [k for k, s in enumerate(sets) if len(s)]
                start = 0
                while start < len(full):
                    end, held = start, 0
                    while end < len(full) and (end == start or held + len(sets[full[end]]) <= _CHUNK):
                        held += len(sets[full[end]])
                        end += 1
                    for k, b in zip(full[start:end], bands(super_minhash([sets[k] for k in full[start:end]], slots), rows), strict=True):
                        made[k] = b
                    start = end
                yield pd.DataFrame({"id": pd.Series(ids[part], dtype=object), "n_shingles": [len(s) for s in sets], "set_key": keys, "bands": made})

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInPandas(run, f"id {kind}, n_shingles long, set_key string, bands array<long>")


def shingle_sets(df: DataFrame, words: int) -> DataFrame:
    """Per (id, text) row: id, the set as a sorted array of long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(words)
        for batch in batches:
            ids, texts = batch["id"].tolist(), [t or "" for t in batch["text"]]
            for part in text_slices(texts):
                yield pd.DataFrame({"id": pd.Series(ids[part], dtype=object), "shingles": [shingles(t).view(np.int64) for t in texts[part]]})

    return df.mapInPandas(run, f"id {df.schema['id'].dataType.simpleString()}, shingles array<long>")


def _contracted(edges: DataFrame) -> DataFrame:
    """Each partition's links (a, b) as stars (node, root): union-find, the smallest id is root."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict = {}

        def find(x):
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent.setdefault(up, up)
            return x

        for batch in batches:
            for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        pairs = [(x, r) for x in list(parent) if (r := find(x)) != x]
        yield pd.DataFrame(pairs, columns=["a", "b"])

    kind = edges.schema["a"].dataType.simpleString()
    return edges.select("a", "b").mapInPandas(run, f"a {kind}, b {kind}")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): rows (a, b) with b the smallest id that a reaches, for
    every a but the smallest ids themselves."""
    stars = written(_contracted(edges), "stars")
    while True:
        least = stars.groupBy("a").agg(F.min("b").alias("r"), F.max("b").alias("most"))
        loose = least.where("r <> most").select("a").union(stars.join(least.select(F.col("a").alias("b")), "b", "left_semi").select("a"))
        if loose.isEmpty():
            return stars.distinct()
        least = least.select("a", "r")
        hooks = stars.join(least, "a").where("b <> r").select(F.col("b").alias("a"), F.col("r").alias("b"))
        steps = least.select("a", F.col("r").alias("b")).union(hooks).distinct()
        jumped = steps.join(least.select(F.col("a").alias("b"), F.col("r").alias("up")), "b", "left").select("a", F.coalesce("up", "b").alias("b"))
        stars = written(_contracted(jumped.union(hooks)), "stars")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose full sets reach ``percent``."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.withColumn("common", common).where(100 * F.col("common") >= percent * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b")


def _open(members: DataFrame) -> DataFrame:
    """Bands with two components or more, and into how many blocks their members are dealt."""
    count = F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.count("*") / MEMBERS)).cast("int").alias("blocks")
    return members.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), count).where("lo < hi").select("band", "blocks")


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components of a band, enough of them to join what is linked: every member
    of a band that holds two components or more is compared with every other, in blocks.

    Members of a band are dealt by hash into blocks of about BLOCK set elements and MEMBERS members at most, and each
    pair of blocks is a group of its own, so no task holds more than two blocks or their members x members
    matrix. In a group, one matrix product over
    the shingles that several members have gives the size of every intersection."""
    open_ = _open(members)
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = members.join(open_, "band").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "rep", "comp")
    kind = members.schema["rep"].dataType.simpleString()

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        reps, comps, held = group["rep"].tolist(), group["comp"].tolist(), group["shingles"].tolist()
        sizes = np.array([len(x) for x in held])
        _, column, times = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
        row, several = np.repeat(np.arange(len(held)), sizes), times[column] > 1
        column = (np.cumsum(times > 1) - 1)[column[several]]
        row, order = row[several], np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((len(held), len(held)), np.float32)
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            lo, hi = np.searchsorted(column, (start, start + 4096))
            has = np.zeros((len(held), 4096), np.float32)
            has[row[lo:hi], column[lo:hi] - start] = 1
            common += has @ has.T
        code = np.unique(np.array(comps, dtype=object), return_inverse=True)[1]
        linked = (100 * common >= percent * (sizes[:, None] + sizes - common)) & (code[:, None] != code)
        up = list(range(len(held)))

        def find(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        out = []
        for x, y in zip(*np.nonzero(np.triu(linked)), strict=True):
            a, b = find(code[x]), find(code[y])
            if a != b:
                up[a] = b
                out.append((max(comps[x], comps[y]), min(comps[x], comps[y])))
        return pd.DataFrame(out, columns=["a", "b"], dtype=object)

    return dealt.join(sets.withColumnRenamed("id", "rep"), "rep").groupBy("band", "i", "j").applyInPandas(compare, f"a {kind}, b {kind}")


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """Per row: the key, n_shingles, component_id (smallest id of its group), kept (is that document)."""
    made = written(signatures(df, key, text, words), "signatures")
    classes = made.where("set_key is not null and id is not null").groupBy("set_key").agg(F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands"), F.first("n_shingles").alias("n"))
    rows = classes.select("rep", "n", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    members = written(rows.join(shared, "band"), "members")
    reps = members.groupBy("rep").agg(F.sum("members").alias("hub"))
    source = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sets = written(shingle_sets(source.join(reps.select(F.col("rep").alias("id")), "id", "left_semi"), words), "sets")
    members = written(members.drop("members").join(reps, "rep").select("band", "rep", "n", "hub"), "members")

    best = F.max(F.struct("hub", F.struct("rep", "n").alias("who")))["who"].alias("who")
    lead = members.groupBy("band").agg(best).select("band", F.col("who.rep").alias("l"), F.col("who.n").alias("ln"))
    fits = (F.col("rep") != F.col("l")) & (100 * F.least("n", "ln") >= percent * F.greatest("n", "ln"))
    pairs = members.join(lead, "band").where(fits).select(F.least("rep", "l").alias("a"), F.greatest("rep", "l").alias("b")).distinct()
    links = written(_verified(pairs, sets, percent), "links")
    of = written(components(links), "components")
    now = members.join(of.select(F.col("a").alias("rep"), F.col("b").alias("up")), "rep", "left").select("band", "rep", "n", F.coalesce("up", "rep").alias("comp"))
    more = written(_across(now, sets, percent), "links")
    if not more.isEmpty():
        of = written(components(of.union(more)), "components")
    merged = classes.select("set_key", "rep")
    merged = merged.join(of.select(F.col("a").alias("rep"), F.col("b").alias("up")), "rep", "left").withColumn("component_id", F.coalesce("up", "rep"))
    out = made.select("id", "n_shingles", "set_key").join(merged.select("set_key", "component_id"), "set_key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
