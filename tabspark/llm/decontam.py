"""Benchmark decontamination: SimHash fingerprints of item-sized windows, multi-index Hamming blocks, exact
weighted-shingle similarity. DataFrame functions only.

Words are runs of letters and digits of the lower-cased text. A shingle is five words (an item with fewer
words is one shingle of its own length). A window has as many words as an item; it is a leak if the
weighted Jaccard similarity of both shingle multisets (weight: how often a shingle occurs) is at least
the threshold.

How it runs:
1. Probes: of each document every ``stride``-th shingle is looked up among the items' shingles. With
   similarity p at least, a window shares all but n (1 - p) / (1 + p) of its n shingles with its item, so
   ``stride`` is chosen from the item sizes such that one probe at least hits.
2. A hit at document word i proposes every item-sized window that covers the shingle there, wherever the
   item has it (the similarity ignores order): starts from i - n + k to i for items of n words and
   shingles of k, overlapping ranges merged. So no window of the threshold's similarity is left out.
3. Of these go the windows with too few shingles that the item has at all to reach the threshold.
4. Window and item are fingerprinted (64 bits). 64 bits in RADIUS + 1 blocks: fingerprints within RADIUS
   agree in a block at least, so windows that share no block with their item go, then those beyond
   RADIUS. At similarity 0.8 the expected distance is 10 bits, with deviation 2.9; RADIUS is 24.
5. What is left is compared exactly.

Defined results: null or empty texts and items match nothing; repeated documents give repeated ids once;
of windows with equal similarity the first counts; a window at a text's end is moved back to fit, in a
shorter text it is the whole text; empty tables give an empty table. Only ids and texts are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import written

SHINGLE, SIMILARITY, RADIUS = 5, 80, 24
BROADCAST_ROWS = 200_000  # of the items' shingles, 28 bytes each; beyond it they are shuffled
_EDGES = [round(i * 64 / (RADIUS + 1)) for i in range(RADIUS + 2)]


def words_of(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(F.length(plain) > 0, F.split(plain, " ")).otherwise(F.array().cast("array<string>"))


def grams(words: Column, size: Column, stride: Column | int = 1) -> Column:
    """64-bit hashes of the runs of ``size`` words, every ``stride``-th."""
    steps = F.sequence(F.lit(1), F.size(words) - size + 1, F.lit(stride) if isinstance(stride, int) else stride)
    return F.when(F.size(words) >= size, F.transform(steps, lambda i: F.xxhash64(F.slice(words, i, size), size))).otherwise(F.array().cast("array<bigint>"))


def fingerprint(column: str) -> Column:
    """SimHash: bit b is set if more than half of the shingles have it."""
    return F.expr(f"aggregate(sequence(0, 63), 0L, (f, b) -> f | if(2 * aggregate({column}, 0, (n, h) -> n + cast(shiftright(h, b) & 1L as int)) > size({column}), shiftleft(1L, b), 0L))")


def blocks(column: str) -> Column:
    """The fingerprint's blocks, each as a number that also holds its place."""
    return F.array(*[F.expr(f"(shiftrightunsigned({column}, {a}) & {(1 << (b - a)) - 1}L) * 32 + {i}") for i, (a, b) in enumerate(zip(_EDGES, _EDGES[1:], strict=False))])


def _overlap(a: str, b: str) -> Column:
    return F.expr(f"aggregate(array_distinct({a}), 0, (n, g) -> n + least(size(filter({a}, x -> x = g)), size(filter({b}, x -> x = g))))")


def _stride(sizes: list[tuple[int, int]], percent: int) -> dict[int, int]:
    """Per shingle size the largest step at which a probe must hit, over the numbers of shingles."""
    out: dict[int, int] = {}
    for k, n in sizes:
        misses = math.floor(n * (100 - percent) / (100 + percent))
        out[k] = min(out.get(k, n), max(1, math.ceil(percent * n / 100) // (misses + 1)))
    return out


def leaks(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", words: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """Per document and item with a leak: key, item, similarity and first word of the best window."""
    items = benchmark.select(F.col(item).alias("item"), words_of(F.col(item_text)).alias("words")).where("item is not null and size(words) > 0")
    items = items.withColumn("k", F.least(F.size("words"), F.lit(words))).withColumn("n", F.size("words")).withColumn("ig", grams(F.col("words"), F.col("k")))
    items = items.groupBy("n", "k", "ig").agg(F.collect_set("item").alias("same"), F.min("item").alias("item")).withColumn("ih", fingerprint("ig")).withColumn("ib", blocks("ih"))
    items = written(items, "items")
    shapes = [(r["k"], r["g"]) for r in items.groupBy("k", F.size("ig").alias("g")).count().collect()]  # as many as item lengths
    stride = _stride(shapes, percent)
    source = documents.select(F.col(key).alias("doc"), F.col(text).alias("body")).where("doc is not null")
    hits = items.select("item", "n", "k", F.explode(F.array_distinct("ig")).alias("h"))
    count = items.agg(F.coalesce(F.sum(F.size("ig")), F.lit(0)).alias("c")).first()["c"]
    if count <= BROADCAST_ROWS:
        hits, small = F.broadcast(hits), F.broadcast
    else:
        small = lambda x: x
    cut = source.select("doc", words_of(F.col("body")).alias("words")).select("doc", *[grams(F.col("words"), F.lit(k), s).alias(f"g{k}") for k, s in stride.items()])
    # explode_outer: for explode, Spark pushes a filter on the array's size below the projection that makes
    # the words, and the lambda over them would then make them anew for each shingle
    probes = None
    for k, s in stride.items():
        own = cut.select("doc", F.lit(k).alias("k"), F.posexplode_outer(f"g{k}").alias("p", "h")).withColumn("i", F.col("p") * s)
        probes = own if probes is None else probes.union(own)
    if probes is None:
        probes = source.limit(0).select("doc", F.lit(0).alias("k"), F.lit(0).alias("p"), F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("i"))
    places = probes.join(hits, ["k", "h"]).groupBy("doc", "item", "n", "k").agg(F.array_sort(F.collect_set("i")).alias("at"))
    # a range of starts ends where the next hit's windows do not adjoin it
    places = places.withColumn("cuts", F.expr("filter(sequence(0, size(at) - 1), p -> p = 0 or at[p] - get(at, p - 1) > n - k + 1)"))
    ranges = places.select("doc", F.explode_outer(F.expr("transform(cuts, (p, q) -> struct(item, k, n - k + 1 as size, at[p] - n + k as lo, at[coalesce(get(cuts, q + 1), size(at)) - 1] as hi))")).alias("r"))
    asked = written(ranges.groupBy("doc").agg(F.collect_list("r").alias("ask")), "asked")

    found = source.join(asked, "doc").select("doc", "ask", words_of(F.col("body")).alias("words"))
    found = found.select("doc", "ask", *[grams(F.col("words"), F.lit(k)).alias(f"g{k}") for k in stride])

    def reach(a: Column) -> Column:
        """The shingles of a range's windows in this text, moved back to fit."""
        own = F.array().cast("array<bigint>")
        for k in stride:
            own = F.when(a["k"] == k, F.col(f"g{k}")).otherwise(own)
        last = F.greatest(F.lit(0), F.size(own) - a["size"])
        lo, hi = (F.greatest(F.lit(0), F.least(a[x], last)) for x in ("lo", "hi"))
        return F.struct(a["item"].alias("item"), lo.alias("lo"), F.slice(own, lo + 1, hi - lo + a["size"]).alias("run"))

    runs = found.select("doc", F.explode_outer(F.transform("ask", reach)).alias("x")).select("doc", "x.*").where("size(run) > 0")
    runs = runs.join(small(items.select("item", "same", "ig", "ih", "ib")), "item").withColumn("own", F.least(F.size("run"), F.size("ig")))
    runs = runs.withColumn("known", F.expr("transform(run, h -> array_contains(ig, h))"))
    enough = F.expr(f"filter(sequence(0, size(run) - own), s -> {100 + percent} * size(array_remove(slice(known, s + 1, own), false)) >= {percent} * (own + size(ig)))")
    windows = runs.select("doc", "lo", "run", "own", "same", "ig", "ih", "ib", F.explode_outer(enough).alias("s")).where("s is not null")
    both = windows.withColumn("wg", F.expr("slice(run, s + 1, own)")).withColumn("start", F.col("lo") + F.col("s")).withColumn("wh", fingerprint("wg"))
    near = both.where(F.arrays_overlap(blocks("wh"), "ib") & (F.bit_count(F.col("wh").bitwiseXOR(F.col("ih"))) <= RADIUS))
    common = near.withColumn("common", _overlap("wg", "ig")).withColumn("all", F.size("wg") + F.size("ig") - F.col("common"))
    exact = common.where(100 * F.col("common") >= percent * F.col("all")).select("doc", F.explode("same").alias("item"), (F.col("common") / F.col("all")).alias("similarity"), "start")
    best = exact.groupBy("doc", "item").agg(F.max("similarity").alias("similarity"), F.min_by("start", F.struct(-F.col("similarity"), "start")).alias("first_word"))
    return best.select(F.col("doc").alias(key), F.col("item").alias(item), "similarity", "first_word")


def clean(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``documents`` whose id has no leak, all columns as they are (null ids stay)."""
    return documents.join(leaks(documents, benchmark, key, **options).select(key).distinct(), key, "left_anti").select(*documents.columns)
