"""Ranked lexical search for many items at once, by multi-query common-subexpression evaluation.

Every item asks for the documents with the largest sum of term scores. Items share terms, and often whole
sets of terms, so their sums are evaluated together:

1. One pass cuts every document into terms with their counts; corpus totals and document frequencies come
   from that table.
2. Items are dealt into blocks of about ``BLOCK_TERMS`` terms. In a block, the pair of symbols that most
   items share becomes a new symbol, again and again, until no two items share a pair (`mined`). A symbol is
   a term or the sum of two symbols, so the result is a DAG whose inner nodes are shared term sets.
3. For every slice of documents, a node's accumulator (one partial score a document) is made once from its
   two parts; an item's scores are the sum of the few symbols left in it (`_best`). Each task keeps the
   best rows of each item, a window ranks what the tasks kept.

Memory: a task holds ``CELLS`` accumulators at a time. What travels to the tasks is one block's DAG, bounded
by ``BLOCK_TERMS`` (an item with more terms is alone); each further block is another scan of the counted
documents.

Scores are integers, so neither the order of sums nor the shape of the DAG can change a result. A term has
weight w = floor(1000 * ln((2N + 2) / (2df + 1))), and adds w * (10^9 tf div (1000 tf + 8m)) with
m = 10 + 90nN div L (N documents with a term, L terms in all, n terms in the document).

Defined results: null and empty texts have no term, are in no result and count in no statistic; an item
without terms, or whose terms no document holds, has no rows; rows with the same item id are one item with
the terms of all; every row of ``documents`` is a document of its own, also where ids repeat; equal scores
rank by ascending id, null last; empty tables give an empty result. Only the named columns are read.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabspark.llm.common import text_slices, written
from tabspark.session import scratch_path

TOP = 10
BLOCK_TERMS = 20_000  # terms of the items in a block, about
PAIRED = 48  # shared terms of one item that are mined together
CELLS = 4_000_000  # accumulators that a task holds
SLICE = 1_000_000  # characters cut into terms at a time, about

_IN_TERM = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if b in _IN_TERM else 32 for b in range(256))


def terms(text: str | None) -> Counter:
    """Terms of a text (A-Z lower-cased, as UTF-8) with their counts: runs of ASCII letters and digits and of
    all characters beyond ASCII. No byte of a longer UTF-8 character is below 128, so bytes decide."""
    return Counter((text or "").encode("utf-8").translate(_FOLD).split())


def counted(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: id, n (terms with repeats), terms (the distinct ones), tfs (their counts)."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in text_slices([t or "" for t in texts], SLICE):
                found = [terms(t) for t in texts[part]]
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                words = pa.array([w for c in found for w in c], pa.string())
                tfs = pa.array([k for c in found for k in c.values()], pa.int64())
                n = pa.array([c.total() for c in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], n, pa.ListArray.from_arrays(ends, words), pa.ListArray.from_arrays(ends, tfs)], ["id", "n", "terms", "tfs"])

    return df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, n long, terms array<string>, tfs array<long>")


def mined(items: list[list[str]], paired: int = PAIRED) -> tuple[list[str], list[tuple[int, int]], list[list[int]]]:
    """Terms, nodes and parts of a DAG that gives every item's sum.

    Symbol k is term k, or from len(terms) on the sum of the two earlier symbols in nodes; an item is the
    sum of its parts. Greedy: the pair that most items share becomes a node in all of them, ties to the
    smallest symbols. Terms that one item alone has are never paired; an item's shared terms are mined in
    runs of ``paired``, which bounds the pairs of long items and changes no sum."""
    holders = Counter(t for item in items for t in set(item))
    names = sorted(holders, key=lambda t: (-holders[t], t))
    number = {t: k for k, t in enumerate(names)}
    alone, runs, owner = [], [], []
    for k, item in enumerate(items):
        symbols = sorted({number[t] for t in item})  # the most shared terms first
        shared = [s for s in symbols if holders[names[s]] > 1]
        alone.append(symbols[len(shared):])
        for start in range(0, len(shared), paired):
            runs.append(set(shared[start : start + paired]))
            owner.append(k)
    pairs: dict[tuple[int, int], set[int]] = {}
    for r, run in enumerate(runs):
        ordered = sorted(run)
        for i, a in enumerate(ordered):
            for b in ordered[i + 1 :]:
                pairs.setdefault((a, b), set()).add(r)
    heap = [(-len(rs), pair) for pair, rs in pairs.items() if len(rs) > 1]
    heapq.heapify(heap)
    nodes: list[tuple[int, int]] = []
    while heap:
        times, pair = heapq.heappop(heap)
        now = len(pairs.get(pair, ()))
        if now < 2:
            continue
        if now != -times:
            heapq.heappush(heap, (-now, pair))
            continue
        made, near = len(names) + len(nodes), set()
        nodes.append(pair)
        for r in pairs.pop(pair):
            run = runs[r]
            run.difference_update(pair)
            for x in run:
                for gone in pair:
                    pairs[min(x, gone), max(x, gone)].discard(r)
                pairs.setdefault((x, made), set()).add(r)
            near |= run
            run.add(made)
        for x in near:
            if len(pairs[x, made]) > 1:
                heapq.heappush(heap, (-len(pairs[x, made]), (x, made)))
    parts = alone
    for r, run in enumerate(runs):
        parts[owner[r]] = sorted([*parts[owner[r]], *run])
    return names, nodes, parts


def _dags(items: DataFrame, blocks: int) -> DataFrame:
    """The DAG of every block of items: rows (block, kind, number, term, item_id, parts), kind is term, node
    or item, parts are two symbols of a node or the symbols of an item."""
    kind = items.schema["item_id"].dataType.simpleString()

    def mine(group: pd.DataFrame) -> pd.DataFrame:
        of: dict = {}
        for item, term in zip(group["item_id"].tolist(), group["term"].tolist(), strict=True):
            of.setdefault(None if pd.isna(item) else item, []).append(term)
        names, nodes, parts = mined(list(of.values()))
        rows = [("term", k, t, None, None) for k, t in enumerate(names)]
        rows += [("node", len(names) + k, None, None, list(pair)) for k, pair in enumerate(nodes)]
        rows += [("item", k, None, item, part) for k, (item, part) in enumerate(zip(of, parts, strict=True))]
        out = pd.DataFrame(rows, columns=["kind", "number", "term", "item_id", "parts"]).astype({"kind": object, "term": object, "item_id": object})
        return out.assign(block=group["block"].iloc[0])[["block", "kind", "number", "term", "item_id", "parts"]]

    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(mine, f"block int, kind string, number int, term string, item_id {kind}, parts array<int>")


class Plan:
    """One block's DAG with the weights of its terms, from rows of its table."""

    def __init__(self, rows: list, documents: int, terms_in_all: int) -> None:
        of = {kind: sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["number"]) for kind in ("term", "node", "item")}
        self.terms = [r["term"] for r in of["term"]]
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * r["df"] + 1))) for r in of["term"]], np.int64)
        self.nodes = [tuple(r["parts"]) for r in of["node"]]
        self.items = [np.array(r["parts"], np.int64) for r in of["item"]]
        self.documents, self.terms_in_all = documents, terms_in_all


def _place(row: tuple) -> tuple:
    """Sort key of (score, id): highest score first, then the smaller id, null last."""
    return -row[0], row[1] is None, 0 if row[1] is None else row[1]


def _best(df: DataFrame, plan: Plan, top: int, cells: int) -> DataFrame:
    """Each task's best rows of every item of the plan: number of the item, doc_id, score."""
    first, symbols = len(plan.terms), len(plan.terms) + len(plan.nodes)
    step = max(1, cells // max(1, symbols))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, id_type = pa.array(plan.terms, pa.string()), None
        held: list[list[tuple]] = [[] for _ in plan.items]  # (score, id), the best first
        for batch in batches:
            ids, n, lists, tfs = (batch.column(name) for name in ("id", "n", "terms", "tfs"))
            id_type, ids = ids.type, ids.to_pylist()
            m = np.array([10 + (90 * x * plan.documents) // plan.terms_in_all for x in n.to_pylist()], np.int64)
            symbol = pc.index_in(lists.flatten(), value_set=vocabulary)
            row = np.repeat(np.arange(len(ids)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            known = symbol.is_valid().to_numpy(zero_copy_only=False)
            symbol = symbol.fill_null(0).to_numpy(zero_copy_only=False)[known]
            row, tf = row[known], tfs.flatten().to_numpy(zero_copy_only=False)[known]
            partial = plan.weights[symbol] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
            for start in range(0, len(ids), step):
                lo, hi = np.searchsorted(row, (start, start + step))
                sums = np.zeros((symbols, min(step, len(ids) - start)), np.int64)
                sums[symbol[lo:hi], row[lo:hi] - start] = partial[lo:hi]
                for k, (a, b) in enumerate(plan.nodes, first):  # every shared set once
                    np.add(sums[a], sums[b], out=sums[k])
                for best, parts in zip(held, plan.items, strict=True):
                    score = sums[parts].sum(0)
                    least = best[-1][0] if len(best) == top else 1
                    if len(score) > top:
                        least = max(least, int(np.partition(score, -top)[-top]))
                    found = [(int(score[x]), ids[start + x]) for x in np.flatnonzero(score >= max(1, least))]
                    if found:
                        best[:] = sorted(best + found, key=_place)[:top]
        rows = [(k, doc, score) for k, best in enumerate(held) for score, doc in best]
        if rows:
            number, doc, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(doc, id_type), pa.array(score, pa.int64())], ["number", "doc_id", "score"])

    kind = df.schema["id"].dataType.simpleString()
    return df.select("id", "n", "terms", "tfs").mapInArrow(run, f"number int, doc_id {kind}, score long")


def search(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
           top: int = TOP, block_terms: int = BLOCK_TERMS, cells: int = CELLS) -> DataFrame:
    """Per item its ``top`` documents with a score above 0: item_id, rank (from 1), doc_id, score."""
    spark = documents.sparkSession
    docs = written(counted(documents, key, text), "counted")
    asked = counted(benchmark, item, item_text).select(F.col("id").alias("item_id"), F.explode("terms").alias("term")).distinct()
    asked = written(asked, "asked")
    docs_n, in_all = docs.agg(F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = docs.select(F.explode("terms").alias("term")).join(asked.select("term").distinct(), "term", "left_semi")
    df = found.groupBy("term").agg(F.count("*").alias("df"))
    blocks = max(1, -(-asked.count() // block_terms))
    dags = written(_dags(asked, blocks).join(df, "term", "left").fillna({"df": 0}), "dags")

    path, kind = scratch_path(spark, f"best-{uuid.uuid4().hex}"), documents.schema[key].dataType.simpleString()
    spark.createDataFrame([], f"block int, number int, doc_id {kind}, score long").write.parquet(path)
    for block in range(blocks):
        plan = Plan(dags.where(F.col("block") == block).collect(), docs_n, in_all)
        if plan.items and in_all:
            _best(docs, plan, top, cells).withColumn("block", F.lit(block)).select("block", "number", "doc_id", "score").write.mode("append").parquet(path)
    order = Window.partitionBy("block", "number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = spark.read.parquet(path).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = dags.where("kind = 'item'").select("block", "number", "item_id")
    return ranked.join(names, ["block", "number"]).select("item_id", "rank", "doc_id", "score")
