"""Near-duplicate vectors within a label, by PCA-ordered tiled comparison.

Vectors are made unit vectors and turned into principal directions, largest first. Two tiles of vectors are
compared a few directions at a time: after each step the product so far plus the product of the two suffix
norms bounds the cosine, pairs whose bound is under the threshold are out, and a pair of tiles without a
pair left is done (`near`). The turn keeps cosines, so the bound loses no link; what is left at the end is
compared anew by the vectors as given, in double precision.

How it runs: equal vectors of a label become one class first, so copies are never paired. Classes are put in
cells of the first two directions as wide as linked vectors can be apart, so only neighbouring cells are
compared. A cell is dealt by hash into tiles of about ``TILE`` classes, and every pair of tiles is a group
of its own: no task holds more than two tiles, however large a label is. A pair of tiles gives back a row
per linked class: how many vectors it is linked with, and the smallest class it reaches there. A label
whose vectors spread like noise is compared in full, which is quadratic in the label.

The directions come from about ``SAMPLE`` classes, chosen by hash, of each length of vector; they steer
speed alone. Lengths over ``TURNED`` are not turned.

Defined results: only vectors with an id, a label and the same length are compared. A vector that is null,
empty, zero, or holds a null or non-finite component, or whose label is null, links with nothing and is its
own component; a null id has n_links 0, a null component and is kept, and links with nothing. Repeated rows
are vectors of their own that are linked (n_links counts rows). An empty table gives an empty result. Only
key, vector and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import written
from tabspark.llm.near_dedup import components

SIMILARITY, TILE, SAMPLE, TURNED = 0.93, 1_000, 5_000, 2_048
STEP, CELLS = 8, 2_000_000  # directions of a step, vector components gathered at a time
_SLACK = 1e-9  # more than the products' rounding


def unit(vectors: list) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that no square overflows."""
    out = np.stack([np.asarray(v, np.float64) for v in vectors])
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def near(a: np.ndarray, b: np.ndarray, least: float, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) of unit rows whose product may reach ``least``: leading components first."""
    nobody = np.empty(0, np.int64)
    tail = lambda x: np.sqrt(np.append(np.cumsum((x * x)[:, ::-1], 1)[:, ::-1], np.zeros((len(x), 1)), 1))
    left_a, left_b, product, width = tail(a), tail(b), np.zeros((len(a), len(b))), a.shape[1]
    for start in range(0, width, step):
        end = min(start + step, width)
        product += a[:, start:end] @ b[:, start:end].T
        alive = product + left_a[:, end, None] * left_b[None, :, end] >= least - _SLACK
        count = np.count_nonzero(alive)
        if not count:
            return nobody, nobody
        if 20 * count < alive.size or end == width:
            break
    i, j = np.nonzero(alive)
    so_far = product[i, j]
    for start in range(end, width, step):  # few are left: on with these pairs alone
        stop, kept = min(start + step, width), np.zeros(len(i), bool)
        for k in range(0, len(i), max(1, CELLS // step)):
            part = slice(k, k + max(1, CELLS // step))
            so_far[part] += np.einsum("ij,ij->i", a[i[part], start:stop], b[j[part], start:stop])
            kept[part] = so_far[part] + left_a[i[part], stop] * left_b[j[part], stop] >= least - _SLACK
        i, j, so_far = i[kept], j[kept], so_far[kept]
    return i, j


def exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs, those whose product reaches ``least``."""
    kept, step = np.zeros(len(i), bool), max(1, CELLS // a.shape[1])
    for k in range(0, len(i), step):
        part = slice(k, k + step)
        kept[part] = np.einsum("ij,ij->i", a[i[part]], b[j[part]]) >= least
    return i[kept], j[kept]


def _keyed(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """id, label, vector, and a 128-bit key of label and values (null where it can't be linked)."""
    types = {name: df.schema[column].dataType.simpleString() for name, column in (("id", key), ("label", label), ("vector", vector))}

    def hashed(name: str | None, v) -> str | None:
        if name is None or v is None or not len(v):
            return None
        values = np.asarray(v, np.float64) + 0.0  # -0.0 is 0.0
        return xxhash.xxh3_128_hexdigest(f"{len(v)}:{name}:".encode() + values.tobytes()) if np.isfinite(values).all() and values.any() else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [hashed(name, v) for name, v in zip(batch.pop("name"), batch["vector"], strict=True)]
            yield batch.assign(key=pd.Series(keys, index=batch.index, dtype=object))

    given = df.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"), F.col(label).cast("string").alias("name"))
    made = given.mapInPandas(run, ", ".join(f"{n} {t}" for n, t in types.items()) + ", key string")
    return made.withColumn("key", F.when(F.col("id").isNotNull(), F.col("key")))


def directions(classes: DataFrame, total: int, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """By length of vector, its principal directions as columns, the largest first; from a sample."""
    share = min(1.0, sample / max(1, total))
    chosen = classes.where((F.size("vector") <= TURNED) & (F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))))
    by_length: dict[int, list] = {}
    for row in chosen.select("vector").toLocalIterator():
        by_length.setdefault(len(row["vector"]), []).append(row["vector"])
    out = {}
    for length, vectors in by_length.items():
        u = unit(vectors)
        out[length] = np.linalg.eigh(u.T @ u)[1][:, ::-1].copy()
    return out


def _turned(u: np.ndarray, turn: dict[int, np.ndarray]) -> np.ndarray:
    return u @ turn[u.shape[1]] if u.shape[1] in turn else u


def _in_cells(classes: DataFrame, turn: dict[int, np.ndarray], width: float) -> DataFrame:
    """Classes with length, and cell (x, y) of the first two directions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            length = batch["vector"].map(len).to_numpy()
            cell = np.zeros((len(batch), 2), np.int32)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                lead = _turned(unit([batch["vector"].iloc[k] for k in at]), turn)[:, :2]
                cell[at, : lead.shape[1]] = np.floor(lead / width)
            yield batch.assign(length=length, x=cell[:, 0], y=cell[:, 1])

    old = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInPandas(run, old + ", length int, x int, y int")


def _links(placed: DataFrame, turn: dict[int, np.ndarray], least: float, tile: int) -> DataFrame:
    """Per pair of tiles and class linked in it: key, linked (rows it is linked with there), root (the
    least key that it reaches there)."""
    where = ["label", "length", "x", "y"]
    cells = placed.groupBy(*where).agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    mine = placed.join(cells, where).withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
    mine = mine.select(*where, "tile", "key", "copies", "vector")
    steps = F.explode(F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x, y in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))]))
    beside = cells.select(*where, F.col("tiles").alias("other_tiles"), steps.alias("s")).select(
        "label", "length", (F.col("x") + F.col("s.dx")).alias("x"), (F.col("y") + F.col("s.dy")).alias("y"), F.col("s.dx").alias("dx"), F.col("s.dy").alias("dy"), "other_tiles")
    pairs = beside.join(cells, where)  # (x, y) is the right tile, (x - dx, y - dy) the left one
    pairs = pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("other_tiles") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    inside = (F.col("dx") == 0) & (F.col("dy") == 0)
    pairs = pairs.where(~inside | (F.col("i") <= F.col("j"))).select(*where, "dx", "dy", "i", "j")
    right = pairs.withColumn("tile", F.col("j"))
    left = pairs.where(~inside | (F.col("i") < F.col("j"))).withColumn("tile", F.col("i"))
    left = left.withColumns({"rx": F.col("x"), "ry": F.col("y")}).withColumns({"x": F.col("x") - F.col("dx"), "y": F.col("y") - F.col("dy")})
    group = ["label", "length", "rx", "ry", "dx", "dy", "i", "j"]
    sides = mine.join(right.withColumns({"rx": F.col("x"), "ry": F.col("y")}), [*where, "tile"]).select(*group, F.lit(True).alias("right"), "key", "copies", "vector")
    sides = sides.union(mine.join(left, [*where, "tile"]).select(*group, F.lit(False), "key", "copies", "vector"))

    def compare(pair: pd.DataFrame) -> pd.DataFrame:
        pair = pair.sort_values("key", ignore_index=True)
        b = np.flatnonzero(pair["right"])
        a = np.flatnonzero(~pair["right"])
        alone = not len(a)  # a tile with itself
        a = b if alone else a
        u = unit(pair["vector"].tolist())
        turned = _turned(u, turn)
        i, j = near(turned[a], turned[b], least)
        if alone:
            i, j = i[i < j], j[i < j]
        i, j = exact(u[a], u[b], i, j, least)
        i, j = a[i], b[j]
        copies, linked = pair["copies"].to_numpy(np.int64), np.zeros(len(pair), np.int64)
        np.add.at(linked, i, copies[j])
        np.add.at(linked, j, copies[i])
        root, was = np.arange(len(pair)), None
        while was is None or (was != root).any():
            was = root.copy()
            np.minimum.at(root, i, was[j])
            np.minimum.at(root, j, was[i])
            root = root[root]
        at, keys = np.flatnonzero(linked), pair["key"].to_numpy(object)
        return pd.DataFrame({"key": pd.Series(keys[at], dtype=object), "linked": linked[at], "root": pd.Series(keys[root[at]], dtype=object)})

    return sides.groupBy(*group).applyInPandas(compare, "key string, linked long, root string")


def groups(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = SIMILARITY, tile: int = TILE) -> DataFrame:
    """Per row: the key, n_links (other rows linked directly), component_id (smallest id of its group), kept
    (has that id)."""
    rows = written(_keyed(df, key, vector, label), "keyed")
    able = rows.where("key is not null")
    classes = able.groupBy("key").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = written(classes, "classes")
    turn = directions(classes, classes.count())
    placed = written(_in_cells(classes.drop("rep"), turn, sqrt(max(0.0, 2 - 2 * least)) + 1e-6), "placed")
    links = written(_links(placed, turn, least, tile), "links")
    of = components(links.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")))
    degree = links.groupBy("key").agg(F.sum("linked").alias("linked"))
    done = classes.select("key", "rep", "copies").join(degree, "key", "left").join(of.select(F.col("a").alias("key"), F.col("b").alias("up")), "key", "left")
    done = written(done.select("key", "rep", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("up", "key").alias("root")), "linked")
    # written, so that the join may split a large group's rows
    least_id = written(done.groupBy("root").agg(F.min("rep").alias("component_id")), "least")
    done = done.join(least_id, "root").select("key", "n_links", "component_id")
    linked = able.select("id", "key").join(done, "key").select("id", "n_links", "component_id")
    rest = rows.where("key is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.union(rest)
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
