"""Trees grown over binned rows: the learner of a boosting round (M1).

Every feature is binned once, by thresholds found over all rows: midpoints of its distinct values where they
are at most BINS, else about equal shares of the rows. As many features as fit share one 16-bit cell (``Layout``), so a
row is a few cells, and one count over a cell's values holds the histograms of all its features.

Rows travel as blocks of arrays, not one by one. A tree grows a level at a time: each block gives, per node
and bin, the sums of gradients and weights and the rows; only the smaller child of a split is summed, the
other one is its parent less that. Gradients and weights are whole numbers of 2^-shift, so the sums, and with
them the trees, are the same however the rows are dealt.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tabspark.operators.ensemble import LEAF, Node

BINS = 32
CELL = 1 << 10  # values of a cell; more than BINS, so every feature fits one
BLOCK_ROWS = 1 << 17
EXACT = 1 << 14  # distinct values of a feature that are counted one by one
POINTS = 1 << 10  # values that stand for a longer list
SHIFT = 34  # BLOCK_ROWS << SHIFT is below 2^53: a block's sums are exact as doubles
LEAST_WEIGHT = 1e-6  # of a row that is certain already


# ----- thresholds -----------------------------------------------------------------------------------------

Counted = tuple[np.ndarray, np.ndarray]  # values in order, rows of each


def distinct(values: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Values in order, each once, and the sums of their counts."""
    order = np.argsort(values)
    values = values.take(order)
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]][: len(values)])
    return (values.take(first), *(np.add.reduceat(c.take(order), first) if len(first) else c for c in counts))


def _merged(parts: list[Counted]) -> Counted:
    return distinct(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _shortened(c: Counted) -> Counted:
    """POINTS values at most: neighbours stand together, about as many rows in each group, under the median one."""
    values, rows = c
    if len(values) <= POINTS:
        return c
    ends = np.cumsum(rows)
    group = ((ends - 1) * POINTS) // ends[-1]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    middle = np.searchsorted(ends, (np.r_[0, ends[first[1:] - 1]] + np.r_[ends[first[1:] - 1], ends[-1]]) / 2)
    return values[middle], np.add.reduceat(rows, first)


class Values:
    """Rows of each value of one feature. Exact up to EXACT distinct values; past it lists of like size are
    merged and shortened, so a rank is off by a share of about 1/POINTS for each doubling of the rows."""

    def __init__(self) -> None:
        self.exact: list[Counted] = []
        self.size = 0
        self.levels: dict[int, Counted] = {}

    def add(self, c: Counted) -> Values:
        self.exact.append(c)
        self.size += len(c[0])
        if self.size > EXACT:
            self.exact = [_merged(self.exact)]
            self.size = len(self.exact[0][0])
            if self.size > EXACT:
                self._push(0, _shortened(self.exact.pop()))
                self.size = 0
        return self

    def _push(self, level: int, c: Counted) -> None:
        while level in self.levels:
            c = _shortened(_merged([self.levels.pop(level), c]))
            level += 1
        self.levels[level] = c

    def merge(self, other: Values) -> Values:
        for level, c in sorted(other.levels.items()):
            self._push(level, c)
        for c in other.exact:
            self.add(c)
        return self

    def counted(self) -> Counted:
        parts = [*self.levels.values(), *self.exact]
        return _merged(parts) if parts else (np.zeros(0), np.zeros(0, np.int64))


def thresholds(c: Counted, bins: int = BINS) -> np.ndarray:
    """Split candidates of a feature, as Spark's trees choose them; a row goes left where its value is at most one."""
    values, rows = c
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle
    ends, chosen = np.cumsum(rows), []
    stride = ends[-1] / bins
    target = stride
    for k in range(1, len(values)):
        if abs(ends[k - 1] - target) < abs(ends[k] - target):
            chosen.append(middle[k - 1])
            target += stride
    return np.array(chosen[: bins - 1])


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as rows x features."""
    if column.null_count:
        raise ValueError("feature vectors must not be null")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(column) and len(flat) % len(column):
        raise ValueError("feature vectors must be of one length")
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def values_of(batches: Iterable[pa.RecordBatch]) -> list[Values]:
    """Values of each feature of the first column; NaN and infinite ones get the outer bins and are no candidates."""
    found: list[Values] = []
    for batch in batches:
        x = matrix(batch.column(0))
        if not len(x):
            continue
        if not found:
            found = [Values() for _ in range(x.shape[1])]
        if x.shape[1] != len(found):
            raise ValueError("feature vectors must be of one length")
        for f, seen in enumerate(found):
            v = x[:, f]
            v = v[np.isfinite(v)] + 0.0  # -0.0 is 0.0
            seen.add(np.unique(v, return_counts=True))
    return found


def merge_values(a: list[Values], b: list[Values]) -> list[Values]:
    if not a or not b:
        return a or b
    if len(a) != len(b):
        raise ValueError("feature vectors must be of one length")
    return [x.merge(y) for x, y in zip(a, b, strict=True)]


# ----- cells ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Thresholds of every feature, and its place: bin = cell // stride % bins of the feature."""

    thresholds: tuple[np.ndarray, ...]
    cell: np.ndarray
    stride: np.ndarray
    bins: np.ndarray
    widths: tuple[int, ...]  # values of each cell

    @classmethod
    def of(cls, found: list[np.ndarray]) -> Layout:
        """The widest features first, each to the first cell with room; one of a single bin takes none."""
        bins = np.array([len(t) + 1 for t in found], np.int64)
        cell, stride, widths = np.zeros(len(found), np.int64), np.ones(len(found), np.int64), []
        for f in np.argsort(-bins, kind="stable"):
            at = next((k for k, w in enumerate(widths) if w * bins[f] <= CELL), len(widths))
            if at == len(widths):
                widths.append(1)
            cell[f], stride[f] = at, widths[at]
            widths[at] *= int(bins[f])
        return cls(tuple(found), cell, stride, bins, tuple(widths) or (1,))

    @property
    def offsets(self) -> np.ndarray:
        """First place of each feature in a row of all bins, and their number."""
        return np.r_[0, np.cumsum(self.bins)]

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Cells x rows of a matrix of values. NaN stands above every threshold, as in Spark's trees."""
        if x.shape[1] != len(self.bins):
            raise ValueError(f"feature vectors of length {x.shape[1]} for a model of {len(self.bins)} features")
        out = np.zeros((len(self.widths), len(x)), np.uint16)
        for f, t in enumerate(self.thresholds):
            if len(t) == 1:
                out[self.cell[f]] += (~(x[:, f] <= t[0])).astype(np.uint16) * np.uint16(self.stride[f])
            elif len(t):
                out[self.cell[f]] += np.searchsorted(t, x[:, f], side="left").astype(np.uint16) * np.uint16(self.stride[f])
        return out

    def per_feature(self, sums: list[np.ndarray]) -> np.ndarray:
        """Sums over each cell's values (nodes x values) as sums over each feature's bins: nodes x all bins."""
        nodes = len(sums[0])
        out, offsets = np.zeros((nodes, self.offsets[-1]), sums[0].dtype), self.offsets
        for f, n in enumerate(self.bins):
            s = sums[self.cell[f]].reshape(nodes, -1, n, self.stride[f])
            out[:, offsets[f] : offsets[f + 1]] = s.sum(axis=(1, 3))
        return out


@dataclass
class Block:
    """Rows as arrays: their cells (cells x rows), labels, margins, numbers, and whether they are in the round's draw."""

    cells: np.ndarray
    y: np.ndarray
    margin: np.ndarray
    row: np.ndarray
    drawn: np.ndarray | None = None


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK_ROWS) -> Iterator[Block]:
    """Batches of (cells, label, margin, row) as blocks of about ``size`` rows."""

    def block() -> Block:
        t = pa.Table.from_batches(held).combine_chunks()
        col = lambda n: t.column(n).to_numpy()
        return Block(np.ascontiguousarray(unpacked_cells(t.column("_cells").chunk(0)).T), col("_y").astype(np.int8), col("_margin"), col("_row"))

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == size:
                yield block()
                held, rows = [], 0
    if rows:
        yield block()


def packed_cells(cells: np.ndarray) -> pa.Array:
    """Cells x rows as one binary value a row."""
    width, n = cells.shape
    data = np.ascontiguousarray(cells.T)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * (2 * width)), pa.py_buffer(data)])


def unpacked_cells(packed: pa.Array) -> np.ndarray:
    """Rows x cells of one binary value a row."""
    kind = np.int64 if pa.types.is_large_binary(packed.type) else np.int32
    ends = np.frombuffer(packed.buffers()[1], kind)[packed.offset : packed.offset + len(packed) + 1]
    return np.frombuffer(packed.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.uint16).reshape(len(packed), -1)


# ----- trees ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Splits by heap place (root 1, children 2k and 2k + 1), and the value of every place a row can end at."""

    feature: np.ndarray  # LEAF where there is no split
    bin: np.ndarray  # the last bin that goes left
    value: np.ndarray
    gain: np.ndarray

    @property
    def depth(self) -> int:
        split = np.flatnonzero(self.feature != LEAF)
        return int(split[-1]).bit_length() if len(split) else 0

    def importances(self, features: int) -> np.ndarray:
        """Gain of each feature, summed to 1 where there is any."""
        split = self.feature != LEAF
        out = np.bincount(self.feature[split], self.gain[split], minlength=features)
        return out / out.sum() if out.sum() else out

    def nodes(self, layout: Layout, rate: float) -> tuple[Node, ...]:
        """Nodes from the root down, left before right, leaves scaled by the rate."""
        out: list[Node | None] = []

        def take(at: int) -> int:
            here, f = len(out), int(self.feature[at])
            out.append(None)
            if f == LEAF:
                out[here] = Node(value=rate * float(self.value[at]))
            else:
                left = take(2 * at)
                out[here] = Node(f, float(layout.thresholds[f][self.bin[at]]), left, take(2 * at + 1))
            return here

        take(1)
        return tuple(out)


def places(tree: Tree, layout: Layout, cells: np.ndarray) -> np.ndarray:
    """Heap place that each row ends at."""
    n = cells.shape[1]
    at = np.ones(n, np.int64)
    flat, every = cells.reshape(-1), np.arange(n, dtype=np.int64)
    stays = np.ones(len(tree.feature), bool)
    column = np.zeros(len(tree.feature), np.int64)
    right = np.zeros((len(tree.feature), CELL), bool)
    for k in np.flatnonzero(tree.feature != LEAF):
        f = tree.feature[k]
        stays[k], column[k] = False, layout.cell[f] * n
        right[k] = np.arange(CELL) // layout.stride[f] % layout.bins[f] > tree.bin[k]
    right = right.reshape(-1)
    for level in range(tree.depth):
        step = flat.take(column.take(at) + every) + at * CELL
        below = 2 * at + right.take(step)
        ended = stays[1 << level : 2 << level]
        # places before this level were left behind: a row that stays there is at a leaf
        at = np.where(stays.take(at), at, below) if level and (ended.any() or stays[1 : 1 << level].any()) else below
    return at


def gradients(y: np.ndarray, margin: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the logistic loss: label - p and p (1 - p), as whole numbers of 2^-shift."""
    p, one = 1.0 / (1.0 + np.exp(-margin)), 2.0**shift
    return np.rint((y - p) * one), np.rint(np.maximum(p * (1.0 - p), LEAST_WEIGHT) * one)


def level_sums(some: Iterable[Block], tree: Tree, layout: Layout, wanted: np.ndarray, shift: int) -> np.ndarray:
    """3 x wanted places x all bins: gradients, weights and rows of the drawn rows."""
    slot = np.full(2 * len(tree.feature) + 2, -1, np.int64)
    slot[wanted] = np.arange(len(wanted))
    total = [[np.zeros(len(wanted) * width, np.int64) for width in layout.widths] for _ in range(3)]
    for b in some:
        at = slot.take(places(tree, layout, b.cells)) if tree.depth else np.zeros(len(b.y), np.int64)
        rows = np.flatnonzero((at >= 0) & b.drawn)
        if not len(rows):
            continue
        at = at.take(rows)
        g, h = gradients(b.y.take(rows), b.margin.take(rows), shift)
        for c, width in enumerate(layout.widths):
            key = at * width + b.cells[c].take(rows)
            for out, weights in zip(total, (g, h, None), strict=True):
                out[c] += np.bincount(key, weights, len(wanted) * width).astype(np.int64)
    return np.stack([layout.per_feature([x.reshape(len(wanted), -1) for x in out]) for out in total])


def drawn(row: np.ndarray, seed: int, share: float) -> np.ndarray:
    """Whether a row takes part in a round: by a hash of its number, so a repeated task draws the same rows."""
    x = row.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    for move, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(move))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(44) < np.uint64(int(share * (1 << 20)))


def advanced(block: Block, tree: Tree | None, layout: Layout, rate: float, seed: int, share: float) -> Block:
    """The block at the start of a round: margins grown by the tree before it, and the rows of its draw."""
    margin = block.margin if tree is None else block.margin + rate * tree.value.take(places(tree, layout, block.cells))
    take = np.ones(len(block.y), bool) if share >= 1 else drawn(block.row, seed, share)
    return Block(block.cells, block.y, margin, block.row, take)


def _best(sums: np.ndarray, layout: Layout, features: np.ndarray, min_rows: int, min_gain: float) -> tuple[int, int, float, float] | None:
    """Feature, bin, gain and left rows of a node's best split of the features it may try; None without one."""
    g, h, n = sums
    offsets = layout.offsets
    first = slice(offsets[0], offsets[1])
    total = [x[first].sum() for x in (g, h, n)]
    if not total[1]:
        return None
    # sums up to each bin of its own feature
    left = [np.cumsum(x) for x in (g, h, n)]
    starts = np.repeat(offsets[:-1], layout.bins)
    left = [c - np.where(starts > 0, c[starts - 1], 0) for c in left]
    right = [t - c for t, c in zip(total, left, strict=True)]
    usable = np.repeat(np.isin(np.arange(len(layout.bins)), features), layout.bins)
    usable[offsets[1:] - 1] = False  # after the last bin nothing is right
    usable &= (left[2] >= max(min_rows, 1)) & (right[2] >= max(min_rows, 1)) & (left[1] > 0) & (right[1] > 0)
    if not usable.any():
        return None
    lg, lh, rg, rh = (np.asarray(x, np.float64)[usable] for x in (left[0], left[1], right[0], right[1]))
    whole = float(total[0]) ** 2 / float(total[1])
    gains = lg * lg / lh + rg * rg / rh - whole
    k = int(np.argmax(gains))
    if gains[k] <= 0 or gains[k] / float(total[1]) < min_gain:
        return None
    place = int(np.flatnonzero(usable)[k])
    f = int(np.searchsorted(offsets, place, side="right")) - 1
    return f, place - int(offsets[f]), float(gains[k]), int(left[2][place])


def grow(sums_of: Callable[[Tree, np.ndarray], np.ndarray], layout: Layout, depth: int, min_rows: int, min_gain: float, feature_share: float, seed: int) -> Tree:
    """A tree of a round; ``sums_of`` gives the level sums of the wanted places under the tree so far. A node
    tries its own draw of the features."""
    features, offsets = len(layout.bins), layout.offsets
    tries = max(1, min(features, math.ceil(feature_share * features))) if feature_share < 1 else features
    tree = Tree(*(np.full(2 << depth, x) for x in (LEAF, 0, 0.0, 0.0)))
    open_ = {1: sums_of(tree, np.array([1]))[:, 0]}
    for level in range(depth):
        smaller: dict[int, int] = {}
        for at, sums in open_.items():
            g, h = (int(x[offsets[0] : offsets[1]].sum()) for x in sums[:2])
            tree.value[at] = g / h if h else 0.0
            some = np.arange(features) if tries == features else np.random.default_rng((seed % (1 << 32), at)).choice(features, tries, replace=False)
            best = _best(sums, layout, some, min_rows, min_gain)
            if best is not None:
                f, b, tree.gain[at], left = best
                tree.feature[at], tree.bin[at] = f, b
                rows = int(sums[2][offsets[0] : offsets[1]].sum())
                smaller[at] = 2 * at if 2 * left <= rows else 2 * at + 1
                if level == depth - 1:  # the last children need no bins, only their totals
                    cut = offsets[f] + b + 1
                    for child, own in ((2 * at, slice(offsets[f], cut)), (2 * at + 1, slice(cut, offsets[f + 1]))):
                        g, h = (int(x[own].sum()) for x in sums[:2])
                        tree.value[child] = g / h
        if level == depth - 1 or not smaller:
            break
        found = sums_of(tree, np.array(list(smaller.values())))
        below = {}
        for k, (at, small) in enumerate(smaller.items()):
            below[small], below[small ^ 1] = found[:, k], open_[at] - found[:, k]
        open_ = dict(sorted(below.items()))
    return tree
