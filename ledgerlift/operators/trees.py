"""Tree ensembles and kernel machines that ask for sums over the rows, wherever the rows are.

A fit is a generator: it yields requests (statistics of some nodes, a Gram matrix, class counts) and gets
their sums over all rows. ``alone`` answers from the rows of one task; ``together`` answers the requests of
many fits in one Spark job over blocks of rows. Both give the same model.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce

import numpy as np

U = np.uint64
LEAF = -1


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """Pseudo-random 64-bit numbers of numbers and a seed."""
    with np.errstate(over="ignore"):
        x = x + U(seed % (1 << 64)) * U(0x9E3779B97F4A7C15) + U(0x632BE59BD9B4E019)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def uniform(x: np.ndarray, seed: int) -> np.ndarray:
    return (mixed(x, seed) >> U(11)).astype(np.float64) / 2**53


@dataclass(frozen=True)
class Recipe:
    """How an ensemble is grown. ``forest`` averages trees on bootstraps, else trees are boosted."""

    name: str
    forest: bool
    trees: int
    rate: float = 1.0
    depth: int | None = None
    leaves: int | None = None  # best-first growth to so many leaves
    l2: float = 0.0
    min_rows: int = 1
    min_hessian: float = 0.0
    rows: float = 1.0  # share of the rows for each tree
    features: float = 1.0  # share of the features for each tree
    from_average: bool = False
    weight: str = "none"  # none, positive or balanced
    seed: int = 42


@dataclass
class Tree:
    """Nodes in arrays; node 0 is the root. ``low`` goes left where the value is at most ``cut``."""

    feature: list[int] = field(default_factory=lambda: [LEAF])
    bin: list[int] = field(default_factory=lambda: [0])
    low: list[int] = field(default_factory=lambda: [0])
    high: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin: int, gain: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.gain[node] = feature, bin, gain
        for side in (self.low, self.high):
            side[node] = len(self.feature)
            for x, empty in zip((self.feature, self.bin, self.low, self.high, self.value, self.gain), (LEAF, 0, 0, 0, 0.0, 0.0)):
                x.append(empty)
        return self.low[node], self.high[node]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x, k) for x, k in ((self.feature, np.int16), (self.bin, np.int16), (self.low, np.int32), (self.high, np.int32), (self.value, np.float64), (self.gain, np.float64)))


def leaf_of(bins: np.ndarray, tree: tuple[np.ndarray, ...], at: np.ndarray | None = None) -> np.ndarray:
    """The leaf of every row; rows that have come to the nodes ``at`` go on from there."""
    feature, cut, low, high = tree[:4]
    at = np.zeros(len(bins), np.int32) if at is None else at
    rows = np.flatnonzero(feature[at] != LEAF)
    while len(rows):
        node = at[rows]
        at[rows] = np.where(bins[rows, feature[node]] <= cut[node], low[node], high[node])
        rows = rows[feature[at[rows]] != LEAF]
    return at


#: Rows of a node below which its rows go on together with those of other nodes.
FEW = 256


def leaves_of(columns: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    """The leaf of every row from the bins by feature: nodes part their rows, those of small nodes go down together."""
    feature, cut, low = tree[:3]  # the high side of a node is next to its low side
    n = columns.shape[1]
    out = np.zeros(n, np.int32)
    if feature[0] == LEAF or not n:
        return out
    open_, few, at = [(0, np.arange(n))], [], []
    while open_:
        node, rows = open_.pop()
        if feature[node] == LEAF:
            out[rows] = node
        elif len(rows) < FEW:
            few.append(rows)
            at.append(np.full(len(rows), node))
        else:
            sides = parted(columns[feature[node]], cut[node], rows)
            open_ += [(int(low[node]) + high, side) for high, side in enumerate(sides) if len(side)]
    if few:
        rows, at, flat = np.concatenate(few), np.concatenate(at), columns.ravel()
        while len(rows):
            at = low.take(at) + (flat.take(feature.take(at).astype(np.int64) * n + rows) > cut.take(at))
            ended = feature.take(at) == LEAF
            here = np.flatnonzero(ended)
            out[rows.take(here)] = at.take(here)
            here = np.flatnonzero(~ended)
            rows, at = rows.take(here), at.take(here)
    return out


def parted(column: np.ndarray, cut: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the rows whose bin is at most the cut, and the others."""
    side = column.take(rows) <= cut
    return rows.take(np.flatnonzero(side)), rows.take(np.flatnonzero(~side))


def margin_of(bins: np.ndarray, trees: list[tuple]) -> np.ndarray:
    return margin_by_columns(np.ascontiguousarray(bins.T), trees)


def margin_by_columns(columns: np.ndarray, trees: list[tuple]) -> np.ndarray:
    out = np.zeros(columns.shape[1])
    for tree in trees:
        out += tree[4].take(leaves_of(columns, tree))
    return out


class Block:
    """Rows in memory: bins of the features, their values, the label, which parts use a row, and a random key.

    Bins that are known are not made again; tree ensembles need no values then.
    """

    def __init__(self, x: np.ndarray | None, y: np.ndarray, use: np.ndarray, key: np.ndarray, edges: list[np.ndarray], bins: np.ndarray | None = None):
        self.x, self.y, self.use, self.key = x, y.astype(np.float64), use, key.astype(U)
        self.bins = binned(x, edges) if bins is None else bins
        self.margins: dict = {}
        self._words: np.ndarray | None = None
        self.judged: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # margins out of fold, by part
        self.growing: Growing | Summed | None = None

    @cached_property
    def order(self) -> np.ndarray:
        """For each feature the rows in order of their bins."""
        return np.argsort(self.bins, axis=0, kind="stable").T.astype(np.int32)

    @cached_property
    def columns(self) -> np.ndarray:
        """The bins by feature."""
        return np.ascontiguousarray(self.bins.T)

    def words(self, kind: np.dtype) -> np.ndarray:
        """The bins of a row side by side in words of eight bytes, by word."""
        if self._words is None:
            a_word = 8 // kind.itemsize
            wide = np.zeros((len(self.y), -(-max(1, self.bins.shape[1]) // a_word) * a_word), kind)
            wide[:, : self.bins.shape[1]] = self.bins
            self._words = np.ascontiguousarray(wide.view(np.uint64).T)
        return self._words

    @cached_property
    def bundles(self) -> list[tuple[list[int], list[int], np.ndarray]]:
        """Features of few bins together: which, their widths, and the bins of each row as one number."""
        out: list = []
        for j in np.argsort(self.widths, kind="stable").tolist():
            width = self.widths[j]
            if out and np.prod(out[-1][1]) * width <= BUNDLE:
                out[-1][0].append(j)
                out[-1][1].append(width)
            else:
                out.append(([j], [width]))
        joined = []
        for features, widths in out:
            if len(features) > 1:
                cell = np.zeros(len(self.y), np.uint16)
                for j, width in zip(features, widths):
                    cell = cell * np.uint16(width) + self.columns[j]
                joined.append((features, widths, cell))
        return joined

    @cached_property
    def widths(self) -> list[int]:
        return [int(c.max(initial=0)) + 1 for c in self.columns]

    def margin(self, fit: tuple, old: list, recent: list) -> np.ndarray:
        """The margins of a boosted fit so far; only trees that are new since the last call are applied."""
        done, margin = self.margins.get(fit, (0, np.zeros(len(self.y))))
        total = len(old) + len(recent)
        if done > total:
            done, margin = 0, np.zeros(len(self.y))
        new = [*old[done:], *recent[max(0, done - len(old)) :]]
        if new:
            margin = margin + margin_by_columns(self.columns, new)
        self.margins[fit] = (total, margin)
        return margin


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each value: bin b holds what is above edge b - 1 and at most edge b; NaN is in the last."""
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1).astype(np.int16) if len(edges) else np.zeros((len(x), 0), np.int16)


# --- requests: what a fit asks of a block, and how answers of blocks are put together ----------------


@dataclass(frozen=True)
class Classes:
    """Rows of class 0 and 1 that a part uses."""

    part: int

    def of(self, block: Block) -> np.ndarray:
        y = block.y[block.use[:, self.part]]
        return np.array([np.count_nonzero(y == 0), np.count_nonzero(y == 1)], float)

    merge = staticmethod(np.add)


@dataclass(frozen=True)
class Cells:
    """Statistics of open nodes by feature and bin: rows (slot, feature, bin, G, H, rows).

    For a boosted tree G and H are sums of gradients and curvatures; for a tree of a forest the drawn
    rows of class 1 and of both.
    """

    recipe: Recipe
    part: int
    number: int
    tree: tuple
    open: tuple[int, ...]
    weights: tuple[float, float] = (1.0, 1.0)
    start: float = 0.0
    old: object = ()  # earlier trees: a list, or a broadcast one
    recent: tuple = ()
    fit: str = ""  # tells fits of one recipe apart

    def drawn(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which rows the tree uses, and their parts in the sums."""
        use = block.use[:, self.part]
        seed = self.recipe.seed * 1_000_003 + self.number
        if self.recipe.forest:
            drawn = np.searchsorted(POISSON, uniform(block.key, seed), "right").astype(np.float64)
            use = use & (drawn > 0)
            g, h = drawn * block.y, drawn
        else:
            old = getattr(self.old, "value", self.old)
            margin = self.start + block.margin((self.fit, self.recipe, self.part), old, self.recent)
            p = 1 / (1 + np.exp(-margin))
            w = np.where(block.y == 1, self.weights[1], self.weights[0])
            g, h = w * (p - block.y), w * p * (1 - p)
            if self.recipe.rows < 1:
                use = use & (uniform(block.key, seed) < self.recipe.rows)
        return use, g, h

    def slots(self) -> np.ndarray:
        """The place of each node among the open ones, or -1."""
        slot = np.full(len(self.tree[0]), -1, np.int64)
        slot[list(self.open)] = np.arange(len(self.open))
        return slot

    def of(self, block: Block) -> np.ndarray:
        use, g, h = self.drawn(block)
        mine = np.where(use, self.slots()[leaf_of(block.bins, self.tree)], -1)
        active = mine >= 0
        features = block.bins.shape[1]
        n = int(active.sum())
        if not n:
            return np.zeros((0, 6))
        # By feature, then node, then bin: a stable sort by node of rows that are in order of their bins.
        rows = block.order[active[block.order]].reshape(features, n)
        kind = np.uint16 if len(self.open) < 1 << 16 else np.int64
        rows = np.take_along_axis(rows, np.argsort(mine[rows].astype(kind), axis=1, kind="stable"), axis=1)
        node, bin = mine[rows], block.bins[rows, np.arange(features)[:, None]]
        first = np.ones((features, n), bool)
        first[:, 1:] = (node[:, 1:] != node[:, :-1]) | (bin[:, 1:] != bin[:, :-1])
        starts = np.flatnonzero(first)
        flat = rows.ravel()
        out = np.empty((6, len(starts)))
        out[0], out[1], out[2] = node.ravel()[starts], starts // n, bin.ravel()[starts]
        out[3], out[4] = (np.add.reduceat(v[flat], starts) for v in (g, h))
        out[5] = np.diff(np.r_[starts, features * n])
        return out.T

    @staticmethod
    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        both = np.concatenate([a, b])
        order = np.lexsort((both[:, 2], both[:, 0], both[:, 1]))
        both = both[order]
        starts = np.flatnonzero(np.r_[True, (both[1:, :3] != both[:-1, :3]).any(axis=1)][: len(both)])
        return np.c_[both[starts, :3], np.add.reduceat(both[:, 3:], starts, axis=0)] if len(both) else both


#: Up to which uniform number a row is drawn 0, 1, 2, ... times: the Poisson distribution of mean 1.
POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1.0, 16.0)]))


# --- growing ------------------------------------------------------------------------------------------


@dataclass
class Best:
    feature: int
    bin: int
    gain: float
    left: np.ndarray  # G, H and rows of the left side
    right: np.ndarray


def score(recipe: Recipe, g: np.ndarray, h: np.ndarray, weights: tuple[float, float]) -> np.ndarray:
    """The quality of a node; a split gains what its sides have more than the node."""
    if not recipe.forest:
        return g * g / (h + recipe.l2)
    one, zero = weights[1] * g, weights[0] * (h - g)
    return (one * one + zero * zero) / np.maximum(one + zero, 1e-300)


def best_splits(
    recipe: Recipe, cells: np.ndarray, slots: int, weights, allowed: Callable, totals: np.ndarray | None = None
) -> tuple[np.ndarray, dict[int, Best]]:
    """The sums of each slot, and the best split of those that have one.

    ``totals`` are the sums if they are known: then cells of some features may be left out.
    """
    known, totals = totals is not None, np.zeros((slots, 3)) if totals is None else totals
    if not len(cells):
        return totals, {}
    slot, feature = cells[:, 0].astype(np.int64), cells[:, 1].astype(np.int64)
    if not known:
        of_first = feature == feature[0]
        np.add.at(totals, slot[of_first], cells[of_first, 3:])
    starts = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | (feature[1:] != feature[:-1])])
    size = np.diff(np.r_[starts, len(cells)])
    sums = np.cumsum(cells[:, 3:], axis=0)
    left = sums - np.repeat(sums[starts] - cells[starts, 3:], size, axis=0)
    right = totals[slot] - left
    last = np.zeros(len(cells), bool)
    last[starts + size - 1] = True
    several = np.zeros((slots, int(feature.max()) + 1), bool)
    several[slot[starts], feature[starts]] = size > 1
    ok = ~last & allowed(several)[slot, feature]
    ok &= (left[:, 2] >= recipe.min_rows) & (right[:, 2] >= recipe.min_rows)
    ok &= (left[:, 1] >= recipe.min_hessian) & (right[:, 1] >= recipe.min_hessian)
    at = np.flatnonzero(ok)
    whole = score(recipe, totals[:, 0], totals[:, 1], weights)
    gain = score(recipe, left[at, 0], left[at, 1], weights) + score(recipe, right[at, 0], right[at, 1], weights) - whole[slot[at]]
    most = np.full(slots, 1e-9)
    np.maximum.at(most, slot[at], gain)
    hit = np.flatnonzero(gain >= most[slot[at]])
    names, first = np.unique(slot[at[hit]], return_index=True)
    found = {}
    for s, i in zip(names.tolist(), hit[first].tolist()):
        c = at[i]
        found[s] = Best(int(feature[c]), int(cells[c, 2]), float(gain[i]), left[c], right[c])
    return totals, found


@dataclass
class Growing:
    """The tree that a task grows: its rows, where they have come to, and their parts in the sums."""

    tree: tuple
    rows: np.ndarray
    at: np.ndarray
    g: np.ndarray
    h: np.ndarray


class Near:
    """Open nodes over the rows of one task: their sums and best splits, feature by feature, in the order of the rows."""

    def __init__(self, request: Cells, block: Block):
        self.block, self.slots = block, len(request.open)
        tree = (request.fit, request.recipe, request.part, request.number)
        if block.growing is None or block.growing.tree != tree or request.open == (0,):
            use, g, h = request.drawn(block)
            rows = np.flatnonzero(use)
            block.growing = Growing(tree, rows, np.zeros(len(rows), np.int32), g[rows], h[rows])
        now = block.growing
        now.at = leaf_of(block.bins[now.rows], request.tree, now.at)
        slot = request.slots()[now.at]
        active = np.flatnonzero(slot >= 0)
        self.slot, self.rows, self.g, self.h = slot[active], now.rows[active], now.g[active], now.h[active]
        if request.recipe.leaves is None:
            # Nodes that are not open now stay closed.
            block.growing = Growing(tree, self.rows, now.at[active], self.g, self.h)
        self.totals = np.stack([np.bincount(self.slot, w, self.slots) for w in (self.g, self.h, None)], axis=1)

    def best_splits(self, recipe: Recipe, weights, allowed: Callable) -> tuple[np.ndarray, dict[int, Best]]:
        if not len(self.rows):
            return self.totals, {}
        cells = [self.cells_of(j, self.slot, self.rows, self.g, self.h) for j in range(len(self.block.columns))]
        return best_splits(recipe, np.concatenate(cells), self.slots, weights, allowed)

    def cells_of(self, feature: int, slot: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The cells of one feature, each summed in the order of the rows."""
        width = self.block.widths[feature]
        cell = slot * width + self.block.columns[feature][rows]
        if self.slots * width < 1 << 16:
            cell = cell.astype(np.uint16)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        out = np.empty((6, len(first)))
        out[0], out[2] = np.divmod(cell[first], width)
        out[1], out[5] = feature, np.diff(np.r_[first, len(cell)])
        out[3], out[4] = np.add.reduceat(g[order], first), np.add.reduceat(h[order], first)
        return out.T


#: Cells up to which features of few bins are counted together.
BUNDLE = 1024
#: Rows from which a task sums boosted trees by bins, a node's sums being its parent's without its sibling's.
MANY = 20_000


class Histograms:
    """Open nodes of a boosted tree over many rows of one task: of two siblings only the smaller one's rows are summed.

    The sums are those of ``Near`` but for rounding, which may choose otherwise between splits of equal gain.
    """

    def __init__(self, request: Cells, block: Block):
        self.request, self.block = request, block

    def best_splits(self, recipe: Recipe, weights, allowed: Callable) -> tuple[np.ndarray, dict[int, Best]]:
        request, block = self.request, self.block
        features = np.flatnonzero(allowed(np.ones((1, len(block.columns)), bool))[0])
        if request.open == (0,):
            use, self.g, self.h = request.drawn(block)
            rows = np.flatnonzero(use)
            block.growing = Summed(self.g, self.h, {0: rows}, {0: self.sums(features, rows, self.g, self.h)})
        now: Summed = block.growing
        low = request.tree[2]
        parent = {side: node for node in now.rows if low[node] for side in (low[node], low[node] + 1)}
        for node in request.open:
            if node not in now.rows:
                self.split(now, parent[node], features)
        cells = np.stack([now.cells[node] for node in request.open], axis=1)
        totals = cells[:, :, 0].sum(axis=2).T if len(features) else np.zeros((len(request.open), 3))
        return totals, dense_splits(recipe, cells, totals, features, weights)

    def sums(self, features: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """G, H and rows by feature and bin."""
        g, h = g.take(rows), h.take(rows)
        out = np.zeros((3, len(features), max(self.block.widths, default=1)))
        place = {j: i for i, j in enumerate(features.tolist())}
        bundles = self.block.bundles if len(rows) >= 4 * BUNDLE else []
        for joined, widths, column in bundles:
            wanted = [(place.pop(j), axis) for axis, j in enumerate(joined) if j in place]
            if wanted:
                sums = counts(column, rows, g, h, int(np.prod(widths))).reshape(3, *widths)
                for i, axis in wanted:
                    out[:, i, : widths[axis]] = sums.sum(axis=tuple(1 + a for a in range(len(widths)) if a != axis))
        for j, i in place.items():
            width = self.block.widths[j]
            out[:, i, :width] = counts(self.block.columns[j], rows, g, h, width)
        return out

    def split(self, now: Summed, node: int, features: np.ndarray) -> None:
        """The rows and the sums of both sides of a node, which is done with."""
        feature, cut, low = (x[node] for x in self.request.tree[:3])
        low, rows, whole = int(low), now.rows.pop(node), now.cells.pop(node)
        now.rows[low], now.rows[low + 1] = parted(self.block.columns[feature], cut, rows)
        small, large = sorted((low, low + 1), key=lambda side: len(now.rows[side]))
        now.cells[small] = self.sums(features, now.rows[small], now.g, now.h)
        rest = whole - now.cells[small]
        rest[:2, rest[2] == 0] = 0.0
        now.cells[large] = rest


def counts(column: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
    """G, H and rows by the values of a column."""
    cell, out = column.take(rows).astype(np.intp), np.empty((3, size))
    out[0], out[1], out[2] = np.bincount(cell, g, size), np.bincount(cell, h, size), np.bincount(cell, minlength=size)
    return out


@dataclass
class Summed:
    """The boosted tree that a task grows: gradients and curvatures of all rows, and rows and sums of nodes not yet split."""

    g: np.ndarray
    h: np.ndarray
    rows: dict[int, np.ndarray]
    cells: dict[int, np.ndarray]


def dense_splits(recipe: Recipe, cells: np.ndarray, totals: np.ndarray, features: np.ndarray, weights) -> dict[int, Best]:
    """The best split of each slot that has one, from G, H and rows by slot, feature and bin."""
    left = np.cumsum(cells, axis=3)
    right = totals.T[:, :, None, None] - left
    ok = (cells[2] > 0) & (left[2] >= recipe.min_rows) & (right[2] >= max(1, recipe.min_rows))
    ok &= (left[1] >= recipe.min_hessian) & (right[1] >= recipe.min_hessian)
    slots, _, width = ok.shape
    at = np.flatnonzero(ok)
    gain = np.full(ok.size, -np.inf)
    l, r = left.reshape(3, -1).take(at, axis=1), right.reshape(3, -1).take(at, axis=1)
    whole = score(recipe, totals[:, 0], totals[:, 1], weights)
    gain[at] = score(recipe, l[0], l[1], weights) + score(recipe, r[0], r[1], weights) - whole.take(at // (ok.size // max(1, slots)))
    found = {}
    if not ok.size:
        return found
    gain = gain.reshape(slots, -1)
    for s, c in enumerate(gain.argmax(axis=1).tolist()):
        if gain[s, c] >= 1e-9:
            i, b = divmod(c, width)
            found[s] = Best(int(features[i]), b, float(gain[s, c]), left[:, s, i, b].copy(), right[:, s, i, b].copy())
    return found


def drawing(recipe: Recipe, number: int, features: int) -> Callable[[np.ndarray], np.ndarray]:
    """Which features a tree may use, from those that can split each node: a boosted tree draws once, a forest in every node."""
    rng = np.random.default_rng([recipe.seed, number])
    chosen = np.ones(features, bool)
    if recipe.features < 1:
        chosen[rng.permutation(features)[max(1, int(recipe.features * features)) :]] = False
    per_node = max(1, int(features**0.5)) if recipe.forest else features

    def allowed(several: np.ndarray) -> np.ndarray:
        # Of the features that can split a node a forest draws some, in every node anew.
        width = several.shape[1]
        ok = several & chosen[:width]
        if per_node >= width:
            return ok
        rank = np.where(ok, rng.random(several.shape), 2.0)
        return ok & (rank <= np.partition(rank, per_node - 1, axis=1)[:, per_node - 1 : per_node])

    return allowed


def grow(recipe: Recipe, part: int, number: int, features: int, **state) -> Generator[Cells, np.ndarray | Near | Histograms | Grown, tuple]:
    """One tree. Depth-wise all open nodes are split; best-first those of most gain, looked at ahead in one go."""
    allowed = drawing(recipe, number, features)
    tree, depth = Tree(), {0: 0}
    weights = state.get("weights", (1.0, 1.0))
    totals: dict[int, np.ndarray] = {}
    splits: dict[int, Best] = {}
    ahead: dict[int, tuple[int, int]] = {}  # nodes whose sides are looked at, but that may stay leaves

    def opened(node: int) -> list[int]:
        """Split a node; its sides that may be split again."""
        best = splits[node]
        ahead[node] = tree.split(node, best.feature, best.bin, best.gain)
        out = []
        for side, sums in zip(ahead[node], (best.left, best.right), strict=True):
            totals[side], depth[side] = sums, depth[node] + 1
            g, h, rows = sums
            may = 0 < g < h if recipe.forest else h >= 2 * recipe.min_hessian
            if may and rows >= 2 * recipe.min_rows and (recipe.depth is None or depth[side] < recipe.depth):
                out.append(side)
        return out

    def look_ahead() -> list[int]:
        """Go best first as far as it is known, then open all leaves that may still come in: their sides."""
        while True:
            left, edge, ends = recipe.leaves - 1, [n for n in (0,) if n in splits], []
            while edge and left and not ends:
                node = max(edge, key=lambda n: (splits[n].gain, -n))
                if node not in ahead:
                    ends = sorted(edge, key=lambda n: -splits[n].gain)[:left]
                    break
                edge.remove(node)
                left -= 1
                edge += [side for side in ahead[node] if side in splits]
            sides = [side for node in ends if node not in ahead for side in opened(node)]
            if sides or not ends:
                return sides

    wanted = [0]
    while wanted:
        cells = yield Cells(recipe, part, number, tree.arrays(), tuple(wanted), **state)
        if isinstance(cells, Grown):
            return cells.tree
        near = isinstance(cells, Near | Histograms)
        if recipe.forest and 0 in wanted:
            if near:
                one, both = cells.totals[0, :2]
            else:
                one, both = (cells[cells[:, 1] == cells[0, 1]][:, 3:5].sum(axis=0)) if len(cells) else (0.0, 0.0)
            weights = tuple(both / (2 * max(n, 1e-300)) for n in (both - one, one))
        if near:
            sums, found = cells.best_splits(recipe, weights, allowed)
        else:
            sums, found = best_splits(recipe, cells, len(wanted), weights, allowed)
        for s, node in enumerate(wanted):
            totals[node] = sums[s]
            if s in found:
                splits[node] = found[s]
        if recipe.leaves is None:
            wanted = [side for node in wanted if node in splits for side in opened(node)]
            continue
        wanted = look_ahead()
    kept = best_first(recipe, splits, ahead) if recipe.leaves is not None else set(ahead)
    return finished(recipe, tree, kept, totals, weights)


@dataclass
class Grown:
    """The whole tree that was asked for, as the tasks of a forest answer."""

    tree: tuple


#: Bits of each of three whole numbers in one: drawn rows of class 1, drawn rows, rows.
PACK = 21
#: Times a node was drawn (at most 16) and its class in six bits, as those three numbers.
PACKED = np.array([((i >> 1) * (i & 1)) + ((i >> 1) << PACK) + (1 << 2 * PACK) for i in range(64)], np.int64)
#: Bits of a whole number that a double holds.
EXACT = 53
#: Values of a level that are looked at in one go: several drawn features of few rows.
TOGETHER = 131_072
#: Rows a node on average from which a level is counted in arrays of all bins, below it is sorted.
DENSE = 512


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and how long they are."""
    first = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=first[1:])
    starts = np.flatnonzero(first)
    sizes = np.empty_like(starts)
    np.subtract(starts[1:], starts[:-1], out=sizes[:-1])
    sizes[-1:] = len(x) - starts[-1:]
    return starts, sizes


class Level:
    """The rows of a forest's open nodes, node by node: their bins in words of eight bytes, how often drawn, their class.

    Sums of a forest are whole numbers, so the order of the rows does not matter.
    """

    def __init__(self, words: np.ndarray, paid: np.ndarray, sizes: np.ndarray, kind: np.dtype):
        self.words, self.paid, self.sizes, self.kind = words, paid, sizes, kind
        self.starts = np.cumsum(sizes) - sizes
        self.slot = np.repeat(np.arange(len(sizes)), sizes)
        self.values = words.view(kind).ravel()
        self.a_word = 8 // kind.itemsize
        self.first = np.arange(len(paid)) * self.a_word

    def several(self, features: int) -> np.ndarray:
        """Which features have more than one bin in a node."""
        out = np.empty((len(self.sizes), len(self.words)), np.uint64)
        for k, word in enumerate(self.words):
            changed = np.zeros_like(word)
            np.bitwise_xor(word[1:], word[:-1], out=changed[1:])
            changed[self.starts] = 0
            out[:, k] = np.bitwise_or.reduceat(changed, self.starts)
        return out.view(self.kind)[:, :features] != 0

    def bins(self, feature: np.ndarray) -> np.ndarray:
        """The bins of all rows for a feature of each node, or for several lines of them."""
        word, place = np.divmod(feature.astype(np.int64), self.a_word)
        offset = word * (len(self.paid) * self.a_word) + place
        return self.values.take(offset.take(self.slot, axis=-1) + self.first)

    def totals(self) -> np.ndarray:
        drawn = (self.paid >> 1).astype(np.float64)
        one = drawn * (self.paid & 1)
        return np.stack([np.add.reduceat(one, self.starts), np.add.reduceat(drawn, self.starts), self.sizes.astype(np.float64)], axis=1)

    def best(self, recipe: Recipe, wanted: np.ndarray, totals: np.ndarray, weights: tuple, width: int) -> tuple[np.ndarray, ...]:
        """The best split of each node: feature (or LEAF), bin, gain, and the sums of its low side. The first of equals is taken."""
        slots = len(self.sizes)
        feature, cut, gain, low = np.full(slots, LEAF), np.zeros(slots, np.int64), np.full(slots, -np.inf), np.zeros((slots, 3))
        whole = score(recipe, totals[:, 0], totals[:, 1], weights)
        of, which = np.nonzero(wanted)
        number = np.bincount(of, minlength=slots)
        begin = np.cumsum(number) - number
        most = totals[:, 1].max()
        find = self.counted(width, most) if len(self.paid) >= DENSE * slots or most >= 1 << PACK else self.sorted()
        features, step = int(number.max(initial=0)), max(1, TOGETHER // max(1, len(self.paid)))
        for k in range(0, features, step):
            ks = np.arange(k, min(k + step, features))[:, None]
            has = (number > ks).ravel()
            tried = which.take(np.where(has, (begin + ks).ravel(), 0)).reshape(-1, slots)
            at, bin, left = find(self.bins(tried))  # at: line and node
            slot = at % slots if len(ks) > 1 else at
            right = totals.take(slot, axis=0) - left
            ok = has.take(at) & (left[:, 2] >= recipe.min_rows) & (right[:, 2] >= max(1, recipe.min_rows))
            ok &= (left[:, 1] >= recipe.min_hessian) & (right[:, 1] >= recipe.min_hessian)
            ok = np.flatnonzero(ok)
            if not len(ok):
                continue
            at, slot, bin, left, right = at.take(ok), slot.take(ok), bin.take(ok), left.take(ok, axis=0), right.take(ok, axis=0)
            found = score(recipe, left[:, 0], left[:, 1], weights) + score(recipe, right[:, 0], right[:, 1], weights) - whole.take(slot)
            starts, sizes = runs(at)
            most_of = np.maximum.reduceat(found, starts)
            hit = np.flatnonzero(found == np.repeat(most_of, sizes))
            top, place = np.full(len(has), -np.inf), np.zeros(len(has), np.int64)
            top[at.take(starts)], place[at.take(starts)] = most_of, hit.take(np.searchsorted(hit, starts))
            line = top.reshape(-1, slots).argmax(axis=0) * slots + np.arange(slots)
            most_of = top.take(line)
            s = np.flatnonzero((most_of >= 1e-9) & (most_of > gain))
            line = line.take(s)
            hit = place.take(line)
            feature[s], cut[s], gain[s], low[s] = tried.ravel().take(line), bin.take(hit), most_of.take(s), left.take(hit, axis=0)
        return feature, cut, gain, low

    def counted(self, width: int, most: float) -> Callable[[np.ndarray], tuple[np.ndarray, ...]]:
        """Line and node, bin, and the sums up to it, from arrays of all bins."""
        bits = max(1, (width - 1).bit_length())
        size, base, one = len(self.sizes) << bits, self.slot << bits, EXACT // 3
        drawn = np.arange(64) >> 1
        numbers = drawn * (np.arange(64) & 1), drawn, np.ones(64, int)
        if most < 1 << one:
            # All three numbers of a node in one that a double holds to the last bit.
            numbers = (numbers[0] + (numbers[1] << one) + (numbers[2] << 2 * one),)
        held = [n.astype(np.float64).take(self.paid) for n in numbers]

        def find(bins: np.ndarray) -> tuple[np.ndarray, ...]:
            lines = len(bins)
            cell = (base + bins + size * np.arange(lines)[:, None]).ravel()
            sums = [np.bincount(cell, h if lines == 1 else np.tile(h, lines), lines * size) for h in held]
            at = np.flatnonzero(sums[-1])
            left = [np.cumsum(x.reshape(-1, 1 << bits), axis=1).ravel().take(at) for x in sums]
            if len(left) == 1:
                whole, mask = left[0].astype(np.int64), (1 << one) - 1
                left = [whole & mask, (whole >> one) & mask, whole >> 2 * one]
            return at >> bits, at & ((1 << bits) - 1), np.stack(left, axis=1).astype(np.float64)

        return find

    def sorted(self) -> Callable[[np.ndarray], tuple[np.ndarray, ...]]:
        """The same from sorted numbers of node, bin, draws and class."""
        bits = 8 * self.kind.itemsize
        key = np.uint32 if len(self.sizes).bit_length() + bits + 6 <= 32 else np.uint64
        slots, base, mask = len(self.sizes), (self.slot.astype(key) << key(bits + 6)) | self.paid, (1 << PACK) - 1

        def find(bins: np.ndarray) -> tuple[np.ndarray, ...]:
            keys = bins.astype(key) << key(6)
            keys |= base
            keys.sort(axis=1)
            cell = keys >> key(6)
            last = np.ones(cell.shape, bool)
            np.not_equal(cell[:, 1:], cell[:, :-1], out=last[:, :-1])
            ends = np.flatnonzero(last)
            upto = np.cumsum(PACKED.take(keys & key(63))).take(ends)
            cell = cell.ravel().take(ends).astype(np.int64)
            at, bin = (cell >> bits) + slots * (ends // bins.shape[1]), cell & ((1 << bits) - 1)
            starts, sizes = runs(at)
            before = upto.take(starts - 1)
            before[0] = 0
            left = upto - np.repeat(before, sizes)
            return at, bin, np.stack([left & mask, (left >> PACK) & mask, left >> 2 * PACK], axis=1).astype(np.float64)

        return find

    def next(self, feature: np.ndarray, cut: np.ndarray, sizes: np.ndarray) -> Level:
        """The rows of the sides (node, low or high) that stay open: those with a size."""
        side = self.bins(feature) > cut.take(self.slot)
        kept = (sizes > 0).ravel().take(2 * self.slot + side)
        low, high = np.flatnonzero(kept > side), np.flatnonzero(kept & side)
        order = np.empty(len(low) + len(high), np.int64)
        order[np.arange(len(low)) + (np.cumsum(sizes[:, 1]) - sizes[:, 1]).take(self.slot.take(low))] = low
        order[np.arange(len(high)) + np.cumsum(sizes[:, 0]).take(self.slot.take(high))] = high
        words = np.empty((len(self.words), len(order)), np.uint64)
        for word, new in zip(self.words, words):
            word.take(order, out=new)
        return Level(words, self.paid.take(order), sizes[sizes > 0], self.kind)


def forest_tree(request: Cells, block: Block) -> tuple[np.ndarray, ...]:
    """A tree of a forest over the rows of one task, level by level; the same as by single requests."""
    recipe, features = request.recipe, block.bins.shape[1]
    allowed = drawing(recipe, request.number, features)
    use, one, drawn = request.drawn(block)
    rows = np.flatnonzero(use)
    kind = np.dtype(np.uint8 if max(block.widths, default=0) <= 256 else np.uint16)
    paid = (2 * drawn.take(rows) + (one.take(rows) > 0)).astype(np.uint8)
    level = Level(block.words(kind).take(rows, axis=1), paid, np.array([len(rows)]), kind)
    totals = level.totals() if len(rows) else np.zeros((1, 3))
    weights = tuple(totals[0, 1] / (2 * max(n, 1e-300)) for n in (totals[0, 1] - totals[0, 0], totals[0, 0]))
    levels, depth, at = [], 0, np.zeros(1, np.int64)
    nodes = totals
    while True:
        split = np.full(len(nodes), LEAF), np.zeros(len(nodes), np.int64), np.zeros(len(nodes)), np.zeros((len(nodes), 3))
        if len(at) and len(level.paid):
            totals = nodes.take(at, axis=0)
            feature, cut, gain, low = level.best(recipe, allowed(level.several(features)), totals, weights, max(block.widths))
            for whole, part in zip(split, (feature, cut, gain, low)):
                whole[at] = part
        levels.append((nodes, *split[:3]))
        inner = np.flatnonzero(split[0] != LEAF)
        if not len(inner):
            break
        depth += 1
        sides = np.stack([split[3].take(inner, axis=0), nodes.take(inner, axis=0) - split[3].take(inner, axis=0)], axis=1)
        opened = (sides[:, :, 0] > 0) & (sides[:, :, 0] < sides[:, :, 1]) & (sides[:, :, 2] >= 2 * recipe.min_rows)
        if recipe.depth is not None and depth >= recipe.depth:
            opened[:] = False
        sizes = np.zeros((len(at), 2), np.int64)
        sizes[feature != LEAF] = np.where(opened, sides[:, :, 2], 0)
        level = level.next(np.maximum(feature, 0), cut, sizes)
        at, nodes = np.flatnonzero(opened.ravel()), sides.reshape(-1, 3)
    return numbered(recipe, levels, weights)


def numbered(recipe: Recipe, levels: list[tuple[np.ndarray, ...]], weights: tuple) -> tuple[np.ndarray, ...]:
    """The arrays of a tree from those of its levels, with the nodes in the order of ``finished``."""
    inside = [np.flatnonzero(level[1] != LEAF) for level in levels]
    # Splits at and below each node, from the bottom up.
    below: list[np.ndarray] = []
    for level, inner in zip(reversed(levels), reversed(inside)):
        count = np.zeros(len(level[1]), np.int64)
        if len(inner):
            count[inner] = 1 + below[-1].reshape(-1, 2).sum(axis=1)
        below.append(count)
    below.reverse()
    size = 1 + 2 * int(below[0][0])
    out = tuple(np.full(size, empty, kind) for empty, kind in ((LEAF, np.int16), (0, np.int16), (0, np.int32), (0, np.int32), (0, np.float64), (0, np.float64)))
    place, before = np.zeros(1, np.int64), np.zeros(1, np.int64)  # splits that come before a node: high sides first
    for k, ((sums, feature, cut, gain), inner) in enumerate(zip(levels, inside)):
        one, zero = weights[1] * sums[:, 0], weights[0] * (sums[:, 1] - sums[:, 0])
        out[4][place] = np.where(one + zero > 0, one / np.where(one + zero > 0, one + zero, 1), 0.0)
        if not len(inner):
            break
        own, first = place.take(inner), before.take(inner)
        out[0][own], out[1][own], out[5][own] = feature.take(inner), cut.take(inner), gain.take(inner)
        out[2][own], out[3][own] = 1 + 2 * first, 2 + 2 * first
        place = np.stack([1 + 2 * first, 2 + 2 * first], axis=1).ravel()
        high = below[k + 1].reshape(-1, 2)[:, 1]
        before = np.stack([first + 1 + high, first + 1], axis=1).ravel()
    return out


def best_first(recipe: Recipe, splits: dict, ahead: dict) -> set[int]:
    kept, edge = set(), [n for n in (0,) if n in splits]
    while edge and len(kept) < recipe.leaves - 1:
        node = max(edge, key=lambda n: (splits[n].gain, -n))
        edge.remove(node)
        kept.add(node)
        edge += [side for side in ahead[node] if side in splits]
    return kept


def finished(recipe: Recipe, tree: Tree, kept: set[int], totals: dict, weights) -> tuple:
    """The tree with only the ``kept`` splits and with the values of its leaves."""
    out, place, queue = Tree(), {0: 0}, [0]
    while queue:
        node = queue.pop()
        at = place[node]
        g, h, _ = totals[node]
        if recipe.forest:
            one, zero = weights[1] * g, weights[0] * (h - g)
            out.value[at] = one / (one + zero) if one + zero > 0 else 0.0
        else:
            out.value[at] = -recipe.rate * g / (h + recipe.l2) if h + recipe.l2 > 0 else 0.0
        if node in kept:
            sides = out.split(at, tree.feature[node], tree.bin[node], tree.gain[node])
            for side, new in zip((tree.low[node], tree.high[node]), sides):
                place[side] = new
                queue.append(side)
    return out.arrays()


def fit_ensemble(
    recipe: Recipe, part: int, features: int, trees: range | None = None, share: Callable = tuple, fit: str = ""
) -> Generator:
    """Trees of a forest, or all rounds of boosting: (start margin, trees). ``share`` hands earlier trees to the tasks."""
    if recipe.forest:
        grown = []
        for number in trees if trees is not None else range(recipe.trees):
            grown.append((yield from grow(recipe, part, number, features)))
        return 0.0, grown
    zero, one = yield Classes(part)
    weights = {
        "none": (1.0, 1.0),
        "positive": (1.0, (zero / (zero + one)) / max(one / (zero + one), 1e-6)) if zero + one else (1.0, 1.0),
        "balanced": tuple((zero + one) / (2 * n) if n else 1.0 for n in (zero, one)),
    }[recipe.weight]
    start = 0.0
    if recipe.from_average and zero and one:
        start = float(np.log(weights[1] * one / (weights[0] * zero)))
    grown, old, told = [], (), 0
    for number in range(recipe.trees):
        if len(grown) - told >= 25:
            old, told = share(grown), len(grown)
        state = {"weights": weights, "start": start, "old": old, "recent": tuple(grown[told:]), "fit": fit}
        grown.append((yield from grow(recipe, part, number, features, **state)))
    return start, grown


# --- answering ----------------------------------------------------------------------------------------


def alone(block: Block | list[Block], fit: Generator):
    """Carry out a fit on the rows of one task; only a kernel machine's may come as several blocks."""
    answer, blocks = None, block if isinstance(block, list) else [block]
    while True:
        try:
            request = fit.send(answer)
        except StopIteration as end:
            return end.value
        if isinstance(request, Cells):
            answer = near(request, blocks[0])
        else:
            answer = reduce(request.merge, [request.of(b) for b in blocks])


def near(request: Cells, block: Block) -> Near | Histograms | Grown:
    """The open nodes of a tree over the rows of one task; a forest's tree is grown at once."""
    if request.recipe.forest and request.recipe.leaves is None:
        return Grown(forest_tree(request, block))
    return Histograms(request, block) if not request.recipe.forest and len(block.y) >= MANY else Near(request, block)


def together(total: Callable, fits: dict):
    """Carry out fits side by side: all their present requests are one call of ``total``."""
    done, asked = {}, {}
    answers = dict.fromkeys(fits)
    while answers:
        for name, answer in answers.items():
            try:
                asked[name] = fits[name].send(answer)
            except StopIteration as end:
                done[name] = end.value
                asked.pop(name, None)
        answers = dict(zip(asked, total(list(asked.values())), strict=True)) if asked else {}
    return done


class Ensemble:
    """A fitted ensemble on binned features."""

    def __init__(self, recipe: Recipe, start: float, trees: list[tuple], edges: list[np.ndarray]):
        self.recipe, self.start, self.trees, self.edges = recipe, start, trees, edges

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = margin_of(binned(x, self.edges), self.trees)
        if self.recipe.forest:
            return margin / max(1, len(self.trees))
        return 1 / (1 + np.exp(-(self.start + margin)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return (self.probability(x) >= 0.5).astype(np.int64)

    def gains(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each feature is split on, and what these splits gain in all."""
        count, gain = np.zeros(len(self.edges), np.int64), np.zeros(len(self.edges))
        for tree in self.trees:
            inner = tree[0] != LEAF
            np.add.at(count, tree[0][inner], 1)
            np.add.at(gain, tree[0][inner], tree[5][inner])
        return count, gain

    def splits(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each feature is split on, and the mean gain of its splits."""
        count, gain = self.gains()
        return count, gain / np.maximum(count, 1)

    def shares(self) -> np.ndarray:
        """Each feature's share in the impurity that a tree takes away, summed over the trees."""
        out = np.zeros(len(self.edges))
        for tree in self.trees:
            inner = tree[0] != LEAF
            if inner.any():
                own = np.zeros(len(self.edges))
                np.add.at(own, tree[0][inner], tree[5][inner])
                out += own / own.sum()
        return out

    def impurity(self) -> np.ndarray:
        """The mean over the trees of each feature's share in the impurity that a tree takes away; sums to 1."""
        out = self.shares()
        return out / out.sum() if out.sum() else out


# --- the kernel machine -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Moments:
    """Number, sums and sums of squares of the features of a part's rows."""

    part: int

    def of(self, block: Block) -> np.ndarray:
        x = block.x[block.use[:, self.part]]
        return np.stack([np.full(x.shape[1], float(len(x))), x.sum(axis=0), (x * x).sum(axis=0)])

    merge = staticmethod(np.add)


@dataclass(frozen=True)
class Landmarks:
    """The ``count`` rows of a part with the smallest keys: key, then features."""

    part: int
    count: int

    def of(self, block: Block) -> np.ndarray:
        use = np.flatnonzero(block.use[:, self.part])
        key = mixed(block.key[use], 77)
        use = use[np.argsort(key, kind="stable")[: self.count]]
        return np.c_[uniform(block.key[use], 77), block.x[use]]

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        both = np.concatenate([a, b])
        return both[np.argsort(both[:, 0], kind="stable")[: self.count]]


def kernel_rows(x: np.ndarray, scale: np.ndarray, gamma: float, marks: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The kernels of rows with the landmarks, and a constant; with ``lifted`` weights inner products are about the kernel."""
    a = np.nan_to_num(x / scale)
    out = np.ones((len(x), len(marks) + 1))
    away = out[:, :-1]
    np.matmul(a, marks.T, out=away)
    away *= -2
    away += (a * a).sum(axis=1)[:, None]
    away += (marks * marks).sum(axis=1)
    np.maximum(away, 0, out=away)
    away *= -gamma
    np.exp(away, out=away)
    return out


def lift(root: np.ndarray) -> np.ndarray:
    """From coordinates in which landmarks are independent, and a constant, to kernels with them."""
    out = np.zeros((root.shape[0] + 1, root.shape[1] + 1))
    out[:-1, :-1], out[-1, -1] = root, 1.0
    return out


def squares(z: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The sum of the outer squares of some rows."""
    z = z.take(np.flatnonzero(which), axis=0)
    return z.T @ z


@dataclass(frozen=True)
class Hinge:
    """Gradient, Hessian and loss of the squared hinge for each weight vector; fold k of ``folds`` leaves its rows out."""

    part: int
    map: tuple
    classes: tuple[float, float]
    weights: tuple
    folds: int

    def of(self, block: Block) -> np.ndarray:
        use = block.use[:, self.part]
        y, up = block.y[use], lift(self.map[3])
        if not self.weights:
            return np.zeros((0, up.shape[1], up.shape[1] + 1))
        z = kernel_rows(block.x[use], *self.map)
        sign, cost = np.where(y == 1, 1.0, -1.0), np.where(y == 1, self.classes[1], self.classes[0])
        fold = (mixed(block.key[use], 78) % U(max(1, self.folds))).astype(np.int64)
        short = 1 - sign[:, None] * (z @ (up @ np.stack([w for _, w in self.weights], axis=1)))
        on = short > 0
        z *= np.sqrt(cost)[:, None]
        ks = [k for k, _ in self.weights]
        kept = fold[:, None] != np.array(ks)
        slopes = z.T @ np.where(on & kept, -(np.sqrt(cost) * sign)[:, None] * short, 0.0)
        # Most rows count for most weight vectors: their squares are summed once a fold, what differs is put right.
        common = 2 * on.sum(axis=1) > len(ks)
        shared = {f: squares(z, common & (fold == f)) for f in np.unique(fold).tolist()}
        whole = sum(shared.values(), np.zeros((z.shape[1], z.shape[1])))
        out = []
        for i, k in enumerate(ks):
            h = whole - shared[k] if k in shared else whole
            h = h + squares(z, on[:, i] & ~common & kept[:, i]) - squares(z, common & ~on[:, i] & kept[:, i])
            out.append(np.c_[up.T @ h @ up, up.T @ slopes[:, i]])
        return np.stack(out)

    merge = staticmethod(np.add)


@dataclass(frozen=True)
class Platt:
    """Gradient and Hessian of a logistic fit to the margins that each row gets from the fit without its fold."""

    part: int
    map: tuple
    classes: tuple[float, float]
    weights: np.ndarray
    ab: tuple[float, float]

    def margin(self, block: Block, use: np.ndarray) -> np.ndarray:
        """The margins, which are the same in all steps of a fit."""
        known, margin = block.judged.get(self.part, (None, None))
        if known is None or not np.array_equal(known, self.weights):
            z = kernel_rows(block.x[use], *self.map)
            fold = (mixed(block.key[use], 78) % U(len(self.weights))).astype(np.int64)
            margin = np.take_along_axis(z @ (lift(self.map[3]) @ self.weights.T), fold[:, None], axis=1)[:, 0]
            block.judged[self.part] = self.weights, margin
        return margin

    def of(self, block: Block) -> np.ndarray:
        use = block.use[:, self.part]
        y, margin = block.y[use], self.margin(block, use)
        cost = np.where(y == 1, self.classes[1], self.classes[0])
        inputs = np.c_[margin, np.ones(len(margin))]
        p = 1 / (1 + np.exp(-np.clip(inputs @ np.array(self.ab), -500, 500)))
        h = (inputs * (cost * p * (1 - p))[:, None]).T @ inputs
        return np.c_[h, inputs.T @ (cost * (p - y))]

    merge = staticmethod(np.add)


def fit_kernel(part: int, c: float, landmarks: int, folds: int, steps: int) -> Generator:
    """An RBF machine on landmarks: squared hinge by Newton steps, probabilities from margins out of fold."""
    zero, one = yield Classes(part)
    classes = tuple((zero + one) / (2 * n) if n else 1.0 for n in (zero, one))
    n, total, square = yield Moments(part)
    count = max(n.max(initial=0.0), 1.0)
    spread = np.maximum(square / count - (total / count) ** 2, 0)
    scale = np.where(spread > 1e-12 * np.maximum(square / count, 1e-300), np.sqrt(spread), 1.0)
    mean = total / count / scale
    variance = float((square / count / scale**2).mean() - mean.mean() ** 2)
    gamma = 1.0 / (len(scale) * variance) if variance > 0 else 1.0
    marks = np.nan_to_num((yield Landmarks(part, landmarks))[:, 1:] / scale)
    away = (marks * marks).sum(axis=1)
    values, vectors = np.linalg.eigh(np.exp(-gamma * np.maximum(away[:, None] + away - 2 * marks @ marks.T, 0)))
    good = values > 1e-8 * max(values.max(initial=0.0), 1e-300)
    map = (scale, gamma, marks, vectors[:, good] / np.sqrt(values[good]))
    width = int(good.sum()) + 1
    ridge = np.r_[np.ones(width - 1), 1e-8]  # the constant is free
    # The last fit is on all rows.
    live = {k: np.zeros(width) for k in [*range(folds), -1]}
    fitted, taken = {}, 0
    while live and taken < steps:
        taken += 1
        answer = yield Hinge(part, map, classes, tuple(live.items()), folds)
        for (k, w), found in zip(list(live.items()), answer, strict=True):
            h, g = 2 * c * found[:, :-1] + np.diag(ridge), 2 * c * found[:, -1] + ridge * w
            step = np.linalg.solve(h, g)
            live[k] = w - step
            if np.abs(step).max(initial=0.0) <= 1e-7 * max(1.0, np.abs(w).max(initial=0.0)):
                fitted[k] = live.pop(k)
    converged = not live
    fitted |= live
    held = np.stack([fitted[k] for k in range(folds)])
    ab = np.zeros(2)
    for _ in range(50):
        found = yield Platt(part, map, classes, held, tuple(ab))
        step = np.linalg.solve(found[:, :2] + 1e-9 * np.eye(2), found[:, 2])
        ab = ab - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-10:
            break
    return Machine(map, fitted[-1], (float(ab[0]), float(ab[1])), converged)


#: Rows whose distances to the landmarks are worked on at once, so that they stay in a core's cache.
NEAR_ROWS = 64


@dataclass
class Machine:
    """A fitted kernel machine."""

    map: tuple
    weights: np.ndarray
    ab: tuple[float, float]
    converged: bool

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled rows and their squared distances to the landmarks; einsum, as its sums do not depend on other rows."""
        scale, _, marks, _ = self.map
        a = np.nan_to_num(x / scale)
        square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", marks, marks)
        return a, square - 2 * np.einsum("ij,kj->ik", a, marks)

    def margin_at(self, away: np.ndarray, pull: np.ndarray) -> np.ndarray:
        """The margins from the distances, which are overwritten; ``pull`` are the weights of the landmarks."""
        np.maximum(away, 0, out=away)
        away *= -self.map[1]
        return np.einsum("ij,j->i", np.exp(away, out=away), pull) + self.weights[-1]

    def margin(self, x: np.ndarray) -> np.ndarray:
        pull, out = self.map[3] @ self.weights[:-1], np.empty(len(x))
        for a in range(0, len(x), NEAR_ROWS):
            out[a : a + NEAR_ROWS] = self.margin_at(self.distances(x[a : a + NEAR_ROWS])[1], pull)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x) * self.ab[0] + self.ab[1], -500, 500)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return (self.margin(x) > 0).astype(np.int64)

    def predict_moved(self, x: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Iterator[np.ndarray]:
        """The predictions with one column replaced, for each column and line of values.

        Only that column's part in the distances to the landmarks changes.
        """
        scale, _, marks, root = self.map
        pull, out = root @ self.weights[:-1], np.empty((len(columns), len(x)), np.int64)
        for first in range(0, len(x), NEAR_ROWS):
            rows = slice(first, first + NEAR_ROWS)
            a, away = self.distances(x[rows])
            for k, (column, line) in enumerate(zip(columns.tolist(), values, strict=True)):
                new, old = np.nan_to_num(line[rows] / scale[column])[:, None], a[:, column][:, None]
                moved = new + old - 2 * marks[:, column]
                moved *= new - old
                moved += away
                out[k, rows] = self.margin_at(moved, pull) > 0
        yield from out
