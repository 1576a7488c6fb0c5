"""Histogram gradient boosting on Spark (M5, M6): second order with L2, or first order as ``GBTClassifier`` does it.

Features are cut into at most 255 bins
once, and a level of a tree takes one pass over the binned rows. A task adds its
rows into one histogram per (candidate, node, feature) of gradient, weight (a Hessian) and row count; the
histograms are shuffled by that key, summed as they come and searched for the best cut where they
meet. The binned rows are kept in blocks of columns, so a tree is walked and a histogram added with a few operations a block. The driver gets one row per key, a number fixed by the parameters. All candidates of a grid
grow side by side, so a grid takes as many passes as its longest candidate.

A fit of many passes over a table whose bins a task can hold goes another way (``_grown_in_place``): one task a candidate keeps the rows
and grows the trees there, so that a pass is no job and moves no rows. Of two sibling nodes the smaller one is counted, the other
one is what it leaves of the parent. The trees are the same.

``fit_boosted`` grows the trees of Spark ML's ``GBTClassifier`` (same cuts, gains, leaf values, scores and
importances): residuals ``4y / (1 + exp(2yF))`` with y = ±1, the gain of variance, leaves of weighted means, rate 1
for the first tree. Times the node's weight, the gain of variance is the gain below with λ = 0 and the row weight as Hessian.

Second-order gains are ``GL²/(HL+λ) + GR²/(HR+λ) − G²/(H+λ)``, leaf values ``−rate · G/(H+λ)``. Gradients and
Hessians are added as whole numbers (at least 2^24 steps up to 2^38 rows), so the trees depend neither on the
partitioning nor on tasks that ran twice.

In second order NULL and NaN features count as 0, as in scoring (M9), and rows without a label are not used; in first order both are an error.
"""

from __future__ import annotations

import gc
import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskweave.session import written

BINS = 255
MIN_HESSIAN = 1e-3
#: Finished trees whose values are added anew in each pass before the margins are computed again.
PENDING = 2
#: Times that margins build on those before them until they are written: each task carries the trees of all those times.
CHAIN = 4
#: Rows kept as one value; their whole-number gradients are added in doubles before they go to 64-bit sums.
BLOCK = 1 << 15
#: Bins of features that are counted together, at most.
JOINT = 256
#: Blocks of rows that one task of a pass reads, about, where there are more than one for each core.
BLOCKS_A_TASK = 64
#: Histograms that one task of a pass searches.
KEYS_A_TASK = 64
#: Passes from which a fit grows its trees in tasks that keep the rows, the most rows of such a task (50 bytes
#: each with 24 features), the deepest trees there, and the trees of one job, which is what a lost task costs at most.
LONG_FIT, MOST_IN_PLACE, DEPTH_IN_PLACE, TREES_A_JOB = 60, 1 << 23, 7, 100
#: A count of rows and one of rows of class 1 are added as one number: the second one takes the bits above these.
COUNT_BITS = 31
#: ``new XORShiftRandom(42).nextInt()``: with it ``GBTClassifier`` (seed 42) draws the rows whose values make the cuts.
CUT_SAMPLE_SEED = 444206279
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, value double, gain double"


def feature_values(features: list[str]) -> Column:
    """The features as one array of doubles without NULL and NaN."""
    zero = F.lit(0.0)
    return F.array(*[F.coalesce(F.nanvl(F.col(f"`{f}`").cast("double"), zero), zero) for f in features])


def bin_edges(df: DataFrame, features: list[str]) -> list[np.ndarray]:
    """Upper bounds of the bins of every feature: midpoints between the distinct values where there are at
    most 255, otherwise percentiles of the whole table. At most 254 numbers a feature reach the driver."""
    x = df.select(*[v.alias(f"x{i}") for i, v in enumerate([feature_values([f])[0] for f in features])])
    few = x.agg(*[F.approx_count_distinct(c).alias(c) for c in x.columns]).first()
    small = [c for c in x.columns if few[c] <= 2 * BINS]
    sets = x.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in small]).first() if small else {}
    exact = {c: np.array(sets[c]) for c in small if len(sets[c]) <= BINS}
    rest = [c for c in x.columns if c not in exact]
    grid = [i / BINS for i in range(1, BINS)]
    cuts = x.agg(*[F.percentile_approx(c, grid, 10_000).alias(c) for c in rest]).first() if rest else {}
    return [(exact[c][1:] + exact[c][:-1]) / 2 if c in exact else np.unique(cuts[c]) for c in x.columns]


def cut_points(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> np.ndarray:
    """At most ``most`` cuts of one feature as ``GBTClassifier`` sets them: middles between distinct values, all of
    them if they are few enough, else those next to equal shares of the weight. What the weights of ``values``
    lack of ``expected`` counts as zeros."""
    some = values != 0.0
    v, at = np.unique(values[some], return_inverse=True)
    if not len(v):
        return np.array([])
    w = np.bincount(at, weights=weights[some])
    zeros = expected - w.sum()
    if zeros > np.finfo(float).eps * len(at) * len(at):
        place = int(np.searchsorted(v, 0.0))
        v, w = np.insert(v, place, 0.0), np.insert(w, place, zeros)
    middles = (v[:-1] + v[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride = expected / (most + 1)
    target, before, cuts = stride, w[0], []
    for i in range(1, len(v)):
        now = before + w[i]
        if abs(before - target) < abs(now - target):
            cuts.append(middles[i - 1])
            target += stride
        before = now
    return np.array(cuts)


def boosted_edges(df: DataFrame, features: list[str], target: str, weights: dict[int, float], counts: dict[int, int]) -> list[np.ndarray]:
    """The cuts that ``GBTClassifier`` sets with 255 bins and seed 42. As there, a table of more than 255² rows
    gives about that many rows for them, drawn in the same way, and all rows are used for the trees."""
    n = sum(counts.values())
    share = min(1.0, BINS * BINS / n)
    rows = df.select(F.col(f"`{target}`").cast("int").alias("y"), *[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    if share < 1.0:
        drawn = rows._jdf.toJavaRDD().sample(False, share, CUT_SAMPLE_SEED)
        rows = DataFrame(df.sparkSession._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), df.sparkSession)
    expected = share * sum(weights[y] * c for y, c in counts.items())
    most = min(BINS, n) - 1

    def cuts(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        w = np.array([weights[0], weights[1]])[pdf["y"].to_numpy()]
        return pd.DataFrame({"i": [key[0]], "cuts": [cut_points(pdf["x"].to_numpy(), w, expected, most)]})

    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"x{i}").alias("x")) for i in range(len(features))]))
    values = rows.select("y", each.alias("v")).select("y", "v.i", "v.x")
    found = {r["i"]: np.array(r["cuts"]) for r in values.groupBy("i").applyInPandas(cuts, "i int, cuts array<double>").collect()}
    return [found[i] for i in range(len(features))]


@dataclass(frozen=True)
class Steps:
    """What rows add to histograms: gradients in whole numbers of ``unit``, and Hessians in such, or (first order)
    the rows of class 1, whose weights follow from the counts."""

    weights: tuple[float, float]
    unit: float
    newton: bool

    def of(self, margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = np.array(self.weights)[y]
        if self.newton:
            p = 1.0 / (1.0 + np.exp(-margin))
            return np.rint(w * (p - y) / self.unit), np.rint(w * p * (1.0 - p) / self.unit)
        sign = y * 2.0 - 1.0
        with np.errstate(over="ignore"):
            return np.rint(w * (-4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))) / self.unit), y

    def weight(self, h, n):
        return h * self.unit if self.newton else (n - h) * self.weights[0] + h * self.weights[1]


@dataclass
class Tree:
    """Nodes in the order of their numbers; the right child follows the left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> int:
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, len(self.left), gain
        for col, empty in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.value, 0.0), (self.gain, 0.0)):
            col.extend([empty, empty])
        return self.left[node]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(c) for c in (self.feature, self.cut, self.left, self.value))


def walk(columns: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The node every row ends in: left where the feature is at most the cut. ``columns`` has one line per
    feature; children come after their parent, so one look at each inner node, over all rows at once, is enough."""
    node = np.zeros(columns.shape[1], np.uint8 if len(left) <= 256 else np.int64)
    for j in np.flatnonzero(feature >= 0):
        step, here = columns[feature[j]] > cut[j], node == j
        # Bytes are taken as they are, without a copy.
        step, here = (a.view(np.uint8) if node.dtype == np.uint8 else a.astype(node.dtype) for a in (step, here))
        step += node.dtype.type(left[j] - j)
        step *= here
        node += step
    return node


def joint_groups(n_bins: list[int]) -> list[list[int]]:
    """The features in groups of at most ``JOINT`` combinations of bins (or one feature). One histogram over the
    combinations holds those of all features of a group, so the rows are counted once for all of them."""
    groups: list[list[int]] = []
    for f in sorted(range(len(n_bins)), key=lambda f: -n_bins[f]):
        fits = next((g for g in groups if n_bins[f] * int(np.prod([n_bins[i] for i in g])) <= JOINT), None)
        if fits is None:
            groups.append([f])
        else:
            fits.append(f)
    return groups


def joint_lines(bins: np.ndarray, groups: list[list[int]], n_bins: list[int]) -> np.ndarray:
    """For every group of several features, the place of each row's bins among their combinations."""
    lines = [np.ravel_multi_index([bins[f] for f in g], [n_bins[f] for f in g]) for g in groups if len(g) > 1]
    return np.stack(lines).astype(np.uint8) if lines else np.zeros((0, bins.shape[1]), np.uint8)


def of_each(hist: np.ndarray, group: list[int], n_bins: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(feature, its histograms) from the histograms (any, [g, h, n], combination) of a group."""
    sizes = [n_bins[f] for f in group]
    cells = hist[:, :, : int(np.prod(sizes))].reshape(len(hist), 3, *sizes)
    for i, f in enumerate(group):
        one = cells.sum(axis=tuple(2 + k for k in range(len(group)) if k != i))
        yield f, one if sizes[i] > 1 else np.pad(one, ((0, 0), (0, 0), (0, 1)))


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def bin_type(edges: list[np.ndarray]) -> type:
    """Bytes where they hold all bins. Cuts from drawn rows may be some more than 254."""
    return np.uint8 if max(map(len, edges), default=0) < 256 else np.uint16


def binned(df: DataFrame, features: list[str], target: str, edges: list[np.ndarray], block: int = BLOCK) -> DataFrame:
    """(bins, y): up to ``block`` rows of the input in one row, a line of bytes (or ``bin_type``) per feature, and the labels 0 and 1."""
    kind = bin_type(edges)

    def packed(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([_binary(rows[None, :-1]), _binary(rows[None, -1].astype(np.uint8))], names=["bins", "y"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((len(edges) + 1, 0), kind)
        for b in batches:
            if not len(b):
                continue
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(b), len(edges))
            lines = [np.searchsorted(e, x[:, i]).astype(kind) for i, e in enumerate(edges)]
            y = b.column(1).to_numpy(zero_copy_only=False).astype(kind)
            rest = np.concatenate([rest, np.stack([*lines, y])], axis=1)
            while rest.shape[1] >= block:
                yield packed(rest[:, :block])
                rest = rest[:, block:]
        if rest.shape[1]:
            yield packed(rest)

    rows = df.where(F.col(f"`{target}`").cast("int").isNotNull())
    rows = rows.select(feature_values(features).alias("x"), F.col(f"`{target}`").cast("int").alias("y"))
    return rows.mapInArrow(cut, "bins binary, y binary")


def with_margins(rows: RDD, trees: list[list[tuple]]) -> RDD:
    """(bins, joint lines, y, margins) blocks with a line of margins for every candidate, to which its ``trees`` are added."""

    def add(block: tuple) -> tuple:
        bins, joint, y, margins = block
        margins = margins.copy()
        for m, grown in enumerate(trees):
            for feature, cut, left, value in grown:
                margins[m] += value[walk(bins, feature, cut, left)]
        return bins, joint, y, margins

    return rows.map(add, preservesPartitioning=True)


_lean = False


def lean_worker() -> None:
    """Leaves what a Python worker has imported out of the garbage collection that Spark has it do after every
    task. The next task of the worker waits for it, which is long beside a short pass."""
    global _lean
    if not _lean:
        gc.collect()
        gc.freeze()
        _lean = True


def _add_histograms(acc: np.ndarray, bins: np.ndarray, ones: list[np.ndarray | None], slot: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
    """Add rows to ``acc`` (slot, feature, [g, h, n], bin); rows of slot −1 count for none. Where a feature
    has two bins, ``ones`` holds its rows in the second one, and the first one gets what they leave of the slot.
    An ``h`` of bytes (0 or 1) is counted in one go with the rows."""
    slots, width = acc.shape[0], acc.shape[3]
    slot = np.where(slot < 0, slots, slot)
    start = slot * width
    packed = h.dtype == np.uint8
    adds = (g, h * float(1 << COUNT_BITS) + 1.0) if packed else (g, h, None)

    def summed(at: np.ndarray, cells: int, rows: np.ndarray | None = None) -> list[np.ndarray]:
        found = [np.bincount(at, weights=w if w is None or rows is None else w[rows], minlength=cells + 1)[:cells].astype(np.int64) for w in adds]
        return [found[0], found[1] >> COUNT_BITS, found[1] & ((1 << COUNT_BITS) - 1)] if packed else found

    sums = summed(slot, slots) if any(rows is not None for rows in ones) else []
    for f, rows in enumerate(ones):
        if rows is None:
            for i, found in enumerate(summed(start + bins[f], slots * width)):
                acc[:, f, i] += found.reshape(slots, width)
        else:
            for i, found in enumerate(summed(slot[rows], slots, rows)):
                acc[:, f, i, 1] += found
                acc[:, f, i, 0] += sums[i] - found


def best_cuts(hist: np.ndarray, steps: Steps, l2: np.ndarray, min_leaf: np.ndarray) -> list[tuple]:
    """(g, h, n, gain, cut, gl, hl, nl) of every node and feature in ``hist`` (node and feature, [g, h, n], bin);
    cut −1 where none gains; of equal gains the lowest bin wins."""
    total = hist.sum(axis=2)
    left = np.cumsum(hist, axis=2)[:, :, :-1]
    right = total[:, :, None] - left
    gl, gr, g = left[:, 0] * steps.unit, right[:, 0] * steps.unit, total[:, 0] * steps.unit
    hl, hr, h = (steps.weight(s[:, 1], s[:, 2]) for s in (left, right, total))
    ok = (left[:, 2] >= min_leaf[:, None]) & (right[:, 2] >= min_leaf[:, None]) & (hl >= MIN_HESSIAN) & (hr >= MIN_HESSIAN)
    more = l2[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, gl * gl / (hl + more) + gr * gr / (hr + more) - (g * g / (h + l2))[:, None], -np.inf)
    cut = np.argmax(gain, axis=1)
    gain = gain[np.arange(len(cut)), cut]
    at = left[np.arange(len(cut)), :, cut]
    # A node of equal residuals gains nothing but rounding.
    none = ~(gain > (0.0 if steps.newton else 1e-13 * g * g / h))
    gain[none], cut[none], at[none] = 0.0, -1, 0
    return list(zip(*total.T.tolist(), gain.tolist(), cut.tolist(), *at.T.tolist()))


def level_splits(rows: RDD, n_bins: list[int], steps: Steps, state: list[dict]) -> list[tuple]:
    """(key, best cut) of every (candidate, open node, feature), from one pass over the rows with ``n_bins`` bins by feature."""
    n_features, groups = len(n_bins), joint_groups(n_bins)
    width = max(2, *[int(np.prod([n_bins[f] for f in g])) for g in groups])
    first = np.cumsum([0] + [s["slots"] for s in state])
    keys = int(first[-1]) * len(groups)
    # Few keys, a number fixed by the parameters, so few tasks: each pass is a job of its own.
    tasks = max(1, min(rows.context.defaultParallelism, keys // KEYS_A_TASK)) if rows.getNumPartitions() > 1 else 1

    def histograms(blocks: Iterator[tuple]) -> Iterator[tuple]:
        lean_worker()
        acc = np.zeros((int(first[-1]), len(groups), 3, width), np.int64)
        for bins, joint, y, margins in blocks:
            several = iter(joint)
            lines = [next(several) if len(g) > 1 else bins[g[0]] for g in groups]
            for s, at in zip(state, first):
                margin = margins[s["candidate"]].copy()
                for feature, cut, left, value in s["pending"]:
                    margin += value[walk(bins, feature, cut, left)]
                slot = s["slot"][walk(bins, *s["tree"][:3])]
                _add_histograms(acc[at : at + s["slots"]], lines, [None] * len(lines), slot, *steps.of(margin, y))
        flat = acc.reshape(-1, 3, width)
        for part in range(tasks):
            yield part, flat[part::tasks]

    def search(parts: Iterator[tuple]) -> Iterator[list[tuple]]:
        lean_worker()
        hist = None
        for part, more in parts:
            hist = more if hist is None else hist + more
        if hist is None:
            return
        slot, place = divmod(np.arange(part, keys, tasks), len(groups))
        owner = np.searchsorted(first, slot, side="right") - 1
        l2, least = (np.array([s[c] for s in state])[owner] for c in ("l2", "min_leaf"))
        for i in np.unique(place):
            at = place == i
            for f, one in of_each(hist[at], groups[i], n_bins):
                found = best_cuts(one, steps, l2[at], least[at])
                yield [(int(k) * n_features + f, *cut) for k, cut in zip(slot[at], found) if cut[2]]

    found = rows.mapPartitions(histograms)
    if rows.getNumPartitions() > 1:
        found = found.partitionBy(tasks, int)
    return [r for part in found.mapPartitions(search).collect() for r in part]


class _Candidate:
    """Trees of one parameter set; the tree in growth and its open nodes."""

    def __init__(self, params: dict, steps: Steps):
        self.params, self.steps = params, steps
        self.l2 = params["l2_regularization"] if steps.newton else 0.0
        self.trees: list[Tree] = []
        self.settled = 0  # trees that the margins hold already
        self._plant()

    def _plant(self) -> None:
        self.tree, self.open, self.depth = Tree(), [0], 0

    @property
    def finished(self) -> bool:
        return len(self.trees) >= self.params["max_iter"]

    def state(self, candidate: int) -> dict:
        slot = np.full(len(self.tree.left), -1)
        slot[self.open] = np.arange(len(self.open))
        return {
            "candidate": candidate, "slots": len(self.open), "slot": slot,
            "tree": self.tree.arrays(), "pending": [t.arrays() for t in self.trees[self.settled :]],
            "l2": self.l2, "min_leaf": self.params["min_samples_leaf"],
        }

    def _value(self, g: int, h: int, n: int) -> float:
        below = self.steps.weight(h, n) + self.l2
        # In first order the labels themselves, half the first residuals, make the first tree, and its rate is 1.
        rate = self.params["learning_rate"] if self.steps.newton or self.trees else 0.5
        return -rate * (g * self.steps.unit) / below if below > 0 else 0.0

    @staticmethod
    def chosen(cuts: list) -> tuple:
        return max(cuts, key=lambda fr: (fr[1][4] >= 0, fr[1][3], -fr[0]))

    def grow(self, found: dict[int, list]) -> None:
        """``found`` maps an open node's place to its (feature, cut) pairs; of equal gains the first feature wins."""
        least, deepest = self.params["min_samples_leaf"], self.params["max_depth"]
        then = []
        for i, node in enumerate(self.open):
            feature, (g, h, n, gain, cut, gl, hl, nl) = self.chosen(found[i])
            if cut < 0:
                self.tree.value[node] = self._value(g, h, n)
                continue
            left = self.tree.split(node, feature, cut, gain if self.steps.newton or self.trees else gain / 4)
            for child, sums in zip((left, left + 1), ((gl, hl, nl), (g - gl, h - hl, n - nl))):
                self.tree.value[child] = self._value(*sums)
                if self.depth + 1 < deepest and sums[2] >= 2 * least and self.steps.weight(*sums[1:]) >= 2 * MIN_HESSIAN:
                    then.append(child)
        self.open, self.depth = then, self.depth + 1
        if not then:
            self.trees.append(self.tree)
            self._plant()


class _Rows:
    """Blocks of rows that a task keeps, each with its margins and its places in the tree in growth."""

    def __init__(self, parts: Iterator[tuple[np.ndarray, np.ndarray]], n_bins: list[int], groups: list[list[int]], base: float):
        self.n_bins, self.groups, self.blocks = n_bins, groups, []
        self.sizes = [int(np.prod([n_bins[f] for f in g])) for g in groups]
        self.first = np.cumsum([0, *self.sizes])
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for bins, y in parts:
            held.append((bins, y))
            if sum(len(y) for _, y in held) >= BLOCK:
                held = self._keep(held, base)
        if held:
            self._keep(held, base)

    def _keep(self, held: list[tuple], base: float) -> list:
        bins, y = np.concatenate([b for b, _ in held], axis=1), np.concatenate([y for _, y in held])
        several = iter(joint_lines(bins, self.groups, self.n_bins))
        lines = [next(several) if len(g) > 1 else bins[g[0]] for g in self.groups]
        self.blocks.append({"bins": bins, "lines": lines, "y": y, "margin": np.full(len(y), base), "node": np.zeros(len(y), np.uint8)})
        return []

    def add(self, tree: tuple) -> None:
        """The tree's values are added to the margins."""
        feature, cut, left, value = tree
        for b in self.blocks:
            b["margin"] += value[walk(b["bins"], feature, cut, left)]

    def plant(self, steps: Steps) -> None:
        for b in self.blocks:
            b["g"], b["h"] = steps.of(b["margin"], b["y"])
            b["node"][:] = 0

    def step(self, tree: Tree, nodes: list[int]) -> None:
        """The rows of the ``nodes`` that were split move on to the children."""
        for b in self.blocks:
            for j in nodes:
                if tree.feature[j] >= 0:
                    there = (b["bins"][tree.feature[j]] > tree.cut[j]).view(np.uint8)
                    there += np.uint8(tree.left[j] - j)
                    there *= (b["node"] == j).view(np.uint8)
                    b["node"] += there

    def settle(self, tree: Tree) -> None:
        value = np.array(tree.value)
        for b in self.blocks:
            b["margin"] += value[b["node"]]

    def histograms(self, nodes: list[int], known: np.ndarray | None) -> np.ndarray:
        """(node, [g, h, n], bin of all groups) of the ``nodes``; ``known``: the last two of the root, where they don't change."""
        acc = np.zeros((len(nodes), 3, int(self.first[-1])), np.int64)
        if known is not None:
            acc[0, 1:] = known
        place = np.full(256, -1, np.int8 if len(nodes) < 128 else np.int16)
        place[nodes] = np.arange(len(nodes))
        for b in self.blocks:
            rows = None
            if nodes != [0]:
                slot = place[b["node"]]
                rows = np.flatnonzero(slot >= 0)
                if not len(rows):
                    continue
                slot = slot[rows].astype(np.int64)
            g, h = (b["g"], b["h"]) if rows is None else (b["g"][rows], b["h"][rows])
            packed = h.dtype == np.uint8
            adds = (g,) if known is not None else (g, h * float(1 << COUNT_BITS) + 1.0) if packed else (g, h, None)
            for line, size, at in zip(b["lines"], self.sizes, self.first):
                cell = line.astype(np.int64) if rows is None else line[rows] + slot * size
                found = [np.bincount(cell, weights=w, minlength=len(nodes) * size).reshape(len(nodes), size).astype(np.int64) for w in adds]
                if len(found) == 2:
                    found = [found[0], found[1] >> COUNT_BITS, found[1] & ((1 << COUNT_BITS) - 1)]
                for i, sums in enumerate(found):
                    acc[:, i, at : at + size] += sums
        return acc


def _found(hist: np.ndarray, rows: _Rows, steps: Steps, l2: float, least: int) -> dict[int, list]:
    """The best cut of every node in ``hist`` (node, [g, h, n], bin of all groups) and feature, by the node's place."""
    of: dict[int, np.ndarray] = {}
    for group, size, at in zip(rows.groups, rows.sizes, rows.first):
        of.update(of_each(hist[:, :, at : at + size], group, rows.n_bins))
    out: dict[int, list] = {i: [] for i in range(len(hist))}
    narrow = [f for f in of if of[f].shape[2] <= 32]
    for features in (narrow, [f for f in of if f not in narrow]):
        if not features:
            continue
        width = max(of[f].shape[2] for f in features)
        # Bins that a feature doesn't have are empty, and a cut before them leaves nothing on the right.
        both = np.zeros((len(features), len(hist), 3, width), np.int64)
        for i, f in enumerate(features):
            both[i, :, :, : of[f].shape[2]] = of[f]
        keys = len(features) * len(hist)
        cuts = best_cuts(both.reshape(keys, 3, width), steps, np.full(keys, l2), np.full(keys, least))
        for k, cut in enumerate(cuts):
            if cut[2]:
                out[k % len(hist)].append((features[k // len(hist)], cut))
    return out


def _grow_here(rows: _Rows, c: _Candidate, trees: int) -> None:
    """``c`` gets ``trees`` more trees, or all it lacks."""
    for t in c.trees:
        rows.add(t.arrays())
    wanted, counts = min(c.params["max_iter"], len(c.trees) + trees), None
    while len(c.trees) < wanted:
        rows.plant(c.steps)
        hists: dict[int, np.ndarray] = {}
        smaller: dict[int, tuple[int, int]] = {}  # the nodes to count: (sibling, parent)
        done = len(c.trees)
        while len(c.trees) == done:
            tree, opened = c.tree, c.open
            if opened == [0]:
                own = rows.histograms([0], counts)
                if not c.steps.newton:
                    counts = own[0, 1:]
                hists = {0: own[0]}
            else:
                counted = sorted(smaller)
                now = dict(zip(counted, rows.histograms(counted, None)))
                now.update({other: hists[parent] - now[node] for node, (other, parent) in smaller.items()})
                hists = now
            found = _found(np.stack([hists[j] for j in opened]), rows, c.steps, c.l2, c.params["min_samples_leaf"])
            best = {j: c.chosen(found[i]) for i, j in enumerate(opened)}
            c.grow(found)
            rows.step(tree, opened)
            smaller = {}
            for j, (_, (_, _, n, _, _, _, _, nl)) in best.items():
                left = tree.left[j]
                if tree.feature[j] >= 0 and (left in c.open or left + 1 in c.open) and len(c.trees) == done:
                    a, b = (left, left + 1) if 2 * nl <= n else (left + 1, left)
                    smaller[a] = (b, j)
        rows.settle(tree)


def kept_in_place(n: int, grid: list[dict]) -> bool:
    """Whether one task keeps the ``n`` rows for each candidate; a fit of few passes, deep trees or more rows goes pass by pass."""
    long = max(p["max_iter"] * p["max_depth"] for p in grid) >= LONG_FIT
    return long and max(p["max_depth"] for p in grid) <= DEPTH_IN_PLACE and n <= MOST_IN_PLACE


def _grown_in_place(table: DataFrame, n_bins: list[int], kind: type, grown: list[_Candidate], base: float) -> None:
    """All trees of the candidates, each from tasks of its own that keep all rows; the candidates grow at the same time."""
    rows = table.repartition(1).rdd
    groups, n_features = joint_groups(n_bins), len(n_bins)

    def fit(i: int) -> None:
        while not grown[i].finished:
            c = grown[i]

            def here(part: Iterator) -> Iterator[list[Tree]]:
                lean_worker()
                before = len(c.trees)
                parts = ((np.frombuffer(r["bins"], kind).reshape(n_features, -1), np.frombuffer(r["y"], np.uint8)) for r in part)
                _grow_here(_Rows(parts, n_bins, groups, base), c, TREES_A_JOB)
                yield c.trees[before:]

            c.trees.extend(rows.mapPartitions(here).first())

    with ThreadPoolExecutor(len(grown)) as pool:
        list(pool.map(inheritable_thread_target(table.sparkSession)(fit), range(len(grown))))


@dataclass
class HistModel:
    """A fitted model: base margin and trees with thresholds on the raw features."""

    features: list[str]
    base: float
    trees: list[dict]  # feature, threshold, left, value, gain: one list each
    newton: bool = True

    def _coded(self) -> tuple[list[np.ndarray], list[tuple]]:
        """The thresholds of every feature in order, and the trees with places among them as cuts."""
        seen: list[set] = [set() for _ in self.features]
        for t in self.trees:
            for f, v in zip(t["feature"], t["threshold"]):
                if f >= 0:
                    seen[f].add(v)
        edges = [np.array(sorted(s)) for s in seen]
        cuts = [[int(np.searchsorted(edges[f], v)) if f >= 0 else 0 for f, v in zip(t["feature"], t["threshold"])] for t in self.trees]
        return edges, [(np.array(t["feature"]), np.array(c), np.array(t["left"]), np.array(t["value"])) for t, c in zip(self.trees, cuts)]

    def probability(self, features: list[str] | None = None) -> Column:
        """P(class 1) of the feature columns, as one Arrow-batched expression. First order: NaN lies above every threshold."""
        base, newton = self.base, self.newton
        edges, trees = self._coded()
        kind = np.uint8 if max(map(len, edges), default=0) < 256 else np.int64

        @pandas_udf("double")
        def score(*x: pd.Series) -> pd.Series:
            codes = np.stack([np.searchsorted(e, v.to_numpy()).astype(kind) for e, v in zip(edges, x)])
            margin = np.full(codes.shape[1], base)
            for tree, cut, left, value in trees:
                margin += value[walk(codes, tree, cut, left)]
            with np.errstate(over="ignore"):
                return pd.Series(1.0 / (1.0 + np.exp(-margin)) if newton else 1.0 - 1.0 / (1.0 + np.exp(2.0 * margin)))

        zero, columns = F.lit(0.0), [F.col(f"`{f}`").cast("double") for f in features or self.features]
        return score(*[F.coalesce(F.nanvl(c, zero) if newton else c, zero) for c in columns])

    def importances(self) -> list[float]:
        """Share of the total gain per feature (all 0 where no tree has a cut)."""
        total = np.zeros(len(self.features))
        for t in self.trees:
            for f, gain in zip(t["feature"], t["gain"]):
                total[f] += gain if f >= 0 else 0.0
        return (total / total.sum() if total.sum() > 0 else total).tolist()

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per node, and the base margin with the feature names beside it."""
        rows = [
            (i, j, *(t[c][j] for c in ("feature", "threshold", "left", "value", "gain")))
            for i, t in enumerate(self.trees)
            for j in range(len(t["left"]))
        ]
        spark.createDataFrame(rows, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = [(json.dumps({"base": self.base, "features": self.features, "newton": self.newton}),)]
        spark.createDataFrame(head, "head string").coalesce(1).write.mode("overwrite").parquet(f"{path}/head")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HistModel:
        head = json.loads(spark.read.parquet(f"{path}/head").first()[0])
        trees: list[dict] = []
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            if r["node"] == 0:
                trees.append({c: [] for c in ("feature", "threshold", "left", "value", "gain")})
            for c in trees[-1]:
                trees[-1][c].append(r[c])
        return cls(head["features"], head["base"], trees, head["newton"])


def fit_hist(df: DataFrame, features: list[str], target: str, grid: list[dict], balanced: bool = True) -> list[HistModel]:
    """One model per parameter set, all grown in the same passes.

    ``balanced`` weighs a row by n / (classes · rows of its class) (M4). Equal gains: the lowest
    feature, then the lowest bin. A table of one class gives trees of one leaf. Labels other than 0
    and 1, or none at all, are an error.
    """
    edges = bin_edges(df, features)
    y = F.col(f"`{target}`").cast("int")
    counts = {r["y"]: r["n"] for r in df.where(y.isNotNull()).groupBy(y.alias("y")).agg(F.count(F.lit(1)).alias("n")).limit(3).collect()}
    if not counts or not set(counts) <= {0, 1}:
        raise ValueError(f"Boosting needs labels 0 and 1, got {sorted(counts)}.")
    n = sum(counts.values())
    weights = {y: n / (len(counts) * counts[y]) if balanced and y in counts else 1.0 for y in (0, 1)}
    share = sum(weights[y] * c for y, c in counts.items() if y == 1) / sum(weights[y] * c for y, c in counts.items())
    share = min(max(share, 1e-12), 1 - 1e-12)
    base = float(np.log(share / (1 - share)))
    return _grown(df, features, target, edges, grid, weights, n, base, newton=True)


def fit_boosted(df: DataFrame, features: list[str], target: str, grid: list[dict]) -> list[HistModel]:
    """One model per parameter set, the trees of ``GBTClassifier`` with 255 bins, seed 42 and balanced weights (M4),
    all grown in the same passes. Equal gains: the lowest feature, then the lowest bin. Its ``l2_regularization`` is not
    used. Labels other than 0 and 1, features without a finite value, or no rows at all are an error."""
    y = F.col(f"`{target}`").cast("int")
    cells = [F.col(f"`{f}`").cast("double") for f in features]
    odd = F.lit(False)
    for c in cells:
        odd = odd | c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    found = df.groupBy(y.alias("y")).agg(F.count(F.lit(1)).alias("n"), F.count_if(odd).alias("odd")).limit(4).collect()
    counts = {r["y"]: r["n"] for r in found}
    if not counts or not set(counts) <= {0, 1}:
        raise ValueError(f"Boosting needs labels 0 and 1, got {list(counts)}.")
    if any(r["odd"] for r in found):
        raise ValueError("Boosting needs features without NULL, NaN and infinite values.")
    n = sum(counts.values())
    if n >= 1 << COUNT_BITS:
        raise ValueError(f"Boosting counts fewer than 2^{COUNT_BITS} rows, got {n}.")
    weights = {v: n / (len(counts) * counts[v]) if v in counts else 1.0 for v in (0, 1)}
    edges = boosted_edges(df, features, target, weights, counts)
    return _grown(df, features, target, edges, grid, weights, n, 0.0, newton=False)


def _grown(df: DataFrame, features: list[str], target: str, edges: list[np.ndarray], grid: list[dict], weights: dict[int, float], n: int, base: float, newton: bool) -> list[HistModel]:
    """The passes over the binned rows until every candidate has its trees."""
    table = written(binned(df, features, target, edges), "boost-bins")
    n_bins, kind = [len(e) + 1 for e in edges], bin_type(edges)
    # |gradient| <= the largest weight (times 4 in first order): sums of n rows stay below 2^62, sums of a block below 2^53.
    unit = max(weights.values()) * (1.0 if newton else 4.0) / 2.0 ** min(36, 62 - n.bit_length())
    steps = Steps((weights[0], weights[1]), unit, newton)
    grown = [_Candidate(p, steps) for p in grid]
    n_features, candidates, groups = len(features), len(grid), joint_groups(n_bins)
    if kept_in_place(n, grid):
        _grown_in_place(table, n_bins, kind, grown, base)
        return [HistModel(list(features), base, [_raw(t, edges) for t in c.trees], newton) for c in grown]
    cores = df.sparkSession.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() > cores:
        # Files fall into parts of unlike sizes, and a few more parts than cores take each pass twice as long.
        table = table.repartition(cores * -(-n // (BLOCK * BLOCKS_A_TASK * cores)))

    def block(row) -> tuple:
        bins = np.frombuffer(row["bins"], kind).reshape(n_features, -1)
        return bins, joint_lines(bins, groups, n_bins), np.frombuffer(row["y"], np.uint8), np.full((candidates, bins.shape[1]), base)

    rows = table.rdd.map(block).persist(StorageLevel.MEMORY_AND_DISK)
    settlings, base_rows, before = 0, None, None  # base_rows: the last margins that were written; before: those that the next pass reads once more
    try:
        while not all(c.finished for c in grown):
            live = [(i, c) for i, c in enumerate(grown) if not c.finished]
            state = [c.state(i) for i, c in live]
            found = _by_node(level_splits(rows, n_bins, steps, state), state, n_features)
            if before is not None:
                before.unpersist()
                before = None
            for (_, c), nodes in zip(live, found):
                c.grow(nodes)
            if any(len(c.trees) - c.settled >= PENDING for _, c in live):
                settlings += 1
                before, rows = rows, _settle(rows, grown, settlings % CHAIN == 0)
                if rows.isCheckpointed():
                    base_rows = _replace(base_rows, rows)
    finally:
        rows.unpersist()
        if before is not None:
            before.unpersist()
        _replace(base_rows, None)
    return [HistModel(list(features), base, [_raw(t, edges) for t in c.trees], newton) for c in grown]


def _settle(old: RDD, grown: list[_Candidate], write: bool) -> RDD:
    """Margins after all finished trees, kept in memory or on disk; a lost part is computed from the bins
    or margins last written and the trees since then. The next pass computes them on its way from ``old``, which is kept until
    then. ``write``: a checkpoint for the passes to come, made at once. Candidates with all their trees need no margins."""
    trees = [[] if c.finished else [t.arrays() for t in c.trees[c.settled :]] for c in grown]
    rows = with_margins(old, trees).persist(StorageLevel.MEMORY_AND_DISK)
    if write:
        rows.checkpoint()
        rows.count()
    for c in grown:
        c.settled = len(c.trees)
    return rows


def _replace(old: RDD | None, new: RDD | None) -> RDD | None:
    """``new``, after the checkpoint of ``old``, which no later task reads, is deleted."""
    if old is not None:
        path = old.ctx._jvm.org.apache.hadoop.fs.Path(old.getCheckpointFile())
        path.getFileSystem(old.ctx._jsc.hadoopConfiguration()).delete(path, True)
    return new


def _by_node(splits: list[tuple], state: list[dict], n_features: int) -> list[dict[int, list]]:
    first = np.cumsum([0] + [s["slots"] for s in state])
    out: list[dict[int, list]] = [{} for _ in state]
    for key, *cut in splits:
        slot, feature = divmod(key, n_features)
        i = int(np.searchsorted(first, slot, side="right")) - 1
        out[i].setdefault(slot - int(first[i]), []).append((feature, cut))
    return out


def _raw(tree: Tree, edges: list[np.ndarray]) -> dict:
    threshold = [float(edges[f][c]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cut)]
    return {"feature": tree.feature, "threshold": threshold, "left": tree.left, "value": tree.value, "gain": tree.gain}
