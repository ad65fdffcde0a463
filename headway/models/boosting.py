"""Gradient boosting on absolute error over binned features, with early stopping.

The rows stay in Spark as binned features with their prediction so far, in blocks: a block is one
row of arrays, so that a round moves and joins a few large values instead of every row. A tree
grows level by level: tasks add up gradients per node, feature and bin, one shuffle sums them, and
a task per node picks the split. A node of few rows goes to one task, which grows the rest of its
subtree alone. Leaves hold the lower median of what is left to explain. Gradients are signs, so their sums
are exact, and rows and features are sampled by seeded hashes: the same rows give the same
model, however they are partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.session import stage

#: A node with at most so many rows is grown to its leaves by one task.
SUBTREE_ROWS = 400_000
#: Rounds after which the rows are written and read back, to cut their lineage.
STAGE_EVERY = 25
#: Accuracy of the quantiles: exact up to so many different values.
ACCURACY = 10_000

#: A block: arrays of its rows, then the absolute errors of its held rows added up, and their number.
_ARRAYS = {"bins": np.uint8, "y": np.float64, "pred": np.float64, "held": np.int8, "key": np.int64}
_STATE = ", ".join(f"{n} binary" for n in _ARRAYS) + ", error double, n_held long"
_SUMS = "node int, gradient binary, n binary"
_NODES = "node int, feature int, cut int, value double, rows long"


@dataclass(frozen=True)
class TrainParams:
    """The published training settings; the last two are the usual defaults."""

    max_depth: int = 8
    eta: float = 0.08
    subsample: float = 0.8
    colsample: float = 0.8
    min_child: int = 5
    rounds: int = 800
    early_stopping: int = 50
    seed: int = 42
    bins: int = 256
    l2: float = 1.0


@dataclass(frozen=True)
class Tree:
    """Node 1 is the root, 2n and 2n + 1 are the children of n; ``feature`` is -1 at leaves.

    Rows whose bin is at most ``cut`` go left. ``value`` is what a leaf adds, before ``eta``.
    """

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node each row ends in."""
        node = np.ones(len(bins), np.int64)
        every = np.arange(len(bins))
        for _ in range(int(len(self.feature)).bit_length() - 2):
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                break
            right = bins[every, np.maximum(f, 0)] > self.cut[node]
            node = np.where(inner, 2 * node + right, node)
        return node


def empty_tree(depth: int) -> Tree:
    size = 2 ** (depth + 1)
    return Tree(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size))


@dataclass(frozen=True)
class Boosted:
    """A fitted model: cut points per feature, trees, the value to start from.

    ``errors`` has the mean absolute validation error by round, from the start value on,
    also of the rounds after the best one, whose trees are gone.
    """

    cuts: tuple[np.ndarray, ...]
    trees: tuple[Tree, ...]
    base: float
    eta: float
    errors: tuple[float, ...] = field(default=())

    def bins(self, features: np.ndarray) -> np.ndarray:
        return _binned(features, self.cuts)

    def predict(self, features: np.ndarray) -> np.ndarray:
        bins = self.bins(features)
        out = np.full(len(bins), self.base)
        for tree in self.trees:
            out += self.eta * tree.value[tree.leaves(bins)]
        return out


def _binned(features: np.ndarray, cuts: tuple[np.ndarray, ...]) -> np.ndarray:
    columns = [np.searchsorted(c, features[:, k], "left") for k, c in enumerate(cuts)]
    return np.stack(columns, axis=1).astype(np.uint8) if columns else np.zeros((len(features), 0), np.uint8)


def best_split(
    gradients: np.ndarray, counts: np.ndarray, params: TrainParams
) -> tuple[int, int] | None:
    """(feature, cut) of the largest gain over (feature, bin) sums; the first of equal ones."""
    left, n = np.cumsum(gradients, axis=1), np.cumsum(counts, axis=1)
    whole, total = left[0, -1], n[0, -1]
    right, m = whole - left, total - n
    gain = left**2 / (n + params.l2) + right**2 / (m + params.l2) - whole**2 / (total + params.l2)
    gain = np.where((n >= params.min_child) & (m >= params.min_child), gain, 0)
    at = int(np.argmax(gain))
    return divmod(at, gain.shape[1]) if gain.flat[at] > 1e-9 else None


def _median(values: np.ndarray) -> float:
    """The lower of the two in the middle, as Spark's quantiles have it."""
    return float(np.partition(values, (len(values) - 1) // 2)[(len(values) - 1) // 2])


def _sums(bins: np.ndarray, gradients: np.ndarray, params: TrainParams) -> tuple[np.ndarray, np.ndarray]:
    gradient, n = np.zeros((bins.shape[1], params.bins)), np.zeros((bins.shape[1], params.bins), np.int64)
    for k in range(bins.shape[1]):
        column = bins[:, k].astype(np.intp)
        gradient[k] = np.bincount(column, gradients, params.bins)
        n[k] = np.bincount(column, minlength=params.bins)
    return gradient, n


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The arrays of each block; ``bins`` has a row per row."""
    for b in batches:
        for k in range(b.num_rows):
            block = {n: np.frombuffer(b[n][k].as_buffer(), t) for n, t in _ARRAYS.items()}
            yield block | {"bins": block["bins"].reshape(len(block["y"]), -1)}


def _joined(column: pd.Series, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype)


def _subtree(params: TrainParams, used: np.ndarray):
    """All nodes below and including the given one, from its rows."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rest = _joined(rows["rest"], np.float64)
        bins = _joined(rows["bins"], np.uint8).reshape(len(rest), len(used))
        sign, every = np.sign(rest), np.arange(len(rest))
        out, open_ = [], [(int(key[0]), every, _sums(bins, sign, params))]
        while open_:
            node, at, sums = open_.pop()
            split = None
            if node.bit_length() <= params.max_depth and len(at) >= 2 * params.min_child:
                split = best_split(*sums, params)
            if split is None:
                out.append((node, -1, 0, _median(rest[at]), len(at)))
                continue
            out.append((node, int(used[split[0]]), split[1], 0.0, len(at)))
            right = bins[at, split[0]] > split[1]
            children = at[~right], at[right]
            # Only the smaller child's rows are added up; the other has what is left, exactly.
            fewer = int(len(children[1]) < len(children[0]))
            own = _sums(bins[children[fewer]], sign[children[fewer]], params)
            both = own, tuple(x - y for x, y in zip(sums, own, strict=True))
            open_ += [(2 * node + k, children[k], both[k != fewer]) for k in (0, 1)]
        return pd.DataFrame(out, columns=["node", "feature", "cut", "value", "rows"])

    return run


def _sampled(keys: np.ndarray, turn: int, params: TrainParams) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys.view(np.uint64) ^ (np.uint64(params.seed * 1_000_003 + turn) * np.uint64(0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return x < np.uint64(min(2**64 - 1, int(params.subsample * 2**64)))


def _at_nodes(tree: Tree, open_: list[int], turn: int, params: TrainParams, used: np.ndarray):
    """Per block: (node, used bins, what is left to explain) of its sampled training rows at open nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for block in _blocks(batches):
            keep = (block["held"] == 0) & _sampled(block["key"], turn, params)
            bins, rest = block["bins"][keep], (block["y"] - block["pred"])[keep]
            node = tree.leaves(bins)
            bins = bins[:, used]
            for k in np.intersect1d(node, open_).tolist():
                at = node == k
                yield k, bins[at], rest[at]

    return run


def _partial_sums(at_nodes, params: TrainParams):
    """(node, gradient, n) of a task's rows, both by feature and bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for k, bins, rest in at_nodes(batches):
            new = _sums(bins, np.sign(rest), params)
            sums[k] = [x + y for x, y in zip(sums[k], new, strict=True)] if k in sums else list(new)
        for k, found in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), *[pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in found]],
                names=["node", "gradient", "n"],
            )

    return run


def _parts(at_nodes):
    """A row of arrays per node and block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, bins, rest in at_nodes(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([bins.tobytes()], pa.binary()), pa.array([rest.tobytes()], pa.binary())],
                names=["node", "bins", "rest"],
            )

    return run


def _rests(at_nodes):
    """A row per row, with what is left to explain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, _, rest in at_nodes(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rest), k, np.int32)), pa.array(rest)], names=["node", "rest"]
            )

    return run


def _split_node(params: TrainParams, used: np.ndarray):
    def run(key: tuple, sums: pd.DataFrame) -> pd.DataFrame:
        gradient, n = (
            _joined(sums[c], np.int64).reshape(len(sums), len(used), params.bins).sum(axis=0) for c in ("gradient", "n")
        )
        split = best_split(gradient.astype(float), n.astype(float), params)
        left = int(n[split[0], : split[1] + 1].sum()) if split else 0
        feature, cut = (int(used[split[0]]), split[1]) if split else (-1, 0)
        return pd.DataFrame(
            [(int(key[0]), feature, cut, 0.0, left)], columns=["node", "feature", "cut", "value", "rows"]
        )

    return run


def grow_tree(state: DataFrame, rows: int, turn: int, params: TrainParams, width: int) -> Tree:
    """One tree on the sampled rows; what reaches the driver is at most one row per node."""
    chosen = np.random.default_rng([params.seed, turn]).choice(
        width, max(1, round(params.colsample * width)), replace=False
    )
    used = np.sort(chosen)
    tree = empty_tree(params.max_depth)
    large, small, leaves = ([1], [], []) if rows > SUBTREE_ROWS else ([], [1], [])
    counts = {1: rows}

    def at_nodes(nodes: list[int]):
        return _at_nodes(tree, nodes, turn, params, used)

    while large:
        sums = state.mapInArrow(_partial_sums(at_nodes(large), params), _SUMS)
        found = {r["node"]: r for r in sums.groupBy("node").applyInPandas(_split_node(params, used), _NODES).collect()}
        following = []
        for node in large:
            split = found.get(node)
            if split is None or split["feature"] < 0:
                leaves.append(node)
                continue
            tree.feature[node], tree.cut[node] = split["feature"], split["cut"]
            counts |= {2 * node: split["rows"], 2 * node + 1: counts[node] - split["rows"]}
            for child in (2 * node, 2 * node + 1):
                if counts[child] <= SUBTREE_ROWS:
                    small.append(child)
                elif child.bit_length() > params.max_depth:
                    leaves.append(child)
                else:
                    following.append(child)
        large = following
    if leaves:
        median = F.percentile_approx("rest", 0.5, ACCURACY)
        rests = state.mapInArrow(_rests(at_nodes(leaves)), "node int, rest double")
        for node, value in rests.groupBy("node").agg(median).collect():
            tree.value[node] = value
    if small:
        parts = state.mapInArrow(_parts(at_nodes(small)), "node int, bins binary, rest binary")
        for r in parts.groupBy("node").applyInPandas(_subtree(params, used), _NODES).collect():
            tree.feature[r["node"]], tree.cut[r["node"]], tree.value[r["node"]] = r["feature"], r["cut"], r["value"]
    return tree


def _block(arrays: dict[str, np.ndarray]) -> pa.RecordBatch:
    held = arrays["held"] == 1
    error = np.abs(arrays["y"] - arrays["pred"])[held].sum()
    return pa.RecordBatch.from_arrays(
        [*[pa.array([arrays[n].astype(t, copy=False).tobytes()], pa.binary()) for n, t in _ARRAYS.items()],
         pa.array([float(error)]), pa.array([int(held.sum())], pa.int64())],
        names=[*_ARRAYS, "error", "n_held"],
    )


def _advanced(tree: Tree, eta: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            yield _block(block | {"pred": block["pred"] + eta * tree.value[tree.leaves(block["bins"])]})

    return run


def _initial(cuts: tuple[np.ndarray, ...], base: float):
    """A block per Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            features = np.array(b["features"].to_pylist(), float).reshape(b.num_rows, len(cuts))
            yield _block({
                "bins": _binned(features, cuts), "y": np.asarray(b["y"]), "pred": np.full(b.num_rows, base),
                # 2: NULL, in neither part
                "held": b["held"].cast(pa.int8()).fill_null(2).to_numpy(), "key": np.asarray(b["key"]),
            })

    return run


def boost(rows: DataFrame, params: TrainParams = TrainParams()) -> Boosted:
    """Fit on ``rows(features array<double>, y double, held boolean)``.

    Rows that are ``held`` validate: boosting stops after ``early_stopping`` rounds without
    a smaller error on them, and the trees up to the best round stay. Without such rows all
    rounds are fitted. No training row gives a model that predicts 0.
    """
    rows = stage(rows.withColumn("key", F.xxhash64("features", "y")), "boosting-input")
    train = rows.where("NOT held")
    size = rows.groupBy("held").agg(F.count("*").alias("n"), F.max(F.size("features")).alias("width")).collect()
    counts = {r["held"]: r["n"] for r in size}
    width = max((r["width"] for r in size), default=0)
    if not counts.get(False) or not width:
        return Boosted(tuple(np.zeros(0) for _ in range(width)), (), 0.0, params.eta)
    at = [k / params.bins for k in range(1, params.bins)]
    found = train.agg(
        F.percentile_approx("y", 0.5, ACCURACY).alias("base"),
        *[F.percentile_approx(F.col("features")[k], at, ACCURACY).alias(f"f{k}") for k in range(width)],
    ).first()
    cuts = tuple(np.unique(np.array(found[f"f{k}"], float)) for k in range(width))
    state = stage(rows.mapInArrow(_initial(cuts, float(found["base"])), _STATE), "boosting-rows")
    trees, errors = [], []

    def error(df: DataFrame) -> float:
        return round(df.agg(F.sum("error") / F.sum("n_held")).first()[0], 9)

    validated = bool(counts.get(True))
    if validated:
        errors.append(error(state))
    for turn in range(params.rounds):
        tree = grow_tree(state, counts[False], turn, params, width)
        trees.append(tree)
        before = state
        state = before.mapInArrow(_advanced(tree, params.eta), _STATE)
        if turn % STAGE_EVERY == STAGE_EVERY - 1:
            state = stage(state, "boosting-rows")
        else:
            state = state.persist(StorageLevel.MEMORY_AND_DISK)
        if validated:
            errors.append(error(state))
            before.unpersist()
            if len(errors) - 1 - int(np.argmin(errors)) >= params.early_stopping:
                break
    state.unpersist()
    kept = int(np.argmin(errors)) if validated else len(trees)
    return Boosted(cuts, tuple(trees[:kept]), float(found["base"]), params.eta, tuple(errors))
