"""A stacked classifier: four base learners and a logistic meta learner.

All fits of a call - every learner, every fold of every stack - are carried out together. A table of at most
``rows_a_task`` rows is dealt to one task per fit (a forest: per some of its trees), as a byte per value where
trees are grown; for a larger one the sums that the fits ask for are made by one Spark job per step over blocks
of rows, for all of them at once. Both ways run the same fits and give the same models.

Trees without a depth limit grow with the rows. Forests that tasks have grown therefore stay in a staged table
(``Forest``) and meet the rows that they score there; the driver holds models of bounded size.
"""

from __future__ import annotations

import pickle
import uuid
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ledgerlift.operators import trees as T
from ledgerlift.operators.split import class_counts, stratified_folds
from ledgerlift.session import stage

LEARNERS = ("rf", "gbt_depth", "gbt_leaf", "svc")


@dataclass(frozen=True)
class Sizes:
    """Model sizes. The defaults are the published ones."""

    # Published hyper-parameters.
    forest_trees: int = 400
    forest_min_leaf: int = 2
    boost_rounds: int = 500
    boost_rate: float = 0.05
    boost_subsample: float = 0.9
    boost_features: float = 0.9
    boost_l2: float = 1.0
    boost_depth: int = 6
    svc_c: float = 2.0
    meta_iterations: int = 3000
    folds: int = 5
    seed: int = 42
    # Defaults of the published learners.
    boost_leaves: int = 31
    leaf_min_rows: int = 20
    svc_folds: int = 5
    # Values are cut into as many bins; the kernel is that of as many landmarks, by Newton steps.
    max_bins: int = 255
    landmarks: int = 500
    svc_steps: int = 100
    # Rows up to which a fit is one task, rows of a block beyond, and trees that a task grows.
    rows_a_task: int = 1_000_000
    block_rows: int = 65_536
    trees_a_task: int = 50


SMALL = Sizes(
    forest_trees=10, boost_rounds=5, boost_rate=0.3, boost_depth=3, boost_leaves=8, landmarks=64,
    svc_folds=2, folds=2, max_bins=32, trees_a_task=5,
)


@dataclass
class Learner:
    """A fitted base learner: adds its probability, or its 0/1 prediction, to a table.

    ``model`` answers ``probability`` and ``predict`` for a matrix of feature values.
    """

    name: str
    model: object

    def score(self, df: DataFrame) -> DataFrame:
        return self.add_score(df, f"p_{self.name}")

    def add_score(self, df: DataFrame, column: str) -> DataFrame:
        return self._with(df, column, "probability", "double")

    def add_prediction(self, df: DataFrame, column: str) -> DataFrame:
        return self._with(df, column, "predict", "int")

    def _with(self, df: DataFrame, column: str, what: str, kind: str) -> DataFrame:
        if isinstance(self.model, Forest):
            p = self.model.score(df, column)
            return p if what == "probability" else p.withColumn(column, (F.col(column) >= 0.5).cast(kind))
        held = df.sparkSession.sparkContext.broadcast(self.model)  # a model's size does not grow with the rows scored

        @F.pandas_udf(kind)
        def answer(features: pd.Series) -> pd.Series:
            if features.empty:
                return pd.Series([], dtype=float)
            return pd.Series(getattr(held.value, what)(np.stack(features.to_numpy()).astype(float)))

        return df.withColumn(column, answer(vector_to_array("features")))


def feature_vector(columns: list[str]) -> Column:
    """The feature columns as one vector."""
    return array_to_vector(F.array(*[F.col(f"`{c}`").cast("double") for c in columns]))


def with_weights(df: DataFrame, label: str) -> DataFrame:
    """Add ``w_balanced`` and ``w_positive`` from the class counts of these rows."""
    counts = {r["class"]: r["n"] for r in class_counts(df.where(F.col(label).isin(0, 1)), label).collect()}
    total = sum(counts.values())
    rate = counts.get(1, 0) / max(total, 1)
    balanced = F.lit(1.0)
    for c, n in counts.items():
        balanced = F.when(F.col(label) == F.lit(c), F.lit(total / (len(counts) * n))).otherwise(balanced)
    positive = F.when(F.col(label) == 1, F.lit((1 - rate) / max(rate, 1e-6))).otherwise(F.lit(1.0))
    return df.withColumns({"w_balanced": balanced, "w_positive": positive})


# --- forests ---------------------------------------------------------------------------------


#: Rows that one task scores with one piece of a forest.
SCORED_ROWS = 262_144


def bin_bytes(x: np.ndarray, edges: list[np.ndarray]) -> pa.Array:
    """The bins of each row as one binary value."""
    bins = np.ascontiguousarray(T.binned(x, edges).astype(_bin_kind(edges)))
    size = bins.shape[1] * bins.itemsize
    ends = np.arange(len(bins) + 1, dtype=np.int64) * size
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bins), [None, pa.py_buffer(ends), pa.py_buffer(bins)]).cast(pa.binary())


def _bin_kind(edges: list[np.ndarray]) -> type:
    return np.uint8 if max(map(len, edges), default=0) < 256 else np.uint16


def bins_of(column: pa.ChunkedArray, edges: list[np.ndarray]) -> np.ndarray:
    """The matrix of ``bin_bytes``."""
    return np.frombuffer(b"".join(column.to_pylist()), _bin_kind(edges)).reshape(len(column), len(edges))


def with_bins(df: DataFrame, x: str, edges: list[np.ndarray]) -> DataFrame:
    """Add ``bins`` to a table with an array of feature values."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b[x].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(float)
            yield pa.RecordBatch.from_arrays([*b.columns, bin_bytes(values, edges)], [*b.schema.names, "bins"])

    return df.mapInArrow(add, StructType([*df.schema.fields, StructField("bins", BinaryType())]))


def forest_scores(rows: DataFrame, n: int, pieces: DataFrame, numbers: int, trees: int, edges: list[np.ndarray]) -> DataFrame:
    """``row, part, p``: the forests of some parts on rows with ``row, part, bins``, of which there are about ``n``.

    Each of the ``numbers`` pieces of a part meets the part's rows in buckets; sums are made in the order of the pieces.
    """
    buckets = max(1, ceil(n / SCORED_ROWS))
    keys = ["part", "piece", "bucket"]
    tasks = min(1_000, 8 * numbers * buckets)
    copies = pieces.select("part", "piece", "trees", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")).repartition(tasks, *keys)
    dealt = rows.select("row", "part", "bins", F.pmod(F.hash("row"), F.lit(buckets)).alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(numbers - 1))).alias("piece"))
    dealt = dealt.repartition(tasks, *keys)

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        margin = np.zeros(left.num_rows)
        if left.num_rows:
            bins = bins_of(left["bins"], edges)
            for held in right["trees"]:
                margin += T.margin_of(bins, pickle.loads(held.as_py()))
        return pa.table([left["row"], left["part"], left["piece"], pa.array(margin)], ["row", "part", "piece", "margin"])

    margins = dealt.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(judge, "row bigint, part int, piece int, margin double")
    whole = margins.groupBy("row", "part").agg(F.sort_array(F.collect_list(F.struct("piece", "margin"))).alias("m"))
    return whole.select("row", "part", (F.aggregate(F.col("m.margin"), F.lit(0.0), lambda a, b: a + b) / max(1, trees)).alias("p"))


@dataclass
class Forest:
    """A fitted forest whose trees are in a staged table of ``part, piece, trees``; the driver has what importances need.

    ``shares`` are each feature's parts in the impurity taken away, summed over the trees.
    """

    pieces: DataFrame
    part: int
    numbers: int
    trees: int
    edges: list[np.ndarray]
    shares: np.ndarray
    counts: np.ndarray
    gains: np.ndarray

    def score(self, df: DataFrame, column: str) -> DataFrame:
        """Add the probability to a table with a ``features`` vector, which is staged with numbered rows."""
        numbered = stage(df.withColumn("_row", F.monotonically_increasing_id()), "to-score")
        rows = numbered.select(F.col("_row").alias("row"), F.lit(self.part).alias("part"), vector_to_array("features").alias("x"))
        rows = with_bins(rows, "x", self.edges)
        found = forest_scores(rows, numbered.count(), self.own(), self.numbers, self.trees, self.edges)
        return numbered.join(found.select(F.col("row").alias("_row"), F.col("p").alias(column)), "_row").drop("_row")

    def plus(self, other: Forest) -> Forest:
        """The forest of the trees of two pieces."""
        sums = {k: getattr(self, k) + getattr(other, k) for k in ("numbers", "trees", "shares", "counts", "gains")}
        return replace(self, **sums)

    def own(self) -> DataFrame:
        return self.pieces.where(F.col("part") == self.part)

    def gathered(self, recipe: T.Recipe) -> T.Ensemble:
        """The forest in the driver's memory."""
        grown = [t for r in self.own().orderBy("piece").collect() for t in pickle.loads(r.trees)]
        return T.Ensemble(recipe, 0.0, grown, self.edges)

    def splits(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each feature is split on, and the mean gain of its splits."""
        return self.counts, self.gains / np.maximum(self.counts, 1)

    def impurity(self) -> np.ndarray:
        """The mean over the trees of each feature's share in the impurity that a tree takes away; sums to 1."""
        return self.shares / self.shares.sum() if self.shares.sum() else self.shares


# --- fits ------------------------------------------------------------------------------------


def recipes(sizes: Sizes, boost_weight: str = "positive") -> dict[str, T.Recipe]:
    """The three tree ensembles."""
    shared = {"trees": sizes.boost_rounds, "rate": sizes.boost_rate, "l2": sizes.boost_l2, "features": sizes.boost_features, "seed": sizes.seed}
    return {
        "rf": T.Recipe("rf", True, sizes.forest_trees, min_rows=sizes.forest_min_leaf, seed=sizes.seed),
        "gbt_depth": T.Recipe(
            "gbt_depth", False, depth=sizes.boost_depth, min_hessian=1.0, rows=sizes.boost_subsample, weight=boost_weight, **shared
        ),
        # Its published row subsample has no effect without a bagging frequency, so all rows are used.
        "gbt_leaf": T.Recipe(
            "gbt_leaf", False, leaves=sizes.boost_leaves, min_rows=sizes.leaf_min_rows, min_hessian=1e-3,
            from_average=True, weight="balanced", **shared,
        ),
    }


def bin_edges(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Upper edges of about equally full bins of each feature; a feature of few values has one bin a value."""
    shares = [i / bins for i in range(1, bins)]
    x = [F.when(~F.isnan(F.get("x", F.lit(j))), F.get("x", F.lit(j))) for j in range(width)]
    found = rows.agg(*[F.percentile_approx(c, shares, 100 * bins).alias(f"q{j}") for j, c in enumerate(x)]).first()
    return [np.unique(np.array(found[j] or [], float)) for j in range(width)]


def fit_all(rows: DataFrame, parts: int, width: int, sizes: Sizes, learners: tuple[str, ...], boost_weight: str = "positive") -> dict:
    """All ``learners`` on all parts: models by (name, part).

    ``rows`` has key (bigint), y (0 or 1), x (array of ``width`` doubles) and use (array of booleans: which
    parts a row belongs to).
    """
    edges = bin_edges(rows, width, sizes.max_bins)
    kinds = recipes(sizes, boost_weight)
    jobs: list[tuple[str, int, range | None]] = []
    # The longest first.
    for name in sorted(learners, key=("gbt_leaf", "gbt_depth", "rf", "svc").index):
        for part in range(parts):
            if name == "rf":
                cuts = [*range(0, sizes.forest_trees, sizes.trees_a_task), sizes.forest_trees]
                jobs += [(name, part, range(a, b)) for a, b in zip(cuts, cuts[1:])]
            else:
                jobs.append((name, part, None))
    fit = _in_tasks if rows.count() <= sizes.rows_a_task else _by_steps
    found: dict = {}
    for (name, part, _), result in zip(jobs, fit(rows, parts, width, sizes, kinds, edges, jobs), strict=True):
        if name == "rf" and (name, part) in found:
            before = found[name, part]
            result = before.plus(result) if isinstance(before, Forest) else (0.0, before[1] + result[1])
        found[name, part] = result
    models = {}
    for (name, part), result in found.items():
        if isinstance(result, Forest):
            models[name, part] = result
        elif name == "svc":
            models[name, part] = result
            if not result.converged:
                warnings.warn(f"the kernel machine has not converged in {sizes.svc_steps} steps", stacklevel=2)
        else:
            start, grown = result
            models[name, part] = T.Ensemble(kinds[name], start, grown, edges)
    return models


def _one_fit(name: str, part: int, width: int, sizes: Sizes, kinds: dict, numbers: range | None = None, **more):
    if name == "svc":
        return T.fit_kernel(part, sizes.svc_c, sizes.landmarks, sizes.svc_folds, sizes.svc_steps)
    return T.fit_ensemble(kinds[name], part, width, numbers, **more)


#: Rows whose kernels a task holds at once.
KERNEL_ROWS = 16_384


def _in_tasks(rows: DataFrame, parts: int, width: int, sizes: Sizes, kinds: dict, edges, jobs: list) -> list:
    """One task for each fit, with the rows of its part; a forest is grown by several, and its trees stay in a staged table."""
    labels = _labels(rows, len(jobs))
    of_part = [[labels[i] for i, job in enumerate(jobs) if job[1] == p] for p in range(parts)]
    number = {label: i for i, label in enumerate(labels)}
    pieces = {i: numbers.start // sizes.trees_a_task for i, (_, _, numbers) in enumerate(jobs) if numbers is not None}
    wanted = F.array(*[F.when(F.get("use", F.lit(p)), F.array(*map(F.lit, of_part[p]))).otherwise(F.array().cast("array<int>")) for p in range(parts)])
    # Values go to the kernel machines only; trees are grown from the bins.
    kernels = [label for label, job in zip(labels, jobs) if job[0] == "svc"]
    dealt = with_bins(rows.select("key", "y", "x", F.flatten(wanted).alias("jobs")), "x", edges)
    dealt = dealt.select("key", "y", "x", "bins", F.explode("jobs").alias("job"))
    of_kernel = F.col("job").isin(kernels) if kernels else F.lit(False)
    dealt = dealt.select("key", "y", "job", F.when(of_kernel, F.col("x")).alias("x"), F.when(~of_kernel, F.col("bins")).alias("bins"))
    dealt = dealt.repartition(len(jobs), "job")

    def fit(table: pa.Table) -> pa.Table:
        label = table["job"][0].as_py()
        name, part, numbers = jobs[number[label]]
        # In the order of the keys, so that the sums do not depend on that of the rows.
        table = table.sort_by("key")
        n = table.num_rows
        y, key, use = table["y"].to_numpy(), table["key"].to_numpy(), np.ones((n, 1), bool)
        if name == "svc":
            x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, width)
            cuts = [slice(a, a + KERNEL_ROWS) for a in range(0, n, KERNEL_ROWS)]
            none = np.zeros((0, 0), np.uint8)
            block = [T.Block(x[c], y[c], use[c], key[c], edges, none) for c in cuts]
        else:
            block = T.Block(None, y, use, key, edges, bins_of(table["bins"], edges))
        with np.errstate(all="ignore"):
            result = T.alone(block, _one_fit(name, 0, width, sizes, kinds, numbers))
        trees, piece = None, None
        if name == "rf":
            piece, grown = pieces[number[label]], T.Ensemble(kinds[name], 0.0, result[1], edges)
            trees, result = pickle.dumps([t[:5] for t in grown.trees]), (len(grown.trees), grown.shares(), *grown.gains())
        return pa.table({
            "job": pa.array([label], pa.int32()), "model": pa.array([pickle.dumps(result)], pa.binary()),
            "part": pa.array([part], pa.int32()), "piece": pa.array([piece], pa.int32()), "trees": pa.array([trees], pa.binary()),
        })

    fitted = stage(dealt.groupBy("job").applyInArrow(fit, "job int, model binary, part int, piece int, trees binary"), "models")
    forests = fitted.where("piece is not null").select("part", "piece", "trees")
    results = {}
    for r in fitted.select("job", "model").collect():
        result, (name, part, _) = pickle.loads(r.model), jobs[number[r.job]]
        results[number[r.job]] = Forest(forests, part, 1, result[0], edges, *result[1:]) if name == "rf" else result
    if len(results) < len(jobs):
        raise ValueError("a fold has no rows to train on")
    return [results[i] for i in range(len(jobs))]


def _labels(rows: DataFrame, n: int) -> list[int]:
    """Numbers whose hashes fall into partitions 0, 1, ..., so that each fit has a task of its own."""
    ids = rows.sparkSession.range(64 * n).select(F.col("id").cast("int").alias("id"))
    chosen = ids.groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("part")).agg(F.min("id").alias("id"))
    found = {r.part: r.id for r in chosen.collect()}
    spare = iter(range(64 * n, 65 * n))
    return [found[p] if p in found else next(spare) for p in range(n)]


_blocks: dict[tuple[str, int], T.Block] = {}


def _by_steps(rows: DataFrame, parts: int, width: int, sizes: Sizes, kinds: dict, edges, jobs: list) -> list:
    """Every step of all fits is one job over blocks of rows; blocks are staged, and read again where a task has lost them."""
    spark = rows.sparkSession
    sc = spark.sparkContext
    blocks = max(1, ceil(rows.count() / sizes.block_rows))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held).sort_by("key")
            lists = [table[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1) for c in ("x", "use")]
            packed = pickle.dumps((lists[0], table["y"].to_numpy(), lists[1], table["key"].to_numpy()))
            yield pa.RecordBatch.from_pydict({"block": pa.array([packed], pa.large_binary())})

    dealt = rows.select("key", "y", "x", "use").repartition(blocks, "key").mapInArrow(pack, "block binary")
    packed = stage(dealt, "blocks").rdd.persist(StorageLevel.MEMORY_AND_DISK)
    name = uuid.uuid4().hex
    shared_edges = sc.broadcast(edges)
    told: list = []

    def share(grown: list):
        told.append(sc.broadcast(list(grown)))
        return Held(told[-1])

    def total(requests: list) -> list:
        asked = sc.broadcast(requests)

        def answer(index: int, found) -> Iterator[list]:
            if (name, index) not in _blocks:
                for other in [k for k in _blocks if k[0] != name]:
                    del _blocks[other]
                loaded = [pickle.loads(bytes(r.block)) for r in found]
                if not loaded:
                    return
                whole = [np.concatenate(c) for c in zip(*loaded, strict=True)]
                _blocks[name, index] = T.Block(whole[0], whole[1], whole[2], whole[3], shared_edges.value)
            with np.errstate(all="ignore"):
                yield [r.of(_blocks[name, index]) for r in asked.value]

        def merge(a: list, b: list) -> list:
            return [r.merge(x, y) for r, x, y in zip(asked.value, a, b, strict=True)]

        answers = packed.mapPartitionsWithIndex(answer)
        out = answers.collect()[0] if blocks == 1 else answers.treeReduce(merge)
        asked.unpersist()
        return out

    fits = {}
    for i, (kind, part, numbers) in enumerate(jobs):
        more = {} if kind == "svc" else {"share": share, "fit": name}
        fits[i] = _one_fit(kind, part, width, sizes, kinds, numbers, **more)
    with np.errstate(all="ignore"):
        found = T.together(total, fits)
    packed.unpersist()
    return [found[i] for i in range(len(jobs))]


@dataclass(frozen=True)
class Held:
    """Earlier trees, as a broadcast."""

    broadcast: object

    @property
    def value(self) -> list:
        return self.broadcast.value


def training_rows(df: DataFrame, label: str, id: str, *columns: Column) -> DataFrame:
    """key, y and x of a table with a ``features`` vector, and more columns."""
    return df.select(
        F.xxhash64(id).alias("key"), F.col(label).cast("int").alias("y"), vector_to_array("features").alias("x"), *columns
    )


def fit_learner(df: DataFrame, label: str, id: str, name: str, sizes: Sizes = Sizes(), boost_weight: str = "positive") -> Learner:
    """One base learner on all rows of a table with a ``features`` vector."""
    return fit_learners(df, label, id, (name,), sizes, boost_weight)[name]


def fit_learners(
    df: DataFrame, label: str, id: str, names: tuple[str, ...] = LEARNERS, sizes: Sizes = Sizes(), boost_weight: str = "positive"
) -> dict[str, Learner]:
    """Base learners on all rows of a table with a ``features`` vector, fitted together."""
    rows = stage(training_rows(df, label, id, F.array(F.lit(True)).alias("use")), "train")
    first = rows.first()
    if first is None:
        raise ValueError("there are no rows to train on")
    models = fit_all(rows, 1, len(first["x"]), sizes, names, boost_weight)
    return {name: Learner(name, models[name, 0]) for name in names}


# --- the logistic meta learner ----------------------------------------------------------------


@dataclass
class Logistic:
    """Coefficients of a fitted logistic regression."""

    coefficients: list[float]
    intercept: float


def fit_logistic(rows: DataFrame, inputs: list[str], label: str, weight: str, group: str, groups: int, penalty: float = 1.0, steps: int = 100) -> list[Logistic]:
    """A weighted logistic regression with an L2 term for each group 0, 1, ...: Newton's method.

    Gradient and Hessian of all groups are one aggregate per step; only these few numbers reach the driver.
    """
    names = [F.col(c).cast("double") for c in inputs] + [F.lit(1.0)]
    n = len(names)
    beta = np.zeros((groups, n))
    ridge = np.r_[np.full(n - 1, penalty), 0.0]

    def sums(beta: np.ndarray) -> dict[int, np.ndarray]:
        held = F.array(*[F.array(*[F.lit(float(v)) for v in line]) for line in beta])
        own = F.get(held, F.col(group))
        margin = sum((F.get(own, F.lit(i)) * c for i, c in enumerate(names)), F.lit(0.0))
        judged = rows.withColumn("_p", 1 / (1 + F.exp(-margin))).withColumn("_c", F.col(weight) * F.col("_p") * (1 - F.col("_p")))
        out = judged.groupBy(group).agg(
            *[F.sum(F.col(weight) * (F.col("_p") - F.col(label)) * c).alias(f"g{i}") for i, c in enumerate(names)],
            *[F.sum(F.col("_c") * names[i] * names[j]).alias(f"h{i}_{j}") for i in range(n) for j in range(i + 1)],
            F.sum(F.col(weight) * (F.log1p(F.exp(-F.abs(margin))) + F.greatest(margin, F.lit(0.0)) - F.col(label) * margin)).alias("loss"),
        )
        found = {}
        for r in out.collect():
            h = np.array([[r[f"h{max(i, j)}_{min(i, j)}"] for j in range(n)] for i in range(n)])
            found[r[group]] = (np.array([r[f"g{i}"] for i in range(n)]), h, r["loss"])
        return found

    def total_loss(k: int, loss: float, beta: np.ndarray) -> float:
        return loss + float((ridge * beta[k] ** 2).sum()) / 2

    here = sums(beta)
    size = np.ones(groups)
    for _ in range(steps):
        move = np.zeros_like(beta)
        for k, (g, h, _) in here.items():
            move[k] = np.linalg.solve(h + np.diag(ridge) + 1e-12 * np.eye(n), g + ridge * beta[k])
        if np.abs(move).max(initial=0.0) < 1e-9:
            break
        # Halve the step of a group whose loss would rise.
        size[:] = 1.0
        while True:
            there = sums(beta - size[:, None] * move)
            worse = [k for k in here if total_loss(k, there[k][2], beta - size[:, None] * move) > total_loss(k, here[k][2], beta) + 1e-9]
            if not worse or size.min() < 1e-6:
                break
            size[worse] /= 2
        beta, here = beta - size[:, None] * move, there
    return [Logistic(line[:-1].tolist(), float(line[-1])) for line in beta]


# --- the stack ------------------------------------------------------------------------------


@dataclass
class StackModel:
    """Fitted base learners and meta learner."""

    features: list[str]
    learners: dict[str, Learner]
    meta: Logistic

    def prepare(self, df: DataFrame) -> DataFrame:
        """Add the ``features`` vector."""
        return df.withColumn("features", feature_vector(self.features))

    def score(self, df: DataFrame, column: str = "p") -> DataFrame:
        """Add the positive-class probability to a table with the feature columns."""
        return self.score_prepared(self.prepare(df), column).drop("features")

    def score_prepared(self, df: DataFrame, column: str = "p") -> DataFrame:
        scored = reduce(lambda d, learner: learner.score(d), self.learners.values(), df)
        inputs = [f"p_{name}" for name in self.learners]
        margin = F.lit(float(self.meta.intercept))
        for name, coefficient in zip(inputs, self.meta.coefficients):
            margin = margin + F.col(name) * F.lit(float(coefficient))
        return scored.withColumn(column, 1 / (1 + F.exp(-margin))).drop(*inputs)

    def weights(self) -> dict[str, float]:
        """The meta learner's coefficient of each base learner."""
        return {name: float(c) for name, c in zip(self.learners, self.meta.coefficients)}


def weight_table(spark, model: StackModel) -> DataFrame:
    """The meta weights as a table, one row per base learner."""
    return spark.createDataFrame(list(model.weights().items()), "model string, weight double")


def fit_stacks(
    df: DataFrame, features: list[str], label: str, id: str, members: list[Column], sizes: Sizes = Sizes(),
    learners: tuple[str, ...] = LEARNERS,
) -> list[StackModel]:
    """A stack on the rows of each member column: base learners per fold, the meta learner on their
    out-of-fold scores, base learners on all rows. All of it is fitted together.
    """
    flags = [f"m{s}" for s in range(len(members))]
    rows = df.select(
        F.col(id).alias("id"), F.col(label).cast("int").alias("y"), feature_vector(features).alias("features"),
        *[F.coalesce(m, F.lit(False)).alias(f) for m, f in zip(members, flags, strict=True)],
    )
    rows = stage(rows, "rows")
    # Folds are dealt within each stack; a row that is not in it has no fold there.
    for flag in flags:
        own = stratified_folds(rows.where(flag).select("id", "y"), "y", "id", sizes.folds, sizes.seed + 7)
        own = with_weights(own, "y").select("id", F.struct("fold", "w_balanced").alias(f"in_{flag}"))
        rows = rows.join(own, "id", "left")
    whole = sizes.folds + 1
    use = [(F.col(f"in_{f}.fold") != k) if k < sizes.folds else F.col(f) for f in flags for k in range(whole)]
    within = F.array(*[F.struct(F.col(f"in_{f}.fold").alias("fold"), F.col(f"in_{f}.w_balanced").alias("w")) for f in flags])
    table = training_rows(rows, "y", "id", F.array(*[F.coalesce(u, F.lit(False)) for u in use]).alias("use"), within.alias("within"))
    table = stage(table.withColumn("row", F.monotonically_increasing_id()), "train")
    models = fit_all(table, whole * len(members), len(features), sizes, learners)

    staged = [n for n in learners if isinstance(models[n, 0], Forest)]
    here = [n for n in learners if n not in staged]
    held = df.sparkSession.sparkContext.broadcast({(n, part): m for (n, part), m in models.items() if part % whole < sizes.folds and n in here})
    names = [f"p_{n}" for n in learners]

    def out_of_fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b["x"].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            fold, part = b["fold"].to_numpy(), b["stack"].to_numpy() * whole
            p = np.zeros((b.num_rows, len(here)))
            for which in np.unique(part + fold).tolist():
                at = part + fold == which
                for j, name in enumerate(here):
                    p[at, j] = held.value[name, which].probability(x[at])
            kept = ["row", "stack", "fold", "y", "w"]
            yield pa.RecordBatch.from_arrays([*[b[c] for c in kept], *[pa.array(c) for c in p.T]], [*kept, *[f"p_{n}" for n in here]])

    left_out = table.select("row", "x", "y", F.posexplode("within").alias("stack", "z")).where("z.fold is not null")
    left_out = left_out.select("row", "x", F.col("y").cast("double").alias("y"), F.col("stack"), F.col("z.fold").cast("int").alias("fold"), F.col("z.w").cast("double").alias("w"))
    schema = ", ".join(["row bigint", "stack int", "fold int", "y double", "w double", *[f"`p_{n}` double" for n in here]])
    blended = left_out.mapInArrow(out_of_fold, schema)
    for name in staged:
        forest = models[name, 0]
        rows = with_bins(left_out.select("row", (F.col("stack") * whole + F.col("fold")).cast("int").alias("part"), "x"), "x", forest.edges)
        pieces = forest.pieces.where(F.col("part") % whole < sizes.folds)
        p = forest_scores(rows, ceil(table.count() / sizes.folds), pieces, forest.numbers, forest.trees, forest.edges)
        p = p.select("row", F.floor(F.col("part") / whole).cast("int").alias("stack"), F.col("p").alias(f"p_{name}"))
        blended = blended.join(p, ["row", "stack"])
    blended = stage(blended.select("stack", "y", "w", *[f"`{n}`" for n in names]), "held-out")
    metas = fit_logistic(blended, names, "y", "w", "stack", len(members), steps=sizes.meta_iterations)
    return [
        StackModel(features, {n: Learner(n, models[n, s * whole + sizes.folds]) for n in learners}, meta) for s, meta in enumerate(metas)
    ]


def fit_stack(
    df: DataFrame, features: list[str], label: str, id: str, sizes: Sizes = Sizes(), learners: tuple = LEARNERS
) -> StackModel:
    """A stack on all rows."""
    return fit_stacks(df, features, label, id, [F.lit(True)], sizes, learners)[0]


def cross_validated_scores(
    df: DataFrame, features: list[str], label: str, id: str, sizes: Sizes = Sizes(), folds: int = 5
) -> DataFrame:
    """``id, y, fold, p``: every row scored by a stack that has not seen its fold."""
    folded = stage(stratified_folds(df, label, id, folds, sizes.seed), "folds")
    stacks = fit_stacks(folded, features, label, id, [F.col("fold") != k for k in range(folds)], sizes)
    parts = []
    for k, model in enumerate(stacks):
        scored = model.score(folded.where(F.col("fold") == k))
        parts.append(scored.select(F.col(id).alias("id"), F.col(label).alias("y"), "fold", "p"))
    return stage(reduce(DataFrame.unionByName, parts), "cross-validated")
