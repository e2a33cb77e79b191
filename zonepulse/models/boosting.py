"""Boosted trees for several classes with a joint softmax (Friedman: Greedy Function Approximation, 2001, algorithm 6).

Features are binned once. Each round grows one tree per class from the gradients of the same softmax; a level of all trees is one
job: tasks sum gradients, hessians and weights by (model, class, node, feature, bin), the tasks' sums are added by (model, class,
node), and the driver, which gets one row for each of these, chooses the splits. Rows carry their scores; trees go out with the jobs. Every
``STORE_ROUNDS`` rounds the scores are stored, so neither lineage nor work per row grows with the rounds.

Several models are grown side by side by the same jobs, each leaving one fold out: cross-validation costs the jobs of one fit.
"""

import json
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from zonepulse import rules
from zonepulse.models import metrics
from zonepulse.operators.split import KEY, stratified_folds
from zonepulse.session import materialize, tasks_for

LEVEL = rules.TARGETS[0]
BINS = 64
STORE_ROUNDS = 10
LEAST_GAIN = 1e-9
DIRECT = 8              # so many tasks' sums are added by the driver, more by a shuffle
BATCH = 1 << 14             # rows summed together
NO_FOLD = -1


@dataclass(frozen=True)
class Settings:
    """Rounds, depth, step and share of rows per round; ``leaf_rows``: least rows (by weight) of a leaf."""

    rounds: int = 100
    depth: int = 6
    step: float = 0.05
    subsample: float = 0.8
    leaf_rows: float = 1.0
    bins: int = BINS
    seed: int = rules.SEED


@dataclass
class Trees:
    """Trees of (model, class) as heaps: children of node i are 2i + 1 and 2i + 2; a leaf has feature -1."""

    feature: np.ndarray     # (models, classes, nodes)
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, models: int, classes: int, depth: int) -> "Trees":
        shape = models, classes, 2 ** (depth + 1) - 1
        return cls(np.full(shape, -1), np.zeros(shape, int), np.zeros(shape), np.zeros(shape))

    def nodes(self, binned: np.ndarray, model: int, klass: int, depth: int) -> np.ndarray:
        """Node of each row after at most ``depth`` steps."""
        at, begin, flat = np.zeros(len(binned), int), np.arange(len(binned)) * binned.shape[1], np.ascontiguousarray(binned).reshape(-1)
        feature, cut = self.feature[model, klass], self.bin[model, klass]
        for _ in range(depth):
            f = feature[at]
            at = np.where(f >= 0, 2 * at + 1 + (flat[begin + np.maximum(f, 0)] > cut[at]), at)
        return at

    def add_to(self, scores: np.ndarray, binned: np.ndarray, depth: int) -> None:
        """Adds the leaves' values to scores (rows, models, classes)."""
        for m in range(self.value.shape[0]):
            for k in range(self.value.shape[1]):
                scores[:, m, k] += self.value[m, k][self.nodes(binned, m, k, depth)]


def softmax(scores: np.ndarray) -> np.ndarray:
    shifted = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def thresholds(df: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """Ascending cuts of each column, at most ``bins - 1``: quantiles of a mergeable sketch, so one pass. A
    value goes left of a cut that is not below it."""
    shares = F.array(*(F.lit(i / bins) for i in range(1, bins)))
    row = df.agg(*(F.percentile_approx(_value(c), shares, 10_000).alias(c) for c in columns)).first()
    return [np.unique(np.array(row[c] or [], float)) for c in columns]


def _value(column: str):
    return F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(0.0)), F.lit(0.0))


def prepared(df: DataFrame, columns: list[str], cuts: list[np.ndarray], label: str, weight: str | None, key: tuple[str, ...],
             fold: str | None, start: np.ndarray) -> DataFrame:
    """(label, weight, fold, draw, bins, scores): a row's bins are one byte each, its draw decides in which rounds it takes part."""
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("weight", T.DoubleType()), T.StructField("fold", T.IntegerType()),
                           T.StructField("draw", T.LongType()), T.StructField("bins", T.BinaryType()), T.StructField("scores", T.BinaryType())])
    first = start.astype(np.float64).tobytes()

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            binned = np.empty((n, len(cuts)), np.uint8)
            for i, cut in enumerate(cuts):
                binned[:, i] = np.searchsorted(cut, batch.column(4 + i).to_numpy(zero_copy_only=False), "left")
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([r.tobytes() for r in binned], pa.binary()),
                                              pa.array([first] * n, pa.binary())], names=schema.names)

    return df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("int").alias("_label"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_weight"),
        (F.col(fold).cast("int") if fold else F.lit(NO_FOLD)).alias("_fold"), F.xxhash64(*key).alias("_draw"),
        *(_value(c).alias(c) for c in columns)).mapInArrow(run, schema)


@dataclass(frozen=True)
class _Shape:
    models: int
    classes: int
    features: int
    settings: Settings
    parts: int = 1          # tasks that read the rows


def _joined(column: pa.Array, kind: type) -> np.ndarray:
    """All bytes of a binary column without nulls, as they lie in it: no object for each row."""
    column = column.cast(pa.binary())
    if not len(column):
        return np.empty(0, kind)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind)


def _rows(batch: pa.RecordBatch, shape: _Shape, trees: list[Trees]):
    """(label, weight, fold, draw, bins, scores) with the trees since the scores were stored added."""
    label, weight, fold, draw = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
    binned = _joined(batch.column(4), np.uint8).reshape(-1, shape.features)
    scores = _joined(batch.column(5), np.float64).reshape(-1, shape.models, shape.classes).copy()
    for tree in trees:
        tree.add_to(scores, binned, shape.settings.depth)
    return label, weight, fold, draw, binned, scores


def _takes_part(draw: np.ndarray, round_: int, settings: Settings) -> np.ndarray:
    mixed = (draw.astype(np.uint64) ^ np.uint64(settings.seed * 0x9E3779B9 + round_ + 1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 < settings.subsample


SUMS = "slot int, sums binary"


def _sums(state: DataFrame, shape: _Shape, done: list[Trees], growing: Trees, round_: int, level: int) -> dict[int, np.ndarray]:
    """Sums of gradients, hessians and weights by feature and bin of each slot (model, class, node of the level). Besides, slot
    -1 - model: the loss of its rows before this round and their weight."""
    settings, width = shape.settings, 2 ** level

    def count(batches):
        size = width * settings.bins
        total = np.zeros((shape.models, shape.classes, 3, shape.features, size))
        loss = np.zeros((shape.models, 2))
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                label, weight, fold, draw, binned, scores = _rows(whole.slice(at, BATCH), shape, done)
                chance, chosen = softmax(scores), _takes_part(draw, round_, settings)
                rows, columns = np.arange(len(label)), np.ascontiguousarray(binned.T)
                for m in range(shape.models):
                    mine = fold != m
                    loss[m] += -(weight * mine * np.log(np.maximum(chance[rows, m, label], 1e-300))).sum(), (weight * mine).sum()
                    mine &= chosen
                    for k in range(shape.classes):
                        node = growing.nodes(binned, m, k, level) - (width - 1)
                        some = mine & (node >= 0)               # rows in leaves above are done
                        g = (label[some] == k) - chance[some, m, k]
                        w = weight[some]
                        first, values = node[some] * settings.bins, (w * g, w * np.abs(g) * (1 - np.abs(g)), w)
                        for f in range(shape.features):
                            place = first + columns[f, some]
                            for i, v in enumerate(values):
                                total[m, k, i, f] += np.bincount(place, weights=v, minlength=size)
        # By (model, class, node): sum, feature, bin.
        slots = total.reshape(shape.models, shape.classes, 3, shape.features, width, settings.bins).transpose(0, 1, 4, 2, 3, 5)
        slots = slots.reshape(-1, 3, shape.features, settings.bins)
        yield packed({i: x for i, x in enumerate(slots) if x[2].any()} | {-1 - m: x for m, x in enumerate(loss) if x[1]})

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, sums in zip(*(c.to_pylist() for c in batch.columns)):
                total[slot] = total.get(slot, 0.0) + np.frombuffer(sums)
        yield packed(total)

    def packed(sums):
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                          names=["slot", "sums"])

    counted = state.mapInArrow(count, SUMS)
    if shape.parts > DIRECT:
        counted = counted.repartition("slot").mapInArrow(add, SUMS)
    out: dict[int, np.ndarray] = {}
    table = counted.toArrow()           # models x classes x 2**level rows, for each of a few tasks at most
    for slot, sums in zip(table["slot"].to_pylist(), table["sums"].to_pylist()):
        out[slot] = out.get(slot, 0.0) + np.frombuffer(sums)
    return out


def _grow(found: dict[int, np.ndarray], shape: _Shape, growing: Trees, level: int) -> np.ndarray:
    """Splits the level's nodes where that lowers the squared error of the gradients most; returns each model's loss and weight.

    Ties go to the first feature and lowest bin. Children get their Newton step at once, as their sums are known.
    """
    settings, width, base = shape.settings, 2 ** level, 2 ** level - 1
    slots = shape.models * shape.classes * width
    sums = np.zeros((slots, 3, shape.features, settings.bins))
    for slot, x in found.items():
        if slot >= 0:
            sums[slot] = x.reshape(sums.shape[1:])
    sums = sums.reshape(shape.models, shape.classes, width, 3, shape.features, settings.bins).transpose(3, 0, 1, 2, 4, 5)
    left = np.cumsum(sums, axis=-1)
    whole = left[..., :1, -1:]
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[0] ** 2 / left[2] + right[0] ** 2 / right[2] - whole[0] ** 2 / whole[2]
        gain[(left[2] < settings.leaf_rows - 1e-9) | (right[2] < settings.leaf_rows - 1e-9) | ~np.isfinite(gain)] = -np.inf
        newton = settings.step * (shape.classes - 1) / shape.classes * np.where(left[1] > 1e-12, left[0] / left[1], 0.0)
        newton_right = settings.step * (shape.classes - 1) / shape.classes * np.where(right[1] > 1e-12, right[0] / right[1], 0.0)
        at_root = settings.step * (shape.classes - 1) / shape.classes * np.where(whole[1] > 1e-12, whole[0] / whole[1], 0.0)
    flat = gain.reshape(shape.models, shape.classes, width, -1)
    # Equal gains differ by rounding: the first within it is taken.
    top = flat.max(axis=-1, keepdims=True)
    best = np.argmax(flat >= top - LEAST_GAIN * np.maximum(1.0, np.abs(top)), axis=-1)
    for m in range(shape.models):
        for k in range(shape.classes):
            for node in range(width):
                here = base + node
                if level == 0:
                    growing.value[m, k, 0] = at_root[m, k, 0, 0, 0]
                choice = flat[m, k, node, best[m, k, node]]
                if not choice > LEAST_GAIN:
                    continue
                f, cut = divmod(int(best[m, k, node]), settings.bins)
                growing.feature[m, k, here], growing.bin[m, k, here], growing.gain[m, k, here] = f, cut, choice
                growing.value[m, k, 2 * here + 1] = newton[m, k, node, f, cut]
                growing.value[m, k, 2 * here + 2] = newton_right[m, k, node, f, cut]
    return np.array([found.get(-1 - m, (0.0, 0.0)) for m in range(shape.models)])


def _with_trees(state: DataFrame, shape: _Shape, trees: list[Trees]) -> DataFrame:
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                scores = _rows(batch, shape, trees)[-1]
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array([s.tobytes() for s in scores], pa.binary())],
                                                 names=batch.schema.names)

    return state.mapInArrow(run, state.schema)


@dataclass
class SoftmaxModel:
    """A fitted model: columns, their cuts, first scores, and one heap of nodes per round and class."""

    columns: list[str]
    cuts: list[np.ndarray]
    start: np.ndarray
    trees: Trees            # "models" are the rounds here
    depth: int
    losses: list[float] = field(default_factory=list)

    def scored(self, values: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(cut, values[:, i], "left") for i, cut in enumerate(self.cuts)], axis=1)
        scores = np.tile(self.start, (len(values), 1))
        for r in range(self.trees.value.shape[0]):
            for k in range(len(self.start)):
                scores[:, k] += self.trees.value[r, k][self.trees.nodes(binned, r, k, self.depth)]
        return softmax(scores)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (array, sums to 1) and ``prediction`` (the first most likely class); nulls count as 0."""
        shared = df.sparkSession.sparkContext.broadcast(self)        # rounds x classes x 2**(depth + 1) nodes

        @F.pandas_udf("array<double>")
        def chances(x: pd.DataFrame) -> pd.Series:
            return pd.Series(list(shared.value.scored(x.to_numpy(float))))

        values = F.struct(*(_value(c).alias(c) for c in self.columns))
        most = F.array_position("probability", F.array_max("probability")) - 1
        return df.withColumn("probability", chances(values)).withColumn("prediction", most.cast("double"))

    def importance(self) -> dict[str, float]:
        """Each column's share of all gains."""
        used = self.trees.feature >= 0
        total = np.bincount(self.trees.feature[used], weights=self.trees.gain[used], minlength=len(self.columns))
        return dict(zip(self.columns, total / total.sum() if total.sum() else total))

    def save(self, spark: SparkSession, path: str) -> None:
        rounds, classes, nodes = self.trees.value.shape
        meta = {"columns": self.columns, "cuts": [c.tolist() for c in self.cuts], "start": self.start.tolist(), "depth": self.depth,
                "losses": self.losses, "shape": [rounds, classes, nodes]}
        index = np.stack(np.meshgrid(*map(np.arange, (rounds, classes, nodes)), indexing="ij"), axis=-1).reshape(-1, 3)
        table = pd.DataFrame(index, columns=["round", "class", "node"]).assign(
            feature=self.trees.feature.ravel(), bin=self.trees.bin.ravel(), value=self.trees.value.ravel(), gain=self.trees.gain.ravel())
        spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SoftmaxModel":
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        table = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["round", "class", "node"])
        trees = Trees(*(table[c].to_numpy().reshape(meta["shape"]) for c in ("feature", "bin", "value", "gain")))
        return cls(meta["columns"], [np.array(c) for c in meta["cuts"]], np.array(meta["start"]), trees, meta["depth"], meta["losses"])


def fit_models(df: DataFrame, folds: int = 0, fold: str = "fold", settings: Settings = Settings(), columns: list[str] | None = None,
               label: str = LEVEL, weight: str | None = None, key: tuple[str, ...] = KEY) -> list[SoftmaxModel]:
    """One model of all rows, or one for each of ``folds`` folds, of the rows outside it.

    Labels are 0 to the largest one; rows without a label are left out. ``df`` is read a few times; pass a stored frame.
    """
    columns = [c for c in columns or rules.FEATURES if c in df.columns]
    spark, models = df.sparkSession, max(folds, 1)
    share = F.sum(F.col(weight) if weight else F.lit(1.0))
    found = df.where(F.col(label).isNotNull()).groupBy(F.col(label).cast("int")).agg(share, F.count("*")).collect()
    counts = {r[0]: r[1] for r in found}
    if not counts:
        raise ValueError("boosting needs labelled rows")
    classes = max(max(counts) + 1, 2)
    prior = np.array([max(counts.get(k, 0.0), 1e-9) for k in range(classes)])
    start = np.log(prior / prior.sum())
    cuts = thresholds(df, columns, settings.bins)
    state = prepared(df, columns, cuts, label, weight, key, fold if folds else None, np.tile(start, (models, 1)))
    state = materialize(state.repartition(tasks_for(sum(r[2] for r in found))), "boosting")
    shape = _Shape(models, classes, len(columns), settings, state.rdd.getNumPartitions())
    grown: list[Trees] = []
    pending: list[Trees] = []
    losses: list[list[float]] = [[] for _ in range(models)]
    for round_ in range(settings.rounds):
        growing = Trees.empty(models, classes, settings.depth)
        for level in range(settings.depth):
            loss = _grow(_sums(state, shape, pending, growing, round_, level), shape, growing, level)
            if level == 0:
                for m in range(models):
                    losses[m].append(float(loss[m, 0] / max(loss[m, 1], 1e-300)))
            if not (growing.feature[:, :, 2 ** level - 1:2 ** (level + 1) - 1] >= 0).any():
                break
        grown.append(growing)
        pending.append(growing)
        if len(pending) == STORE_ROUNDS:
            state, pending = materialize(_with_trees(state, shape, pending), "boosting"), []
    out = []
    for m in range(models):
        parts = (np.stack([getattr(t, name)[m] for t in grown]) for name in ("feature", "bin", "value", "gain"))
        out.append(SoftmaxModel(columns, cuts, start, Trees(*parts), settings.depth, losses[m]))
    return out


def fit(df: DataFrame, settings: Settings = Settings(), **options) -> SoftmaxModel:
    """The congestion classifier: 100 rounds of trees of depth 6, one per class, by default."""
    return fit_models(df, settings=settings, **options)[0]


def cross_validate(df: DataFrame, folds: int = 5, settings: Settings = Settings(), label: str = LEVEL) -> tuple[float, float, list[float]]:
    """(mean, standard deviation, each) of weighted F1 over stratified folds; every fold is scored by the model that left it out."""
    folded = materialize(stratified_folds(df, label, folds), "folds")
    scores = []
    for i, model in enumerate(fit_models(folded, folds, settings=settings, label=label)):
        held_out = model.transform(folded.where(F.col("fold") == i))
        scores.append(metrics.classification_scores(held_out, label).first()["weighted_f1"])
    mean = math.fsum(scores) / folds
    return mean, math.sqrt(math.fsum((s - mean) ** 2 for s in scores) / folds), scores
