"""Isolation forest for hotspots (Liu, Ting, Zhou: Isolation Forest, ICDM 2008).

Spark samples the rows per tree, builds the trees in parallel groups and scores rows where
they are. A group holds one tree's sample (about 1.5 ψ rows), the node table at most
2ψ - 1 rows per tree, so neither grows with the data.
"""

import json
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonepulse import rules
from zonepulse.operators.quantile import quantile
from zonepulse.operators.split import KEY
from zonepulse.session import materialize

NODE_SCHEMA = ("tree_id int, node_id int, feature int, threshold double, "
               "left int, right int, path double")
OVERSAMPLE = 1.5


def average_path(rows: int) -> float:
    """Expected path length of an unsuccessful search among ``rows`` points."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2 * (math.log(rows - 1) + np.euler_gamma) - 2 * (rows - 1) / rows


def _grow(points: np.ndarray, limit: int, rng: np.random.Generator) -> list[list]:
    """Nodes of one tree, parents before children; ``path`` is the path length at a leaf."""
    nodes: list[list] = []
    pending = [(points, 0, None, False)]
    while pending:
        rows, depth, parent, is_right = pending.pop()
        at = len(nodes)
        if parent is not None:
            nodes[parent][4 if is_right else 3] = at
        low, high = rows.min(axis=0), rows.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or varying.size == 0:
            nodes.append([at, -1, 0.0, -1, -1, depth + average_path(len(rows))])
            continue
        f = int(rng.choice(varying))
        # Below high, so neither the left side (<=) nor the right side is empty.
        cut = float(min(rng.uniform(low[f], high[f]), np.nextafter(high[f], low[f])))
        nodes.append([at, f, cut, -1, -1, 0.0])
        left = rows[:, f] <= cut
        pending.append((rows[~left], depth + 1, at, True))
        pending.append((rows[left], depth + 1, at, False))
    return nodes


def _sampled(df: DataFrame, columns: list[str], key: tuple[str, ...], rows: int, trees: int,
             sample: int, seed: int) -> DataFrame:
    """About ``OVERSAMPLE * sample`` rows per tree with their draw; all rows if there are few.

    Each row joins each tree with the same probability, by draws that depend on its key only.
    The number of trees before a row's first one is geometric, so one draw settles that most
    rows join none; only the others draw for each later tree. About 1.5 · trees · ψ rows are
    shuffled whatever the input size.
    """
    if not rows:
        raise ValueError("a forest needs rows to grow from")
    share = min(1.0, OVERSAMPLE * sample / rows)
    scale = 2 ** 53
    keys = [F.col(k) for k in key]
    uniform = (F.pmod(F.xxhash64(*keys, F.lit(f"first {seed}")), F.lit(scale)) + 1) / F.lit(float(scale))
    first = F.floor(F.ln(uniform) / F.lit(math.log1p(-share))) if share < 1 else F.lit(0)

    def draw(tree: Column) -> Column:
        return F.xxhash64(*keys, tree, F.lit(seed))

    joined = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(trees - 1)),
                 lambda t: (t == F.col("_first"))
                 | ((t > F.col("_first")) & (F.pmod(draw(t), F.lit(scale)) < int(share * scale)))),
        lambda t: F.struct(t.alias("tree_id"), draw(t).alias("draw")))
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    return (df.withColumn("_first", first)
              .filter(F.col("_first") < trees)
              .select(F.explode(joined).alias("d"), *values)
              .select("d.tree_id", "d.draw", *columns))


def grow_trees(df: DataFrame, columns: list[str], key: tuple[str, ...], rows: int, trees: int,
               sample: int, seed: int) -> DataFrame:
    """The node table of all trees."""
    limit = math.ceil(math.log2(max(sample, 2)))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree_id"].iloc[0])
        chosen = group.sort_values(["draw", *columns])[columns].to_numpy(float)[:sample]
        nodes = _grow(chosen, limit, np.random.default_rng([seed, tree]))
        table = pd.DataFrame(
            nodes, columns=["node_id", "feature", "threshold", "left", "right", "path"])
        table.insert(0, "tree_id", tree)
        return table

    return (_sampled(df, columns, key, rows, trees, sample, seed)
            .groupBy("tree_id").applyInPandas(build, NODE_SCHEMA))


@dataclass
class HotspotForest:
    """A fitted forest: node table, columns, sample size and score threshold."""

    nodes: DataFrame
    columns: list[str]
    sample: int
    threshold: float = math.inf
    _score: Column | None = field(default=None, repr=False)

    def score_column(self) -> Column:
        """Anomaly score in (0, 1), higher is more isolated. Only the model's columns go
        through Python (Arrow batches); the rest of the row stays in the JVM."""
        if self._score is not None:
            return self._score
        table = self.nodes.orderBy("tree_id", "node_id").toPandas()
        trees = table["tree_id"].nunique()
        starts = table.groupby("tree_id").size().cumsum().shift(fill_value=0).to_numpy()
        offset = np.repeat(starts, table.groupby("tree_id").size().to_numpy())
        packed = {
            "root": starts,
            "feature": table["feature"].to_numpy(),
            "threshold": table["threshold"].to_numpy(),
            "left": table["left"].to_numpy() + offset,
            "right": table["right"].to_numpy() + offset,
            "path": table["path"].to_numpy(),
        }
        shared = self.nodes.sparkSession.sparkContext.broadcast(packed)
        usual = average_path(self.sample)

        @F.pandas_udf("double")
        def score(x: pd.DataFrame) -> pd.Series:
            n = shared.value
            values = x.to_numpy(float)
            row = np.arange(len(values))
            total = np.zeros(len(values))
            for root in n["root"]:
                at = np.full(len(values), root)
                while True:
                    f = n["feature"][at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    goes_left = values[row, np.maximum(f, 0)] <= n["threshold"][at]
                    at = np.where(inner, np.where(goes_left, n["left"][at], n["right"][at]), at)
                total += n["path"][at]
            return pd.Series(2.0 ** (-(total / trees) / usual) if usual else np.full(len(values), 0.5))

        values = F.struct(*(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                            for c in self.columns))
        self._score = score(values)
        return self._score

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` and ``is_hotspot`` (score strictly above the threshold)."""
        return (df.withColumn("anomaly_score", self.score_column())
                  .withColumn("is_hotspot", F.col("anomaly_score") > self.threshold))

    def save(self, path: str) -> None:
        spark = self.nodes.sparkSession
        self.nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = json.dumps({"columns": self.columns, "sample": self.sample,
                           "threshold": self.threshold})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "HotspotForest":
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        return cls(spark.read.parquet(f"{path}/nodes"), meta["columns"], meta["sample"],
                   meta["threshold"])


def fit_hotspot_forest(df: DataFrame, columns: tuple[str, ...] = rules.HOTSPOT_FEATURES,
                       key: tuple[str, ...] = KEY, trees: int = 100, max_sample: int = 256,
                       contamination: float = 0.05, seed: int = rules.SEED) -> HotspotForest:
    """Fit on the available ``columns``; the threshold is the exact (1 - contamination) quantile
    of the training scores. ``df`` is read several times; pass a stored frame."""
    present = [c for c in columns if c in df.columns]
    rows = df.count()
    sample = min(max_sample, rows)
    nodes = materialize(grow_trees(df, present, key, rows, trees, sample, seed), "forest-nodes")
    forest = HotspotForest(nodes, present, sample)
    scores = materialize(df.select(forest.score_column().alias("score")), "forest-scores")
    forest.threshold = quantile(scores, "score", 1 - contamination)
    return forest
