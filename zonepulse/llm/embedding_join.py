"""Near copies among embeddings: every pair of one label whose cosine reaches a limit, found by a subspace pigeonhole join.

Unit vectors with cosine ``c`` or more are at most ``sqrt(2 - 2c)`` apart. Turned by one random rotation and cut into blocks of
a few dimensions, such a pair is, in one block at least, no farther apart than that block's share of the squared
distance (its share of the dimensions). So each block is range-joined under its own budget and the union holds every pair:

1. Equal vectors of a label are one class with a weight.
2. A block is laid out in cells ``WIDTH`` radii wide. A vector goes to its own cell, and as a visitor to the neighbouring
   cells of greater number that its ball reaches: two vectors in reach of each other meet in exactly one cell. With more
   vectors a label, more of a block's dimensions are cut, so cells stay small.
3. Cells that hold more than ``TILE`` vectors are cut into tiles, and a task compares two tiles.
4. A pair is verified where it meets first (the least block that joins it), by half-precision copies of the rotated vectors
   with a proven error: what that error can't decide is decided by the vectors themselves in double precision.
   A task returns numbers of links and a spanning forest of them, not pairs.
"""

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from zonepulse.llm.components import components
from zonepulse.session import materialize

COSINE = 0.98
BLOCK_DIMS = 8              # dimensions of a block, at most
WIDTH = 3                   # side of a cell, in radii of a block's range join
CELL = 2048                 # vectors that a cell should hold on average
TILE = 8192                 # vectors of a cell that one task compares with as many
STRIP = 256                 # vectors compared at a time
PAIRS = 1 << 18             # candidate pairs looked at together
NUMBERS = 1 << 21           # of a matrix of vectors placed together
SEED = 20260
#: Rounding to half precision moves a unit vector by less than this (2**-11 of its length, and numbers too small for it).
ROUNDED = 2.0 ** -11 + 1e-5
#: Bound of the error of a cosine from rounded vectors, in single precision.
UNSURE = 2 * ROUNDED + ROUNDED ** 2 + 1e-5


@lru_cache(4)
def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every worker."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(SEED + dims)).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks(dims: int) -> list[tuple[int, int]]:
    """(from, to) of each block: as few as ``BLOCK_DIMS`` allows, of nearly equal size."""
    edges = np.linspace(0, dims, -(-dims // BLOCK_DIMS) + 1).round().astype(int).tolist()
    return list(zip(edges, edges[1:]))


def radii(dims: int, cosine: float) -> np.ndarray:
    """Each block's radius: the budget for rounded vectors, shared out by dimensions."""
    budget = (math.sqrt(max(2 - 2 * cosine, 0.0)) + 2 * ROUNDED) ** 2
    return np.sqrt([budget * (b - a) / dims for a, b in blocks(dims)]) * (1 + 1e-5)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; large and tiny numbers neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.square(scaled).sum(axis=1, keepdims=True))


def turned(vectors: np.ndarray) -> np.ndarray:
    """Rotated unit vectors in half precision."""
    return (unit(vectors) @ rotation(vectors.shape[1])).astype(np.float16)


def cells(block: np.ndarray, radius: float, cut: int):
    """(row, number, home) of the cells that each row of a block's coordinates goes to.

    Only the first ``cut`` coordinates are cut. A cell is no narrower than two radii, so a ball reaches at most one neighbour
    a coordinate; the distance to a cell is summed over the coordinates, which leaves far corners out.
    """
    side, n = WIDTH * radius, len(block)
    across = int(2 * math.ceil(1.01 / side)) + 3          # a unit vector's coordinates, and a neighbour on either side
    used = min(cut, block.shape[1], int(62 / math.log2(across)))
    at, number, home = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    reach, limit = np.zeros(n), radius * radius * (1 + 1e-6)
    for k in range(used):
        place = block[:, k].astype(np.float64) / side
        cell = np.floor(place).astype(np.int64)
        within = place - cell
        step = np.where(within < 0.5, -1, 1)
        gap = np.square(np.minimum(within, 1 - within) * side)
        base = cell + across // 2
        over = reach + gap[at]
        near = np.flatnonzero(over <= limit)
        number, home = number * across, home * across
        number = np.concatenate([number + base[at], (number + base[at] + step[at])[near]])
        home = np.concatenate([home + base[at], (home + base[at])[near]])
        reach, at = np.concatenate([reach, over[near]]), np.concatenate([at, at[near]])
    kept = number >= home
    return at[kept], number[kept], (number == home)[kept]


def _by_length(batch: pa.RecordBatch, column: str):
    """(rows, matrix in double precision) for each length of the vectors in a list column."""
    lists = batch.column(batch.schema.get_field_index(column))
    ends = lists.offsets.to_numpy()
    lengths, values = np.diff(ends), lists.values.to_numpy(zero_copy_only=False)
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        yield rows, values[ends[rows][:, None] + np.arange(n)].astype(np.float64)


def placed(classes: DataFrame, cosine: float, cut: int, light: bool) -> DataFrame:
    """(label, dims, block, cell, home, node, weight, vector) of every cell that a class goes to; ``light``: only
    (label, dims, block, cell, rows), counted within each batch."""
    keys = [classes.schema["label"], T.StructField("dims", T.IntegerType()), T.StructField("block", T.IntegerType()),
            T.StructField("cell", T.LongType())]
    schema = T.StructType(keys + ([T.StructField("rows", T.LongType())] if light else [
        T.StructField("home", T.BooleanType()), T.StructField("node", T.LongType()), T.StructField("weight", T.LongType()),
        T.StructField("vector", T.BinaryType())]))

    def run(batches):
        for whole in batches:
            step = max(1, NUMBERS * whole.num_rows // max(1, len(whole.column(1).flatten())))
            for begin in range(0, whole.num_rows, step):
                batch = whole.slice(begin, step)
                for rows, matrix in _by_length(batch, "vector"):
                    dims, halves = matrix.shape[1], turned(matrix)
                    label, raw = batch.column(0).take(pa.array(rows)), pa.array([v.tobytes() for v in halves], pa.binary())
                    for b, ((first, last), radius) in enumerate(zip(blocks(dims), radii(dims, cosine))):
                        at, cell, home = cells(halves[:, first:last], radius, cut)
                        fixed = [label.take(pa.array(at)), *(pa.array(np.full(len(at), x, np.int32)) for x in (dims, b)), pa.array(cell)]
                        if light:
                            table = pa.table(fixed, names=schema.names[:4]).group_by(schema.names[:4]).aggregate([([], "count_all")])
                            yield from table.select([*schema.names[:4], "count_all"]).rename_columns(schema.names).to_batches()
                            continue
                        node, weight = (batch.column(k).take(pa.array(rows[at])) for k in (2, 3))
                        yield pa.RecordBatch.from_arrays([*fixed, pa.array(home), node, weight, raw.take(pa.array(at))],
                                                         names=schema.names)

    return classes.select("label", "vector", "node", "weight").mapInArrow(run, schema)


def _close(x: np.ndarray, y: np.ndarray, edges: list[tuple[int, int]], limits: np.ndarray, block: int):
    """Of pairs of rows, which are within the radius of ``block`` and of no block before it.

    The same numbers in the same order, whichever task asks: a pair passes in exactly one block.
    """
    left = np.arange(len(x))
    for k in [block, *range(block)]:
        a, b = edges[k]
        apart = np.square(x[left, a:b].astype(np.float32) - y[left, a:b].astype(np.float32)).sum(axis=1, dtype=np.float64)
        left = left[apart <= limits[k]] if k == block else left[apart > limits[k]]
    return left


def compare(vectors: np.ndarray, home: np.ndarray, left: np.ndarray, right: np.ndarray, block: int, cosine: float):
    """(i, j, sure) of the pairs of a cell that belong to ``block`` and may reach the cosine.

    ``left``, ``right``: rows of two tiles. A pair has a home row; in one tile it is looked at once.
    """
    dims = vectors.shape[1]
    edges, radius = blocks(dims), radii(dims, cosine)
    limits = np.square(radius)
    a, b = edges[block]
    own = vectors[:, a:b].astype(np.float32)
    right = right[np.argsort(own[right, -1], kind="stable")]          # the last coordinate is the one cut last
    sorted_last, lengths = own[right, -1], np.square(own).sum(axis=1)
    left = left[np.argsort(own[left, -1], kind="stable")]
    for begin in range(0, len(left), STRIP):
        some = left[begin:begin + STRIP]
        low = np.searchsorted(sorted_last, own[some[0], -1] - radius[block] * 1.001, "left")
        high = np.searchsorted(sorted_last, own[some[-1], -1] + radius[block] * 1.001, "right")
        for at in range(low, high, PAIRS // STRIP):
            others = right[at:min(at + PAIRS // STRIP, high)]
            apart = lengths[some][:, None] + lengths[others][None, :] - 2 * (own[some] @ own[others].T)
            i, j = np.nonzero(apart <= limits[block] * 1.001 + 1e-5)
            i, j = some[i], others[j]
            # Of two home rows the one that comes first asks; a visitor never asks.
            fine = home[i] & (~home[j] | (i < j))
            i, j = i[fine], j[fine]
            close = _close(vectors[i], vectors[j], edges, limits, block)
            i, j = i[close], j[close]
            found = np.einsum("ij,ij->i", vectors[i].astype(np.float32), vectors[j].astype(np.float32))
            found /= np.sqrt(_squared(vectors[i]) * _squared(vectors[j]))
            maybe = found >= cosine - UNSURE
            yield i[maybe], j[maybe], found[maybe] >= cosine + UNSURE


def _squared(vectors: np.ndarray) -> np.ndarray:
    return np.square(vectors.astype(np.float32)).sum(axis=1)


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Least row of each row's component, for links (i, j) between n rows."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all() and (root[i] == root[j]).all():
            return root


def joined(rows: DataFrame, cosine: float) -> DataFrame:
    """(kind, a, b, n): for every two tiles in a cell 'links' (a has n further links), 'tie' (a and b are connected) and
    'check' (a and b may be linked)."""
    schema = T.StructType([T.StructField("kind", T.StringType()), *(T.StructField(c, T.LongType()) for c in "abn")])

    def run(batches):
        current, held = None, []
        for batch in batches:
            n = batch.num_rows
            differ = np.zeros(max(n - 1, 0), bool)
            for column in batch.columns[:6]:
                differ |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False) if n else False
            starts = [0, *(np.flatnonzero(differ) + 1).tolist()] if n else []
            for a, b in zip(starts, [*starts[1:], n]):
                if (key := tuple(column[a].as_py() for column in batch.columns[:6])) != current:
                    yield from close(current, held)
                    current, held = key, []
                held.append(batch.slice(a, b - a))
        yield from close(current, held)

    def close(key, held):
        if not held or sum(x.num_rows for x in held) < 2:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        dims, block = key[1], key[2]
        vectors = np.frombuffer(b"".join(table["vector"].to_pylist()), np.float16).reshape(-1, dims)
        home, side = (table[c].to_numpy() for c in ("home", "side"))
        node, weight = (table[c].to_numpy().astype(np.int64) for c in ("node", "weight"))
        everyone = np.arange(len(node))
        # One tile with itself (0), or the first tile (1) with the second (2): either may hold the home row of a pair.
        sides = [(everyone, everyone)] if key[4] == key[5] else [
            (np.flatnonzero(side == 1), np.flatnonzero(side == 2)), (np.flatnonzero(side == 2), np.flatnonzero(side == 1))]
        count, ties_i, ties_j = np.zeros(len(node), np.int64), [], []
        for left, right in sides:
            for i, j, sure in compare(vectors, home, left[home[left]], right, block, cosine):
                if not sure.all():
                    yield out("check", node[i[~sure]], node[j[~sure]], np.zeros(int((~sure).sum()), np.int64))
                i, j = i[sure], j[sure]
                np.add.at(count, i, weight[j])
                np.add.at(count, j, weight[i])
                if len(i):
                    root = forest(i, j, len(node))
                    tied = np.flatnonzero(root != everyone)
                    ties_i.append(tied)
                    ties_j.append(root[tied])
        some = np.flatnonzero(count)
        if len(some):
            yield out("links", node[some], node[some], count[some])
            root = forest(np.concatenate(ties_i), np.concatenate(ties_j), len(node))
            tied = np.flatnonzero(root != everyone)
            yield out("tie", node[tied], node[root[tied]], np.zeros(len(tied), np.int64))

    def out(kind, a, b, n):
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(a), pa.string()), pa.array(a), pa.array(b), pa.array(n)],
                                          names=schema.names)

    keys = ["label", "dims", "block", "cell", "i", "j"]
    return (rows.select(*keys, "side", "home", "node", "weight", "vector").repartition(*keys)
            .sortWithinPartitions(*keys).mapInArrow(run, schema))


def _valid(vector: Column) -> Column:
    """Whether a vector has a direction: not null, nothing in it null, NaN or infinite, something in it not zero."""
    def fine(x):
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def exact_cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision of two vectors of equal length."""
    def scaled(v):
        wide = F.transform(v, lambda x: x.cast("double"))
        return F.transform(wide, lambda x: x / F.array_max(F.transform(wide, F.abs)))

    def total(v):
        return F.aggregate(v, F.lit(0.0), lambda s, x: s + x)

    x, y = scaled(a), scaled(b)
    product = total(F.zip_with(x, y, lambda p, q: p * q))
    return product / F.sqrt(total(F.transform(x, lambda p: p * p)) * total(F.transform(y, lambda p: p * p)))


def link_near(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
              cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) of every row of ``df``.

    ``n_links``: other rows of the same label with a cosine of ``cosine`` (above 0) or more; repeated rows and repeated keys
    are rows of their own. ``component_id``: least key reachable by links, itself included; ``kept``: it is the row's own.
    A null label, a vector that is null, empty, all zero, or holds nulls, NaN or infinities, links with nothing, as do vectors
    of different length. A null key links as any other, but names no component: its row has a null component only where no
    linked row has a key, and is kept then. An empty frame gives no rows.
    """
    spark = df.sparkSession
    given = materialize(df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
                        .withColumn("fine", _valid(F.col("vector")) & F.col("label").isNotNull()), "vectors")
    fine = given.where("fine")
    classes = materialize(fine.groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("key").alias("least"))
                          .withColumn("node", F.monotonically_increasing_id()), "classes")
    largest = classes.groupBy("label").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    # Each cut coordinate about halves a cell, as a cell is more than twice as wide as coordinates spread.
    cut = max(1, math.ceil(math.log2(max(largest, 1) / CELL)))
    full = (placed(classes, cosine, cut, True).groupBy("label", "dims", "block", "cell").agg(F.sum("rows").alias("rows"))
            .where(F.col("rows") > TILE).withColumn("tiles", F.ceil(F.col("rows") / TILE).cast("int")).drop("rows"))
    full = materialize(full, "full-cells")
    rows = placed(classes, cosine, cut, False).join(full, ["label", "dims", "block", "cell"], "left")
    # In a cell of several tiles a row meets every tile: as i with those from its own on, as j with those before.
    tile, tiles = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"), F.coalesce("tiles", F.lit(1))
    rows = (rows.withColumn("own", F.coalesce(tile, F.lit(0))).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
            .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
            .withColumn("side", F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)))
    found = materialize(joined(rows, cosine), "joined")

    open_ = found.where("kind = 'check'").select("a", "b")
    for c in "ab":
        open_ = open_.join(classes.select(F.col("node").alias(c), F.col("vector").alias(f"{c}_vector"),
                                          F.col("weight").alias(f"{c}_weight")), c)
    decided = materialize(open_.where(exact_cosine(F.col("a_vector"), F.col("b_vector")) >= cosine)
                          .select("a", "b", "a_weight", "b_weight"), "decided")
    links = (found.where("kind = 'links'").select(F.col("a").alias("node"), "n")
             .unionByName(decided.select(F.col("a").alias("node"), F.col("b_weight").alias("n")))
             .unionByName(decided.select(F.col("b").alias("node"), F.col("a_weight").alias("n")))
             .groupBy("node").agg(F.sum("n").alias("n")))
    ties = found.where("kind = 'tie'").select("a", "b").unionByName(decided.select("a", "b"))
    grouped = components(ties)
    least = (grouped.join(classes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_least")))
    known = (classes.join(links, "node", "left").join(grouped, "node", "left").join(least, "component", "left")
             .select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("component_least", "least").alias("component_id")))
    return (fine.select("key", "label", "vector").join(known, ["label", "vector"]).select("key", "n_links", "component_id")
            .unionByName(given.where("NOT fine").select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id")))
            .select(F.col("key").alias(key), "n_links", "component_id",
                    F.col("key").eqNullSafe(F.col("component_id")).alias("kept")))
