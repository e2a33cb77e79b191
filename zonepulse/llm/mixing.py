"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources a document belongs to), which
leaves a small network: from each pattern, as many tokens as it holds for every repetition, the first
at no cost and each further one dearer (convex), to each source it belongs to, up to the source's
quota. The cheapest flow that meets the quotas as far as they can be met says how many tokens of every pattern to
take. Documents are then selected by a seeded hash: whole repetitions for all, and one more for those
whose hash is below a threshold, found from sums per hash range (4,096 a pattern) and, in one range alone, by order.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonepulse.llm.text import plain
from zonepulse.session import materialize

MAX_REPEATS = 3
SEED = 11
PASSES = 4
NEAR = 0.02                 # share of what is wanted that may be left


def capped_targets(sizes: dict, weights: dict, total: float, cap: float = MAX_REPEATS) -> dict:
    """Shares of ``total`` by weight, none above ``cap`` times its size; the excess is shared again by weight."""
    targets, open_ = {}, {s for s in sizes if weights[s] > 0}
    left = min(float(total), cap * sum(sizes[s] for s in open_))
    while open_:
        whole = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / whole >= cap * sizes[s]}
        if not full:
            return {s: 0.0 for s in sizes} | targets | {s: left * weights[s] / whole for s in open_}
        for s in full:
            targets[s] = float(cap * sizes[s])
            left -= targets[s]
        left, open_ = max(left, 0.0), open_ - full
    return {s: 0.0 for s in sizes} | targets


def route(capacity: dict, quotas: dict, repeats: int = MAX_REPEATS) -> dict:
    """Tokens from each pattern to each of its sources: {(pattern, source): tokens}.

    ``capacity``: tokens by pattern (a tuple of sources). Successive cheapest augmenting paths; the k-th
    repetition of a pattern costs ``k - 1`` a token, so patterns are repeated evenly and as little as the quotas allow.
    """
    flow = {(p, s): 0.0 for p in capacity for s in p if s in quotas}
    taken, given = dict.fromkeys(capacity, 0.0), dict.fromkeys(quotas, 0.0)
    tiny = 1e-9 * max([1.0, *quotas.values()])

    def room(p, level):         # tokens left in the repetition that comes next
        return capacity[p] * (level + 1) - taken[p]

    for level in range(repeats):        # a path starts at the cheapest repetition that is left
        while True:
            start = [p for p in capacity if room(p, level) > tiny]
            came: dict = {("p", p): None for p in start}
            todo = [("p", p) for p in start]
            end = None
            for kind, node in todo:     # patterns reach sources; a source that a pattern feeds can send it elsewhere
                if kind == "p":
                    steps = [("s", s) for s in node if s in quotas]
                else:
                    if quotas[node] - given[node] > tiny:
                        end = ("s", node)
                        break
                    steps = [("p", p) for p in capacity if flow.get((p, node), 0.0) > tiny]
                for step in steps:
                    if step not in came:
                        came[step] = (kind, node)
                        todo.append(step)
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            amount = min([room(path[0][1], level), quotas[end[1]] - given[end[1]],
                          *(flow[b[1], a[1]] for a, b in zip(path, path[1:]) if a[0] == "s")])
            for a, b in zip(path, path[1:]):
                if a[0] == "p":
                    flow[a[1], b[1]] += amount
                else:
                    flow[b[1], a[1]] -= amount
            taken[path[0][1]] += amount
            given[end[1]] += amount
    return flow


def select(df: DataFrame, wanted: dict, pattern: str, size: str, key: str, seed: int = SEED) -> DataFrame:
    """``df`` with ``repeats``: how often each document is taken so that a pattern's tokens come to what is wanted.

    ``wanted``: {pattern: (tokens wanted, tokens held)}. All documents are taken as many whole times as that allows. Then,
    in the order of a seeded hash of key and size, documents are taken once more up to the first that is too large for
    what is left; what then is left goes, in the same way, to documents that fit it, ``PASSES`` times in all. The
    order depends on no partitioning; only documents of one hash range of each pattern are sorted, the rest is sums.
    """
    spark = df.sparkSession
    whole = {p: int(n // held) if held else 0 for p, (n, held) in wanted.items()}
    rest = {p: n - whole[p] * held for p, (n, held) in wanted.items()}
    bits = F.xxhash64(F.col(key), F.col(size), F.lit(seed)).bitwiseAND((1 << 62) - 1)
    docs = df.withColumns({"_bits": bits, "_more": F.lit(0)}).withColumn("_range", F.shiftright("_bits", 50))
    for level in (0,) * PASSES + (1,) * 2:
        if level and all(r <= NEAR * wanted[p][0] or whole[p] + 1 >= MAX_REPEATS for p, r in rest.items()):
            break                       # only where too little fits are documents taken once more still
        left = spark.createDataFrame([(p, float(r)) for p, r in rest.items()], f"{pattern} bigint, _rest double")
        docs = docs.join(F.broadcast(left), pattern, "left")            # a row per pattern
        free = [p for p in rest if whole[p] + level < MAX_REPEATS]
        fits = ((F.col("_more") == level) & (F.col(size) > 0) & (F.col(size) <= F.col("_rest"))
                & (F.col(pattern).isin(free) if free else F.lit(False)))
        sums = docs.where(fits).groupBy(pattern, "_range").agg(F.sum(size).alias("_sum"), F.max("_rest").alias("_rest"))
        before = F.sum("_sum").over(Window.partitionBy(pattern).orderBy("_range")) - F.col("_sum")
        cut = (sums.withColumn("_start", before).where(F.col("_start") + F.col("_sum") > F.col("_rest"))
               .groupBy(pattern).agg(F.min("_range").alias("_cut"), F.min("_start").alias("_start")))
        marked = docs.withColumn("_fits", fits).join(F.broadcast(cut), pattern, "left")
        inside = F.col("_fits") & (F.col("_range") == F.col("_cut"))
        order = Window.partitionBy(pattern).orderBy("_bits", key, size).rowsBetween(Window.unboundedPreceding, 0)
        closer = marked.where(inside).withColumn("_more", F.when(
            F.col("_start") + F.sum(size).over(order) <= F.col("_rest"), level + 1).otherwise(F.col("_more")))
        others = marked.where(~F.coalesce(inside, F.lit(False))).withColumn("_more", F.when(
            F.col("_fits") & (F.col("_cut").isNull() | (F.col("_range") < F.col("_cut"))), level + 1).otherwise(F.col("_more")))
        docs = materialize(others.unionByName(closer).withColumn(
            "_new", F.when(F.col("_fits") & (F.col("_more") == level + 1), F.col(size)).otherwise(0)), "mixed")
        for row in docs.groupBy(pattern).agg(F.sum("_new").alias("n")).collect():
            rest[row[pattern]] -= row["n"]
        docs = docs.drop("_rest", "_cut", "_start", "_fits", "_new")
    # What no document fits into goes to the smallest larger one, if that comes nearer than leaving it.
    left = spark.createDataFrame([(p, float(r)) for p, r in rest.items()], f"{pattern} bigint, _rest double")
    larger = (docs.join(F.broadcast(left), pattern).where((F.col("_more") == 0) & (F.col(size) > F.col("_rest"))
                                                          & (F.col(size) < 2 * F.col("_rest")))
              .groupBy(pattern).agg(F.min(F.struct(size, "_bits")).alias("_last")))      # a row per pattern
    last = F.coalesce(F.struct(F.col(size), F.col("_bits")) == F.col("_last"), F.lit(False))
    docs = docs.join(F.broadcast(larger), pattern, "left").withColumn(
        "_more", F.when(last & (F.col("_more") == 0), 1).otherwise(F.col("_more"))).drop("_last")
    times = spark.createDataFrame(list(whole.items()), f"{pattern} bigint, _whole bigint")
    return docs.join(F.broadcast(times), pattern, "left").withColumn(
        "repeats", F.coalesce("_whole", F.lit(0)) + F.col("_more")).drop("_bits", "_range", "_more", "_whole")


def mix(df: DataFrame, sources: Column, size: str, weights, key: str = "doc_id", total: float | None = None,
        max_repeats: int = MAX_REPEATS, seed: int = SEED) -> tuple[DataFrame, dict, dict]:
    """(``df`` with ``repeats``, targets by source, tokens held by source).

    ``sources``: array of source names of a document (null is a source of its own; an empty array belongs to none and is
    never taken); ``weights``: function from the sorted source names, null last, to their weights; ``total``:
    tokens wanted, by default all. The driver holds one row per membership pattern and no document.
    Repeated rows count and are selected as documents of their own or together; null sizes count as 0.
    """
    docs = plain(df, "repeats").withColumns({size: F.coalesce(F.col(size), F.lit(0)).cast("bigint"),
                           "_pattern": F.array_sort(F.array_distinct(sources))})
    pattern_id = F.xxhash64("_pattern", F.lit(3))
    docs = docs.withColumn("_pattern_id", pattern_id)
    held = docs.groupBy("_pattern_id", "_pattern").agg(F.sum(size).alias("n")).collect()    # one row per pattern
    names = {r["_pattern_id"]: tuple(r["_pattern"] or ()) for r in held}
    capacity, ids = {}, {p: i for i, p in names.items()}
    for r in held:
        capacity[names[r["_pattern_id"]]] = float(r["n"])
    sizes: dict = {}
    for p, n in capacity.items():
        for s in p:
            sizes[s] = sizes.get(s, 0.0) + n
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    given = dict(zip(order, weights(order)))
    targets = capped_targets(sizes, given, sum(capacity.values()) if total is None else total, max_repeats)
    flow = route(capacity, targets, max_repeats)
    wanted = {ids[p]: (sum(flow.get((p, s), 0.0) for s in p), n) for p, n in capacity.items()}
    picked = select(docs, wanted, "_pattern_id", size, key, seed)
    return picked.drop("_pattern", "_pattern_id"), targets, sizes
