"""Rule-based hotspots and their evaluation."""

from pyspark.sql import DataFrame, Window, functions as F


def rule_hotspots(grid: DataFrame, quantile: float = 0.95) -> DataFrame:
    """Flag cells with a trip spike (at or above the zone's quantile) and falling speed.

    The quantile is a discrete one, so it is an observed trip count. Its aggregation buffer
    holds one counter per distinct trip count of a zone, at most one per hour.
    """
    spike = F.expr(f"percentile_disc({quantile}) WITHIN GROUP (ORDER BY trip_count)")
    per_zone = grid.groupBy("zone_id").agg(spike.cast("long").alias("spike_trips"))
    spiking = (F.col("trip_count") >= F.col("spike_trips")) & (F.col("speed_delta") < 0)
    return (grid.join(per_zone, "zone_id", "left")
                .withColumn("is_hotspot", F.coalesce(spiking, F.lit(False))))


def detection_scores(flagged: DataFrame, truth: str, flag: str = "is_hotspot") -> DataFrame:
    """Confusion counts, precision, recall and F1 of a flag against a boolean truth; one pass."""
    hit, real = F.col(flag), F.col(truth)
    counts = flagged.agg(
        F.count_if(hit & real).alias("true_positives"),
        F.count_if(hit & ~real).alias("false_positives"),
        F.count_if(~hit & real).alias("false_negatives"))
    tp, fp, fn = (F.col(c) for c in counts.columns)
    zero = F.lit(0.0)
    return counts.withColumns({
        "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), zero),
        "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero),
    })


def detection_rate(flagged: DataFrame, flag: str = "is_hotspot") -> DataFrame:
    """How many rows are flagged, and their share in percent."""
    return flagged.agg(
        F.count("*").alias("rows"),
        F.count_if(flag).alias("hotspots"),
        (F.avg(F.col(flag).cast("double")) * 100).alias("hotspot_pct"))


SKETCH_K = 800          # of a KLL sketch: rank error below 0.6 % (99 % confidence), a few kilobytes a zone


def trip_sketches(grid: DataFrame) -> DataFrame:
    """(zone_id, sketch): mergeable KLL sketches of the zones' trip counts, of bounded size however many cells there are."""
    return grid.groupBy("zone_id").agg(F.kll_sketch_agg_bigint("trip_count", F.lit(SKETCH_K)).alias("sketch"))


def merged_sketches(*parts: DataFrame) -> DataFrame:
    """One sketch a zone of several deliveries' sketches, in any order."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("zone_id").agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))


def sketched_spikes(sketches: DataFrame, quantile: float = 0.95) -> DataFrame:
    """(zone_id, spike_trips) from sketches: the quantile of :func:`rule_hotspots` within the rank error."""
    return sketches.select("zone_id", F.kll_sketch_get_quantile_bigint("sketch", F.lit(quantile)).alias("spike_trips"))


def top_scores(scored: DataFrame, k: int, score: str, by: str = "hour_bucket", key: str = "zone_id") -> DataFrame:
    """The ``k`` rows of highest score of every hour, ties by key: ranked per hour, so nothing is sorted as a whole, and a task keeps
    ``k`` rows an hour before the shuffle."""
    best = Window.partitionBy(by).orderBy(F.col(score).desc_nulls_last(), F.col(key))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def precision_at_k(scored: DataFrame, truth: str, k: int, score: str = "anomaly_score", by: str = "hour_bucket") -> DataFrame:
    """Alerts raised by the top ``k`` of every hour, those that are right, precision, and false alarms as a share of alerts."""
    alerts = top_scores(scored, k, score, by).agg(F.count("*").alias("alerts"), F.count_if(F.col(truth)).alias("right"))
    share = F.coalesce(F.try_divide(F.col("right"), F.col("alerts")), F.lit(0.0))
    return alerts.withColumns({
        "precision_at_k": share,
        "false_alarm_rate": F.coalesce(F.try_divide(F.col("alerts") - F.col("right"), F.col("alerts")), F.lit(0.0))})
