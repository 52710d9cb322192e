"""Operational tables: namespace cost, workload CPU, ROI, SLO, logs, risks, sync runs
(AGG16-AGG21, AGG23, AGG25).  The reference declares these tables only (Ev S); the
formulas below are ours, constrained by the columns, and say so.

Every aggregate is a built-in partial/final aggregation.  Percentiles use
``percentile_disc``, which counts each distinct value of a group: exact at every size,
partially aggregated like a sum, and bounded by the distinct values that the column's
precision allows, not by the rows of a hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Ours: a sample whose activity score (props.k, 0..99) is below this is idle; a pod
# idle in every sample of the day is a zombie.
IDLE_BELOW = 20


def percentile(column: str, p: float, kind: str) -> Column:
    """The smallest value that at least the part ``p`` of the group's values do not exceed.

    Spark gives it as a double; ``kind`` is the column's decimal type.
    """
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY `{column}`)").cast(kind)


def namespace_daily(samples: DataFrame) -> DataFrame:
    """AGG16: per (day, namespace) billable, usage, waste, efficiency, pods, zombies.

    ``samples``: (ts, namespace, pod, cost decimal, activity int).  waste = billable -
    usage; efficiency = usage / billable * 100 (double; NULL when billable is 0);
    pods and zombies come from a first aggregation per pod, so the count is exact
    and no group is held in one task.  100 / 80 gives waste 20, efficiency 80.
    """
    per_pod = samples.groupBy(F.to_date("ts").alias("day"), "namespace", "pod").agg(
        F.sum("cost").alias("billable"),
        F.sum(F.when(F.col("activity") >= IDLE_BELOW, F.col("cost")).otherwise(F.lit(0))).alias("used"),
        F.max("activity").alias("max_activity"),
    )
    agg = per_pod.groupBy("day", "namespace").agg(
        F.sum("billable").cast("decimal(18,2)").alias("billable_cost"),
        F.sum("used").cast("decimal(18,2)").alias("usage_cost"),
        F.count(F.lit(1)).alias("pod_count"),
        F.count_if(F.col("max_activity") < IDLE_BELOW).alias("zombie_count"),
    )
    return agg.select(
        "day", "namespace", "billable_cost", "usage_cost",
        (F.col("billable_cost") - F.col("usage_cost")).cast("decimal(18,2)").alias("waste_cost"),
        (F.try_divide(F.col("usage_cost").cast("double"), F.col("billable_cost").cast("double")) * F.lit(100.0)).alias("efficiency"),
        "pod_count", "zombie_count",
    )


def workload_hourly(samples: DataFrame) -> DataFrame:
    """AGG17: per (hour, namespace, workload) max, p95 and average CPU.

    avg = exact decimal sum / count, reported as a double; p95 = exact
    percentile (an actual sample value).
    """
    return samples.groupBy(
        F.date_trunc("hour", "ts").alias("time_bucket"), "namespace", "workload_name"
    ).agg(
        F.max("cpu_usage").alias("max_cpu_usage"),
        percentile("cpu_usage", 0.95, "decimal(10,4)").alias("p95_cpu_usage"),
        (F.sum("cpu_usage").cast("double") / F.count(F.lit(1))).alias("avg_cpu_usage"),
        F.count(F.lit(1)).alias("samples"),
    )


def roi_savings(events: DataFrame) -> DataFrame:
    """AGG18: Σ savings and event count per (namespace, event_type)."""
    return events.groupBy("namespace", "event_type").agg(
        F.sum("savings_amount").cast("decimal(38,2)").alias("savings_amount"),
        F.count(F.lit(1)).alias("events"),
    )


def slo_daily(requests: DataFrame, slos: DataFrame) -> DataFrame:
    """AGG19: per (day, slo) availability, error budget left and status.

    availability = good / total; budget left = 100 * (1 - (1 - avail) / (1 - target))
    (the usual SRE definition; NULL for a target of 1).  Status (ours): HEALTHY when
    at least 25 % of the budget is left, AT_RISK while some is left, else BREACHED.
    ``requests``: (ts, service_name, good boolean); ``slos``: (id, service_name, target_slo).
    """
    per_day = requests.groupBy(F.to_date("ts").alias("day"), "service_name").agg(
        F.count_if("good").alias("good"), F.count(F.lit(1)).alias("total")
    )
    j = per_day.join(slos.select("id", "service_name", "target_slo"), "service_name")
    avail = F.col("good").cast("double") / F.col("total").cast("double")
    target = F.col("target_slo").cast("double")
    budget = F.lit(100.0) * (F.lit(1.0) - F.try_divide(F.lit(1.0) - avail, F.lit(1.0) - target))
    out = j.select(
        "day", F.col("id").alias("slo_id"), "service_name", "good", "total",
        avail.alias("availability"), budget.alias("error_budget_remaining"),
    )
    return out.withColumn(
        "status",
        F.when(F.col("error_budget_remaining") >= 25, "HEALTHY")
        .when(F.col("error_budget_remaining") >= 0, "AT_RISK")
        .otherwise("BREACHED"),
    )


def error_counts(logs: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """AGG20: error-log counts per tumbling ``bucket`` and service."""
    return logs.groupBy(F.window("timestamp", bucket).alias("w"), "service").agg(
        F.count(F.lit(1)).alias("errors")
    ).select(F.col("w.start").alias("bucket_start"), "service", "errors")


def latency_stats(logs: DataFrame) -> DataFrame:
    """AGG21: per (service, path) request count, p50/p95 latency, 5xx count."""
    return logs.groupBy("service", "path").agg(
        F.count(F.lit(1)).alias("requests"),
        percentile("latency_ms", 0.5, "decimal(10,2)").alias("p50_latency_ms"),
        percentile("latency_ms", 0.95, "decimal(10,2)").alias("p95_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.count_if(F.col("status_code") >= 500).alias("server_errors"),
    )


def severity_of(score: F.Column) -> F.Column:
    """Ours: severity bands of an evidence score 0..99."""
    return (
        F.when(score >= 90, "critical").when(score >= 70, "high").when(score >= 40, "medium").otherwise("low")
    )


def incident_counts(incidents: DataFrame) -> DataFrame:
    """AGG23: incidents per (service, root-cause type, status), with the mean evidence
    score read from the JSON snapshot (``get_json_object``)."""
    score = F.get_json_object("snapshot_data", "$.k").cast("int")
    return incidents.groupBy("service_name", "root_cause_type", "status").agg(
        F.count(F.lit(1)).alias("incidents"),
        F.sum(score).alias("score_sum"),
        F.max(score).alias("max_score"),
    )


def risk_counts(risks: DataFrame) -> DataFrame:
    """AGG23: risks per (risk_type, severity, status, namespace)."""
    return risks.groupBy("risk_type", "severity", "status", "namespace").agg(F.count(F.lit(1)).alias("risks"))


def sync_run_summary(jobs: DataFrame) -> DataFrame:
    """AGG25: per status the job count, total and mean duration, progress ratio.

    Durations are summed as exact microseconds; mean = total / jobs (double);
    progress = Σ current / Σ total (double, NULL when nothing was planned).
    """
    dur = F.unix_micros(F.col("completed_at")) - F.unix_micros(F.col("started_at"))
    return jobs.groupBy("status").agg(
        F.count(F.lit(1)).alias("jobs"),
        F.sum(dur).alias("total_duration_us"),
        (F.sum(dur).cast("double") / F.count(F.lit(1)) / F.lit(1e6)).alias("avg_duration_s"),
        F.try_divide(F.sum("progress_current").cast("double"), F.sum("progress_total").cast("double")).alias("progress_ratio"),
    )


# ------------------------------------------------------------------ quantiles at scale
#: Size of the stored sketches, and the rank error that goes with it (about 99 of 100 sketches).
SKETCH_K, RANK_ERROR = 200, 0.0133


def latency_sketches(logs: DataFrame, keys: tuple[str, ...] = ("service",), value: str = "latency_ms", k: int = SKETCH_K) -> DataFrame:
    """AGG21 over long ranges: one mergeable KLL sketch and count for each hour and key.

    A sketch holds some hundred values whatever it has seen, so tasks combine sketches
    instead of gathering a hot key's values, and hours merge to days without the logs.
    """
    seen = logs.filter(F.col(value).isNotNull())
    return seen.groupBy(F.date_trunc("hour", "timestamp").alias("hour"), *keys).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n")
    )


def merged_quantiles(sketches: DataFrame, keys: tuple[str, ...], ranks: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Day and key with count and quantiles, from stored hourly sketches."""
    merged = sketches.groupBy(F.to_date("hour").alias("day"), *keys).agg(
        F.kll_merge_agg_double("sketch").alias("_s"), F.sum("n").alias("n")
    )
    names = [f"p{round(100 * q)}" for q in ranks]
    return merged.select(
        "day", *keys, "n", *[F.kll_sketch_get_quantile_double("_s", F.lit(q)).alias(c) for q, c in zip(ranks, names)]
    )


# ------------------------------------------------------------------ JSON evidence
def evidence_counts(df: DataFrame, column: str, path: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """AGG23: rows by a nested field of a JSON column, malformed JSON counted apart.

    The column is parsed once to VARIANT, whatever shape a row has.  ``field`` is null
    where the JSON has none (or a null); ``bad_json`` marks rows that are no JSON.
    """
    parsed = df.select(*keys, F.col(column).alias("_j"), F.try_parse_json(column).alias("_v"))
    bad = F.col("_j").isNotNull() & F.col("_v").isNull()
    field = F.try_variant_get("_v", path, "string")
    return parsed.groupBy(*keys, field.alias("field"), bad.alias("bad_json")).agg(F.count(F.lit(1)).alias("n"))


def evidence_schema(df: DataFrame, column: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The schema that the JSON documents of each key share, as text (drift shows as VARIANT)."""
    parsed = df.select(*keys, F.try_parse_json(column).alias("_v"))
    return parsed.groupBy(*keys).agg(F.schema_of_variant_agg("_v").alias("shape"))
