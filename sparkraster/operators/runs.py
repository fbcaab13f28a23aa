"""Tracking, comparison and ranking of evaluation runs. Rows are runs with metric and policy columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparkraster.operators.sampling import _ranked
from sparkraster.operators.tables import shared_table

#: Required fields and statuses of a run record, and which way a metric is better.
REQUIRED_FIELDS = (
    "schema_name", "schema_version", "module_name", "module_version", "data_contract_version", "run_id", "stage_name", "created_at_utc", "status",
)
#: Required fields that may be null.
NULLABLE_FIELDS = ("module_version", "stage_name")
STATUSES = ("success", "partial", "failed")
#: How CSV files write a null, so that an empty string stays one.
NULL = "\\N"
#: Which way each metric is better.
ORIENTATION = {
    "extent_iou": "higher_is_better", "extent_f1": "higher_is_better", "extent_precision": "higher_is_better", "extent_recall": "higher_is_better",
    "boundary_f1": "higher_is_better", "boundary_precision": "higher_is_better", "boundary_recall": "higher_is_better",
    "boundary_bde": "lower_is_better", "goc": "lower_is_better", "guc": "lower_is_better", "gtc": "lower_is_better", "normalized_gtc": "lower_is_better",
}


def reasons(tests: dict[str, Column]) -> Column:
    """Array of the names whose test holds."""
    return F.filter(F.array(*[F.when(bad, F.lit(n)) for n, bad in tests.items()]), lambda v: v.isNotNull())


def manifest_contract(
    runs: DataFrame, required: tuple[str, ...] = REQUIRED_FIELDS, nullable: tuple[str, ...] = NULLABLE_FIELDS, key: str = "run_id"
) -> DataFrame:
    """A row for each required field that is not there, is null or empty, and for each unknown status.

    The ``nullable`` fields must be there and may be null.
    """
    tests = {}
    for c in required:
        if c not in runs.columns:
            tests[f"missing_{c}"] = F.lit(True)
        elif c not in nullable:
            tests[f"missing_{c}"] = F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    if "status" in runs.columns:
        tests["status"] = F.col("status").isNotNull() & ~F.col("status").isin(*STATUSES)
    return runs.select(key, F.explode(reasons(tests)).alias("violation"))


def read_manifests(spark, path: str) -> DataFrame:
    """Run records of JSON files, one object each: the required fields, metrics and the sources they came from."""
    fields = ", ".join(f"{c} string" for c in REQUIRED_FIELDS)
    return spark.read.schema(f"{fields}, source_run_ids array<string>, metrics map<string,double>, outputs map<string,string>").option("multiLine", True).json(path)


def write_manifests(runs: DataFrame, path: str) -> None:
    """Run records as JSON lines; a record against the contract is an error."""
    bad = manifest_contract(runs).limit(1).collect()
    if bad:
        raise ValueError(f"run record {bad[0][0]}: {bad[0][1]}")
    runs.write.mode("errorifexists").json(path)


def export_table(rows: DataFrame, path: str, kind: str = "json") -> None:
    """A table of metrics or deltas as JSON lines or as CSV with a header, a file for each partition; nulls stay nulls."""
    out = rows.write.mode("errorifexists")
    if kind == "json":
        out.option("ignoreNullFields", "false").json(path)
    elif kind == "csv":
        out.option("header", "true").option("nullValue", NULL).csv(path)
    else:
        raise ValueError(f"unknown kind of table: {kind}")


def read_table(spark, path: str, schema: str, kind: str = "json") -> DataFrame:
    """A table that ``export_table`` wrote."""
    r = spark.read.schema(schema)
    return r.json(path) if kind == "json" else r.option("header", "true").option("nullValue", NULL).csv(path)


def unpivot_metrics(runs: DataFrame, metrics: list[str], key: str = "run_id") -> DataFrame:
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return runs.select(key, F.inline(F.array(*rows)))


def run_delta(pairs: DataFrame, runs: DataFrame, required: list[str], optional: list[str], orientation: dict[str, str] = ORIENTATION) -> DataFrame:
    """Right minus left of each metric for ``pairs(left_id, right_id)``.

    ``improved`` follows the ``orientation`` of the metric, and a metric without
    one is an error; ``status`` is ok, skipped (an optional metric missing on a
    side) or missing (a required one).
    """
    unknown = [m for m in required + optional if m not in orientation]
    if unknown:
        raise ValueError(f"no orientation of {', '.join(unknown)}")
    long = unpivot_metrics(runs, required + optional)
    left = long.select(F.col("run_id").alias("left_id"), "metric", F.col("value").alias("left_value"))
    right = long.select(F.col("run_id").alias("right_id"), "metric", F.col("value").alias("right_value"))
    j = pairs.join(left, "left_id").join(right, ["right_id", "metric"])
    d = F.col("right_value") - F.col("left_value")
    better = {x: [m for m in required + optional if orientation[m] == x] for x in ("higher_is_better", "lower_is_better")}
    lower = F.col("metric").isin(*(better["lower_is_better"] or [""]))
    status = F.when(d.isNotNull(), "ok").when(F.col("metric").isin(*(optional or [""])), "skipped").otherwise("missing")
    return j.select(
        "left_id", "right_id", "metric", F.when(lower, "lower_is_better").otherwise("higher_is_better").alias("orientation"),
        "left_value", "right_value", d.alias("delta"),
        F.when(d.isNull() | (d == 0), F.lit(None).cast("boolean")).otherwise((d > 0) != lower).alias("improved"), status.alias("status"),
    )


def scene_selection(scenes: DataFrame, sides: dict[str, DataFrame], policy: str) -> DataFrame:
    """``scene_id, included, reason, policy`` of each scene.

    A scene is included when every side has it; the reason names the first side
    that lacks it. Scenes that only a side knows do not come.
    """
    df = scenes.select("scene_id").distinct()
    missing = []
    for i, (name, side) in enumerate(sides.items()):
        has = side.select("scene_id").distinct().withColumn(f"has{i}", F.lit(True))
        df = df.join(has, "scene_id", "left")
        missing.append(F.when(F.col(f"has{i}").isNull(), F.lit(f"missing_{name}")))
    reason = F.coalesce(*missing) if missing else F.lit(None).cast("string")
    return df.select("scene_id", reason.isNull().alias("included"), reason.alias("reason"), F.lit(policy).alias("policy"))


def policy_compat(pairs: DataFrame, runs: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """For each pair and policy group the first column that differs, or compatible; numbers within 1e-9 are equal."""
    cols = sorted({c for g in groups.values() for c in g})
    kinds = dict(runs.dtypes)
    left = runs.select(F.col("run_id").alias("left_id"), *[F.col(c).alias(f"l_{c}") for c in cols])
    right = runs.select(F.col("run_id").alias("right_id"), *[F.col(c).alias(f"r_{c}") for c in cols])
    j = pairs.join(left, "left_id").join(right, "right_id")

    def differs(c):
        a, b = F.col(f"l_{c}"), F.col(f"r_{c}")
        return F.abs(a - b) > 1e-9 if kinds[c] in ("double", "float") else ~a.eqNullSafe(b)

    out = [
        F.struct(F.lit(g).alias("policy"), F.coalesce(*[F.when(differs(c), F.lit(f"{c} mismatch")) for c in names], F.lit("compatible")).alias("reason"))
        for g, names in groups.items()
    ]
    return j.select("left_id", "right_id", F.inline(F.array(*out)))


def readiness(pairs: DataFrame, runs: DataFrame, compat: DataFrame) -> DataFrame:
    """ready, partial or not_ready of each pair: all, some or no policy groups agree; different eval modes block all."""
    n = compat.groupBy("left_id", "right_id").agg(F.count_if(F.col("reason") == "compatible").alias("good"), F.count("*").alias("n"))
    l, r = (runs.select(F.col("run_id").alias(f"{s}_id"), F.col("eval_mode").alias(f"{s}_mode")) for s in ("left", "right"))
    j = pairs.join(n, ["left_id", "right_id"]).join(l, "left_id").join(r, "right_id")
    state = F.when(~F.col("left_mode").eqNullSafe(F.col("right_mode")) | (F.col("good") == 0), "not_ready").when(F.col("good") == F.col("n"), "ready").otherwise("partial")
    return j.select("left_id", "right_id", state.alias("readiness"))


def provenance_overlap(pairs: DataFrame, sources: DataFrame) -> DataFrame:
    """``shared, same`` of the source sets of both runs; ``sources(run_id, source_ids)``."""
    l, r = (sources.select(F.col("run_id").alias(f"{s}_id"), F.col("source_ids").alias(s)) for s in ("left", "right"))
    j = pairs.join(l, "left_id").join(r, "right_id")
    return j.select(
        "left_id", "right_id", F.size(F.array_intersect("left", "right")).alias("shared"),
        (F.array_sort(F.array_distinct("left")) == F.array_sort(F.array_distinct("right"))).alias("same"),
    )


def ranking(runs: DataFrame) -> DataFrame:
    """0.4 extent_f1 + 0.3 boundary_f1 + 0.3 (1 - normalized_gtc), rounded to 6 digits, and the rank; runs without one of them are left out.

    Equal scores share the first of their ranks. The order is global but no task sorts all runs.
    """
    s = F.round(0.4 * F.col("extent_f1") + 0.3 * F.col("boundary_f1") + 0.3 * (1 - F.col("normalized_gtc")), 6)
    scored = _ranked(runs.withColumn("score", s).where("score is not null").select("run_id", "score"), [F.col("score").desc(), F.col("run_id")])
    first = scored.groupBy("score").agg(F.min("rank").cast("int").alias("rank"))
    return scored.drop("rank").join(first, "score").select("run_id", "score", "rank")


def best_epochs(history: DataFrame) -> DataFrame:
    """Adds ``composite`` (0.6 boundary F1 + 0.4 extent F1) and ``is_best``: strictly better than every epoch before."""
    c = 0.6 * F.col("boundary_f1") + 0.4 * F.col("extent_f1")
    w = W.partitionBy("run_id").orderBy("epoch").rowsBetween(W.unboundedPreceding, -1)
    h = history.withColumn("composite", c)
    before = F.max("composite").over(w)
    return h.withColumn("is_best", before.isNull() | (F.col("composite") > before))


def top_k(df: DataFrame, value: str, key: str, k: int, largest: bool) -> DataFrame:
    """The k rows of the largest or smallest value, ties by key, with their ``rank``."""
    first = df.where(F.col(value).isNotNull()).orderBy(F.col(value).desc() if largest else F.col(value), key).limit(k)
    w = W.orderBy(F.col(value).desc() if largest else F.col(value), key)
    return first.withColumn("rank", F.row_number().over(w))


def win_loss(deltas: DataFrame, keys: list[str]) -> DataFrame:
    """Wins, losses and ties of the right side over all compared metrics of each key."""
    ok = F.col("status") == "ok"
    return deltas.groupBy(*keys).agg(
        F.count_if(ok & F.col("improved")).alias("wins"), F.count_if(ok & ~F.col("improved")).alias("losses"),
        F.count_if(ok & F.col("improved").isNull()).alias("ties"),
    )


def error_taxonomy(counts: DataFrame, key: str) -> DataFrame:
    """``key, error, value`` from the columns split_gt, merged_gt, missed, spurious, invalid_area and boundary_bde."""
    names = {"split_error": "split_gt", "merge_error": "merged_gt", "missed_parcel": "missed", "spurious_parcel": "spurious", "invalid_area_artifact": "invalid_area", "boundary_shift": "boundary_bde"}
    rows = [F.struct(F.lit(n).alias("error"), F.col(c).cast("double").alias("value")) for n, c in names.items()]
    return counts.select(key, F.inline(F.array(*rows)))


def experiment_summary(wanted: DataFrame, runs: DataFrame, baseline_id, metrics: list[str]) -> DataFrame:
    """A row for each wanted ``run_id``: its metrics, their difference to the baseline, and status missing without a run.

    Of several rows with the baseline's id the first by status and metrics counts.
    """
    found = F.struct("status", *metrics)
    base = runs.where(F.col("run_id") == baseline_id).agg(F.min(found).alias("base")).select(*[F.col(f"base.{m}").alias(f"base_{m}") for m in metrics])
    j = wanted.join(runs.select("run_id", "status", *metrics), "run_id", "left").join(F.broadcast(base), how="left")  # one row
    return j.select(
        "run_id", F.coalesce("status", F.lit("missing")).alias("status"), *metrics, *[(F.col(m) - F.col(f"base_{m}")).alias(f"d_{m}") for m in metrics]
    )


def lineage(runs: DataFrame) -> DataFrame:
    """All ancestors: ``run_id, ancestor_id, depth`` over ``runs(run_id, parent_id)``, the least depth of each.

    Each round joins the ancestors known with themselves, so the reach doubles
    and the rounds are the logarithm of the longest line; a round that finds no
    new pair ends it, so cycles end. The least depths up to the reach are exact
    in every round.
    """
    every = runs.where("parent_id is not null").select("run_id", F.col("parent_id").alias("ancestor_id"), F.lit(1).alias("depth"))
    every = shared_table(every.distinct())
    n = every.count()
    while n:
        on = every.select(F.col("run_id").alias("ancestor_id"), F.col("ancestor_id").alias("next"), F.col("depth").alias("more"))
        far = every.join(on, "ancestor_id").select("run_id", F.col("next").alias("ancestor_id"), (F.col("depth") + F.col("more")).alias("depth"))
        new = shared_table(every.unionAll(far).groupBy("run_id", "ancestor_id").agg(F.min("depth").alias("depth")))
        more = new.count()
        if more == n:
            break
        every, n = new, more
    return every


def track_readiness(counts: DataFrame) -> DataFrame:
    """``ready, reason`` of the object track from ``n_gt, n_pred``: both sides need a parcel."""
    reason = F.when(F.col("n_gt").isNull() | (F.col("n_gt") == 0), "no ground truth parcels").when(F.col("n_pred").isNull() | (F.col("n_pred") == 0), "no predicted parcels")
    return counts.withColumns({"ready": reason.isNull(), "reason": reason})


def threshold_provenance(runs: DataFrame, columns: list[str], mixed: str = "mixed_explicit_threshold_provenance") -> DataFrame:
    """The one value of the policy columns, or ``mixed``."""
    kinds = F.array_distinct(F.array(*[F.col(c).cast("string") for c in columns]))
    return runs.select("run_id", F.when(F.size(kinds) == 1, kinds[0]).otherwise(mixed).alias("mode"))


def layer_alignment(layers: DataFrame, reference: DataFrame) -> DataFrame:
    """Layers that differ from their scene's reference: size, CRS, or a transform value by more than 1e-9 (``gt`` array)."""
    r = reference.select("scene_id", *[F.col(c).alias(f"r_{c}") for c in ("width", "height", "crs", "gt")])
    j = layers.join(r, "scene_id")
    off = F.exists(F.zip_with("gt", "r_gt", lambda a, b: F.abs(a - b)), lambda d: d.isNull() | (d > 1e-9))
    tests = {"size": (F.col("width") != F.col("r_width")) | (F.col("height") != F.col("r_height")), "crs": ~F.col("crs").eqNullSafe(F.col("r_crs")), "transform": off}
    return j.select("scene_id", "layer", F.explode(reasons(tests)).alias("violation"))


def crs_check(scenes: DataFrame, vectors: DataFrame) -> DataFrame:
    """``status`` of each vector against its scene: same, reprojection_required, missing_crs or not_projected."""
    j = vectors.join(scenes.select("scene_id", F.col("crs").alias("scene_crs"), "is_projected"), "scene_id")
    same = F.upper(F.trim("crs")) == F.upper(F.trim("scene_crs"))
    return j.withColumn(
        "status", F.when(F.col("crs").isNull() | F.col("scene_crs").isNull(), "missing_crs").when(~F.col("is_projected"), "not_projected").when(same, "same").otherwise("reprojection_required")
    )


def geometry_kind(kind: Column) -> Column:
    """Upper-case geometry type without 3D and 25D prefixes and Z, M and ZM suffixes."""
    k = F.upper(F.trim(kind))
    k = F.regexp_replace(F.regexp_replace(k, r"^(3D|2\.5D)\s*", ""), r"25D$", "")
    return F.regexp_replace(k, r"[\s_]*(ZM|Z|M)$", "")


def valid_policy(scenes: DataFrame) -> DataFrame:
    """Scenes whose valid pixels cannot be told: no mask, no nodata value and no override."""
    return scenes.where(~(F.coalesce("has_mask", F.lit(False)) | F.col("nodata").isNotNull() | F.coalesce("override", F.lit(False))))


def artifact_check(manifest: DataFrame, used: DataFrame) -> DataFrame:
    """Roles whose path in a manifest and among the inputs used differ or are missing on a side: ``run_id, role, problem``."""
    m, u = manifest.select("run_id", "role", F.col("path").alias("m_path")), used.select("run_id", "role", F.col("path").alias("u_path"))
    j = m.join(u, ["run_id", "role"], "full_outer")
    problem = F.when(F.col("m_path").isNull(), "not_in_manifest").when(F.col("u_path").isNull(), "not_used").when(F.col("m_path") != F.col("u_path"), "path_differs")
    return j.select("run_id", "role", problem.alias("problem")).where("problem is not null")
