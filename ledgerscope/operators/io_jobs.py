"""Round trips through sinks and sources, manifests and metadata records.

Scratch output goes under the session's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temp folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.functions.constants import FUSION_PRIMARY_WEIGHT, FUSION_SECONDARY_WEIGHT, TRANSACTION_FEATURES
from ledgerscope.operators import scoring as SCO
from ledgerscope.session import ensure_checkpoint_dir
from ledgerscope.sources import tables as T
from ledgerscope.sources import validate as VA
from ledgerscope.sources.json_records import read_json_text, write_json_array
from ledgerscope.sources.schemas import TRANSACTION_REQUEST


def scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/io/{name}-{uuid.uuid4().hex[:12]}"


def roundtrip_parquet(df: DataFrame) -> DataFrame:
    p = T.safe_write_parquet(df, scratch(df.sparkSession, "parquet"))
    return T.safe_read_parquet(df.sparkSession, p, df.schema)


def roundtrip_csv(df: DataFrame) -> DataFrame:
    p = T.write_csv(df, scratch(df.sparkSession, "csv"))
    return T.read_csv(df.sparkSession, p, df.schema)


def roundtrip_json_records(txns: DataFrame) -> DataFrame:
    """Ledger -> JSON lines of request records -> typed rows."""
    spark = txns.sparkSession
    recs = txns.select(
        "transaction_id", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "sender_id",
        "receiver_id", "amount_usd", "transaction_type", "country_origin", "country_dest",
        "structuring_flag", "round_amount", "rapid_movement",
    )
    p = scratch(spark, "json")
    recs.write.mode("overwrite").json(p)
    back = spark.read.schema(TRANSACTION_REQUEST).json(p)
    return back.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))


def score_json(spark: SparkSession, path: str, fitted: DataFrame) -> DataFrame:
    """Score the records of JSON files (an array, one object, or lines) at ``path``;
    records that break a rule are left out (``validate_quarantine`` lists them)."""
    records = VA.validate_valid(VA.parse_records(read_json_text(spark, path)))
    return SCO.score_batch(records, fitted)


def score_json_roundtrip(txns: DataFrame, fitted: DataFrame) -> DataFrame:
    """The ledger written as JSON arrays of request records, read back and scored. Compressed:
    names of fields, the same in every record, are most of the text."""
    recs = txns.select(
        "transaction_id", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "sender_id", "receiver_id",
        "amount_usd", "transaction_type", "country_origin", "country_dest", *VA.FLAGS,
    )
    return score_json(txns.sparkSession, write_json_array(recs, compression="gzip"), fitted)


def write_score_result(summary: DataFrame, flagged: DataFrame, folder: str) -> str:
    """``folder``/summary: the one-row summary as JSON; ``folder``/flagged: one CSV row
    for each flagged transfer, since their list grows with the batch."""
    summary.coalesce(1).write.mode("overwrite").json(f"{folder}/summary")
    T.write_csv(flagged, f"{folder}/flagged")
    return folder


def score_result_roundtrip(summary: DataFrame, flagged: DataFrame) -> DataFrame:
    """Both files written and read back: the summary, and what the flagged rows add up to."""
    spark = summary.sparkSession
    folder = write_score_result(summary, flagged, scratch(spark, "score-result"))
    rows = T.read_csv(spark, f"{folder}/flagged", flagged.schema)
    cents = F.sum(F.round(F.col("amount_usd") * 100).cast("long"))
    seen = rows.agg(F.count(F.lit(1)).alias("flagged_rows"), (F.coalesce(cents, F.lit(0)) / F.lit(100.0)).alias("flagged_usd"))
    s = seen.select(F.struct("flagged_rows", "flagged_usd").alias("s")).scalar()
    back = spark.read.schema(summary.schema).json(f"{folder}/summary")
    return back.select("*", s["flagged_rows"].alias("flagged_rows"), s["flagged_usd"].alias("flagged_usd"))


def sar_reports_roundtrip(reports: DataFrame) -> DataFrame:
    spark = reports.sparkSession
    p = scratch(spark, "sar-json")
    reports.write.mode("overwrite").json(p)
    return spark.read.schema(reports.schema).json(p)


def sar_reports_flat(reports: DataFrame) -> DataFrame:
    """Nested report rows (as read back from their files) with every field in a column of its own."""
    types = F.col("activity.typologies_detected")
    return reports.select(
        "sar_id", "generated_at", "priority", "llm_used", "status", "filer.*", "suspect.*",
        F.array_join(types, ", ").alias("typologies_detected"), F.size(types).alias("n_typologies"),
        *[f"activity.{f.name}" for f in reports.schema["activity"].dataType.fields if f.name != "typologies_detected"],
    )


def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every Parquet file of every table below ``sf_dir`` (single files and
    folders of part files): SHA-256 and bytes, hashed by executors, and its rows."""
    files = T.file_manifest(spark, sf_dir)
    tables = sorted(r["table"] for r in files.select("table").distinct().collect())  # names of tables
    counts = None
    for t in tables:
        rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}").groupBy(F.col("_metadata.file_path").alias("p")).agg(F.count(F.lit(1)).alias("rows"))
        c = rows.select(T.file_below(F.col("p"), t).alias("file"), "rows")
        counts = c if counts is None else counts.unionByName(c)
    if counts is None:
        return files.select("file", "bytes", "sha256", F.lit(0).cast("long").alias("rows"))
    return files.join(counts, "file", "left").select("file", "bytes", "sha256", F.coalesce("rows", F.lit(0)).alias("rows"))


def manifest_rows(manifest: DataFrame) -> DataFrame:
    """Rows of each table: its single file, or its folder's part files together."""
    name = F.split_part("file", F.lit("/"), F.lit(1))
    return manifest.groupBy(name.alias("table_name")).agg(F.sum("rows").alias("rows"))


def preset_manifest(spark: SparkSession, sf_dir: str, presets: dict, out_dir: str | None = None, needs: dict[str, list[str]] | None = None) -> DataFrame:
    """Run report: every named preset is run and written as CSV; status (ok,
    failed, skipped), rows, file, error, start, end and seconds are recorded. A
    preset whose table (``needs``: preset -> tables) is absent is skipped; one
    that fails is recorded with its whole message, and the rest go on."""
    out_dir = out_dir or scratch(spark, "presets")
    rows = []
    for name, fn in presets.items():
        began = dt.datetime.now(dt.timezone.utc)
        path, n, error, status = f"{out_dir}/{name}", None, None, "ok"
        absent = [t for t in (needs or {}).get(name, []) if not T._exists(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")]
        if absent:
            path, status, error = None, "skipped", f"absent: {', '.join(absent)}"
        else:
            try:
                T.write_csv(fn(spark, sf_dir), path)
                n = spark.read.option("header", True).csv(path).count()
            except Exception as e:  # noqa: BLE001 - recorded, not raised
                path, status, error = None, "failed", f"{type(e).__name__}: {e}"
        ended = dt.datetime.now(dt.timezone.utc)
        rows.append((name, status, n, path, error, began, ended, (ended - began).total_seconds()))
    return spark.createDataFrame(rows, "name string, status string, rows long, file string, error string, started_at timestamp, ended_at timestamp, seconds double")


def evaluation_report(metrics: DataFrame, model: str, evaluated_at: str) -> DataFrame:
    return metrics.select(
        F.lit(model).alias("model"),
        F.lit(evaluated_at).alias("evaluated_at"),
        F.to_json(F.struct(*metrics.columns)).alias("metrics"),
    )


def report_fields(report: DataFrame, like: DataFrame) -> DataFrame:
    """The metrics of an evaluation report, read back from its JSON with the types of ``like``."""
    return report.select(F.from_json("metrics", like.schema).alias("m")).select("m.*")


def detector_metadata_flat(meta: DataFrame) -> DataFrame:
    """The nested metadata as columns: weights, names and confusion cells (at most 4) as text."""
    cell = lambda c: F.concat_ws("", c["true_label"].cast("string"), F.lit("/"), c["pred_label"].cast("string"), F.lit(":"), c["count"].cast("string"))
    return meta.select(
        "threshold", F.col("weights.primary").alias("primary_weight"), F.col("weights.secondary").alias("secondary_weight"),
        F.array_join("feature_names", ",").alias("feature_names"), F.array_join(F.transform("confusion_matrix", cell), ",").alias("confusion_cells"),
    )


def detector_metadata(threshold: DataFrame, confusion: DataFrame) -> DataFrame:
    """One nested row: threshold, fusion weights, feature names and the
    confusion matrix; written as JSON and read back with its schema."""
    # at most 4 cells: collected into one array and read as a scalar subquery
    cm = confusion.select(
        F.sort_array(F.collect_list(F.struct("true_label", "pred_label", "count"))).alias("confusion_matrix")
    ).scalar()
    meta = threshold.select(
        "threshold",
        F.struct(F.lit(FUSION_PRIMARY_WEIGHT).alias("primary"), F.lit(FUSION_SECONDARY_WEIGHT).alias("secondary")).alias(
            "weights"
        ),
        F.array(*[F.lit(f) for f in TRANSACTION_FEATURES]).alias("feature_names"),
        cm.alias("confusion_matrix"),
    )
    spark = threshold.sparkSession
    p = scratch(spark, "meta")
    meta.coalesce(1).write.mode("overwrite").json(p)
    return spark.read.schema(meta.schema).json(p)

