"""Registered queries of storage: snapshots (K08), files in the original's layout
(S06, S07, K05, K07) and the claims stream (D14)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import normalize
from ..schemas import RAW_DDL
from ..session import ensure_checkpoint_dir
from ..sinks import files as sinks, snapshots
from ..sources import files as sources
from ..streaming import claims_stream
from . import inputs as I, q_quality  # noqa: F401  (registers the batch form's SQL)
from .oracle import FX_CTE, FXC_CTE, ORACLE
from .registry import query


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _fx(spark, sf_dir):
    return I.derived_claims(I.load(spark, sf_dir, "documents"))


@query("snapshot_update", f"""WITH {FX_CTE}
SELECT claim_ord, confidence AS confidence_1, CASE WHEN claim_ord % 1000 = 3 THEN 0.25::DOUBLE ELSE confidence END AS confidence_2,
       CASE WHEN claim_ord % 1000 = 3 THEN 0.25::DOUBLE WHEN claim_ord % 7 = 0 THEN 0.5::DOUBLE ELSE confidence END AS confidence_3 FROM fx""")
def snapshot_update(spark, sf_dir):
    """A table is written and updated twice; all three versions are read
    afterwards."""
    path = _folder(spark, "snapshot")
    fx = _fx(spark, sf_dir).select("claim_ord", "claim_text", "confidence")
    snapshots.create(fx, path, "claim_ord")
    first = fx.select("claim_ord").where("claim_ord % 1000 = 3")
    snapshots.update(spark, path, first.withColumn("confidence", F.lit(0.25)), "confidence")
    second = fx.select("claim_ord").where("claim_ord % 7 = 0 and claim_ord % 1000 <> 3")
    snapshots.update(spark, path, second.withColumn("confidence", F.lit(0.5)), "confidence")
    one, two, three = [snapshots.read(spark, path, v).select("claim_ord", F.col("confidence").alias(f"confidence_{v}")) for v in (1, 2, 3)]
    return one.join(two, "claim_ord").join(three, "claim_ord")


@query("raw_files_round_trip", f"""WITH {FXC_CTE}
SELECT dense_rank() OVER (ORDER BY rec_ord) - 1 AS file_ord, product_key AS asin, claim_pos, claim_text FROM fxc""")
def raw_files_round_trip(spark, sf_dir):
    """The raw extraction records, as many JSON lines files without
    an order column, read back and numbered by their places in the files."""
    path = _folder(spark, "raw")
    raw = I.raw_records(_fx(spark, sf_dir))
    sinks.write_raw_jsonl(sinks.in_order(raw, "rec_ord", sinks.FILE_RECORDS).drop("rec_ord"), path)
    back = sources.read_raw_jsonl(spark, path, RAW_DDL, has_order=False)
    return back.select(F.col("rec_ord").alias("file_ord"), "asin", F.posexplode("claims").alias("claim_pos", "claim")).select(
        "file_ord", "asin", "claim_pos", F.col("claim.text").alias("claim_text"))


FILE_DDL = "page_ord BIGINT, claim_id STRING, claim_text_verbatim STRING, has_numeric_quantifier BOOLEAN"


@query("claims_csv_round_trip", f"""WITH {FXC_CTE}
SELECT claim_seq AS page_ord, printf('%s_c%04d', product_key, claim_seq) AS claim_id, claim_text AS claim_text_verbatim,
       regexp_matches(claim_text, '[0-9]') AS has_numeric_quantifier FROM fxc""")
def claims_csv_round_trip(spark, sf_dir):
    """The claims table as header CSV, its order column left out,
    read by header names and numbered by the rows' places in the files."""
    path = _folder(spark, "claims")
    claims = normalize.build_claims(I.raw_records(_fx(spark, sf_dir)))
    sinks.write_csv(sinks.in_order(claims, "claim_seq"), path, normalize.CLAIM_COLUMNS)
    return sources.read_csv(spark, path, FILE_DDL)


@query("claim_window_stream", ORACLE["claim_window_rollup"])
def claim_window_stream(spark, sf_dir):
    """The hourly rollup as a stream with a watermark, in two runs from one
    checkpoint: all claims; then rows that are late by a month, which the watermark
    drops, and a row far ahead, which closes the windows that were still open."""
    path = _folder(spark, "stream")
    events = _fx(spark, sf_dir).select("claim_ord", "claim_text", F.timestamp_micros(F.lit(I.CAPTURE_EPOCH_US) + F.col("claim_ord") * 60_000_000).alias("event_time"))
    events.write.parquet(f"{path}/in")
    schema = events.schema
    claims_stream.run_available(spark, f"{path}/in", schema, f"{path}/checkpoint", f"{path}/out")
    late = events.where("claim_ord % 50 = 0").withColumn("event_time", F.col("event_time") - F.expr("INTERVAL 30 DAYS"))
    ahead = events.agg((F.max("event_time") + F.expr("INTERVAL 30 DAYS")).alias("event_time")).select(F.lit(-1).cast("long").alias("claim_ord"), F.lit("").alias("claim_text"), "event_time")
    late.unionByName(ahead).write.mode("append").parquet(f"{path}/in")
    claims_stream.run_available(spark, f"{path}/in", schema, f"{path}/checkpoint", f"{path}/out")
    return spark.read.parquet(f"{path}/out")
