"""Claims over time (D14, an extension): Structured Streaming.

Extraction and hints are row-local (array functions and projections), so the
same code runs on a stream; the only state is the event-time window
aggregation, bounded by the watermark.  ``gate_rollup`` is the shared
DataFrame -> DataFrame step, used by the batch query and the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import HTML_CLAIM_WORDS, ExtractionPolicy
from ..functions.hints import with_hints
from ..operators.extract import rule_claims_per_row


def claim_events(pages: DataFrame, keys=("doc_id",), text_col: str = "text", time_col: str = "event_time",
                 words=HTML_CLAIM_WORDS, policy: ExtractionPolicy = ExtractionPolicy()) -> DataFrame:
    """Stateless: claims of each incoming page with their policy hints."""
    c = rule_claims_per_row(pages, [*keys, time_col], text_col, policy, words)
    return with_hints(c, "claim_text")


def gate_rollup(claims: DataFrame, time_col: str = "event_time", window: str = "1 hour",
                watermark: str | None = None) -> DataFrame:
    """Claims per (event-time window, gate hint) and the max exaggeration
    score; with a watermark, late rows older than it are dropped and the
    window state is released."""
    c = claims.withWatermark(time_col, watermark) if watermark else claims
    g = c.groupBy(F.window(time_col, window).alias("w"), "gate_hint").agg(
        F.count(F.lit(1)).alias("n_claims"), F.max("l_token_score").alias("max_l_score"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "gate_hint",
                    "n_claims", "max_l_score")


def start_gate_rollup(spark: SparkSession, source_dir: str, schema, checkpoint_location: str,
                      derive_time, path: str | None = None, query_name: str = "gate_rollup", sink: str = "parquet",
                      output_mode: str = "append", window: str = "1 hour", watermark: str = "2 hours",
                      path_glob: str | None = None, text_col: str = "text", keys=("doc_id",), words=HTML_CLAIM_WORDS,
                      max_files_per_trigger: int | None = None):
    """Start the streaming rollup over parquet files arriving in
    ``source_dir``.  ``derive_time(df) -> df`` adds ``event_time``.  A window is
    written to ``path`` once the watermark has passed it (file sinks append).
    ``sink="memory"`` holds the rollup on the driver and is for tests.  The
    checkpoint location must be on shared storage in a cluster."""
    if sink != "memory" and path is None:
        raise ValueError("a file sink needs a path")
    r = spark.readStream.schema(schema)
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = derive_time(r.parquet(source_dir))
    out = gate_rollup(claim_events(pages, keys, text_col, words=words), window=window, watermark=watermark)
    w = out.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint_location)
    w = w.format(sink).queryName(query_name)
    return (w if path is None else w.option("path", path)).start()


def run_available(spark: SparkSession, source_dir: str, schema, checkpoint_location: str, path: str,
                  text_col: str = "claim_text", time_col: str = "event_time", window: str = "1 hour",
                  watermark: str = "2 hours") -> None:
    """One run of the rollup over the claims that have arrived in ``source_dir``
    since the last run from this checkpoint; it ends when they are done.  Windows that
    the watermark has passed are appended to ``path``; the others stay in the state."""
    rows = spark.readStream.schema(schema).parquet(source_dir)
    out = gate_rollup(with_hints(rows, text_col), time_col, window, watermark)
    run = out.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint_location).option("path", path)
    run.trigger(availableNow=True).start().awaitTermination()
