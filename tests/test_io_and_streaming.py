"""Sinks -> sources round trips and the streaming rollup."""

import os
import tempfile

from pyspark.sql import functions as F

from claimlens.operators import normalize
from claimlens.plans import inputs as I
from claimlens.schemas import RAW_DDL
from claimlens.sinks import files as sinks
from claimlens.sources import files as sources
from conftest import SF_SMALL


def test_claims_csv_round_trip(spark, tmp_dir):
    raw = I.raw_records(I.derived_claims(I.load(spark, SF_SMALL, "documents")))
    claims = normalize.build_claims(raw)
    path = os.path.join(tmp_dir, "claims")
    sinks.write_claims(claims, path)
    ddl = "claim_seq BIGINT, " + ", ".join(f"{c} STRING" for c in normalize.CLAIM_COLUMNS)
    back = sources.read_csv(spark, path, ddl)
    assert back.count() == claims.count()
    r = back.where("claim_seq = 0").first()
    assert r["claim_id"].endswith("_c0000") and r["phi_hint_ids"].startswith("[")
    assert r["has_citation"] == "false"


def test_raw_jsonl_round_trip(spark, tmp_dir):
    raw = I.raw_records(I.derived_claims(I.load(spark, SF_SMALL, "documents")))
    path = os.path.join(tmp_dir, "raw")
    sinks.write_raw_jsonl(raw, path)
    back = sources.read_raw_jsonl(spark, path, RAW_DDL)
    assert sorted(back.select("rec_ord", F.size("claims")).collect()) == \
        sorted(raw.select("rec_ord", F.size("claims")).collect())


def test_csv_without_order_column(spark, tmp_dir):
    """Columns by name, absent ones null, order from the places in the files."""
    for name, rows in (("a", range(3)), ("b", range(3, 5))):
        with open(os.path.join(tmp_dir, f"{name}.csv"), "w") as f:
            f.write("url,asin,cohort,category_hint\n")
            f.writelines(f'"u,{i}\nx",A{i},R,\n' for i in rows)
    got = sources.read_frame_csv(spark, tmp_dir).orderBy("frame_ord").collect()
    assert [(r["frame_ord"], r["asin"], r["url"]) for r in got] == [(i, f"A{i}", f"u,{i}\nx") for i in range(5)]
    assert {(r["category_hint"], r["stratum"]) for r in got} == {(None, None)}


def test_jsonl_without_order_keeps_every_record(spark, tmp_dir):
    """Small splits: the order runs over the splits of a file and over files."""
    import json
    for name, keys in (("a", range(400)), ("b", range(400, 500))):
        with open(os.path.join(tmp_dir, f"{name}.jsonl"), "w") as f:
            f.writelines(json.dumps({"asin": f"B{i:09d}", "asset_id": "x", "source": "html",
                                     "claims": [{"text": f"claim {i}"}]}) + "\n" for i in keys)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = sources.read_raw_jsonl(spark, tmp_dir, has_order=False)
        assert raw.rdd.getNumPartitions() > 2
        assert sorted(tuple(r) for r in raw.select("rec_ord", "asin").collect()) == [(i, f"B{i:09d}") for i in range(500)]
        claims = normalize.build_claims(raw)
        assert {r["claim_id"] for r in claims.collect()} == {f"B{i:09d}_c{i:04d}" for i in range(500)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_page_bodies_scan(spark, tmp_dir):
    d = os.path.join(tmp_dir, "html")
    os.makedirs(d)
    for k, body in (("B000000001", "<p>one</p>"), ("B000000002", "<p>two\nlines</p>")):
        with open(os.path.join(d, k + ".html"), "w") as f:
            f.write(body)
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("ignored")
    got = sorted(tuple(r) for r in sources.read_page_bodies(spark, d).collect())
    assert got == [("B000000001", "<p>one</p>"), ("B000000002", "<p>two\nlines</p>")]


def test_versioned_write_keeps_input(spark, tmp_dir):
    df = spark.range(3)
    p = sinks.write_versioned(df, os.path.join(tmp_dir, "products"), "2")
    assert p.endswith("version=2") and spark.read.parquet(p).count() == 3


def test_streaming_rollup_equals_batch(spark, tmp_dir):
    from claimlens.streaming.claims_stream import claim_events, gate_rollup, start_gate_rollup
    docs = I.load(spark, SF_SMALL, "documents")
    derive = lambda d: d.withColumn("event_time", F.timestamp_micros(
        F.lit(I.CAPTURE_EPOCH_US) + F.col("doc_id") * 60000000))
    q = start_gate_rollup(spark, SF_SMALL, docs.schema, os.path.join(tmp_dir, "ckpt"), derive,
                          query_name="gate_rollup_test", sink="memory", output_mode="complete", path_glob="documents.parquet",
                          words=I.DENSE_LEXICON)
    try:
        q.processAllAvailable()
        streamed = sorted(tuple(r) for r in spark.sql("SELECT * FROM gate_rollup_test").collect())
    finally:
        q.stop()
    batch = gate_rollup(claim_events(derive(docs), words=I.DENSE_LEXICON))
    assert streamed == sorted(tuple(r) for r in batch.collect()) and streamed
