"""Config loaders (S01-S05) and the remaining sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from claimlens import config
from claimlens.operators import export
from claimlens.sinks import files as sinks
from claimlens.sources import files as sources
from claimlens.schemas import FRAME_DDL

HINTS_YAML = """
phi:
  phi_a:
    patterns: ["alpha", "\\\\bbeta\\\\b"]
k:
  k_a:
    patterns: ["gamma"]
l:
  weights:
    wow: 2
    "FDA approved": 1
fda_warnings: ["gamma"]
ingredient_aliases:
  "gamma": ["g1", "g2"]
"""

PLAN_YAML = """
representative:
  target_n: 50
  strata:
    - {name: A, query: "q a", allocation: 0.6}
    - {name: B, allocation: 0.4}
targeted:
  target_n: 10
  nodes:
    - {name: N1, keywords: [x, y], gate: K}
    - {name: N2, keywords: [z], gate: L, min_l_score: 3}
sampling_frame_version: v2000-01-01
"""


def _write(tmp_dir, name, text):
    p = os.path.join(tmp_dir, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_loaders_keep_order_and_values(tmp_dir):
    h = config.load_hint_rules(_write(tmp_dir, "h.yaml", HINTS_YAML))
    assert h.phi == (("phi_a", ("alpha", r"\bbeta\b")),) and h.k == (("k_a", ("gamma",)),)
    assert h.l_weights == (("wow", 2), ("FDA approved", 1))
    assert h.ingredient_aliases == (("gamma", ("g1", "g2")),)
    p = config.load_sampling_plan(_write(tmp_dir, "p.yaml", PLAN_YAML))
    assert [(s.name, s.allocation, s.query) for s in p.strata] == [("A", 0.6, "q a"), ("B", 0.4, None)]
    assert p.nodes[1].min_l_score == 3 and p.frame_version == "v2000-01-01" and p.t_target_n == 10
    e = config.load_extraction_policy(_write(tmp_dir, "e.yaml", "temperature: 0\nmin_claim_length: 12\n"))
    assert e.min_claim_length == 12 and e.check_deterministic() is e
    with pytest.raises(ValueError):
        config.ExtractionPolicy(temperature=0.2).check_deterministic()
    c = config.load_capture_policy(_write(tmp_dir, "c.yaml", "domain_whitelist: [a.example]\n"))
    assert c.domain_whitelist == ("a.example",)
    s = config.load_table_schema(_write(tmp_dir, "s.json", json.dumps({"required": ["x"]})))
    assert s["required"] == ["x"]


def test_loaded_rules_drive_the_hint_columns(spark, tmp_dir):
    from claimlens.functions import hints
    h = config.load_hint_rules(_write(tmp_dir, "h.yaml", HINTS_YAML))
    df = spark.createDataFrame([("Alpha and gamma, wow",), ("alphabet beta",)], "t string")
    t = F.col("t")
    r = df.select(hints.phi_hint_ids(t, h).alias("p"), hints.k_hint_ids(t, None, h).alias("k"),
                  hints.l_score(t, h).alias("s")).collect()
    assert [tuple(x) for x in r] == [(["phi_a"], ["k_a"], 2), (["phi_a"], [], 0)]


def test_frame_csv_round_trip_keeps_order(spark, tmp_dir):
    fr = spark.createDataFrame([(i, f"R{i:09d}", "u", "R", "random", "S", "S") for i in range(50)], FRAME_DDL)
    path = os.path.join(tmp_dir, "frame")
    sinks.write_frame(fr.repartition(7), path)
    back = sources.read_frame_csv(spark, path)
    assert [r["frame_ord"] for r in back.orderBy("frame_ord").collect()] == list(range(50))


def test_report_and_bundle_sinks(spark, tmp_dir):
    rep = spark.createDataFrame([("K", "k_a", 3, 1), ("Φ", "phi_a", 5, 0)],
                                "gate string, pattern string, count long, report_pos int")
    rp = os.path.join(tmp_dir, "report")
    sinks.write_report(rep, rp)
    files = [f for f in os.listdir(rp) if f.endswith(".csv")]
    assert len(files) == 1
    with open(os.path.join(rp, files[0]), encoding="utf-8") as f:
        lines = f.read().splitlines()
    assert lines[0] == "gate,pattern,count,report_pos" and lines[1].startswith("Φ,phi_a,5")
    t = spark.createDataFrame([("A", 1)], "asin string, n int")
    man = export.bundle_manifest({"t": t}, "2025-01-01T00:00:00Z")
    d = sinks.write_bundle({"t": (t, ("asin", "n"), None)}, man, os.path.join(tmp_dir, "bundle"))
    assert os.path.isdir(os.path.join(d, "t")) and os.path.isdir(os.path.join(d, "bundle_metadata"))
    m = spark.read.json(os.path.join(d, "bundle_metadata")).first()
    assert m["rows_t"] == 1 and len(m["bundle_hash"]) == 64
