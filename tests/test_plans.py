"""Plan-shape checks for the scale properties the operators rely on."""

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extraction_refuses_a_temperature(spark):
    import pytest
    from claimlens.config import ExtractionPolicy
    from claimlens.operators import extract
    for entry, args in ((extract.html_claims, (None, None, ["k"])), (extract.text_claims, (None, None, ["k"])),
                        (extract.image_claims, (None,)), (extract.group_records, (None, ["k"]))):
        with pytest.raises(ValueError):
            entry(*args, policy=ExtractionPolicy(temperature=0.2))


def test_pages_are_spread_only_on_request(spark):
    from claimlens.session import INPUT_PARTITIONS, spread
    assert "RoundRobin" not in _plan(spread(spark.range(5)))
    spark.conf.set(INPUT_PARTITIONS, "3")
    try:
        assert "RoundRobinPartitioning(3)" in _plan(spread(spark.range(5)))
    finally:
        spark.conf.unset(INPUT_PARTITIONS)


def test_cap_uses_partial_window_group_limit(spark):
    plan = _plan(E.queries()["section_claims_dense"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["page_hash"](spark, SF_SMALL))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan
    plan = _plan(E.queries()["sampling_weights"](spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan


def test_global_claim_ids_avoid_single_partition_window(spark):
    plan = _plan(E.queries()["claim_sequence"](spark, SF_SMALL))
    assert "SinglePartition" not in plan or plan.count("SinglePartition") <= 1   # only the small bucket table


def test_claims_are_derived_once(spark):
    """Records and claims are written and read; ordinals join with nothing."""
    for name, scans in (("claims_normalized", 0), ("qc_summary", 2), ("table_fingerprint", 1)):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert plan.count("documents.parquet") <= scans          # the products' URL metadata
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_ordinals_of_an_empty_and_a_one_bucket_table(spark):
    from claimlens.operators.sequence import ordinal
    rows = spark.createDataFrame([(5, 2), (None, 7), (1, None), (5, 1)], "o long, w long")
    for buckets in (1, 2, 256):
        got = sorted((r.o is None, r.o, r.w, r.s) for r in ordinal(rows, "o", weight="w", name="s", tiebreak=["w"], buckets=buckets).collect() if r.o)
        assert got == [(False, 1, None, 0), (False, 5, 1, 0), (False, 5, 2, 1)]
        assert ordinal(rows, "o", weight="w", name="s", buckets=buckets).where("o is null").first().s == 3
        assert ordinal(rows.limit(0), "o", buckets=buckets).count() == 0
