"""Merkle bundles, snapshots and the dictionary join on small tables."""

import hashlib
import threading

import pytest

from claimlens.operators import bundle, dictionary
from claimlens.sinks import snapshots


def rows_of(n, spark):
    return spark.createDataFrame([(i, f"text {i}", None if i % 5 == 0 else i % 3) for i in range(n)], "id long, text string, k int")


def test_root_is_independent_of_layout_and_follows_every_change(spark, monkeypatch):
    monkeypatch.setattr(bundle, "BUCKET", 4)
    df = rows_of(300, spark)

    def root(d):
        return bundle.tree(bundle.digested(d)).where("level = 0").first()

    first = root(df)
    assert first.n_rows == 300 and first.digest == root(df.repartition(9).orderBy("text")).digest
    assert first.digest != root(df.where("id <> 7")).digest != root(df.union(df.where("id = 7"))).digest
    empty = root(df.where("id < 0"))
    assert (empty.n_rows, empty.digest) == (0, hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("size", [3, 1024])
def test_diff_finds_what_changed_and_reads_few_rows(spark, monkeypatch, tmp_dir, size):
    monkeypatch.setattr(bundle, "BUCKET", size)
    old = rows_of(2000, spark).union(rows_of(3, spark))
    new = old.where("id <> 100").selectExpr("id", "case when id = 200 then 'other' else text end AS text", "k").union(
        spark.createDataFrame([(9000, "new", 1), (0, "text 0", None)], "id long, text string, k int"))
    a, b = bundle.write_version(old, f"{tmp_dir}/a"), bundle.write_version(new, f"{tmp_dir}/b")
    assert a != b == bundle.write_version(new.repartition(5), f"{tmp_dir}/c")
    out = bundle.diff(spark, f"{tmp_dir}/a", f"{tmp_dir}/b")
    got = sorted((r.id, r.text, r.old_copies, r.new_copies) for r in out.collect())
    assert got == [(0, "text 0", 2, 3), (100, "text 100", 1, 0), (200, "other", 0, 1), (200, "text 200", 1, 0), (9000, "new", 0, 1)]
    changes = sorted((r.change, r.id, r.old_text, r.new_text) for r in bundle.changed_keys(out.where("id > 0"), "id", ("text",)).collect())
    assert changes == [("added", 9000, None, "new"), ("changed", 200, "text 200", "other"), ("removed", 100, "text 100", None)]
    nodes = [spark.read.parquet(f"{tmp_dir}/{n}/nodes") for n in ("a", "b")]
    assert bundle.differing_buckets(*nodes).count() <= 5
    assert bundle.diff(spark, f"{tmp_dir}/b", f"{tmp_dir}/c").count() == 0


def test_snapshots_keep_old_versions_and_share_folders(spark, tmp_dir):
    path = f"{tmp_dir}/table"
    df = rows_of(500, spark).union(spark.createDataFrame([(None, "no id", 1), (7, "twice", 1)], "id long, text string, k int"))
    assert snapshots.create(df, path, "id") == 1
    before = snapshots.read(spark, path)                         # a reader of the old version
    changes = spark.createDataFrame([(7, "a"), (7, "b"), (9999, "c"), (None, "d"), (8, None)], "id long, text string")
    assert snapshots.update(spark, path, changes, "text") == 2 and snapshots.versions(spark, path) == [1, 2]
    now = {(r.id, r.text) for r in snapshots.read(spark, path).collect()}
    old = {(r.id, r.text) for r in before.collect()}
    assert old == {(r.id, r.text) for r in df.collect()} == {(r.id, r.text) for r in snapshots.read(spark, path, 1).collect()}
    assert now == {(i, "b" if i == 7 else t) for i, t in old} and snapshots.read(spark, path).count() == 502
    one, two = [snapshots._manifest(spark, path, v)["shards"] for v in (1, 2)]
    assert 0 < sum(one[s] != two[s] for s in one) <= 3
    with pytest.raises(ValueError):
        snapshots.read(spark, path, 3)


def test_two_writers_of_one_version(spark, tmp_dir):
    path = f"{tmp_dir}/table"
    snapshots.create(rows_of(20, spark), path, "id")
    manifest = snapshots._manifest(spark, path, 1)
    done = []

    def write():
        try:
            done.append(snapshots._commit(spark, path, 2, manifest))
        except Exception as e:
            done.append(type(e).__name__)

    threads = [threading.Thread(target=write) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert done.count(2) == 1 and snapshots.versions(spark, path) == [1, 2]


def test_leftmost_longest_phrase_wins(spark):
    entries = spark.createDataFrame([("new york", "NY"), ("york city hall", "HALL"), ("New York City", "NYC"), ("city", "CITY"), ("kratom", "M"), ("Kratom", "A"),
                                     ("a b c d", "LONG"), ("!!", "none"), (None, "none"), ("x", None)], "phrase string, name string")
    texts = [(1, "In New-York city hall, kratom."), (2, "york City hall new york"), (3, None), (4, ""), (5, "a b c a b c d"), (1, "city"), (None, "city kratom"), (6, "x !!")]
    df = spark.createDataFrame([(*t, "clash") for t in texts], "id long, text string, phrase string").repartition(3)
    got = sorted([(r.id, r.start, r.size, r.phrase, r.name) for r in dictionary.matches(df, "id", "text", entries).collect()], key=str)
    assert got == sorted([(1, 1, 3, "new york city", "NYC"), (1, 5, 1, "kratom", "A"), (2, 0, 3, "york city hall", "HALL"), (2, 3, 2, "new york", "NY"),
                          (5, 3, 4, "a b c d", "LONG"), (1, 0, 1, "city", "CITY"), (None, 0, 1, "city", "CITY"), (None, 1, 1, "kratom", "A")], key=str)
    found = dictionary.names_per_row(df, "id", "text", entries)
    assert {r.id: r.names for r in found.where("id is not null").collect()} == {1: ["A", "CITY", "NYC"], 2: ["HALL", "NY"], 5: ["LONG"]}
    warnings = spark.createDataFrame([("NY",), ("LONG",), (None,)], "name string")
    assert sorted(r.id for r in dictionary.warned(found, warnings, "id").collect()) == [2, 5]
    assert dictionary.matches(df, "id", "text", entries.where("name = 'zzz'")).count() == 0


def test_a_version_is_written_with_one_shuffle_of_its_rows(spark, tmp_path):
    """Equal rows are counted after they were dealt by ranges of digests."""
    from pyspark.sql import functions as F
    rows = spark.range(300).select((F.col("id") % 100).alias("k"), F.lit("text").alias("t"))
    hashed = bundle.hashed_rows(rows)
    plan = bundle.counted_rows(hashed.repartitionByRange("digest"), ["k", "t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "rangepartitioning" in plan
    bundle.write_version(rows, f"{tmp_path}/a")
    bundle.write_version(rows.where("k <> 7").unionByName(rows.where("k = 9")), f"{tmp_path}/b")
    for bound in (0, 200_000):                  # without and with a broadcast
        bundle.BROADCAST, before = bound, bundle.BROADCAST
        try:
            found = sorted((r.k, r.old_copies, r.new_copies) for r in bundle.diff(spark, f"{tmp_path}/a", f"{tmp_path}/b").collect())
        finally:
            bundle.BROADCAST = before
        assert found == [(7, 3, 0), (9, 3, 6)]


def test_files_in_order_grow_in_number(spark, tmp_path):
    from claimlens.sinks import files as sinks
    from claimlens.sources import files as sources
    rows = spark.range(1000).selectExpr("999 - id as n_ord", "concat('line\n', 999 - id) as t")
    sinks.write_csv(sinks.in_order(rows, "n_ord", 50), f"{tmp_path}/c", ["t"])
    back = sources.read_csv(spark, f"{tmp_path}/c", "n_ord BIGINT, t STRING")
    assert len(list((tmp_path / "c").glob("part-*"))) == 20
    assert all(r.t == f"line\n{r.n_ord}" for r in back.collect()) and back.count() == 1000


def test_a_text_is_hashed_once_and_not_once_a_token(spark):
    from claimlens.operators import dictionary
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "")], "id long, text string")
    entries = spark.createDataFrame([("b c", "x")], "phrase string, name string")
    found = dictionary.matches(docs, "id", "text", entries)
    assert [(r.id, r.start, r.phrase) for r in found.collect()] == [(1, 1, "b c")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    explode = next(i for i, x in enumerate(lines) if "Generate posexplode(tokens" in x)
    assert any("xxhash64(" in x for x in lines[explode:]) and not any("xxhash64(" in x for x in lines[:explode])
