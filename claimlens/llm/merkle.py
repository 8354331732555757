"""Merkle dataset manifest with nested-interval labels (operator 11).

Every row of ``documents`` is a leaf: the digest of its fields.  The leaves of a
branch (a language) are ranked by id.  A node carries the half-open interval of
leaf ranks that it covers; each ``RUN`` consecutive nodes of a level have a parent
whose interval is the union of theirs.  Parents keep the (interval, digest) of
their children.  From the root down, level by level, nodes meet their parents in
a join on (branch, bucket of the interval's start) with the containment of
intervals as condition, and inherit the path above: per level the digests left
and right of the node.  Those are found by interval difference: children of
the parent that end before the node's interval begins, and that begin after it
ends.  The subroots, ranked by branch, are the leaves of one more tree of the
same kind, whose paths continue those of the branches.

A join's bucket holds at most ``RUN`` children of one parent, whatever the size of a
branch; ranks come from a range partitioning and a prefix sum over partitions;
the driver learns numbers of levels only.

Defined results: null fields are marked ``-``; null ids come last and are not
tampered with; rows that repeat an id are ordered by their leaf; repeated rows
are leaves of their own; a null language is a branch, before all others; an
empty table gives an empty result.  Columns besides the five are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimlens.llm.common import cut, lower_ascii

RUN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A level of a path: joined digests of the siblings left and right of a node.
PATH = "array<struct<left string, right string>>"
_POSITION = (1 << 33) - 1


def hashed(text: Column) -> Column:
    """H: lowercase hex sha256."""
    return F.sha2(text, 256)


def leaf(*fields: Column) -> Column:
    """Digest of fields, each ``-`` if null, else byte count, ``:`` and value."""
    def marked(x: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))
    return hashed(F.concat(*[marked(x.cast("string")) for x in fields]))


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with the interval [lo, hi) of each row's rank in its branch by
    ``order`` (nulls last) and the branch's total, written to the shared folder.
    Rows are range-partitioned, and a partition's rows add to what their branch
    has in the partitions before."""
    columns = [F.col(c).asc_nulls_last() for c in order]
    dealt = df.repartitionByRange("branch", *columns).sortWithinPartitions("branch", *columns)
    # Partition number and position, as ordered; the written copy fixes them.
    placed = cut(dealt.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_slice", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit(_POSITION)))
    slices = placed.groupBy("branch", "_slice").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    own = Window.partitionBy("branch")
    before = own.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("branch", "_slice", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                           F.sum("_rows").over(own).alias("total"))
    out = placed.join(slices, ["branch", "_slice"]).withColumn("lo", F.col("_at") + F.col("_shift")).withColumn("hi", F.col("lo") + 1)
    return cut(out.drop("_at", "_slice", "_shift"))


def bucket(rank: Column, level: int) -> Column:
    """Number of the parent on ``level`` whose interval holds a rank."""
    return F.shiftright(rank, level * (RUN.bit_length() - 1))


def single(level: int) -> Column:
    """The branch has one node on ``level``."""
    return F.col("total") <= RUN ** level


def levels(leaves: DataFrame) -> list[DataFrame]:
    """Parents by level, from the leaves (branch, total, lo, hi, digest) up:
    (branch, total, lo, hi, digest, kids).  A branch ends with the level where it
    has one node."""
    most = leaves.agg(F.max("total").alias("most")).first()["most"] or 0
    out, below = [], leaves
    while most > RUN ** len(out):
        open_ = below.where(~single(len(out)))
        node = open_.groupBy("branch", bucket(F.col("lo"), len(out) + 1).alias("bucket")).agg(
            F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        below = cut(node.select("branch", "total", F.col("kids")[0]["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
                                hashed(F.array_join("kids.digest", "")).alias("digest"), "kids"))
        out.append(below)
    return out


def subroots(leaves: DataFrame, parents: list[DataFrame]) -> DataFrame:
    """(branch, digest) of each branch's topmost node."""
    tops = leaves.where(single(0)).select("branch", "digest")
    for level, nodes in enumerate(parents, 1):
        tops = tops.unionByName(nodes.where(single(level)).select("branch", "digest"))
    return tops


def attached(nodes: DataFrame, above: DataFrame, level: int) -> DataFrame:
    """``nodes`` with the path of each: its siblings below the parent on ``level``,
    then the parent's own path, and the parent's subroot."""
    above = above.select("branch", F.col("lo").alias("from"), F.col("hi").alias("to"), F.col("kids").alias("run"), "subroot",
                         F.col("path").alias("further"), bucket(F.col("lo"), level).alias("bucket"))
    joined = nodes.withColumn("bucket", bucket(F.col("lo"), level)).join(above, ["branch", "bucket"]).where("from <= lo and hi <= to")
    left = F.array_join(F.expr("transform(filter(run, k -> k.hi <= lo), k -> k.digest)"), "")
    right = F.array_join(F.expr("transform(filter(run, k -> k.lo >= hi), k -> k.digest)"), "")
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    return joined.withColumn("path", F.concat(step, "further").cast(PATH)).drop("bucket", "from", "to", "run", "further")


def with_paths(leaves: DataFrame, parents: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``leaves`` with path and subroot, from those of their branches' topmost
    nodes (``tops``: branch, path, subroot) downwards."""
    above = None
    for level in range(len(parents), -1, -1):
        nodes = parents[level - 1] if level else leaves
        here = nodes.where(single(level)).join(tops, "branch")
        if above is not None:
            here = here.unionByName(attached(nodes, above, level + 1))
        above = cut(here) if level else here
    return above


def proof(path: Column) -> Column:
    return hashed(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, digest, lambda own, s: hashed(F.concat(s["left"], own, s["right"])))


def manifest(df: DataFrame) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified.  ``folded_root`` starts from a tampered leaf where crc32 of the
    decimal id is a multiple of 3 (the text's A-Z lower-cased)."""
    fields = {c: F.col(c) for c in FIELDS}
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("s"), "lang"), F.lit("n")).alias("branch"),
                     leaf(*fields.values()).alias("digest"),
                     F.when(tampered, leaf(*{**fields, "text": lower_ascii(F.col("text"))}.values())).alias("tampered"))
    leaves = ranked(cut(rows), "doc_id", "digest")
    parents = levels(leaves)

    # The subroots are the leaves of one branch, in the order of their branches.
    names = ranked(subroots(leaves, parents).select(F.lit("").alias("branch"), F.col("branch").alias("name"), "digest"), "name")
    over = levels(names)
    root = subroots(names, over).first()
    root = F.lit(root["digest"] if root else None)
    start = df.sparkSession.createDataFrame([("", [], None)], f"branch string, path {PATH}, subroot string")
    tops = with_paths(names, over, start).select(F.col("name").alias("branch"), "path", F.col("digest").alias("subroot"))

    paths = with_paths(leaves, parents, cut(tops))
    out = paths.select("doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), proof(F.col("path")).alias("proof_sha256"),
                       folded(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: Levels written out in the SQL: enough for 8^9 leaves of a language.
SQL_LEVELS, SQL_TOP_LEVELS = 9, 4


def oracle() -> str:
    """The contract in DuckDB SQL: runs by integer division, one level after the
    other; a branch with one node left passes through."""
    def tree(name: str, first: str, depth: int) -> tuple[str, str]:
        sql = f",\n{name}0 AS MATERIALIZED ({first})"
        for k in range(1, depth + 1):
            sql += f""",
{name}{k} AS MATERIALIZED (SELECT branch, i // {RUN} AS i, CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest,
    (any_value(n) + {RUN - 1}) // {RUN} AS n, list(digest ORDER BY i) AS kids FROM {name}{k - 1} GROUP BY branch, i // {RUN})"""
        return sql, f"{name}{depth}"

    mark = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"
    fields = lambda text: " || ".join(mark.format(f"({x})") for x in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text))
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce({bits}, lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * {0xEDB88320}) END, {0xFFFFFFFF}::BIGINT), {0xFFFFFFFF})"
    leaves, top = tree("t", "SELECT branch, i, digest, n FROM ranked", SQL_LEVELS)
    subs, summit = tree("s", "SELECT '' AS branch, row_number() OVER (ORDER BY branch) - 1 AS i, digest, count(*) OVER () AS n FROM " + top, SQL_TOP_LEVELS)
    sql, at = leaves + subs + f""",
walk0 AS (SELECT r.*, b.i AS j, coalesce(tampered, digest) AS own, '' AS proof FROM ranked r JOIN (SELECT branch, row_number() OVER (ORDER BY branch) - 1 AS i FROM {top}) b USING (branch))""", "walk0"
    steps = [("t", k, "w.branch", "w.i") for k in range(1, SQL_LEVELS + 1)] + [("s", k, "''", "w.j") for k in range(1, SQL_TOP_LEVELS + 1)]
    for step, (name, k, branch, rank) in enumerate(steps, 1):
        place = f"(({rank} // {RUN ** (k - 1)}) % {RUN} + 1)"
        sql += f""",
walk{step} AS (SELECT w.* REPLACE (CASE WHEN p.one THEN w.own ELSE sha256(list_aggregate(kids[:{place} - 1] || [w.own] || kids[{place} + 1:], 'string_agg', '')) END AS own,
    CASE WHEN p.one THEN w.proof ELSE w.proof || coalesce(list_aggregate(kids[:{place} - 1] || kids[{place} + 1:], 'string_agg', ''), '') END AS proof)
    FROM {at} w JOIN (SELECT c.branch, c.i, c.kids, b.n = 1 AS one FROM {name}{k} c JOIN (SELECT DISTINCT branch, n FROM {name}{k - 1}) b USING (branch)) p ON p.branch = {branch} AND p.i = {rank} // {RUN ** k})"""
        at = f"walk{step}"
    return f"""
WITH docs AS (SELECT doc_id, coalesce('s' || lang, 'n') AS branch, sha256({fields('text')}) AS digest, CASE WHEN {crc} % 3 = 0 THEN sha256({fields(low)}) END AS tampered FROM documents),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY branch ORDER BY doc_id NULLS LAST, digest) - 1 AS i, count(*) OVER (PARTITION BY branch) AS n FROM docs){sql}
SELECT w.doc_id, w.digest AS leaf, t.digest AS subroot, s.digest AS root, sha256(w.proof) AS proof_sha256, w.own AS folded_root, w.own = s.digest AS verified
FROM {at} w JOIN {top} t ON t.branch = w.branch, {summit} s"""
