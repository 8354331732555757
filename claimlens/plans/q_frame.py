"""Sampling-frame queries (P01-P11) and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import PRODUCT_ID_PATTERNS, PRODUCT_URL_PREFIX
from ..operators import frame
from . import inputs as I
from .oracle import lit
from .registry import query

ID_PATTERNS = (*PRODUCT_ID_PATTERNS, I.PAGE_ID_PATTERN)
HEAD_N = 50


def _plan_df(spark, pairs):
    return spark.createDataFrame([(n, i, float(a)) for i, (n, a) in enumerate(pairs)],
                                 "stratum string, stratum_ord int, allocation double")


def _customer_totals(spark, sf_dir):
    fr = I.customer_frame(I.load(spark, sf_dir, "customer"))
    return fr.agg(F.count(F.when(F.col("cohort") == "R", 1)).alias("r_n"),
                  F.count(F.when(F.col("cohort") == "T", 1)).alias("t_n"),
                  F.countDistinct("stratum").alias("n_nodes")).first()


def _customer_quotas(spark, sf_dir):
    tot = _customer_totals(spark, sf_dir)
    plan = _plan_df(spark, I.SEGMENT_ALLOCATIONS)
    return plan.select("stratum", "stratum_ord", "allocation", F.lit(tot["r_n"]).cast("long").alias("target_n"),
                       frame.stratum_quota(F.lit(tot["r_n"]), F.col("allocation")).alias("quota"),
                       frame.node_quota(F.lit(tot["t_n"]), F.lit(tot["n_nodes"])).alias("node_quota"))


_PLAN_VALUES = ", ".join(f"({lit(n)}, {i}, {a}::DOUBLE)" for i, (n, a) in enumerate(I.SEGMENT_ALLOCATIONS))
_CUST_CTE = f"""tot AS (
  SELECT count(*) FILTER (WHERE c_custkey % 4 <> 0) AS r_n, count(*) FILTER (WHERE c_custkey % 4 = 0) AS t_n,
         count(DISTINCT c_mktsegment) AS n_nodes FROM customer),
plan AS (SELECT * FROM (VALUES {_PLAN_VALUES}) t(stratum, stratum_ord, allocation)),
q AS (
  SELECT stratum, stratum_ord::INTEGER AS stratum_ord, allocation, r_n::BIGINT AS target_n,
         trunc(r_n::DOUBLE * allocation)::INTEGER AS quota, greatest(1, t_n // n_nodes)::BIGINT AS node_quota
  FROM plan, tot)"""


@query("quota_allocation", f"WITH {_CUST_CTE} SELECT * FROM q")
def quota_allocation(spark, sf_dir):
    """P01 + P04: stratum quotas (DOUBLE truncation) and the per-node quota."""
    return _customer_quotas(spark, sf_dir)


@query("plan_slots_r", f"""WITH {_CUST_CTE},
s AS (SELECT stratum, stratum_ord, unnest(range(quota)) AS slot_ord FROM q)
SELECT printf('R%s%05d', upper(substr(stratum, 1, 3)), slot_ord) AS asin,
       {lit(PRODUCT_URL_PREFIX)} || printf('R%s%05d', upper(substr(stratum, 1, 3)), slot_ord) AS url,
       'R' AS cohort, 'placeholder' AS method, stratum AS category_hint, stratum, stratum_ord, slot_ord
FROM s""")
def plan_slots_r(spark, sf_dir):
    """Placeholder slots of the R cohort (quota per segment)."""
    q = _customer_quotas(spark, sf_dir).select("stratum", "stratum_ord", "quota")
    return frame.expand_slots(spark, q, "R")


@query("plan_slots_t", f"""WITH k AS (
  SELECT c_mktsegment AS node, c_name AS keyword,
         row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS slot_ord FROM customer)
SELECT printf('T%s%05d', upper(substr(node, 1, 3)), slot_ord) AS asin,
       {lit(PRODUCT_URL_PREFIX)} || printf('T%s%05d', upper(substr(node, 1, 3)), slot_ord) AS url,
       'T' AS cohort, 'placeholder' AS method, node AS category_hint, node AS stratum, keyword, slot_ord
FROM k WHERE slot_ord < 5""")
def plan_slots_t(spark, sf_dir):
    """First five keywords per node (node = segment, keywords = customer
    names in key order), one slot each."""
    c = I.load(spark, sf_dir, "customer")
    kw = c.select(F.col("c_mktsegment").alias("node"), F.col("c_name").alias("keyword"),
                  F.col("c_custkey").alias("keyword_ord"))
    return frame.expand_keyword_slots(kw, 5, "T")


def _id_sql(url: str) -> str:
    tries = ", ".join(f"nullif(regexp_extract({url}, {lit(p)}, 1), '')" for p in ID_PATTERNS)
    return f"coalesce({tries}, '')"


@query("url_id_extract", f"""SELECT page_id, {_id_sql('url')} AS product_id,
       CASE WHEN {_id_sql('url')} <> '' THEN {lit(PRODUCT_URL_PREFIX)} || {_id_sql('url')} END AS product_url
FROM pages""")
def url_id_extract(spark, sf_dir):
    """P05 + P06: ordered id patterns (first match wins, miss = '') and the
    canonical URL."""
    p = I.load(spark, sf_dir, "pages")
    pid = frame.extract_product_id(F.col("url"), ID_PATTERNS)
    return p.select("page_id", pid.alias("product_id"),
                    F.when(pid != "", frame.product_url(pid)).alias("product_url"))


def _r_results(spark, sf_dir):
    res = I.search_results_r(I.load(spark, sf_dir, "pages"))
    return res.withColumn("asin", frame.extract_product_id(F.col("link"), ID_PATTERNS))


_RES_CTE = f"""res AS (
  SELECT regexp_extract(url, {lit(I.LANG_PATTERN)}, 1) AS stratum, page_id AS rank, url AS link,
         {_id_sql('url')} AS asin FROM pages)"""


@query("frame_harvest_simple", f"""WITH {_RES_CTE}
SELECT stratum, asin, min(rank) AS rank FROM res WHERE asin <> '' GROUP BY stratum, asin""")
def frame_harvest_simple(spark, sf_dir):
    """Dedupe within each stratum's results only."""
    return frame.harvest_simple(_r_results(spark, sf_dir)).select("stratum", "asin", "rank")


def _lang_quotas(spark, sf_dir):
    n = I.load(spark, sf_dir, "pages").count()
    plan = _plan_df(spark, I.LANG_STRATA)
    q = plan.select("stratum", frame.stratum_quota(F.lit(n), F.col("allocation")).alias("quota")).collect()
    return [(r["stratum"], r["quota"]) for r in q]   # plan-sized


def r_harvest(spark, sf_dir):
    res = _r_results(spark, sf_dir)
    picked = frame.harvest_greedy(res, _lang_quotas(spark, sf_dir))
    return picked.select("asin", frame.product_url(F.col("asin")).alias("url"), F.lit("R").alias("cohort"),
                         F.lit("search").alias("method"), F.col("stratum").alias("category_hint"), "stratum",
                         "rank", "group_ord", "pick_ord")


def _greedy_sql(res: str, groups, group_col: str, order: str, quota_sql, prefix: str) -> str:
    """Chained CTEs: one per group, each excluding the ids of earlier groups."""
    ctes, names = [], []
    for i, g in enumerate(groups):
        prior = " ".join(f"AND asin NOT IN (SELECT asin FROM {prefix}{j})" for j in range(i))
        ctes.append(f"""{prefix}{i} AS (
  SELECT *, {i} AS group_ord FROM (
    SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS pick_ord FROM (
      SELECT *, row_number() OVER (PARTITION BY asin ORDER BY {order}) AS _first
      FROM {res} WHERE {group_col} = {lit(g)} AND asin <> '' {prior}) WHERE _first = 1)
  WHERE pick_ord < {quota_sql(g)})""")
        names.append(f"SELECT * FROM {prefix}{i}")
    return ",\n".join(ctes), " UNION ALL ".join(names)


_R_CTES, _R_UNION = _greedy_sql(
    "res", [s for s, _ in I.LANG_STRATA], "stratum", "rank",
    lambda s: f"(SELECT trunc(count(*)::DOUBLE * {dict(I.LANG_STRATA)[s]}::DOUBLE)::BIGINT FROM pages)", "rg")
_R_SQL_CTE = f"""{_RES_CTE},
{_R_CTES},
rpick AS ({_R_UNION})"""


@query("frame_harvest_greedy", f"""WITH {_R_SQL_CTE}
SELECT asin, {lit(PRODUCT_URL_PREFIX)} || asin AS url, 'R' AS cohort, 'search' AS method,
       stratum AS category_hint, stratum, rank, group_ord, pick_ord FROM rpick""")
def frame_harvest_greedy(spark, sf_dir):
    """Greedy representative harvest (strata in plan order, ranks in
    order, dedupe against every earlier kept id, quota per stratum)."""
    return r_harvest(spark, sf_dir)


def t_harvest(spark, sf_dir):
    res = I.search_results_t(I.load(spark, sf_dir, "pages"))
    res = frame.cap_per_keyword(res).withColumn("asin", frame.extract_product_id(F.col("link"), ID_PATTERNS))
    res = res.withColumn("korder", frame.keyword_order(F.col("keyword_ord"), F.col("rank")))
    nodes = [s for s, _ in I.LANG_STRATA]
    quota = max(1, I.T_FIXTURE_TARGET // len(nodes))
    picked = frame.harvest_greedy(res, [(n, quota) for n in nodes], group_col="node", order_col="korder")
    return picked.select("asin", frame.product_url(F.col("asin")).alias("url"), F.lit("T").alias("cohort"),
                         F.lit("keyword").alias("method"), F.col("node").alias("category_hint"),
                         F.col("node").alias("stratum"), "keyword", "rank", "group_ord", "pick_ord")


_TLDS = ", ".join(lit(k) for k in I.TLD_KEYWORDS)
_T_QUOTA = max(1, I.T_FIXTURE_TARGET // len(I.LANG_STRATA))
_T_CTES, _T_UNION = _greedy_sql("tcap", [s for s, _ in I.LANG_STRATA], "node", "keyword_ord, rank",
                                lambda s: str(_T_QUOTA), "tg")
_T_SQL_CTE = f"""tres AS (
  SELECT regexp_extract(url, {lit(I.LANG_PATTERN)}, 1) AS node,
         regexp_extract(regexp_extract(url, {lit(I.HOST_PATTERN)}, 1), '\\.([a-z]+)$', 1) AS keyword,
         page_id AS rank, url AS link, {_id_sql('url')} AS asin FROM pages),
tcap AS (
  SELECT * FROM (
    SELECT *, list_position([{_TLDS}], keyword) AS keyword_ord,
           row_number() OVER (PARTITION BY node, keyword ORDER BY rank) AS _k
    FROM tres WHERE list_position([{_TLDS}], keyword) > 0) WHERE _k <= 10),
{_T_CTES},
tpick AS ({_T_UNION})"""


@query("frame_harvest_targeted", f"""WITH {_T_SQL_CTE}
SELECT asin, {lit(PRODUCT_URL_PREFIX)} || asin AS url, 'T' AS cohort, 'keyword' AS method,
       node AS category_hint, node AS stratum, keyword, rank, group_ord, pick_ord FROM tpick""")
def frame_harvest_targeted(spark, sf_dir):
    """Nodes in order, keywords in order (10 results each), dedupe across
    nodes, per-node quota."""
    return t_harvest(spark, sf_dir)


def _frame(spark, sf_dir):
    r = r_harvest(spark, sf_dir).drop("rank")
    t = t_harvest(spark, sf_dir).drop("rank", "keyword")
    return frame.frame_union(r, t)


_FRAME_SQL = f"""WITH {_R_SQL_CTE}, {_T_SQL_CTE},
fr AS (
  SELECT asin, {lit(PRODUCT_URL_PREFIX)} || asin AS url, 'R' AS cohort, 'search' AS method,
         stratum AS category_hint, stratum, group_ord, pick_ord, 0 AS cohort_ord FROM rpick
  UNION ALL
  SELECT asin, {lit(PRODUCT_URL_PREFIX)} || asin AS url, 'T' AS cohort, 'keyword' AS method,
         node AS category_hint, node AS stratum, group_ord, pick_ord, 1 AS cohort_ord FROM tpick)"""


@query("url_frame", f"{_FRAME_SQL} SELECT * FROM fr")
def url_frame(spark, sf_dir):
    """P10: R rows then T rows, UNION ALL (ids may repeat across cohorts)."""
    return _frame(spark, sf_dir)


@query("frame_head", f"{_FRAME_SQL} SELECT * FROM fr ORDER BY cohort_ord, group_ord, pick_ord LIMIT {HEAD_N}")
def frame_head(spark, sf_dir):
    """The first ``HEAD_N`` frame rows (sample size), R first."""
    return frame.frame_head(_frame(spark, sf_dir), HEAD_N)
