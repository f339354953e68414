"""Group similarity / cluster queries.

Stand-in: line items joined with their part (brand = group) and order
(outcome), type = line status; five numeric metrics standardised globally.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import crosstab as ct
from quarry.operators import similarity as sim
from quarry.operators.features import standardize
from quarry.operators.rank import attach
from quarry.plans.common import OUTCOME_DOMAIN, OUTCOME_SQL, outcome
from quarry.plans.registry import query
from quarry.sources.tables import Tables

METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
MIN_SAMPLES, TOP_N = 10, 20


def merged(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linestatus",
                           *[F.col(c).cast("double").alias(c) for c in METRICS])
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), outcome())
    return li.join(p, "l_partkey").join(o, "l_orderkey")


def means(t: Tables):
    return sim.group_means(standardize(merged(t), METRICS), "l_linestatus", "p_brand", METRICS,
                           MIN_SAMPLES, TOP_N)


MERGED_SQL = f"""
SELECT l.l_linestatus, p.p_brand, {OUTCOME_SQL} AS outcome,
       {", ".join(f"CAST(l.{c} AS DOUBLE) AS {c}" for c in METRICS)}
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey"""
STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in METRICS)
SCALED = ", ".join(f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0.0 END AS {c}" for c in METRICS)
MEANS_SQL = f"""
WITH m AS ({MERGED_SQL}), st AS (SELECT {STATS} FROM m),
z AS (SELECT l_linestatus, p_brand, outcome, {SCALED} FROM m, st),
g AS (SELECT l_linestatus, p_brand, count(*) AS n, {", ".join(f"avg({c}) AS {c}" for c in METRICS)}
      FROM z GROUP BY ALL HAVING count(*) >= {MIN_SAMPLES}),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus ORDER BY n DESC, p_brand) AS group_rank
        FROM g) WHERE group_rank <= {TOP_N}),
u AS (SELECT *, sqrt({" + ".join(f"{c} * {c}" for c in METRICS)}) AS nrm FROM top)"""


def _cos_sql(cond: str) -> str:
    dot = " + ".join(f"(a.{c} / greatest(a.nrm, 1e-9)) * (b.{c} / greatest(b.nrm, 1e-9))" for c in METRICS)
    return f"round(least(greatest({dot}, -1.0), 1.0), 4)"


@query("sim_cosine_groups", "G1 A35 E2 F11", oracle=MEANS_SQL + f"""
SELECT a.l_linestatus, a.p_brand AS group_a, b.p_brand AS group_b, {_cos_sql('')} AS cosine
FROM u a JOIN u b ON a.l_linestatus = b.l_linestatus""")
def sim_cosine_groups(spark, sf_dir):
    """Cosine similarity between the mean standardised vectors of the top
    brands inside each line status."""
    m = means(Tables(spark, sf_dir))
    return sim.cosine_pairs(m, m, "p_brand", "p_brand", on="l_linestatus")


@query("sim_cosine_cross", "G2 J10", oracle=MEANS_SQL + f"""
SELECT a.p_brand AS group_a, b.p_brand AS group_b, {_cos_sql('')} AS cosine
FROM u a JOIN u b ON a.l_linestatus = 'F' AND b.l_linestatus = 'O'""")
def sim_cosine_cross(spark, sf_dir):
    """Cosine between every top brand of status F and every top brand of status O."""
    m = means(Tables(spark, sf_dir))
    return sim.cosine_pairs(m.where(F.col("l_linestatus") == "F"), m.where(F.col("l_linestatus") == "O"),
                            "p_brand", "p_brand")


# Fixed cluster assignment for the SQL-checked cluster reports: the brand's
# manufacturer digit ('Brand#23' → 2).
def _cluster(col="p_brand"):
    return F.substring(F.col(col), 7, 1).cast("int").alias("cluster")


@query("cluster_profiles", "G5", oracle=MEANS_SQL + f"""
SELECT l_linestatus, CAST(substr(p_brand, 7, 1) AS INTEGER) AS cluster,
       {", ".join(f"round(avg({c}), 4) AS {c}" for c in METRICS)} FROM top GROUP BY ALL""")
def cluster_profiles(spark, sf_dir):
    m = means(Tables(spark, sf_dir)).withColumn("cluster", _cluster())
    return sim.cluster_profiles(m, "l_linestatus", "cluster", METRICS)


_TOP_ROWS_SQL = MEANS_SQL + """,
rows_top AS (SELECT z.l_linestatus, z.p_brand, CAST(substr(z.p_brand, 7, 1) AS INTEGER) AS cluster, z.outcome
             FROM z JOIN top USING (l_linestatus, p_brand))"""


def _rows_top(t: Tables):
    m = means(t).select("l_linestatus", "p_brand")
    rows = merged(t).select("l_linestatus", "p_brand", "outcome")
    return rows.join(F.broadcast(m), ["l_linestatus", "p_brand"], "left_semi")  # ≤ 2·TOP_N groups


def _ct_sql(labels: list[str]) -> str:
    lab = ", ".join(labels)
    on = " AND ".join(f"c.{x} = w.{x}" for x in labels)
    return f""",
w AS (SELECT {lab}, count(*) AS label_count, count(outcome) AS n_outcome FROM rows_top GROUP BY ALL),
cells AS (SELECT {lab}, outcome, count(*) AS c FROM rows_top GROUP BY ALL)
SELECT {", ".join('w.' + x for x in labels)}, d.outcome, CAST(coalesce(c.c, 0) AS BIGINT) AS cnt,
       coalesce(round(coalesce(c.c, 0) / w.n_outcome, 4), 0.0) AS pct, CAST(w.label_count AS BIGINT) AS label_count
FROM w CROSS JOIN (SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS outcome) d
LEFT JOIN cells c ON {on} AND c.outcome = d.outcome"""


@query("cluster_outcome_crosstab", "G6", oracle=_TOP_ROWS_SQL + _ct_sql(["l_linestatus", "cluster"]))
def cluster_outcome_crosstab(spark, sf_dir):
    rows = _rows_top(Tables(spark, sf_dir)).withColumn("cluster", _cluster())
    return ct.crosstab_full(rows, ["l_linestatus", "cluster"], "outcome", OUTCOME_DOMAIN)


@query("group_outcome_crosstab", "G7 A20", oracle=_TOP_ROWS_SQL + _ct_sql(["l_linestatus", "p_brand"]))
def group_outcome_crosstab(spark, sf_dir):
    rows = _rows_top(Tables(spark, sf_dir))
    return ct.crosstab_full(rows, ["l_linestatus", "p_brand"], "outcome", OUTCOME_DOMAIN)


@query("agg_breed_insight", "A40", oracle=_TOP_ROWS_SQL + """,
s AS (SELECT l_linestatus, p_brand, avg(CASE WHEN outcome <= 1 THEN 1.0 ELSE 0.0 END) AS fast,
             avg(CASE WHEN outcome >= 3 THEN 1.0 ELSE 0.0 END) AS slow FROM rows_top GROUP BY ALL)
SELECT l_linestatus,
       (SELECT p_brand FROM s s2 WHERE s2.l_linestatus = s.l_linestatus ORDER BY fast DESC, p_brand LIMIT 1) AS fastest_group,
       round(max(fast), 4) AS fastest_share,
       (SELECT p_brand FROM s s2 WHERE s2.l_linestatus = s.l_linestatus ORDER BY slow DESC, p_brand LIMIT 1) AS slowest_group,
       round(max(slow), 4) AS slowest_share
FROM s GROUP BY l_linestatus""")
def agg_breed_insight(spark, sf_dir):
    """Per type: the group with the highest share of fast outcomes (≤1) and of slow ones (≥3)."""
    rows = _rows_top(Tables(spark, sf_dir))
    s = rows.groupBy("l_linestatus", "p_brand").agg(
        F.avg((F.col("outcome") <= 1).cast("double")).alias("fast"),
        F.avg((F.col("outcome") >= 3).cast("double")).alias("slow"))
    # max_by with a (share, reversed name) key: highest share, then smallest name.
    return s.groupBy("l_linestatus").agg(
        F.min_by("p_brand", F.struct(-F.col("fast"), F.col("p_brand"))).alias("fastest_group"),
        F.round(F.max("fast"), 4).alias("fastest_share"),
        F.min_by("p_brand", F.struct(-F.col("slow"), F.col("p_brand"))).alias("slowest_group"),
        F.round(F.max("slow"), 4).alias("slowest_share"))


@query("agg_mixed_clusters", "A41", oracle=MEANS_SQL + """
SELECT CAST(count_if(t >= 2) AS BIGINT) AS mixed_clusters, count(*) AS clusters FROM (
  SELECT substr(p_brand, 7, 1) AS cluster, count(DISTINCT l_linestatus) AS t FROM top GROUP BY ALL)""")
def agg_mixed_clusters(spark, sf_dir):
    m = means(Tables(spark, sf_dir)).withColumn("cluster", _cluster())
    return sim.mixed_clusters(m, "cluster", "l_linestatus")


@query("sim_sorted_by_cluster", "K7", oracle=MEANS_SQL + f""",
place AS (SELECT l_linestatus, p_brand, CAST(substr(p_brand, 7, 1) AS INTEGER) AS cluster,
                 row_number() OVER (PARTITION BY l_linestatus ORDER BY CAST(substr(p_brand, 7, 1) AS INTEGER), p_brand) AS pos
          FROM top)
SELECT a.l_linestatus, a.p_brand AS group_a, b.p_brand AS group_b, pa.cluster AS cluster_a, pb.cluster AS cluster_b,
       CAST(pa.pos AS INTEGER) AS pos_a, CAST(pb.pos AS INTEGER) AS pos_b, {_cos_sql('')} AS cosine
FROM u a JOIN u b ON a.l_linestatus = b.l_linestatus
JOIN place pa ON pa.l_linestatus = a.l_linestatus AND pa.p_brand = a.p_brand
JOIN place pb ON pb.l_linestatus = b.l_linestatus AND pb.p_brand = b.p_brand""")
def sim_sorted_by_cluster(spark, sf_dir):
    """Similarity matrix of each line status with rows and columns in the order
    of (cluster, brand)."""
    m = means(Tables(spark, sf_dir))
    pairs = sim.cosine_pairs(m, m, "p_brand", "p_brand", on="l_linestatus")
    return sim.order_by_cluster(pairs, m.withColumn("cluster", _cluster()), "p_brand", "cluster", "l_linestatus")


@query("cluster_by_type", "G3")
def cluster_by_type(spark, sf_dir):
    """Divisive clustering of the top-brand mean vectors of each status by itself, k = 5."""
    c = sim.cluster_groups(means(Tables(spark, sf_dir)), "l_linestatus", 5)
    return (c.groupBy("l_linestatus", "cluster")
            .agg(F.count(F.lit(1)).alias("size"), F.array_sort(F.collect_list("p_brand")).alias("members")))


@query("cluster_group_vectors", "G4")
def cluster_group_vectors(spark, sf_dir):
    """Divisive clustering (bisecting k-means, k = 5) of the top-brand mean
    vectors of both statuses together, with member lists per cluster."""
    m = means(Tables(spark, sf_dir))
    c = sim.cluster_groups(m, [], 5)
    return (c.groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("size"),
                 F.array_sort(F.collect_list(F.struct("p_brand", "l_linestatus"))).alias("members"))
            .orderBy("cluster"))
