"""Correlation, association and test queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import stats
from quarry.plans.registry import query
from quarry.sources.tables import Tables

# Numeric stand-in columns for the correlation matrix; ``zero_flag`` is a
# constant column, whose correlations are undefined and reported as 0.
_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "zero_flag"]
_CORR_SELECT = ("l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber, "
                "CASE WHEN l_quantity > 1000 THEN 1.0 ELSE 0.0 END AS zero_flag")


def _corr_input(t):
    return t.lineitem.select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber",
                             F.when(F.col("l_quantity") > 1000, 1.0).otherwise(0.0).alias("zero_flag"))


def _corr_sql(pairs_filter: str = "", top: str = "") -> str:
    cols = _CORR_COLS
    means = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}" for i, c in enumerate(cols))
    dev = ", ".join(f"CAST({c} AS DOUBLE) - m{i} AS d{i}" for i, c in enumerate(cols))
    sums = ", ".join(f"sum(d{i} * d{j}) AS s{i}_{j}" for i in range(len(cols)) for j in range(i, len(cols)))
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            lo, hi = min(i, j), max(i, j)
            rows.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {i} AS pos_a, {j} AS pos_b, "
                        f"coalesce(round(CASE WHEN s{i}_{i} * s{j}_{j} = 0 THEN NULL "
                        f"ELSE s{lo}_{hi} / sqrt(s{i}_{i} * s{j}_{j}) END, 4), 0.0) AS corr FROM s")
    return f"""
WITH x AS (SELECT {_CORR_SELECT} FROM lineitem),
m AS (SELECT {means} FROM x),
d AS (SELECT {dev} FROM x, m),
s AS (SELECT {sums} FROM d),
allp AS ({" UNION ALL ".join(rows)})
{top or 'SELECT * FROM allp'}"""


@query("agg_corr_matrix", "A16 J9", oracle=_corr_sql())
def agg_corr_matrix(spark, sf_dir):
    return stats.corr_matrix(_corr_input(Tables(spark, sf_dir)), _CORR_COLS)


@query("agg_corr_top_pairs", "A17", oracle=_corr_sql(top="""
SELECT col_a, col_b, pos_a, pos_b, corr,
       CAST(row_number() OVER (ORDER BY abs(corr) DESC, pos_a, pos_b) AS INTEGER) AS rank
FROM allp WHERE pos_a < pos_b ORDER BY abs(corr) DESC, pos_a, pos_b LIMIT 15"""))
def agg_corr_top_pairs(spark, sf_dir):
    return stats.corr_top_pairs(_corr_input(Tables(spark, sf_dir)), _CORR_COLS, 15)


@query("agg_corr_pair", "A15", oracle="""
WITH m AS (SELECT avg(o_totalprice) AS mx, avg(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1) AS my FROM orders),
s AS (SELECT sum((o_totalprice - mx) * (CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 - my)) AS sxy,
             sum((o_totalprice - mx) * (o_totalprice - mx)) AS sxx,
             sum((CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 - my)
               * (CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 - my)) AS syy FROM orders, m)
SELECT round(CASE WHEN sxx * syy = 0 THEN NULL ELSE sxy / sqrt(sxx * syy) END, 4) AS corr FROM s""")
def agg_corr_pair(spark, sf_dir):
    """Correlation of order price with the outcome code."""
    from quarry.plans.common import outcome
    o = Tables(spark, sf_dir).orders.select("o_totalprice", outcome())
    return stats.corr_pair(o, "o_totalprice", "outcome")


def _cramers_sql(table_sql: str, pairs: list[tuple[str, str]], keyed: bool) -> str:
    parts = []
    for a, b in pairs:
        key = f"'{a}' AS col_a, '{b}' AS col_b, " if keyed else ""
        parts.append(f"""
SELECT {key}chi2, cramers_v FROM (
  WITH cells AS (SELECT CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b, count(*) AS O FROM ({table_sql})
                 WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL),
  rs AS (SELECT a, sum(O) AS rs FROM cells GROUP BY a), cs AS (SELECT b, sum(O) AS cs FROM cells GROUP BY b),
  n AS (SELECT sum(O) AS n, (SELECT count(*) FROM rs) AS r, (SELECT count(*) FROM cs) AS k FROM cells),
  grid AS (SELECT rs.a, cs.b, rs.rs * cs.cs / n.n AS E, coalesce(cells.O, 0) AS O
           FROM rs CROSS JOIN cs CROSS JOIN n LEFT JOIN cells ON cells.a = rs.a AND cells.b = cs.b),
  chi AS (SELECT sum(CASE WHEN (n.r - 1) * (n.k - 1) = 1
                 THEN pow(O + least(0.5, abs(E - O)) * sign(E - O) - E, 2) / E
                 ELSE pow(O - E, 2) / E END) AS chi2, any_value(n.n) AS n, any_value(n.r) AS r,
                 any_value(n.k) AS k FROM grid, n)
  SELECT round(chi2, 4) AS chi2,
         round(sqrt(greatest(0.0, chi2 / n - (k - 1) * (r - 1) / (n - 1))
                    / nullif(least((k - pow(k - 1, 2) / (n - 1)) - 1, (r - pow(r - 1, 2) / (n - 1)) - 1), 0)), 4)
           AS cramers_v FROM chi)""")
    return " UNION ALL ".join(parts)


@query("stat_cramers_v", "T1 D2", oracle=_cramers_sql("SELECT * FROM orders",
                                                      [("o_orderpriority", "o_orderstatus")], False))
def stat_cramers_v(spark, sf_dir):
    return stats.cramers_v(Tables(spark, sf_dir).orders, "o_orderpriority", "o_orderstatus")


@query("stat_cramers_v_2x2", "T1", oracle=_cramers_sql(
    "SELECT l_returnflag = 'R' AS is_r, l_linestatus FROM lineitem", [("is_r", "l_linestatus")], False))
def stat_cramers_v_2x2(spark, sf_dir):
    """2×2 table (Yates' correction path): returned-flag vs line status."""
    li = Tables(spark, sf_dir).lineitem.select((F.col("l_returnflag") == "R").cast("string").alias("is_r"),
                                               "l_linestatus")
    return stats.cramers_v(li, "is_r", "l_linestatus")


_CAT_COLS = ["o_orderpriority", "o_orderstatus", "c_mktsegment", "n_name", "r_name", "order_year"]
_CAT_SQL = """SELECT o.o_orderpriority, o.o_orderstatus, c.c_mktsegment, n.n_name, r.r_name,
                     CAST(year(o.o_orderdate) AS VARCHAR) AS order_year
              FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
              JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""


def _cat_input(t):
    o = t.orders.select("o_custkey", "o_orderpriority", "o_orderstatus",
                        F.year("o_orderdate").cast("string").alias("order_year"))
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return o.join(c, "o_custkey").join(n, "c_nationkey").join(r, "n_regionkey")


def _matrix_sql():
    pairs = [(a, b) for i, a in enumerate(_CAT_COLS) for b in _CAT_COLS[i + 1:]]
    body = _cramers_sql(_CAT_SQL, pairs, True)
    diag = " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0" for c in _CAT_COLS)
    return f"""
WITH v AS ({body})
SELECT col_a, col_b, cramers_v FROM v UNION ALL SELECT col_b, col_a, cramers_v FROM v
UNION ALL {diag}"""


@query("stat_cramers_matrix", "T2", oracle=_matrix_sql())
def stat_cramers_matrix(spark, sf_dir):
    return stats.cramers_matrix(_cat_input(Tables(spark, sf_dir)), _CAT_COLS)


def _anova_sql(factors, target, table):
    parts = []
    for f in factors:
        parts.append(f"""
SELECT '{f}' AS factor, CAST(count(*) - 1 AS BIGINT) AS df_between, CAST(any_value(n_all) - count(*) AS BIGINT) AS df_within,
       round((sum(n * pow(m - gm, 2)) / (count(*) - 1)) / (sum(ss - s * m) / (any_value(n_all) - count(*))), 4) AS f_stat
FROM (SELECT {f}, count(*) AS n, avg(y) AS m, sum(y * y) AS ss, sum(y) AS s FROM t
      WHERE {f} IS NOT NULL GROUP BY {f}) g,
     (SELECT count(*) AS n_all, avg(y) AS gm FROM t) a""")
    return f"WITH t AS (SELECT *, CAST({target} AS DOUBLE) AS y FROM ({table}) WHERE {target} IS NOT NULL) " + \
        " UNION ALL ".join(parts)


@query("stat_anova", "T3", oracle=_anova_sql(["o_orderpriority", "o_orderstatus", "c_mktsegment"],
                                            "o_totalprice", """
SELECT o.o_orderpriority, o.o_orderstatus, c.c_mktsegment, o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""))
def stat_anova(spark, sf_dir):
    """One-way F of order price across priority, status and market segment."""
    t = Tables(spark, sf_dir)
    df = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    return stats.anova(df, ["o_orderpriority", "o_orderstatus", "c_mktsegment"], "o_totalprice")


@query("stat_anova_pvalue", "T3")
def stat_anova_pvalue(spark, sf_dir):
    """ANOVA F with its upper-tail p-value (F distribution, Arrow UDF over one
    row per factor) and a significance flag at 0.05."""
    t = Tables(spark, sf_dir)
    df = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    out = stats.anova(df, ["o_orderpriority", "o_orderstatus", "c_mktsegment"], "o_totalprice", with_p=True)
    return out.withColumn("significant", F.col("p_value") < 0.05)
