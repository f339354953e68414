"""Tabular EDA queries: crosstabs, profiles, value counts, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import crosstab as ct
from quarry.plans.common import (ORDERS_BY_NATION_SQL, OUTCOME_DOMAIN, OUTCOME_SQL,
                                 orders_by_nation, outcome)
from quarry.plans.registry import query
from quarry.sources.tables import Tables

_DOMAIN_SQL = "(SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS outcome)"


def _crosstab_sql(base: str, labels: list[str], filt: str = "", top: str = "") -> str:
    """Oracle for a long-form crosstab with fixed outcome domain 0-4."""
    lab = ", ".join(labels)
    on = " AND ".join(f"c.{x} IS NOT DISTINCT FROM t.{x}" for x in labels)
    return f"""
WITH base AS ({base}),
w AS (SELECT {lab}, count(*) AS label_count, count(outcome) AS n_outcome
      FROM base WHERE {labels[-1]} IS NOT NULL {filt} GROUP BY {lab}),
t AS ({top or 'SELECT * FROM w'}),
cells AS (SELECT {lab}, outcome, count(*) AS c FROM base GROUP BY ALL)
SELECT {", ".join('t.' + x for x in labels)}{', CAST(t.label_rank AS INTEGER) AS label_rank' if top else ''}, d.outcome,
       CAST(coalesce(c.c, 0) AS BIGINT) AS cnt,
       coalesce(round(coalesce(c.c, 0) / t.n_outcome, 4), 0.0) AS pct,
       CAST(t.label_count AS BIGINT) AS label_count
FROM t CROSS JOIN {_DOMAIN_SQL} d
LEFT JOIN cells c ON {on} AND c.outcome = d.outcome
"""


@query("agg_crosstab_topk", "A21 J1 K3 P8 W4", oracle=_crosstab_sql(
    ORDERS_BY_NATION_SQL, ["n_name"],
    top="SELECT *, row_number() OVER (ORDER BY label_count DESC, n_name) AS label_rank "
        "FROM w ORDER BY label_count DESC, n_name LIMIT 10"))
def agg_crosstab_topk(spark, sf_dir):
    """Outcome mix (order priority) for the 10 customer nations with most orders."""
    base = orders_by_nation(Tables(spark, sf_dir))
    return ct.crosstab_topk(base, "n_name", "outcome", OUTCOME_DOMAIN, 10, weight="n")


# --------------------------------------------------------------------------
# Fixed values (display names of the five outcome codes, as reported).
# --------------------------------------------------------------------------
OUTCOME_NAMES = {0: "Same Day", 1: "First Week", 2: "First Month", 3: "2nd-3rd Month",
                 4: "No Adoption"}
STATUS_NAMES = {"F": "Fulfilled", "O": "Open"}   # two-way "type" stand-in


def _case_sql(col: str, mapping: dict, default: str = "Unknown") -> str:
    whens = " ".join(f"WHEN {col} = {ct._lit_sql(k)} THEN {ct._lit_sql(v)}" for k, v in mapping.items())
    return f"coalesce(CASE {whens} END, {ct._lit_sql(default)})"


@query("agg_crosstab_full", "A19", oracle=_crosstab_sql(
    f"SELECT {_case_sql('o_orderstatus', STATUS_NAMES)} AS status_name, {OUTCOME_SQL} AS outcome "
    "FROM orders", ["status_name"]))
def agg_crosstab_full(spark, sf_dir):
    """Type (order status, unknown codes → 'Unknown') × outcome, row %, 0 fill."""
    from quarry.functions.scalar import code_labels
    o = Tables(spark, sf_dir).orders
    base = o.select(code_labels("o_orderstatus", STATUS_NAMES).alias("status_name"), outcome())
    return ct.crosstab_full(base, "status_name", "outcome", OUTCOME_DOMAIN)


@query("agg_crosstab_rowpct", "A18", oracle=f"""
WITH base AS (SELECT o_orderstatus, {OUTCOME_SQL} AS outcome FROM orders),
cells AS (SELECT o_orderstatus, outcome, count(*) AS cnt FROM base
          WHERE o_orderstatus IS NOT NULL AND outcome IS NOT NULL GROUP BY ALL),
tot AS (SELECT o_orderstatus, sum(cnt) AS label_count FROM cells GROUP BY ALL)
SELECT c.o_orderstatus, c.outcome, c.cnt, round(c.cnt / t.label_count, 4) AS pct,
       CAST(t.label_count AS BIGINT) AS label_count
FROM cells c JOIN tot t USING (o_orderstatus)""")
def agg_crosstab_rowpct(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return ct.crosstab_rowpct(o.select("o_orderstatus", outcome()), "o_orderstatus", "outcome")


_TYPE_NATION_SQL = f"""
  SELECT o.o_orderstatus, coalesce(n.n_name, 'Unknown') AS n_name, {OUTCOME_SQL} AS outcome
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderstatus IN ('F', 'O')"""


@query("agg_crosstab_topk_by_type", "A20", oracle=_crosstab_sql(
    _TYPE_NATION_SQL, ["o_orderstatus", "n_name"],
    top="SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus "
        "ORDER BY label_count DESC, n_name) AS label_rank FROM w) WHERE label_rank <= 15"))
def agg_crosstab_topk_by_type(spark, sf_dir):
    """Top-15 customer nations inside each order type, outcome row %."""
    t = Tables(spark, sf_dir)
    per_cust = (t.orders.where(F.col("o_orderstatus").isin("F", "O"))
                .select("o_orderstatus", "o_custkey", outcome())
                .groupBy("o_orderstatus", "o_custkey", "outcome").agg(F.count(F.lit(1)).alias("n")))
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    base = (per_cust.join(cust, "o_custkey").join(nation, "c_nationkey", "left")
            .select("o_orderstatus", F.coalesce("n_name", F.lit("Unknown")).alias("n_name"),
                    "outcome", "n"))
    return ct.crosstab_topk_by_type(base, "o_orderstatus", "n_name", "outcome", OUTCOME_DOMAIN, 15,
                                    weight="n")




@query("agg_crosstab_other", "A22 P15", oracle=f"""
WITH q AS (SELECT l_orderkey AS o_orderkey, CAST(count(*) AS INTEGER) AS qty FROM lineitem GROUP BY ALL),
base0 AS (SELECT q.qty, {OUTCOME_SQL} AS outcome FROM orders o JOIN q USING (o_orderkey)),
topq AS (SELECT qty FROM (SELECT qty, count(*) AS c FROM base0 GROUP BY qty ORDER BY c DESC, qty LIMIT 3)),
ranked AS (SELECT qty, CAST(rank() OVER (ORDER BY qty) - 1 AS INTEGER) AS pos FROM topq),
base AS (SELECT CASE WHEN r.qty IS NOT NULL THEN CAST(b.qty AS VARCHAR) ELSE 'Other' END AS qty_group,
                coalesce(r.pos, 3) AS pos, b.outcome
         FROM base0 b LEFT JOIN ranked r ON b.qty = r.qty),
w AS (SELECT qty_group, pos, count(*) AS label_count, count(outcome) AS n_outcome FROM base GROUP BY ALL),
cells AS (SELECT qty_group, outcome, count(*) AS c FROM base GROUP BY ALL)
SELECT w.qty_group, w.pos, d.outcome, CAST(coalesce(c.c, 0) AS BIGINT) AS cnt,
       coalesce(round(coalesce(c.c, 0) / w.n_outcome, 4), 0.0) AS pct,
       CAST(w.label_count AS BIGINT) AS label_count
FROM w CROSS JOIN {_DOMAIN_SQL} d LEFT JOIN cells c ON c.qty_group = w.qty_group AND c.outcome = d.outcome""")
def agg_crosstab_other(spark, sf_dir):
    """Line count per order: top-3 values kept (numeric order), the rest 'Other'."""
    t = Tables(spark, sf_dir)
    q = (t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
         .agg(F.count(F.lit(1)).cast("int").alias("qty")))
    base = t.orders.select("o_orderkey", outcome()).join(q, "o_orderkey")
    grouped = ct.collapse_rare(base, "qty", 3, "qty_group", order_col="pos")
    return ct.crosstab_full(grouped, ["qty_group", "pos"], "outcome", OUTCOME_DOMAIN)


SEGMENT_ORDER = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD"]


@query("agg_crosstab_by_type", "A23 P16", oracle=_crosstab_sql(
    f"""SELECT o.o_orderstatus, c.c_mktsegment, {OUTCOME_SQL} AS outcome,
       CASE c.c_mktsegment {' '.join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(SEGMENT_ORDER))} END AS pos
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       WHERE o.o_orderstatus IN ('F', 'O')""",
    ["o_orderstatus", "pos", "c_mktsegment"]))
def agg_crosstab_by_type(spark, sf_dir):
    """One crosstab per order type over market segments in a fixed order."""
    t = Tables(spark, sf_dir)
    per_cust = (t.orders.where(F.col("o_orderstatus").isin("F", "O"))
                .select("o_orderstatus", "o_custkey", outcome())
                .groupBy("o_orderstatus", "o_custkey", "outcome").agg(F.count(F.lit(1)).alias("n")))
    base = per_cust.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"),
                         "o_custkey")
    base = ct.ordered_domain(base, "c_mktsegment", SEGMENT_ORDER)
    return ct.crosstab_full(base, ["o_orderstatus", "pos", "c_mktsegment"], "outcome",
                            OUTCOME_DOMAIN, weight="n")


# --------------------------------------------------------------------------
# Profiles, overviews, value counts
# --------------------------------------------------------------------------
from quarry.operators import profile as prof  # noqa: E402

_PART_PROFILE_COLS = [("p_partkey", "bigint", "p_partkey"), ("p_name", "string", "p_name"),
                      ("p_brand", "string", "nullif(p_brand, 'Brand#11')"),
                      ("p_type", "string", "p_type"),
                      ("p_size", "int", "CASE WHEN p_size > 45 THEN NULL ELSE p_size END"),
                      ("p_retailprice", "double", "p_retailprice")]


def _part_for_profile(t: Tables):
    p = t.part
    return p.select("p_partkey", "p_name",
                    F.expr("nullif(p_brand, 'Brand#11')").alias("p_brand"), "p_type",
                    F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_size")).alias("p_size"),
                    "p_retailprice")


def _profile_sql(table_sql: str, cols, target: str | None, blank: bool) -> str:
    num = {"bigint", "int", "double"}
    parts = []
    for i, (name, dtype, _) in enumerate(cols):
        miss = f"{name} IS NULL" + (f" OR trim({name}) = ''" if blank and dtype == "string" else "")
        kind = "Target" if name == target else ("Numerical" if dtype in num else "Categorical")
        parts.append(
            f"SELECT '{name}' AS \"column\", {i} AS position, '{dtype}' AS dtype, '{kind}' AS feature_kind, "
            f"CAST(count(*) - count_if({miss}) AS BIGINT) AS non_null, "
            f"CAST(count_if({miss}) AS BIGINT) AS missing, "
            f"coalesce(round(count_if({miss}) * 100.0 / count(*), 2), 0.0) AS missing_pct FROM t")
    return f"WITH t AS ({table_sql}) " + " UNION ALL ".join(parts)


@query("agg_column_profile", "A1 P13 P20 F5", oracle=_profile_sql(
    "SELECT " + ", ".join(f"{e} AS {n}" for n, _, e in _PART_PROFILE_COLS) + " FROM part",
    _PART_PROFILE_COLS, "p_retailprice", False))
def agg_column_profile(spark, sf_dir):
    """Per-column dtype, non-null, missing, missing % and feature kind of ``part``."""
    return prof.column_profile(_part_for_profile(Tables(spark, sf_dir)), target="p_retailprice")


_DOC_BLANK_COLS = [("doc_id", "bigint", "doc_id"), ("text", "string", "text"),
                   ("lang", "string", "lang"),
                   ("source", "string", "CASE WHEN source = 'src3' THEN '   ' ELSE source END")]


@query("agg_blank_profile", "A2", oracle=_profile_sql(
    "SELECT " + ", ".join(f"{e} AS {n}" for n, _, e in _DOC_BLANK_COLS) + " FROM documents",
    _DOC_BLANK_COLS, None, True))
def agg_blank_profile(spark, sf_dir):
    """Missing = null or blank after trim, for ``documents`` (one source blanked)."""
    d = Tables(spark, sf_dir).documents
    d = d.select("doc_id", "text", "lang",
                 F.when(F.col("source") == "src3", F.lit("   ")).otherwise(F.col("source")).alias("source"))
    return prof.column_profile(d, blank_is_missing=True)


@query("agg_dataset_overview", "A3", oracle="""
SELECT count(*) AS "rows", 6 AS "columns", count(DISTINCT o_orderpriority) AS classes,
       min(o_orderdate) AS date_min, max(o_orderdate) AS date_max,
       CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS fulfilled,
       CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS open
FROM orders""")
def agg_dataset_overview(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return prof.dataset_overview(o, "o_orderpriority", "o_orderdate",
                                 {"fulfilled": F.col("o_orderstatus") == "F",
                                  "open": F.col("o_orderstatus") == "O"})


@query("agg_value_counts", "A4 P5", oracle=f"""
SELECT {_case_sql(OUTCOME_SQL, OUTCOME_NAMES)} AS outcome_name, count(*) AS cnt
FROM orders GROUP BY ALL""")
def agg_value_counts(spark, sf_dir):
    """Frequency of the outcome display names (codes mapped, unknown → 'Unknown')."""
    from quarry.functions.scalar import code_labels
    o = Tables(spark, sf_dir).orders.select(outcome())
    named = o.select(code_labels("outcome", OUTCOME_NAMES).alias("outcome_name"))
    return prof.value_counts(named, "outcome_name")


@query("agg_value_counts_by_key", "A5 P4", oracle="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS cnt FROM orders GROUP BY ALL""")
def agg_value_counts_by_key(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(F.year("o_orderdate").alias("year"))
    return prof.value_counts(o, "year", by_key=True)


@query("agg_category_shares", "A6 K3", oracle="""
WITH c AS (SELECT source, count(*) AS cnt FROM documents GROUP BY ALL),
tot AS (SELECT count(*) AS total FROM documents),
h AS (SELECT 'top' AS part, CAST(row_number() OVER (ORDER BY cnt DESC, source) AS INTEGER) AS rank, source, cnt FROM c
      ORDER BY cnt DESC, source LIMIT 10),
b AS (SELECT 'bottom' AS part, CAST(row_number() OVER (ORDER BY cnt, source DESC) AS INTEGER) AS rank, source, cnt FROM c
      ORDER BY cnt, source DESC LIMIT 5)
SELECT part, rank, source, cnt, round(cnt * 100.0 / total, 2) AS share_pct
FROM (SELECT * FROM h UNION ALL SELECT * FROM b) CROSS JOIN tot""")
def agg_category_shares(spark, sf_dir):
    """Top-10 document sources with % share, and the 5 smallest."""
    return prof.category_shares(Tables(spark, sf_dir).documents, "source")


@query("agg_imbalance", "A7", oracle="""
WITH c AS (SELECT lang, count(*) AS cnt FROM documents GROUP BY ALL)
SELECT max(cnt) AS max_count, min(cnt) AS min_count,
       round(CASE WHEN min(cnt) = 0 THEN NULL ELSE max(cnt) / min(cnt) END, 2) AS imbalance_ratio FROM c""")
def agg_imbalance(spark, sf_dir):
    return prof.imbalance(Tables(spark, sf_dir).documents, "lang")


@query("agg_duplicates", "A26", oracle="""
SELECT 'lang+source' AS subset, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n FROM documents GROUP BY lang, source)
UNION ALL
SELECT 'text', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM documents GROUP BY text)
UNION ALL
SELECT 'url', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM pages GROUP BY url)""")
def agg_duplicates(spark, sf_dir):
    """Extra copies of documents on (lang, source), on text, and of page URLs."""
    t = Tables(spark, sf_dir)
    docs = prof.duplicates(t.documents, {"lang+source": ["lang", "source"], "text": ["text"]})
    return docs.unionByName(prof.duplicates(t.pages, {"url": ["url"]}))


# --------------------------------------------------------------------------
# Joins (J1-J7), projections (P1-P10, P17), scalar functions, K1, U3, U4
# --------------------------------------------------------------------------
from quarry.functions import scalar as fsc  # noqa: E402
from quarry.functions.text import strip  # noqa: E402
from quarry.operators import joins as jn  # noqa: E402
from quarry.operators.rank import attach, feature_subsets, top_k, topk_per_group  # noqa: E402


@query("join_lookup_default", "J1", oracle="""
WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL),
s AS (SELECT coalesce(nn.n_name, 'Unknown') AS state_name, sum(c.n) AS cnt
      FROM c JOIN customer cu ON c.o_custkey = cu.c_custkey
      LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) nn ON cu.c_nationkey = nn.n_nationkey GROUP BY ALL)
SELECT state_name, CAST(cnt AS BIGINT) AS cnt, CAST(row_number() OVER (ORDER BY cnt DESC, state_name) AS INTEGER) AS rank
FROM s ORDER BY cnt DESC, state_name LIMIT 15""")
def join_lookup_default(spark, sf_dir):
    """Orders per customer nation ('Unknown' when the lookup lacks it), top 15."""
    t = Tables(spark, sf_dir)
    per_cust = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    cust = per_cust.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    named = jn.lookup_default(cust, t.nation.where(F.col("n_regionkey") != 0), "c_nationkey", "n_nationkey",
                              "n_name", "state_name")
    counts = named.groupBy("state_name").agg(F.sum("n").cast("long").alias("cnt"))
    return top_k(counts, [F.col("cnt").desc(), F.col("state_name").asc()], 15)


@query("join_inner_features", "J2", oracle="""
SELECT l.l_orderkey, l.l_linenumber, p.p_type, l.l_extendedprice
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
def join_inner_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice") \
        .join(p, "l_partkey").drop("l_partkey")


@query("join_left_measure", "J3", oracle="""
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)""")
def join_left_measure(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")


# Stand-in for annotation → listing → breed lookups: a line item is an
# annotation, its supplier the listing (missing when the balance is not
# positive), nation ids the breed ids (ids ≥ 20 absent from the lookup).
_ANN_SQL = """
SELECT l.l_orderkey, l.l_linenumber, s.s_suppkey IS NOT NULL AS matched,
       s.s_nationkey AS breed1,
       CASE WHEN s.s_nationkey > 15 THEN s.s_nationkey - 10 ELSE 0 END AS breed2,
       CASE WHEN s.s_suppkey IS NULL THEN 'Unknown' WHEN s.s_acctbal >= 5000 THEN 'Dog' ELSE 'Cat' END AS pet_type
FROM lineitem l LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l.l_suppkey = s.s_suppkey"""
_BREEDS_SQL = "(SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 20)"


def _annotations(t: Tables):
    sup = t.supplier.where(F.col("s_acctbal") > 0).select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey", "s_acctbal", F.lit(True).alias("_found"))
    a = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(sup, "l_suppkey", "left")
    matched = F.col("_found").isNotNull()
    a = a.select("l_orderkey", "l_linenumber", matched.alias("matched"),
                 F.col("s_nationkey").alias("breed1"),
                 F.when(F.col("s_nationkey") > 15, F.col("s_nationkey") - 10).otherwise(
                     F.when(matched, F.lit(0))).alias("breed2"),
                 F.when(~matched, F.lit("Unknown")).when(F.col("s_acctbal") >= 5000, F.lit("Dog"))
                 .otherwise(F.lit("Cat")).alias("pet_type"))
    breeds = t.nation.where(F.col("n_nationkey") < 20)
    a = jn.lookup_unknown_id(a, breeds, "breed1", "n_nationkey", "n_name", "breed1_name", F.col("matched"))
    a = jn.lookup_unknown_id(a, breeds, "breed2", "n_nationkey", "n_name", "breed2_name", F.col("matched"))
    return a


@query("join_annotation_enrich", "J4", oracle=f"""
WITH a AS ({_ANN_SQL})
SELECT a.l_orderkey, a.l_linenumber, a.matched, a.breed1, CASE WHEN a.matched THEN a.breed2 END AS breed2, a.pet_type,
       CASE WHEN NOT a.matched THEN 'Unknown' ELSE coalesce(b1.n_name, 'Unknown(' || a.breed1 || ')') END AS breed1_name,
       CASE WHEN NOT a.matched THEN 'Unknown' ELSE coalesce(b2.n_name, 'Unknown(' || a.breed2 || ')') END AS breed2_name
FROM a LEFT JOIN {_BREEDS_SQL} b1 ON a.breed1 = b1.n_nationkey
LEFT JOIN {_BREEDS_SQL} b2 ON CASE WHEN a.matched THEN a.breed2 END = b2.n_nationkey""")
def join_annotation_enrich(spark, sf_dir):
    return _annotations(Tables(spark, sf_dir))


@query("join_unmatched_counts", "J5", oracle=f"""
WITH a AS ({_ANN_SQL})
SELECT CAST(count_if(matched) AS BIGINT) AS matched, CAST(count_if(NOT matched) AS BIGINT) AS unmatched FROM a""")
def join_unmatched_counts(spark, sf_dir):
    return jn.unmatched_counts(_annotations(Tables(spark, sf_dir)), F.col("matched"))


@query("set_distinct_breeds", "U3", oracle=f"""
WITH a AS ({_ANN_SQL}),
n AS (SELECT a.breed1 AS id, coalesce(b1.n_name, 'Unknown(' || a.breed1 || ')') AS name
      FROM a LEFT JOIN {_BREEDS_SQL} b1 ON a.breed1 = b1.n_nationkey WHERE a.matched
      UNION
      SELECT a.breed2, coalesce(b2.n_name, 'Unknown(' || a.breed2 || ')')
      FROM a LEFT JOIN {_BREEDS_SQL} b2 ON a.breed2 = b2.n_nationkey WHERE a.matched AND a.breed2 <> 0)
SELECT CAST(id AS INTEGER) AS id, name FROM n""")
def set_distinct_breeds(spark, sf_dir):
    """Distinct (id, name) breeds used by matched annotations, secondary id 0 excluded."""
    a = _annotations(Tables(spark, sf_dir)).where(F.col("matched"))
    b1 = a.select(F.col("breed1").alias("id"), F.col("breed1_name").alias("name"))
    b2 = a.where(F.col("breed2") != 0).select(F.col("breed2").alias("id"), F.col("breed2_name").alias("name"))
    return b1.union(b2).distinct().orderBy("id")


@query("join_first_match", "J6", oracle="""
SELECT l_orderkey, l_linenumber, l_returnflag AS top_label FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
                               ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS r
  FROM lineitem) WHERE r = 1""")
def join_first_match(spark, sf_dir):
    """First annotation (line) per file (order), with its label."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                               F.col("l_returnflag").alias("top_label"))
    first = jn.first_match(li, "l_orderkey", [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
                                              F.col("top_label")])
    return first.drop("l_partkey", "l_suppkey")


@query("join_exists_file", "J7", oracle="""
SELECT o_orderkey, o_orderstatus FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""")
def join_exists_file(spark, sf_dir):
    t = Tables(spark, sf_dir)
    files = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return jn.exists_in(t.orders.select("o_orderkey", "o_orderstatus"), files, "o_orderkey")


@query("proj_fill_defaults", "P1", oracle="""
SELECT doc_id, coalesce(nullif(source, 'src3'), 'Unknown') AS author,
       coalesce(nullif(lang, 'de'), 'N/A') AS category,
       coalesce(CASE WHEN n_chars < 500 THEN NULL ELSE lang END, '') AS short_text FROM documents""")
def proj_fill_defaults(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    d = d.select("doc_id", F.expr("nullif(source, 'src3')").alias("author"),
                 F.expr("nullif(lang, 'de')").alias("category"),
                 F.when(F.col("n_chars") < 500, F.lit(None)).otherwise(F.col("lang")).alias("short_text"))
    return fsc.fill_defaults(d, {"author": "Unknown", "category": "N/A", "short_text": ""})


@query("proj_parse_date", "P2", oracle="""
SELECT event_id, CAST(try_strptime(CASE WHEN value > 50 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d') END, '%Y-%m-%d')
                      AS DATE) AS day FROM events""")
def proj_parse_date(spark, sf_dir):
    """Lenient parse of a date text column; unparsable values become null."""
    e = Tables(spark, sf_dir).events
    txt = F.when(F.col("value") > 50, F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return e.select("event_id", F.to_date(fsc.parse_date(txt, "yyyy-MM-dd")).alias("day"))


@query("proj_combined_text", "P3", oracle=r"""
SELECT doc_id, regexp_replace(regexp_replace(split_part(text, chr(10), 1), '^\s+|\s+$', '', 'g') || ' ' ||
       regexp_replace(source, '^\s+|\s+$', '', 'g'), '^\s+|\s+$', '', 'g') AS combined_text FROM documents""")
def proj_combined_text(spark, sf_dir):
    """First line (headline) + source, each stripped, joined by a space, stripped."""
    d = Tables(spark, sf_dir).documents
    head = F.substring_index("text", "\n", 1)
    return d.select("doc_id", strip(F.concat_ws(" ", strip(head), strip("source"))).alias("combined_text"))


@query("proj_binary_flags", "P6", oracle="""
SELECT CASE WHEN nullif(source, 'src3') IS NULL THEN 'No Name' ELSE 'Has Name' END AS has_name,
       CASE WHEN lang = 'en' THEN 'Pure Breed' ELSE 'Not Pure Breed' END AS pure_breed, count(*) AS cnt
FROM documents GROUP BY ALL""")
def proj_binary_flags(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    f = d.select(fsc.flag(F.expr("nullif(source, 'src3')").isNull(), "No Name", "Has Name").alias("has_name"),
                 fsc.flag(F.col("lang") == "en", "Pure Breed", "Not Pure Breed").alias("pure_breed"))
    return f.groupBy("has_name", "pure_breed").agg(F.count(F.lit(1)).alias("cnt"))


@query("proj_key_from_filename", "P7", oracle="""
SELECT doc_id, regexp_extract(source || '-' || doc_id || '-' || lang || '.jpg', '^(.*)-[^-]*$', 1) AS pet_id
FROM documents""")
def proj_key_from_filename(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    fname = F.concat_ws("-", "source", F.col("doc_id").cast("string"), F.concat("lang", F.lit(".jpg")))
    return d.select("doc_id", fsc.key_from_filename(fname).alias("pet_id"))


@query("flt_isin_top", "P8", oracle="""
SELECT doc_id, source FROM documents
WHERE source IN (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 3)""")
def flt_isin_top(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "source")
    counts = d.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    top = top_k(counts, [F.col("n").desc(), F.col("source").asc()], 3, rank_col=None).select("source")
    return d.join(F.broadcast(top), "source", "left_semi")  # at most 3 rows


@query("flt_nonblank", "P9", oracle=r"""
SELECT doc_id, lang FROM documents WHERE regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') <> ''""")
def flt_nonblank(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.where(strip(F.coalesce("text", F.lit(""))) != "").select("doc_id", "lang")


@query("flt_min_class_size", "P10", oracle="""
WITH c AS (SELECT lang || '/' || source AS cls, doc_id FROM documents)
SELECT doc_id, cls FROM c WHERE cls IN (SELECT cls FROM c GROUP BY cls HAVING count(*) >= 12)""")
def flt_min_class_size(spark, sf_dir):
    """Keep (lang, source) classes with at least 12 documents.

    Class sizes are an aggregate joined back (not a window), so a huge class
    is counted by many tasks."""
    d = Tables(spark, sf_dir).documents.select("doc_id", F.concat_ws("/", "lang", "source").alias("cls"))
    big = d.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 12).select("cls")
    return d.join(big, "cls", "left_semi")


@query("proj_sample_rows", "P17 F6", oracle=f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
       {_case_sql(OUTCOME_SQL, OUTCOME_NAMES)} AS outcome_name,
       {_case_sql('o_orderstatus', STATUS_NAMES)} AS status_name, o_totalprice
FROM orders ORDER BY o_orderkey LIMIT 10""")
def proj_sample_rows(spark, sf_dir):
    """First 10 display rows by key, codes replaced by labels."""
    o = Tables(spark, sf_dir).orders
    rows = o.orderBy("o_orderkey").limit(10)
    return rows.select("o_orderkey", fsc.date_text("o_orderdate").alias("order_date"),
                       fsc.code_labels(outcome(), OUTCOME_NAMES).alias("outcome_name"),
                       fsc.code_labels("o_orderstatus", STATUS_NAMES).alias("status_name"), "o_totalprice")


@query("top_n_largest_smallest", "K1", oracle="""
(SELECT 'best' AS side, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank,
        o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 8)
UNION ALL
(SELECT 'worst', CAST(row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER),
        o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 8)""")
def top_n_largest_smallest(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice")
    best = top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 8).withColumn("side", F.lit("best"))
    worst = top_k(o, [F.col("o_totalprice"), F.col("o_orderkey")], 8).withColumn("side", F.lit("worst"))
    return best.unionByName(worst).select("side", "rank", "o_orderkey", "o_totalprice")


@query("set_feature_subsets", "U4", oracle="""
WITH g AS (SELECT DISTINCT c_mktsegment AS g FROM customer),
s1 AS (SELECT [g] AS subset, g AS last FROM g),
s2 AS (SELECT list_append(s1.subset, g.g) AS subset, g.g AS last FROM s1 JOIN g ON g.g > s1.last),
s3 AS (SELECT list_append(s2.subset, g.g) AS subset, g.g AS last FROM s2 JOIN g ON g.g > s2.last),
a AS (SELECT subset FROM s1 UNION ALL SELECT subset FROM s2 UNION ALL SELECT subset FROM s3)
SELECT array_to_string(subset, '+') AS subset_name, CAST(len(subset) AS INTEGER) AS size FROM a""")
def set_feature_subsets(spark, sf_dir):
    """Every non-empty subset (size ≤ 3) of the feature groups (market segments)."""
    groups = Tables(spark, sf_dir).customer.select(F.col("c_mktsegment").alias("g")).distinct()
    return feature_subsets(groups, "g", 3).select("subset_name", "size")


@query("fn_trim_lower_strip", "F4", oracle="""
SELECT c_custkey, lower(trim(replace(c_name, '"', ''))) AS name_key FROM customer""")
def fn_trim_lower_strip(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", fsc.trim_lower_strip("c_name").alias("name_key"))


@query("fn_json_path", "F9 S4", oracle="""
SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), -1) AS k,
       coalesce(json_extract_string(props, '$.missing.deep'), 'none') AS deep FROM events""")
def fn_json_path(spark, sf_dir):
    """Optional nested JSON access with defaults on ``events.props``."""
    e = Tables(spark, sf_dir).events
    return e.select("event_id", fsc.json_path("props", "$.k", -1, "int").alias("k"),
                    fsc.json_path("props", "$.missing.deep", "none").alias("deep"))


@query("fn_label_ids", "F12 E9", oracle="""
SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_id FROM (SELECT DISTINCT lang FROM documents)""")
def fn_label_ids(spark, sf_dir):
    """Sorted label → id (distinct labels are aggregated first; the ranking
    runs over the small label set, not over the rows)."""
    from pyspark.sql import Window
    labels = Tables(spark, sf_dir).documents.select("lang").distinct()
    return labels.select("lang", (F.row_number().over(Window.orderBy("lang")) - 1).alias("label_id"))


@query("fn_concat_label", "F13", oracle="""
SELECT doc_id, concat_ws('__', lang, source, 'tf.idf') AS run_id,
       translate(concat_ws('__', lang, source, 'tf.idf'), '/-. ', '____') AS safe_id FROM documents""")
def fn_concat_label(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    rid = fsc.concat_label(F.col("lang"), F.col("source"), F.lit("tf.idf"))
    return d.select("doc_id", rid.alias("run_id"), fsc.safe_id(rid).alias("safe_id"))


@query("fn_clip", "F11", oracle="""
SELECT vec_id, least(greatest(CAST(embedding[1] AS DOUBLE) * 3, -1.0), 1.0) AS clipped,
       greatest(abs(CAST(embedding[2] AS DOUBLE)), 1e-9) AS floored FROM embeddings""")
def fn_clip(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    return e.select("vec_id", fsc.clip(F.col("embedding")[0].cast("double") * 3, -1.0, 1.0).alias("clipped"),
                    fsc.floor_at(F.abs(F.col("embedding")[1].cast("double")), 1e-9).alias("floored"))


@query("agg_pivot_year_category", "A24", oracle="""
WITH b AS (SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, n.n_name
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
top AS (SELECT n_name FROM b GROUP BY n_name ORDER BY count(*) DESC, n_name LIMIT 6),
y AS (SELECT DISTINCT year FROM b WHERE n_name IN (SELECT n_name FROM top)),
c AS (SELECT year, n_name, count(*) AS cnt FROM b WHERE n_name IN (SELECT n_name FROM top) GROUP BY ALL)
SELECT y.year, t.n_name, CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt
FROM y CROSS JOIN top t LEFT JOIN c ON c.year = y.year AND c.n_name = t.n_name""")
def agg_pivot_year_category(spark, sf_dir):
    """Year × top-6 customer nations order counts, zero-filled (long form).

    Each year's counts are gathered into a map of at most 6 entries and read
    back through the (bounded) top-6 list, so zero cells need no join."""
    t = Tables(spark, sf_dir)
    per_cust = (t.orders.select("o_custkey", F.year("o_orderdate").alias("year"))
                .groupBy("o_custkey", "year").agg(F.count(F.lit(1)).alias("n")))
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    b = per_cust.join(cust, "o_custkey").join(nation, "c_nationkey")
    tot = b.groupBy("n_name").agg(F.sum("n").alias("_t"))
    top = top_k(tot, [F.col("_t").desc(), F.col("n_name")], 6, rank_col=None).select("n_name")
    top_list = top.agg(F.collect_list("n_name").alias("_top"))          # 6 names
    cells = (b.join(F.broadcast(top), "n_name", "left_semi")             # ≤ 6 rows
             .groupBy("year", "n_name").agg(F.sum("n").alias("cnt")))
    per_year = cells.groupBy("year").agg(F.map_from_entries(F.collect_list(F.struct("n_name", "cnt"))).alias("_m"))
    grid = attach(per_year, top_list, [])
    return grid.select("year", F.explode("_top").alias("n_name"), "_m") \
        .select("year", "n_name", F.coalesce(F.col("_m")[F.col("n_name")], F.lit(0)).cast("long").alias("cnt"))
