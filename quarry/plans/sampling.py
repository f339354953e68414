"""Sampling and split queries (deterministic md5 order, seed 42)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import sampling as smp
from quarry.plans.registry import query
from quarry.sources.tables import Tables


def _h(col: str) -> str:
    return f"md5(concat(CAST({col} AS VARCHAR), ':42'))"


@query("split_train_test", "V1", oracle=f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_h('o_orderkey')}, o_orderkey) AS pos,
                  count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN pos <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM r""")
def split_train_test(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey")
    return smp.split_train_test(o, "o_orderkey", 0.8, seed=42)


@query("sample_n", "V2", oracle=f"""
SELECT doc_id, lang FROM documents ORDER BY {_h('doc_id')}, doc_id LIMIT 100""")
def sample_n(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "lang")
    return smp.sample_n(d, "doc_id", 100, seed=42)


@query("sample_cap_per_group", "V3", oracle=f"""
SELECT c_custkey, c_nationkey FROM (
  SELECT c_custkey, c_nationkey,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY {_h('c_custkey')}, c_custkey) AS r FROM customer)
WHERE r <= 20""")
def sample_cap_per_group(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_nationkey")
    return smp.sample_cap_per_group(c, "c_nationkey", "c_custkey", 20, seed=42)


_TEST, _VAL = 0.2, 0.1


@query("split_stratified", "V4", oracle=f"""
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_h('doc_id')}, doc_id) AS pos,
                  count(*) OVER (PARTITION BY lang) AS n FROM documents),
t AS (SELECT *, ceil(n * {_TEST}) AS nt FROM r),
v AS (SELECT *, ceil((n - nt) * {_VAL / (1 - _TEST)}) AS nv FROM t)
SELECT doc_id, lang, CASE WHEN pos <= nt THEN 'test' WHEN pos <= nt + nv THEN 'val' ELSE 'train' END AS split
FROM v""")
def split_stratified(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "lang")
    return smp.split_stratified(d, "lang", "doc_id", test=_TEST, val=_VAL, seed=42)


@query("sample_stratified_proportional", "V5", oracle=f"""
WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {_h('doc_id')}, doc_id) AS pos,
                  count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM documents),
w AS (SELECT *, least(greatest(2, CAST(round_even(n * 100 / total, 0) AS BIGINT)), n) AS want FROM r)
SELECT doc_id, source FROM w WHERE pos <= want AND want >= 2""")
def sample_stratified_proportional(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "source")
    return smp.sample_stratified_proportional(d, "source", "doc_id", 100, seed=42)
