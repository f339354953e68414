"""User-defined table functions for SQL (D3)."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from quarry.functions.text import LETTER_TOKEN, STOPWORDS


def register_tokens(spark: SparkSession, name: str = "report_tokens") -> None:
    """Register ``report_tokens(text)`` for ``LATERAL`` joins: one row per
    report token of a text, with its position; null and empty texts give no
    rows.  The native ``tokenize`` column is the faster form inside plans."""
    pattern, stops = re.compile(LETTER_TOKEN), frozenset(STOPWORDS)

    @udtf(returnType="position: int, term: string", useArrow=True)
    class ReportTokens:
        def eval(self, text: str):
            for i, term in enumerate(pattern.findall((text or "").lower())):
                if len(term) >= 3 and term[0] != "'" and term not in stops:
                    yield i, term

    spark.udtf.register(name, ReportTokens)
