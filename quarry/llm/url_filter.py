"""URL filters by redirect equivalence, in DataFrame functions only.

An ordered policy of (host, path) rules judges a url by itself: a rule fits
its host and all subdomains where the path starts with the rule's, and the
longest fitting rule wins.  Urls that redirects (meta refresh, or a table of
observed redirects) and canonical links join are aliases of one page.
Distributed connected components over these edges find the aliases, and a
blocked member blocks every alias that no rule names.  A url that a rule
allows stays allowed whatever its aliases are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, release
from .components import connected_components

#: The policy of the registered query: action, host and path.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_TAG = r"(?i)<(?:link|meta)\b[^<>]*>"
_CANONICAL = r"""(?i)^<link\b.*\brel\s*=\s*(?:"[^"]*\bcanonical\b|'[^']*\bcanonical\b|canonical\b)"""
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_REFRESH = r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b"""
_REFRESH_URL = r"""(?is)\bcontent\s*=\s*["']?[\s0-9.]*[;,]\s*url\s*=\s*["']?([^"'>\s]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty where the url is null or has no ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def address_of(url: Column) -> Column:
    """Host, path and query: what names a page, without scheme and fragment.
    Null where there is no host."""
    host = host_of(url)
    return F.when(host != "", F.concat(host, path_of(url), F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 3)))


def _resolved(target: Column, host: Column, path: Column) -> Column:
    """The address that a link target names on a page; dot segments stay as
    they are, other schemes and empty targets give null."""
    t = F.regexp_replace(F.replace(F.trim(target), F.lit("&amp;"), F.lit("&")), "(?s)#.*$", "")
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), "[^/]*$", "")
    return (F.when(t == "", None)
            .when(t.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), address_of(t))
            .when(t.startswith("//"), address_of(F.concat(F.lit("x:"), t)))
            .when(t.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | (host == ""), None)
            .when(t.startswith("/"), F.concat(host, t))
            .when(t.startswith("?"), F.concat(host, path, t))
            .otherwise(F.concat(host, folder, t)))


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``src, dst`` addresses of the canonical links and meta refreshes."""
    url, html = F.col(url_col).cast("string"), F.col(html_col).cast("string")
    tags = F.regexp_extract_all(html, F.lit(_TAG), F.lit(0))
    href = [lambda t, g=g: F.regexp_extract(t, _HREF, g) for g in (1, 2, 3)]
    canonical = F.transform(F.filter(tags, lambda t: t.rlike(_CANONICAL)), lambda t: F.concat(*[f(t) for f in href]))
    refresh = F.transform(F.filter(tags, lambda t: t.rlike(_REFRESH)), lambda t: F.regexp_extract(t, _REFRESH_URL, 1))
    # The cheap test first: most pages have neither.
    rows = pages.where(html.rlike("(?i)canonical|refresh")).select(
        address_of(url).alias("src"), host_of(url).alias("h"), path_of(url).alias("p"),
        F.explode(F.concat(canonical, refresh)).alias("t"))
    return rows.select("src", _resolved(F.col("t"), F.col("h"), F.col("p")).alias("dst")).where("src <> dst").distinct()


def _split(rule: str) -> tuple[str, str]:
    at = rule.find("/")
    return (rule.lower(), "") if at < 0 else (rule[:at].lower(), rule[at:])


def _judged(rows: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    """``rows`` (with ``host, path``) plus ``rule, action``, null where none
    fits.  Of fitting rules the longest wins, of equally long ones that with
    the longer host, then the allowing one."""
    if not isinstance(rules, DataFrame):
        def order(x):
            return -len(x[1]), -len(_split(x[1])[0]), x[0]
        fits = []
        for action, rule in sorted(rules, key=order):
            h, p = _split(rule)
            fit = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
            fits.append(F.when(fit, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))))
        none = F.lit(None).cast("struct<rule:string,action:string>")
        return rows.withColumn("fit", F.coalesce(*fits, none)).select(*rows.columns, "fit.rule", "fit.action")
    # A list that is a table: equality of a host suffix and a path prefix of a length that rules have.
    split = rules.select("action", "rule", F.lower(F.substring_index("rule", "/", 1)).alias("h"),
                         F.regexp_extract("rule", "(?s)^[^/]*(.*)$", 1).alias("p"))
    lengths = split.agg(F.sort_array(F.collect_set(F.length("p")))).first()[0]
    pairs = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, 1 << 20), "."))
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    probes = pairs.withColumn("h", F.explode(suffixes)).withColumn("n", F.explode(prefixes)).withColumn(
        "p", F.expr("substring(path, 1, n)"))
    best = probes.join(split, ["h", "p"]).groupBy("host", "path").agg(F.min(F.struct(
        -F.length("rule"), -F.length("h"), F.col("action"), F.col("rule"))).alias("fit"))
    return rows.join(best, ["host", "path"], "left").select(*rows.columns, "fit.rule", "fit.action")


def blocked_aliases(edges: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    """``address`` of every member of a component that has a blocked member."""
    labels = materialize(connected_components(edges))
    url = F.concat(F.lit("x://"), F.col("node"))
    judged = _judged(labels.select("component", host_of(url).alias("host"), path_of(url).alias("path")), rules)
    blocked = judged.where("action = 'block'").select("component").distinct()
    out = materialize(labels.join(blocked, "component", "left_semi").select(F.col("node").alias("address")))
    release(labels)
    return out


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame = RULES, redirects: DataFrame | None = None,
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``rules`` is a short list of (action, rule), held in the plan, or a table
    ``action, rule`` of any size, joined by host suffix and path prefix.
    ``redirects`` adds a table ``src, dst`` of urls seen to redirect.

    ``rule`` is the longest fitting rule and null where none fits; its action
    is the verdict.  Else the verdict is ``block`` for an alias of a blocked
    url, in the table or only linked to, and ``allow`` for all others, with
    null urls and such without ``://`` (host and path empty) among them.  Null
    or empty html has no links, repeated rows and ties of equal urls have the
    same result, very long html is searched whole, extra columns are ignored,
    whatever their names, and an empty table gives no rows."""
    edges = link_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(address_of(F.col("src")).alias("src"), address_of(F.col("dst")).alias("dst")))
    aliases = blocked_aliases(edges, rules)
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                        address_of(url).alias("own_address"))
    out = _judged(rows, rules).join(aliases, F.col("own_address") == F.col("address"), "left")
    other = F.when(F.col("address").isNotNull(), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("action", other).alias("verdict"))
