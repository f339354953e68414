"""Run registered Spark queries next to their DuckDB oracles and compare.

Usage: python tests/oracle_check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, round(v, 6))
    if hasattr(v, "item") and not isinstance(v, (list, tuple, str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, bool):
        return (1, float(v))
    if isinstance(v, int):
        return (1, float(v))
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return (2, tuple(_norm(x) for x in list(v)))
    if isinstance(v, dict):
        return (2, tuple(sorted((k, _norm(x)) for k, x in v.items())))
    return (3, str(v))


def compare(spark_rows: list[dict], duck_rows: list[dict], tol=1e-6):
    sc = sorted(spark_rows[0].keys()) if spark_rows else None
    dc = sorted(duck_rows[0].keys()) if duck_rows else None
    if sc and dc and sc != dc:
        return f"columns differ: spark={sc} duck={dc}"
    if len(spark_rows) != len(duck_rows):
        return f"row count spark={len(spark_rows)} duck={len(duck_rows)}"
    cols = sc or dc or []
    a = sorted(tuple(_norm(r[c]) for c in cols) for r in spark_rows)
    b = sorted(tuple(_norm(r[c]) for c in cols) for r in duck_rows)
    for ra, rb in zip(a, b):
        for c, x, y in zip(cols, ra, rb):
            if x == y:
                continue
            if x[0] == 1 and y[0] == 1 and abs(x[1] - y[1]) <= tol * max(1.0, abs(y[1])):
                continue
            return f"value differs in {c}: spark={x} duck={y}; rows {ra} vs {rb}"
    return None


_TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE",
             "float": "FLOAT", "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_diff(spark_schema, description) -> str | None:
    duck_types = {d[0]: str(d[1]).upper() for d in description}
    diffs = []
    for f in spark_schema.fields:
        st = f.dataType.simpleString()
        want = _TYPE_MAP.get(st, st.upper())
        got = duck_types.get(f.name)
        if got is not None and got != want:
            diffs.append(f"{f.name}: spark {st} vs duck {got}")
    return "; ".join(diffs) or None


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    prefixes = [a for a in argv[1:] if not a.startswith("/")]
    from quarry.plans.registry import load_all
    from quarry.session import get_session
    spark = get_session()
    con = duck(sf_dir)
    reg = load_all()
    bad = 0
    for name, q in reg.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        if os.environ.get("ORACLE_ONLY") == "1" and q.oracle is None:
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf_dir)
            srows = [r.asDict(recursive=True) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.oracle is None:
            print(f"rows {name}: {len(srows)} rows ({ts:.1f}s) [no oracle]")
            continue
        try:
            cur = con.execute(q.oracle)
            names = [d[0] for d in cur.description]
            drows = [dict(zip(names, r)) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duck error {str(e)[:400]}")
            bad += 1
            continue
        err = compare(srows, drows)
        if sorted(df.columns) != sorted(names):
            err = f"columns {df.columns} against {names}"
        tdiff = type_diff(df.schema, cur.description)
        if tdiff and not err:
            err = "types " + tdiff
        if err:
            bad += 1
            print(f"FAIL {name}: {err}")
        else:
            print(f"ok   {name}: {len(srows)} rows ({ts:.1f}s)")
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
