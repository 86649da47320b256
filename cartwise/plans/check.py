"""Side-by-side check of a catalogue query against its DuckDB oracle.

Compares row count, column names + types, and the multiset of rows (floats
rounded to 6 digits).  Used by the tests and by ``python -m
cartwise.plans.check <sf_dir> [names...]``.
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

DUCK_TO_SPARK = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float",
    "SMALLINT": "smallint", "HUGEINT": "hugeint", "TINYINT": "tinyint",
}


def duck_connection(sf_dir: str):
    import duckdb
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
        r = round(v, 6)
        return (1, repr(r + 0.0))
    if isinstance(v, Decimal):
        return (1, repr(round(float(v), 6)))
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, str(v))
    if isinstance(v, (list, tuple)):
        return (3, repr([_norm(x) for x in v]))
    return (4, str(v))


def _rows(rows, cols_sorted, index):
    out = []
    for r in rows:
        out.append(tuple(_norm(r[index[c]]) for c in cols_sorted))
    out.sort()
    return out


def compare(spark, name: str, sf_dir: str, con=None, show: int = 3) -> dict:
    from . import catalog, oracle
    fn = catalog.QUERIES[name]
    sql = oracle.ORACLE.get(name)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = None
        return res
    con = con or duck_connection(sf_dir)
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    d_types = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in
               zip(d_cols, [str(x[1]) for x in cur.description])}
    res["oracle_rows"] = len(d_rows)
    res["columns_match"] = sorted(s_cols) == sorted(d_cols)
    res["type_diffs"] = {c: (s_types.get(c), d_types.get(c)) for c in s_cols
                         if c in d_types and s_types.get(c) != d_types.get(c)}
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        res["match"] = False
        return res
    cols = sorted(s_cols)
    a = _rows(s_rows, cols, {c: i for i, c in enumerate(s_cols)})
    b = _rows(d_rows, cols, {c: i for i, c in enumerate(d_cols)})
    res["match"] = a == b
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = [dict(zip(cols, r)) for r in sorted(sa - sb)[:show]]
        res["only_oracle"] = [dict(zip(cols, r)) for r in sorted(sb - sa)[:show]]
    return res


def main(argv):
    from ..session import build_session
    from . import catalog
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(catalog.QUERIES)
    spark = build_session("cartwise-check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": n, "error": repr(e)[:500]}
        ok = r.get("match") and not r.get("type_diffs")
        bad += 0 if (ok or r.get("oracle", 1) is None) else 1
        tag = "OK   " if ok else ("NOORA" if r.get("oracle", 1) is None else "FAIL ")
        print(tag + " " + str(r), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
