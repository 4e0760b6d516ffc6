"""Run every registered query on Spark and its oracle SQL on DuckDB, and
compare row count, column names and an order-insensitive value hash.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "None"
        return repr(v)  # exact: the queries round where engines could differ
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


_SPARK_TYPES = {"IntegerType": "int32", "LongType": "int64", "DoubleType": "float64", "StringType": "str",
                "BooleanType": "bool", "DateType": "date", "FloatType": "float32", "ShortType": "int16"}
_DUCK_TYPES = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "str", "BOOLEAN": "bool",
               "DATE": "date", "FLOAT": "float32", "SMALLINT": "int16"}


def type_families(spark_schema, duck_description):
    s = {f.name: _SPARK_TYPES.get(type(f.dataType).__name__, type(f.dataType).__name__)
         for f in spark_schema.fields}
    d = {c[0]: _DUCK_TYPES.get(str(c[1]).split("(")[0], str(c[1])) for c in duck_description}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    same_cols = sorted(scols) == sorted(dcols)
    type_diffs = type_families(df.schema, res.description)
    sh, sl = digest(srows, scols)
    dh, dl = digest(drows, dcols)
    out = {"name": name, "ok": same_cols and not type_diffs and len(srows) == len(drows) and sh == dh,
           "rows": len(srows), "oracle_rows": len(drows), "cols_ok": same_cols, "types_ok": not type_diffs,
           "spark_s": round(t1 - t0, 2)}
    if not out["ok"]:
        out["spark_cols"], out["oracle_cols"] = scols, dcols
        s_only = sorted(set(sl) - set(dl))[:3]
        d_only = sorted(set(dl) - set(sl))[:3]
        out["spark_only"], out["oracle_only"] = s_only, d_only
        out["type_diffs"] = type_diffs
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from reefcensus.session import get_session

    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
