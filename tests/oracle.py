"""Compare registered queries with their oracles: ``python tests/oracle.py [sf] [name...]``."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def _kind(name):
    name = name.lower()
    for kind, words in {"int": ("int", "long", "short", "hugeint"), "float": ("double", "float"),
                        "decimal": ("decimal",), "str": ("string", "varchar"), "bool": ("bool",),
                        "date": ("date",), "ts": ("timestamp",)}.items():
        if any(w in name for w in words) and not (kind == "date" and "timestamp" in name):
            return kind
    return name


def compare(spark, con, q, sf_dir):
    """None if equal, else a text that says how the results differ."""
    df = q.plan(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if q.oracle is None:
        return None if got else "no rows"
    cur = con.execute(q.oracle)
    names = [c[0] for c in cur.description]
    kinds = {c[0]: str(c[1]) for c in cur.description}
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for f in df.schema.fields:
        a, b = f.dataType.simpleString(), kinds[f.name]
        if _kind(a) != _kind(b):
            return f"type of {f.name}: {a} != {b}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(bad)} rows differ, columns {sorted(names)}, first: {bad[0]}"
    return None


if __name__ == "__main__":
    from registry import QUERIES
    from txnloom.session import build_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("0") else "0.01"
    spark = build_session("oracle", "local[8]", {"spark.sql.shuffle.partitions": "8",
                                                 "spark.ui.enabled": "false",
                                                 "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    failed = 0
    for name, q in QUERIES.items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            diff = compare(spark, con, q, sf_dir)
        except Exception as exc:  # report and go on
            diff = f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.2f}s {diff or ''}", flush=True)
    print("failed:", failed)
