"""Compare registered queries with their check SQL."""

import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type name -> DuckDB type name.
SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return ("float", repr(v))
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    return (type(v).__name__, str(v))


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    """None if both agree, else a text that says how they differ."""
    df = query(spark, sf_dir)
    have = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = normal(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(have) != len(want):
        return f"rows {len(have)} != {len(want)}"
    kinds = {c: SQL_TYPES.get(t, t) for c, t in df.dtypes}
    other = {d[0]: str(d[1]) for d in cur.description}
    if kinds != other:
        return f"types {set(kinds.items()) ^ set(other.items())}"
    for a, b in zip(have, want):
        if a != b:
            return f"first difference (columns {sorted(names)}):\n  spark {a}\n  sql   {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from tests.conftest import build_session

    import __spark_entry__ as e

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    spark, con = build_session(), duck(sf_dir)
    checks = e.oracle_sql()
    for name, q in e.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            result = compare(spark, con, sf_dir, q, checks[name]) if name in checks else "no sql"
        except Exception as ex:  # noqa: BLE001
            result = f"{type(ex).__name__}: {str(ex)[:800]}"
        print(f"{name}: {result or 'equal'}  [{time.time() - start:.2f}s]", flush=True)
