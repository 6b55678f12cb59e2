"""Run registered queries against DuckDB and report differences."""

import math
import sys
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda t: tuple((v is None, str(v)) for v in t))


SPARK_KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def differences(df, sql, con):
    """Readable list of differences; empty when both agree to the last digit."""
    got = df.collect()
    relation = con.sql(sql)
    found = []
    kinds = {n: SPARK_KIND.get(k, k) for n, k in df.dtypes}
    expected_kinds = {n: str(k) for n, k in zip(relation.columns, relation.types)}
    if kinds != expected_kinds:
        found.append(f"schema {sorted(set(kinds.items()) ^ set(expected_kinds.items()))}")
    ours = _rows(df.columns, got)
    theirs = _rows(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} vs {len(theirs)}")
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first:\n  {unequal[0][0]}\n  {unequal[0][1]}")
    return found


def main(sf, names):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import time

    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                found = differences(df, oracles[name], con)
                verdict = "OK" if not found else "DIFF " + "; ".join(found)
            else:
                verdict = f"rows {len(df.collect())}"
        except Exception as err:
            verdict = "ERROR " + str(err)[:700]
        bad += verdict.startswith(("DIFF", "ERROR"))
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("unknown oracles:", set(oracles) - set(queries), "bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
