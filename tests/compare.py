"""Runs registered queries next to their SQL twins and compares rows, types and values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _key(row):
    return tuple((v is None, str(round(v, 2)) if isinstance(v, float) else str(v)) for v in row)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences found; empty when both engines agree."""
    names = sorted(spark_df.columns)
    left = [tuple(_cell(r[n]) for n in names) for r in spark_df.collect()]
    result = con.execute(sql)
    cols = [d[0] for d in result.description]
    types = dict(zip(cols, (str(d[1]) for d in result.description)))
    if sorted(cols) != names:
        return [f"columns {names} vs {sorted(cols)}"]
    order = [cols.index(n) for n in names]
    right = [tuple(_cell(r[i]) for i in order) for r in result.fetchall()]
    same_type = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
                 "boolean": "BOOLEAN"}
    found = [f"type of {n}: {t} vs {types[n]}" for n, t in spark_df.dtypes if same_type.get(t) != types[n]]
    if len(left) != len(right):
        return [*found, f"rows {len(left)} vs {len(right)}"]
    left.sort(key=_key), right.sort(key=_key)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        found.append(f"{len(bad)} of {len(left)} rows differ, first {bad[0]}")
    return found


def main(sf: str, wanted: list[str]) -> None:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from shelfcast.session import session

    spark = session("local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "12g",
                                      "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    con, fns, sqls = duck(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or fns:
        began = time.time()
        try:
            df = fns[name](spark, sf_dir)
            found = compare(df, con, sqls[name]) if name in sqls else [f"(no SQL) {len(df.collect())} rows"]
        except Exception as error:  # reported and counted
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found) and name in sqls
        print(f"{name}: {'ok' if not found else found} {time.time() - began:.1f}s", flush=True)
    print(f"{bad} with differences")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
