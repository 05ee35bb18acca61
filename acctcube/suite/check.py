"""Run registered queries against their SQL and report rows, schema and values.

    python -m acctcube.suite.check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

SPARK_TYPES = {
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _cell(x):
    return None if isinstance(x, float) and math.isnan(x) else x


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between a Spark result and its SQL; empty when they agree."""
    cols = sorted(df.columns)
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return [f"columns: spark {cols} sql {sorted(rel.columns)}"]
    problems = []
    types = dict(zip(rel.columns, [str(x) for x in rel.types], strict=True))
    for name, kind in df.dtypes:
        if SPARK_TYPES.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: spark {kind} sql {types[name]}")
    ours = Counter(tuple(_cell(x) for x in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    theirs = Counter(rel.select(*[f'"{c}"' for c in cols]).fetchall())
    if ours != theirs:
        problems.append(
            f"rows: spark {ours.total()} sql {theirs.total()}; only spark {list((ours - theirs))[:2]};"
            f" only sql {list((theirs - ours))[:2]}; columns {cols}"
        )
    return problems


def main(argv: list[str]) -> int:
    from acctcube.session import build_session
    from acctcube.suite.queries import QUERIES
    from acctcube.suite.sql import oracle

    sf, names = argv[0], argv[1:]
    spark = build_session("check", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf), oracle(), 0
    for name in names or QUERIES:
        start = time.time()
        problems = compare(QUERIES[name](spark, sf), con, sqls[name]) if name in sqls else ["no SQL"]
        bad += bool(problems)
        print(f"{'ok  ' if not problems else 'FAIL'} {name} {time.time() - start:.1f}s", *problems, sep="\n     ", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
