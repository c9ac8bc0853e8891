"""Run registered queries against their SQL: python tests/compare.py SF_DIR [name ...]"""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from threadloom.catalog.views import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text, columns in name order."""
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return "<null>"
        if isinstance(v, float):
            return repr(v)
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in df.astype(object).itertuples(index=False))


def spark_rows(df) -> pd.DataFrame:
    return pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)


def duck_rows(con, sql: str) -> pd.DataFrame:
    result = con.execute(sql)
    return pd.DataFrame(result.fetchall(), columns=[c[0] for c in result.description], dtype=object)


def main(sf_dir: str, names: list[str]) -> None:
    from threadloom.session import drop_stages, local_session

    spark = local_session("compare", 8)
    con = duck(sf_dir)
    found, sql = queries(), oracle_sql()
    bad = []
    print("without query:", sorted(set(sql) - set(found)), "without sql:", sorted(set(found) - set(sql)))
    for name in names or found:
        start = time.time()
        try:
            got = spark_rows(found[name](spark, sf_dir))
            mid = time.time()
            if name not in sql:
                print(f"ROWS {name} {len(got)} {mid - start:.1f}s", flush=True)
                continue
            want = duck_rows(con, sql[name])
            a, b = canonical(got), canonical(want)
            ok = sorted(got.columns) == sorted(want.columns) and a == b
            print(f"{'ok  ' if ok else 'DIFF'} {name} {len(got)} spark {mid - start:.1f}s duck {time.time() - mid:.1f}s", flush=True)
            if not ok:
                bad.append(name)
                print("  columns", sorted(got.columns), sorted(want.columns), len(a), len(b))
                only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
                for x in only_a[:2]:
                    print("  spark", str(x)[:700])
                for x in only_b[:2]:
                    print("  duck ", str(x)[:700])
        except Exception as error:  # report and go on with the next query
            bad.append(name)
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
    print("bad:", bad)
    drop_stages(spark)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
