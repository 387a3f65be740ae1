"""Runs queries on Spark and their statements on DuckDB and compares the results.

``python -m tests.parity [directory] [name-prefix,...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value, dates and numbers in one form."""
    out = pd.DataFrame(index=df.index)
    for c in sorted(df.columns):
        col = df[c]
        if col.dtype == object or str(col.dtype) in ("str", "string") or "datetime" in str(col.dtype):
            kinds = {type(v) for v in col.dropna().head(1000)}
            if any(issubclass(k, (bool,)) for k in kinds):
                out[c] = col.astype("boolean").astype(object)
            elif kinds and all(issubclass(k, (int, float)) or k.__name__ == "Decimal" for k in kinds):
                out[c] = col.astype(float)
            else:
                out[c] = col.map(lambda v: None if pd.isna(v) else str(v)[:10] if hasattr(v, "year") else str(v)).astype(object)
        elif str(col.dtype) in ("bool", "boolean"):
            out[c] = col.astype(object)
        else:
            out[c] = col.astype(float)
    keys = sorted(out.columns, key=lambda c: (out[c].dtype != object, c))
    return out.sort_values(keys, na_position="first", kind="stable").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame, tolerance: float = 0.0) -> list[str]:
    """What differs; values must be bit-equal unless a relative tolerance is given."""
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(set(got.columns) ^ set(want.columns))}"]
    if len(got) != len(want):
        return [f"rows {len(got)} vs {len(want)}"]
    a, b, found = normal(got), normal(want), []
    for c in a.columns:
        if a[c].dtype == object or b[c].dtype == object:
            same = (a[c].isna() & b[c].isna()) | (a[c] == b[c])
        else:
            gap = (a[c] - b[c]).abs()
            same = (a[c].isna() & b[c].isna()) | (gap <= tolerance * b[c].abs().clip(lower=1)) | (a[c] == b[c])
        if not same.all():
            i = (~same).idxmax()
            found.append(f"{c}: {int((~same).sum())} differ, first {a.loc[i].to_dict()} vs {b.loc[i].to_dict()}")
    return found


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2].split(",")) if len(sys.argv) > 2 else ("",)
    spark, con = local_session("8"), duck(sf_dir)
    statements, bad = oracle_sql(), 0
    for name, build in queries().items():
        if not name.startswith(prefixes):
            continue
        try:
            t0 = time.time()
            got = build(spark, sf_dir).toPandas()
            t1 = time.time()
            if name not in statements:
                print(f"{name:45s} rows {len(got):7d}  spark {t1 - t0:5.1f}s  no statement", flush=True)
                continue
            want = con.execute(statements[name]).df()
            t2 = time.time()
            diff = differences(got, want)
            note = "ok" if not diff else "near" if not differences(got, want, 1e-9) else "DIFF"
            bad += bool(diff)
            print(f"{name:45s} rows {len(got):7d}  spark {t1 - t0:5.1f}s  duckdb {t2 - t1:5.1f}s  {note} {'; '.join(diff)[:700]}", flush=True)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:45s} FAILED {type(e).__name__} {str(e)[:700]}", flush=True)
    print("all equal" if not bad else f"{bad} not equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
