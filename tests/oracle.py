"""Compare a registered Spark query with its DuckDB oracle (order-insensitive)."""

from __future__ import annotations

import math

import duckdb

from tablewise.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if v is None:
        return None
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def compare(spark_df, con, sql: str, tol: float = 1e-9) -> list[str]:
    """Differences: floats may differ by ``tol`` of their size, all else not at all."""
    pdf = spark_df.toPandas()
    odf = con.execute(sql).df()
    errs = []
    if sorted(pdf.columns) != sorted(odf.columns):
        return [f"columns differ: spark={sorted(pdf.columns)} oracle={sorted(odf.columns)}"]
    cols = sorted(pdf.columns)
    if len(pdf) != len(odf):
        errs.append(f"row count spark={len(pdf)} oracle={len(odf)}")
    rows = lambda df: sorted((tuple(_norm(x) for x in r) for r in
                              df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False)), key=_key)
    bad = 0
    for ra, rb in zip(rows(pdf), rows(odf)):
        for c, x, y in zip(cols, ra, rb):
            if x != y and not (isinstance(x, float) and isinstance(y, (int, float)) and abs(x - y) <= tol * abs(y)):
                bad += 1
                if len(errs) < 5:
                    errs.append(f"{c}: spark={x!r} oracle={y!r}")
                break
    if bad:
        errs.append(f"{bad} differing cells")
    return errs
