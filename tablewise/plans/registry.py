"""Registry of named queries over the driver tables.

Each entry is a Spark callable ``(spark, sf_dir) -> DataFrame`` plus, where the
operator is SQL-expressible, an equivalent DuckDB SQL string over the same
tables (views named after the tables).  Column names match between the two.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so their ``register`` calls run."""
    from tablewise.plans import (q_assoc, q_cluster, q_encode, q_learn, q_outliers,  # noqa: F401
                                 q_plotdata, q_profile, q_quality, q_scalars, q_scale)


_DESCRIBE_CON = {}


def _describe_con(describe_dir: str):
    con = _DESCRIBE_CON.get(describe_dir)
    if con is None:
        import duckdb
        con = duckdb.connect()
        for t in ("region nation customer supplier part orders lineitem events documents "
                  "embeddings pages benchmark labels conversations").split():
            con.execute(f"create view {t} as select * from read_parquet('{describe_dir}/{t}.parquet')")
        _DESCRIBE_CON[describe_dir] = con
    return con


def rounded_sql(sql: str, describe_dir: str = "/root/testdata/sf0.001") -> str:
    """Wrap an oracle so floating columns are rounded like ``plans.common.finish``
    rounds the Spark side.  Column types come from DuckDB's DESCRIBE of the
    query over the smallest tables; on any failure the SQL is returned as is."""
    from tablewise.plans.common import DECIMALS, DIGITS
    try:
        cols = _describe_con(describe_dir).execute(f"describe ({sql})").fetchall()
    except Exception:
        return sql
    fl = [c[0] for c in cols if c[1] in ("DOUBLE", "FLOAT") or c[1].startswith("DECIMAL")]
    if not fl:
        return sql

    def rounded(name: str) -> str:
        c = f'("{name}"::double)'
        unit = f"pow(10.0::double, greatest(0.0, least({DECIMALS}.0, {DIGITS - 1} - floor(log10(abs({c}))))))"
        noise = f"abs({c}) < 5e-{DECIMALS + 1}"
        return f"""case when {noise} then 0.0::double when not isfinite({c}) then {c}
            else round_even({c} * (case when {noise} then 1 else {unit} end), 0) / (case when {noise} then 1 else {unit} end) end as "{name}" """
    return f"select * replace ({', '.join(map(rounded, fl))}) from ({sql}) as _q"
