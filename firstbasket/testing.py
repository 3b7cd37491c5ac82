"""Order-insensitive comparison of two pandas result frames (Spark vs an SQL oracle), used by the
tests and ``scripts/check_oracle.py``: columns by name, rows as sorted multisets, floats exact
(PASS) or within 1e-9 relative (NEAR)."""

from __future__ import annotations

import math

import pandas as pd


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return norm(v.item())
        except Exception:
            return v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    from decimal import Decimal
    if isinstance(v, Decimal):
        return float(v)
    return v


def rows_of(df: pd.DataFrame, cols):
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def close(a, b, tol):
    if a is None or b is None:
        return a is None and b is None
    if a == b:
        return True
    if isinstance(a, float) or isinstance(b, float):
        try:
            return abs(float(a) - float(b)) <= tol * max(1.0, abs(float(a)), abs(float(b)))
        except Exception:
            return False
    return a == b


def compare(sp: pd.DataFrame, db: pd.DataFrame):
    sc, dc = sorted(sp.columns), sorted(db.columns)
    if sc != dc:
        return "COLS", f"spark={sc} duck={dc}"
    if len(sp) != len(db):
        return "ROWS", f"spark={len(sp)} duck={len(db)}"
    a, b = rows_of(sp, sc), rows_of(db, sc)
    exact = all(all(close(x, y, 0.0) for x, y in zip(r, s)) for r, s in zip(a, b))
    if exact:
        return "PASS", ""
    near = all(all(close(x, y, 1e-9) for x, y in zip(r, s)) for r, s in zip(a, b))
    for r, s in zip(a, b):
        if any(not close(x, y, 1e-9 if near else 0.0) for x, y in zip(r, s)):
            diff = [(c, x, y) for c, x, y in zip(sc, r, s) if not close(x, y, 0.0)]
            return ("NEAR" if near else "VALUES"), f"first diff: {diff[:4]}"
    return "VALUES", ""


_SQL_NAMES = {
    "LongType()": "BIGINT", "IntegerType()": "INTEGER", "ShortType()": "SMALLINT", "ByteType()": "TINYINT",
    "DoubleType()": "DOUBLE", "FloatType()": "FLOAT", "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN",
    "TimestampNTZType()": "TIMESTAMP", "DateType()": "DATE",
}


def type_mismatches(spark_schema, duck_columns, duck_types) -> list[tuple[str, str, str]]:
    """(column, Spark type, DuckDB type) for every column whose types differ."""
    duck = dict(zip(duck_columns, [str(t) for t in duck_types]))
    out = []
    for f in spark_schema.fields:
        s = str(f.dataType)
        name = _SQL_NAMES.get(s, s.replace("DecimalType(", "DECIMAL("))
        if duck.get(f.name) != name:
            out.append((f.name, s, duck.get(f.name)))
    return out
