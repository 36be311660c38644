"""Order-insensitive comparison of Spark rows with DuckDB rows (as the driver does)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib


def norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def digest(cols, rows) -> str:
    return hashlib.sha256("\n".join(repr(r) for r in canonical(cols, rows)).encode()).hexdigest()


def differences(scols, srows, ocols, orows, limit=3):
    names = sorted(scols)
    s, o = set(canonical(scols, srows)), set(canonical(ocols, orows))
    out = []
    for label, diff in (("spark-only", s - o), ("oracle-only", o - s)):
        for row in sorted(diff, key=repr)[:limit]:
            out.append((label, dict(zip(names, row))))
    return out
