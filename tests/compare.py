"""Order-free comparison of a Spark result with its SQL check."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "null"
        return repr(0.0 if value == 0 else value)
    if value is None:
        return "null"
    if isinstance(value, (datetime.datetime, datetime.date, decimal.Decimal)):
        return f"{type(value).__name__}:{value}"
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, con, sql):
    cursor = con.execute(sql)
    expected_names, expected = _rows([d[0] for d in cursor.description], cursor.fetchall())
    names, rows = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if names != expected_names:
        return f"columns {names} <> {expected_names}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows <> {len(expected)}"
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[:3]}"
    return "" if rows else "no rows"
