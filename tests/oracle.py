"""Runs the SQL side of a check and compares rows regardless of order."""

import math
from pathlib import Path

import duckdb


def connect(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (0, "") if math.isnan(value) else (1, repr(value + 0.0))
    if isinstance(value, bool):
        return (2, str(value))
    if isinstance(value, int):
        return (1, repr(float(value)))
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(frame, connection, sql):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(names)
    expected = rows_of(names, result.fetchall())
    actual = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    assert len(actual) == len(expected)
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not different, different[:3]
    return len(actual)
