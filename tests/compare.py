"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if value is not None and not isinstance(value, (bool, int, str)):
        return float(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df, con, sql):
    """None if equal, else a short description."""
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_names, want = _rows([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return None if not bad else f"{len(bad)} of {len(got)} rows differ, e.g. {got_names}: {bad[0]}"
