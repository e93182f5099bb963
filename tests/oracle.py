"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, db, folder: str, function, sql: str) -> str:
    """Empty when the same; else what differs."""
    df = function(spark, folder)
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(sql)
    want_names, want = _rows([c[0] for c in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; {got[:2]} {want[:2]}"
    different = [(g, w) for g, w in zip(got, want) if g != w]
    kinds = [
        (n, type(g).__name__, type(w).__name__)
        for row_g, row_w in zip(got[:50], want[:50])
        for n, g, w in zip(got_names, row_g, row_w)
        if g is not None and type(g) is not type(w)
    ]
    if different:
        return f"{len(different)} rows differ of {len(got)}: {str(different[0])[:600]}"
    return f"kinds {kinds[:3]}" if kinds else ""


def main(folder: str, wanted: list[str]) -> None:
    from recspark.session import local_session

    import __spark_entry__ as entry

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    oracles = entry.oracle_sql()
    for name, function in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, db, folder, function, oracles[name]) or "same"
            else:
                verdict = f"rows only: {function(spark, folder).count()}"
        except Exception as error:  # the report goes on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:900]}"
        print(f"{name:32s} {time.time() - start:6.2f}s  {verdict}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
