"""Compare a Spark result with DuckDB's, columns by name and rows in any order."""

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_rows(sf, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(repr(r[i]) for i in order) for r in rows)


def differences(df, sf, sql):
    """None when equal, else a short account of what differs."""
    names, expected = normal(*oracle_rows(sf, sql))
    spark_names, actual = normal(df.columns, [tuple(r) for r in df.collect()])
    if names != spark_names:
        return f"columns {spark_names} != {names}"
    if actual != expected:
        extra, lacking = actual - expected, expected - actual
        return (
            f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
            f"extra {list(extra.items())[:3]}; lacking {list(lacking.items())[:3]}"
        )
    return None
