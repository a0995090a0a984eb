"""Spark results against DuckDB on the same Parquet tables."""

import os


def values(rows):
    def norm(v):
        if isinstance(v, float):
            return "nan" if v != v else repr(v + 0.0)
        return "[" + ",".join(map(norm, v)) + "]" if isinstance(v, list) else str(v)

    return sorted(tuple(map(norm, r)) for r in rows)


def duck(folder, sql):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    got = con.execute(sql)
    return [c[0] for c in got.description], got.fetchall()


def same(df, folder, sql):
    columns, rows = duck(folder, sql)
    assert sorted(columns) == sorted(df.columns)
    at = [columns.index(c) for c in sorted(columns)]
    spark_rows = values(tuple(r) for r in df.select(*sorted(df.columns)).collect())
    assert spark_rows == values(tuple(r[i] for i in at) for r in rows)
