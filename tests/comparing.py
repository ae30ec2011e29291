"""Rows of a Spark query against rows of its SQL in DuckDB."""

import math
import os

import duckdb


def compare(spark, name, frame, sql, sf_dir):
    """A query's rows against its SQL's in DuckDB."""
    db = duckdb.connect()
    for file in os.listdir(sf_dir):
        db.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    value = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v
    columns = sorted(frame.columns)
    got = sorted((tuple(value(r[c]) for c in columns) for r in frame.collect()), key=repr)
    said = db.sql(sql)
    assert sorted(said.columns) == columns, name
    places = [said.columns.index(c) for c in columns]
    assert got == sorted((tuple(value(r[i]) for i in places) for r in said.fetchall()), key=repr), name
