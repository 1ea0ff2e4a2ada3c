"""Compares a query with its SQL in DuckDB, column by column, in any order of rows."""

import glob
import os

import duckdb

SF = "/root/testdata/sf0.001"


def connect(sf=SF):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}{'/*' if os.path.isdir(f) else ''}')")
    return con


def rows(table):
    import math

    def plain(v):
        if hasattr(v, "item"):
            v = v.item()
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(v, 9) if isinstance(v, float) else v

    names = sorted(table.column_names)
    data = table.select(names).to_pylist()
    return names, sorted(([plain(r[n]) for n in names] for r in data), key=repr)


def same(df, sql, sf=SF):
    import pyarrow as pa

    a, b = df.toArrow(), connect(sf).sql(sql).to_arrow_table()
    b = b.read_all() if isinstance(b, pa.RecordBatchReader) else b
    na, ra = rows(a)
    nb, rb = rows(b)
    assert na == nb
    assert len(ra) == len(rb)
    for x, y in zip(ra, rb):
        assert [float(v) if isinstance(v, int) and not isinstance(v, bool) else v for v in x] == [float(v) if isinstance(v, int) and not isinstance(v, bool) else v for v in y]
