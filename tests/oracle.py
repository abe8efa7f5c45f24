"""Compares a query with its SQL, without regard to order."""

import datetime
import decimal
import os

import duckdb


def _plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 9))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def same(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"create view {name.split('.')[0]} as select * from '{sf_dir}/{name}'")
    df = query(spark, sf_dir)
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    at = [columns.index(c) for c in df.columns]
    want = sorted(tuple(_plain(r[i]) for i in at) for r in found.fetchall())
    assert sorted(tuple(map(_plain, r)) for r in df.collect()) == want
    return len(want)
