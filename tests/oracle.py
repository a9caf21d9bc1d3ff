"""Compares a Spark result with DuckDB's answer to its SQL."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _normal(frame):
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if frame[c].dtype.kind == "f":
            frame[c] = frame[c].map(lambda v: "null" if v != v else f"{v:.6g}")
        elif frame[c].dtype.kind == "M":
            frame[c] = frame[c].astype(str).replace("NaT", "null")
        else:
            frame[c] = frame[c].map(lambda v: "null" if v is None or v != v else str(v))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def assert_same(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got, want = _normal(query(spark, sf_dir).toPandas()), _normal(con.sql(sql).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    assert got.equals(want)
