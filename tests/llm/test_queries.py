"""The registered queries themselves, on the smallest tables."""

import duckdb
import pytest

from concordat.llm import queries as q

SMALL = "/root/testdata/sf0.001"


def plain(rows):
    return sorted(tuple(str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", ["op12_merkle", "op13_phrases"])
def test_new_queries_equal_their_sql(spark, name):
    df = q.QUERIES[name](spark, SMALL)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.sql(q.ORACLES[name])
    assert sorted(want.columns) == sorted(df.columns)
    assert plain(df.select(*want.columns).collect()) == plain(want.fetchall())


def test_merkle_query_tells_tampered_documents(spark):
    rows = q.op12_merkle(spark, SMALL).collect()
    con = duckdb.connect()
    capitals = dict(con.sql(f"SELECT doc_id, text <> translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM '{SMALL}/documents.parquet'").fetchall())
    import zlib

    assert len(rows) == len(capitals) and len({r.root for r in rows}) == 1
    for r in rows:
        assert r.verified == (r.folded_root == r.root) == (not (zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and capitals[r.doc_id]))


def test_mixing_query(spark):
    df = q.op11_mixing(spark, SMALL)
    assert df.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")]
    rows = df.collect()
    con = duckdb.connect()
    want = con.sql(f"SELECT doc_id, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), source FROM '{SMALL}/documents.parquet'").fetchall()
    sizes, sources = {i: n for i, n, _ in want}, {i: s for i, _, s in want}
    assert {r.doc_id: r["size"] for r in rows} == sizes and all(r.taken in (0, r["size"], 2 * r["size"]) for r in rows)
    total = sum(sizes.values())
    by_source = {}
    for r in rows:
        by_source.setdefault(sources[r.doc_id], []).append(r)
    targets = {s: x[0].target for s, x in by_source.items()}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    for s, x in by_source.items():
        assert x[0].source_size == sum(r["size"] for r in x) and targets[s] <= 2 * x[0].source_size + 1e-6
        assert abs(sum(r.taken for r in x) - targets[s]) <= max(r["size"] for r in x) / 2
    assert sorted(map(str, rows)) == sorted(map(str, q.op11_mixing(spark, SMALL).collect()))
