import numpy as np
import pytest
from pyspark.sql import functions as F

from sensoria.checks.compare import differences
from sensoria.llm import hamming


def nearest(rows, asked, k):
    out = []
    for q, a in rows:
        if q not in asked or a is None or not a:
            continue
        near = []
        for i, b in rows:
            if i is None or i == q or not b:
                continue
            size = max(len(x) for _, x in rows if x)
            bit = lambda v, n: n < len(v) and v[n] is not None and (v[n] >= 0 or v[n] != v[n])
            near.append((sum(bit(a, n) != bit(b, n) for n in range(size)), i))
        out += [(q, rank, i, d) for rank, (d, i) in enumerate(sorted(near)[:k], 1)]
    return sorted(set(out))


def found_by(spark, rows, asked, s):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string, code string, value long")
    result = hamming.top_k(vectors, vectors.where(F.col("vec_id").isin(asked)), s)
    return sorted((r.query_id, r["rank"], r.neighbour_id, r.distance) for r in result.collect())


@pytest.mark.parametrize("block", [8192, 40])  # with 40, many blocks of codes and queries meet
def test_equals_brute_force(spark, block):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((5, 70))
    rows = []
    for i in range(400):
        vector = rng.standard_normal(70) if i % 3 else centres[i % 5] + 0.4 * rng.standard_normal(70)
        rows.append((i, [float(np.float32(x)) for x in vector]))
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # one vector many times
    rows += [(2000, None), (2001, []), (2002, [1.0, None, float("nan")]), (None, rows[1][1])]
    asked = [0, 50, 100, 151, 1000, 2000, 2001, 2002]
    found = found_by(spark, [(*r, "x", "y", 1) for r in rows], asked, hamming.Settings(k=7, block_codes=block, block_queries=3))
    assert found == nearest(rows, asked, 7)


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, -1.0], "x", "y", 1), (50, [1.0, 1.0], "x", "y", 1)]
    assert found_by(spark, rows, [0, 50], hamming.Settings()) == [(0, 1, 50, 1), (50, 1, 0, 1)]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert hamming.top_k(none, none).count() == 0


@pytest.mark.parametrize("block", [8192, 20])
def test_repeated_ids_leave_k_neighbours(spark, block):
    rng = np.random.default_rng(9)
    vector = lambda: [float(np.float32(x)) for x in rng.standard_normal(40)]
    rows = [(i, vector()) for i in range(60)]
    rows += [(0, rows[0][1])] + [(1, rows[1][1])] * 30  # one vector again
    rows += [(2, vector()) for _ in range(30)]  # one id with many vectors
    rows += [(3, rows[4][1])] * 5 + [(100 + i, rows[1][1]) for i in range(3)]
    asked = [0, 1, 2, 3, 4, 100]
    found = found_by(spark, [(*r, "x", "y", 1) for r in rows], asked, hamming.Settings(k=10, block_codes=block, block_queries=3))
    expected = []
    for q in asked:
        for code in {tuple(x >= 0 for x in v) for i, v in rows if i == q}:
            near = sorted((sum(a != (x >= 0) for a, x in zip(code, v, strict=True)), i) for i, v in rows if i != q)
            expected += [(q, rank, i, d) for rank, (d, i) in enumerate(near[:10], 1)]
    assert found == sorted(expected)


def test_query_equals_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    duckdb_tables = duckdb.connect()
    duckdb_tables.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    expected = duckdb_tables.sql(hamming.ORACLE).to_arrow_table()
    assert differences(hamming.op3_hamming(spark, folder).toArrow(), expected) == []
