import hashlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskbook.llm import centroids as K
from riskbook.llm.queries import op13_centroid_clustering
from riskbook.llm.sql import CLUSTERING

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(vectors, centroids):
    distance = ((vectors[:, None].astype(object) - centroids[None].astype(object)) ** 2).sum(2)
    best = [min(range(len(centroids)), key=lambda n: (row[n], n)) for row in distance]
    return best, [row[n] for row, n in zip(distance, best, strict=True)]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 40), st.sampled_from([1, 2, 5, 64]), st.sampled_from([1, 3, 100, 1 << 27]))
def test_search_equals_all_distances(seed, many, size, wide):
    random = np.random.default_rng(seed)
    centroids = random.integers(-wide, wide + 1, (many, size))
    vectors = np.concatenate([random.integers(-wide, wide + 1, (30, size)), centroids[::2], np.full((2, size), wide)])
    number, distance = K.Search(centroids).nearest(vectors)
    assert (number.tolist(), distance.tolist()) == brute(vectors, centroids)


def test_search_leaves_out_most_distances():
    random = np.random.default_rng(7)
    centroids = random.integers(-1000, 1000, (256, 1)) + random.integers(-30, 30, (256, 16))
    search = K.Search(centroids)
    vectors = centroids[random.integers(0, 256, 5000)] + random.integers(-9, 9, (5000, 16))
    assert search.nearest(vectors)[0].tolist() == brute(vectors, centroids)[0]
    assert search.compared < 5000 * 256 / 8


def expected(rows, many=16, size=64, scale=64, rounds=3, salt="1"):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    vectors = np.array([[int(np.floor(scale * float(np.float32(x)))) for x in v] for _, v in kept])
    digest = [(i is None, hashlib.sha256(f"{salt}:{i}".encode()).hexdigest(), v.tolist()) for (i, _), v in zip(kept, vectors, strict=True)]
    middles = vectors[sorted(range(len(kept)), key=lambda r: digest[r])[:many]]
    for _ in range(rounds):
        best, _ = brute(vectors, middles)
        for n in set(best):
            mine = vectors[[b == n for b in best]]
            middles[n] = [int(s) // len(mine) for s in mine.sum(0)]
    best, distance = brute(vectors, middles)
    inertia = [sum(d for d, b in zip(distance, best, strict=True) if b == n) for n in range(len(middles))]
    name = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles.tolist()]
    return [(i, b, d, inertia[b], sum(distance), name[b]) for (i, _), b, d in zip(kept, best, distance, strict=True)]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force_and_sql(spark, data):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = result(op13_centroid_clustering(spark, data))
    assert found == sorted(expected(rows), key=repr)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{data}/embeddings.parquet'")
    assert found == sorted(db.sql(CLUSTERING).fetchall(), key=repr)


def test_odd_vectors(spark):
    random = np.random.default_rng(3)
    full = [(i, random.normal(0, 0.3, 64).astype(np.float32).tolist(), 1) for i in range(60)]
    bad = [[None] * 64, [0.1] * 63, [0.1] * 65, [], None, [float("nan")] * 64, [float("inf")] + [0.0] * 63, [-float("inf")] * 64, [None] + [0.0] * 63]
    rows = [*full, *full[:5], *[(900 + i, v, None) for i, v in enumerate(bad)], (None, [0.5] * 64, 2), (None, [-0.5] * 64, 2), (None, [-0.5] * 64, 2)]
    docs = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS cluster", "1 AS id", "2 AS distance", "3 AS vector")
    assert result(K.report(*K.cluster(docs.repartition(4)))) == sorted(expected([r[:2] for r in rows]), key=repr)
    few = spark.createDataFrame(rows[:3], VECTORS)
    assert result(K.report(*K.cluster(few))) == sorted(expected([r[:2] for r in rows[:3]]), key=repr)
    for none in (rows[:0], rows[65:68]):
        assert K.report(*K.cluster(spark.createDataFrame(none, VECTORS))).count() == 0
    same = spark.createDataFrame([(i % 3, [0.25] * 64, 0) for i in range(50)], VECTORS)
    assert {r["distance"] for r in K.report(*K.cluster(same)).collect()} == {0}


def test_too_wide_components_are_an_error(spark):
    wide = spark.createDataFrame([(1, [1e9] * 64, 0)], VECTORS)
    with pytest.raises(Exception, match="after scaling"):
        K.cluster(wide)


def test_other_sizes(spark, data):
    docs = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(r[0], r[1]) for r in docs.select("vec_id", "embedding").collect()]
    found, middles = K.cluster(docs.repartition(7), centroids=40, scale=1000, rounds=2, salt="other")
    assert middles.shape == (40, 64)
    assert result(K.report(found, middles)) == sorted(expected(rows, 40, 64, 1000, 2, "other"), key=repr)
