import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roamrank.llm import inverted_multi_index, queries, topk_blocks, vectors

SCHEMA = "vec_id bigint, embedding array<float>, list string, block string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash", "clash") for i, v in rows], SCHEMA)


def good(rows, zero=True):
    ok = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))
    return [(i, np.asarray(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and ok(v)]


def brute(rows, every, k, change):
    out = []
    for q, qv in rows:
        if q % every:
            continue
        scored = []
        for i, v in rows:
            if i != q:
                n = min(len(v), len(qv))
                scored.append((-sum(a * b for a, b in zip(change(qv)[:n], change(v)[:n])), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.fixture
def rows():
    rng = random.Random(8)
    out = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(700)]
    out += [(i, [0.25] * 12) for i in range(700, 1000)]  # one vector that many share
    nan, inf = float("nan"), float("inf")
    out += [(1000, None), (1050, []), (1100, [nan] * 12), (1150, [None] * 12), (1200, [inf] * 12), (None, [0.1] * 12)]
    return [*out, (1250, [0.0] * 12), (1300, [1.0] * 6), (-50, [0.3] * 12)]


def whole(v):
    return [int(np.floor(256 * x)) for x in v]


def test_topk_is_exact(spark, rows, monkeypatch):
    for name, value in (("BLOCK", 16), ("LIST", 100), ("QUERIES", 5), ("PIVOTS", 4), ("SEEDS", 60)):
        monkeypatch.setattr(topk_blocks, name, value)
    found = topk_blocks.search(frame(spark, rows)).collect()
    assert sorted(map(tuple, found)) == brute(good(rows), 50, 5, whole)


def test_topk_is_exact_where_bundles_meet_lists_in_a_row(spark, rows, monkeypatch):
    for name, value in (("BLOCK", 4), ("LIST", 8), ("QUERIES", 5), ("PIVOTS", 4), ("SEEDS", 60)):
        monkeypatch.setattr(topk_blocks, name, value)
    pairs, meet = [], vectors.meet

    def counted(queries_, lists, n_lists):
        met = meet(queries_, lists, n_lists)
        at = met.select("q_block", "list", F.spark_partition_id().alias("task")).collect()
        pairs.extend([[r["q_block"], r["list"], r["task"]] for r in at])
        assert len({(b, n) for b, n, _ in pairs}) == len(pairs) == queries_.count() * lists.count()
        return met

    monkeypatch.setattr(topk_blocks.V, "meet", counted)
    found = topk_blocks.search(frame(spark, rows)).collect()
    assert sorted(map(tuple, found)) == brute(good(rows), 50, 5, whole)
    # On 8 cores some 130 lists are dealt in threes or more: a bundle follows itself.
    changes = sum(a[0] != b[0] or a[2] != b[2] for a, b in zip(pairs, pairs[1:]))
    assert 2 * changes < len(pairs)


def test_packed_matrices_keep_all_bits():
    rng = np.random.default_rng(4)
    matrix = rng.normal(0, 1, (5, 3))
    small = np.floor(256 * matrix) + 0.0
    odd = np.array([[-0.0, np.inf, 2.0**15]])
    for kind, m in ((b"d", matrix), (b"f", matrix.astype("f").astype(float)), (b"h", small), (b"f", odd), (b"d", odd + 1e-9)):
        data = vectors.packed(m)
        assert data[:1] == kind and vectors.unpacked(data, 3).tobytes() == m.tobytes()
    assert vectors.unpacked(vectors.packed(np.asfortranarray(small)), 3).tobytes() == small.tobytes()


def test_topk_of_few_and_of_none(spark, rows):
    few = [(0, [1.0, 2.0]), (50, [2.0, 1.0]), (7, [1.0, 1.0])]
    assert sorted(map(tuple, topk_blocks.search(frame(spark, few)).collect())) == brute(good(few), 50, 5, whole)
    assert topk_blocks.search(frame(spark, rows).limit(0)).count() == 0
    assert topk_blocks.search(frame(spark, [(1, [1.0])])).count() == 0


def test_topk_beyond_the_whole_numbers_of_a_double():
    big = np.array([[2.0**40, 3.0], [2.0**40, 5.0]])
    assert [int(x) for x in topk_blocks.products(big, big[:1])[:, 0]] == [2**80 + 9, 2**80 + 15]


def test_equal_query_rows(spark):
    twice = [(0, [1.0]), (0, [1.0]), (1, [2.0]), (2, [3.0])]
    found = sorted(map(tuple, topk_blocks.search(frame(spark, twice)).collect()))
    assert found == sorted([(0, 1, 2, 256 * 768), (0, 2, 1, 256 * 512)] * 2)


@pytest.fixture
def results_of_2_mb(spark):
    """Jobs whose tasks together send the driver more than 2 MB fail."""
    conf, key = spark.sparkContext._jsc.sc().conf(), "spark.driver.maxResultSize"
    before = conf.get(key, "1g")
    conf.set(key, "2m")
    yield
    conf.set(key, before)


def test_the_driver_gets_the_sample_alone_from_many_partitions(spark, results_of_2_mb):
    wide = F.transform(F.sequence(F.lit(1), F.lit(500)), lambda i: (F.col("id") % 997 / i).cast("float"))
    table = spark.range(0, 3200, 1, 32).select(F.col("id").alias("vec_id"), wide.alias("embedding"))
    ids, matrix = vectors.sample(table, 100)  # 100 rows of each partition have 6.4 MB
    hashes = [tuple(r) for r in table.select(F.xxhash64("vec_id"), "vec_id").collect()]
    assert ids.tolist() == [i for _, i in sorted(hashes)[:100]]
    assert np.allclose(matrix[:, 0], ids % 997) and matrix.shape == (100, 500)


def test_sample_of_repeated_ids_of_few_and_of_none(spark):
    rows = [(i, [float(i)]) for i in range(40)]
    hashes = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").select(F.xxhash64("vec_id"), "vec_id")
    order = [i for _, i in sorted(map(tuple, hashes.collect()))]
    for repeated in (order[0], order[5], order[39]):
        all_rows = rows + [(repeated, [float(repeated)])] * 200
        table = spark.createDataFrame(all_rows, "vec_id bigint, embedding array<float>").repartition(16)
        expected = [i for i in order for _ in range(201 if i == repeated else 1)]
        for n in (1, 7, 100, 1000):
            ids, matrix = vectors.sample(table, n)
            assert ids.tolist() == expected[:n] and matrix[:, 0].tolist() == expected[:n]
    assert len(vectors.sample(table.limit(0), 5)[0]) == 0


def test_neighbours_on_small_tables_are_exact(spark, rows, monkeypatch):
    monkeypatch.setattr(inverted_multi_index, "LIST", 100)
    monkeypatch.setattr(inverted_multi_index, "QUERIES", 7)
    monkeypatch.setattr(inverted_multi_index, "LEAST", 10_000)  # visits all pairs
    usable = good(rows, zero=False)
    found = sorted(map(tuple, inverted_multi_index.search(frame(spark, rows)).collect()))
    expected = brute(usable, 20, 20, lambda v: v)
    assert [f[:3] for f in found] == [e[:3] for e in expected]
    assert np.allclose([f[3] for f in found], [e[3] for e in expected], rtol=1e-12)
    assert inverted_multi_index.search(frame(spark, rows).limit(0)).count() == 0


def test_recall_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").toPandas()
    matrix = np.stack(table["embedding"]).astype(float)
    ids = table["vec_id"].to_numpy()
    found = {}
    for r in queries.op8_ann(spark, sf_dir).collect():
        found.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        top = set(ids[np.argsort(-scores, kind="stable")[:20]])
        own = found[ids[q]]
        assert len(own) == 20
        hits, total = hits + len(top & set(own)), total + 20
        assert all(abs(s - scores[np.searchsorted(ids, i)]) < 1e-12 for i, s in own.items())
    assert hits / total >= 0.9


def test_pairs_are_visited_by_summed_distance():
    rng = np.random.default_rng(3)
    for enough in (1, 30, 10_000):
        a, b, n = rng.random(6), rng.random(5), rng.integers(0, 9, (6, 5))
        visited = inverted_multi_index.traverse(a, b, n, enough)
        order = np.argsort((a[:, None] + b[None, :]).ravel())
        taken = np.cumsum(n.ravel()[order])
        many = min(30, int(np.searchsorted(taken, enough)) + 1)
        assert sorted(np.flatnonzero(visited.ravel())) == sorted(order[:many])


def test_recall_beside_a_vector_that_a_third_share(spark):
    """The copies use up no more of a query's visit than one vector's answers need."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id")
    table = table.limit(2000).toPandas()
    matrix = np.stack(table["embedding"]).astype(float)
    ids = table["vec_id"].to_numpy()
    asked = np.flatnonzero(ids % 20 == 0)
    for shared in (7, 777):
        copies = [(int(ids.max()) // 20 * 20 + 21 + 2 * i, list(table["embedding"][shared])) for i in range(1000)]
        rows = [(int(i), list(v)) for i, v in zip(ids, table["embedding"])] + copies
        found = {}
        for r in inverted_multi_index.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect():
            found.setdefault(r["query_id"], set()).add(r["vec_id"])
        all_ids = np.array([i for i, _ in rows])
        everything = np.vstack([matrix, np.repeat(matrix[[shared]], len(copies), axis=0)])
        hits = 0
        for q in asked:
            scores = (everything * matrix[q]).sum(axis=1)
            scores[q] = -np.inf
            hits += len(set(all_ids[np.lexsort((all_ids, -scores))[:20]].tolist()) & found[ids[q]])
        assert hits / (20 * len(asked)) >= 0.9


def test_only_visited_pairs_are_multiplied():
    rng = np.random.default_rng(5)
    queries_, matrix, second = rng.random((7, 4)), rng.random((50, 4)), np.sort(rng.integers(0, 6, 50))
    visited = rng.random((7, 6)) < 0.4
    close = inverted_multi_index.products(queries_, matrix, second, visited)
    asked = visited[:, second]
    assert np.all(np.isneginf(close) == ~asked) and np.allclose(close[asked], (queries_ @ matrix.T)[asked])
    pairs = np.zeros((2, 4, 3), dtype=bool)
    pairs[0, 1, 2] = pairs[1, 3, 0] = True
    assert inverted_multi_index.lists_named(pairs, [0, 2, 5, 6, 8]) == [2, 3, 4, 6, 7]


def test_bundles_meet_the_lists_they_visit(spark, monkeypatch):
    """Vectors in far clusters: each bundle needs few of the lists."""
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 1, (16, 8))
    centres *= 10 / np.linalg.norm(centres, axis=1, keepdims=True)
    rows = [(i, (centres[i % 16] + rng.normal(0, 0.1, 8)).tolist()) for i in range(3200)]
    for name, value in (("QUERIES", 10), ("LEAST", 100)):
        monkeypatch.setattr(inverted_multi_index, name, value)
    counts, meet = [], inverted_multi_index.V.meet

    def counted(*given):
        pairs = meet(*given)
        counts.extend([pairs.count(), given[0].count(), given[1].count()])
        return pairs

    monkeypatch.setattr(inverted_multi_index.V, "meet", counted)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = inverted_multi_index.search(table, every=25, visit=0.01).collect()
    assert counts[0] * 2 < counts[1] * counts[2]
    assert len(found) == 128 * 20 and all(r["vec_id"] % 16 == r["query_id"] % 16 for r in found)
