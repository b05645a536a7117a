"""The exact search at sizes where one query at a time takes minutes, over many shards, and with numbers of every size."""

import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from recoflow.llm import kd_search


def expected(ids, points, k=20, every=20):
    """Ids and scores by brute force, one row per query; for distinct ids and vectors of whole numbers."""
    found = {}
    for own in ids[ids % every == 0].tolist():
        scores = points @ points[ids == own][0]
        order = np.lexsort((ids, -scores))
        order = order[ids[order] != own][:k]
        found[own] = list(zip(ids[order].tolist(), scores[order].astype(np.int64).tolist()))
    return found


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_search_of_points_that_no_box_tells_apart(spark, tmp_path):
    """60,000 points without any structure: 180 million products, in blocks (a query and a leaf at a time took 69 s)."""
    rng = np.random.default_rng(1)
    ids, points = np.arange(60_000), rng.normal(size=(60_000, 64))
    points = (points / np.linalg.norm(points, axis=1)[:, None]).astype(np.float32)
    vectors = pa.ListArray.from_arrays(np.arange(0, points.size + 1, 64, dtype=np.int32), pa.array(points.ravel()))
    pq.write_table(pa.table({"vec_id": ids, "embedding": vectors}), tmp_path / "v.parquet")
    table = spark.read.parquet(str(tmp_path / "v.parquet"))
    kd_search.top_k(table.where("vec_id < 100")).count()  # starts the workers
    start = time.perf_counter()
    rows = kd_search.top_k(table).collect()
    assert time.perf_counter() - start < 20
    got, whole = found(rows), np.floor(64 * points.astype(np.float64))
    assert len(rows) == 60_000 and all(len(x) == 20 for x in got.values())
    some = np.flatnonzero(ids % 1000 == 0)
    for own in some.tolist():
        scores = whole @ whole[own]
        order = np.lexsort((ids, -scores))
        order = order[order != own][:20]
        assert got[own] == list(zip(order.tolist(), scores[order].astype(int).tolist()))


def test_search_over_many_shards(spark):
    """Rounds over more and more shards; many equal vectors, whose ids decide, and queries with fewer rows than k in a shard."""
    rng = np.random.default_rng(2)
    ids = rng.permutation(600)[:500]
    points = rng.integers(-3, 4, (500, 3)).astype(float)
    points[100:220] = points[100]
    vectors = spark.createDataFrame([(int(i), p.tolist()) for i, p in zip(ids, points)], "vec_id long, embedding array<double>")
    for shard_rows in (4, 12, 1 << 16):
        assert found(kd_search.top_k(vectors, shard_rows=shard_rows).collect()) == expected(ids, 64 * points)


def test_blocks_of_every_kind_of_number():
    """Trees of each kind of sums, boxes opened for some of the queries, kth rows carried along: as by brute force."""
    rng = np.random.default_rng(3)
    for size, scale, kind in ((6, 40, np.float32), (6, 30_000, np.float64), (5, 1 << 29, np.int64), (4, 1e12, object), (0, 1, np.float32)):
        centres = rng.integers(-scale, scale + 1, (9, size))
        points = np.floor(centres[rng.integers(0, 9, 3000)] + rng.integers(-9, 10, (3000, size)) * (scale / 40))
        points[500:900] = points[500]
        ids = rng.permutation(5000)[:3000]
        queries, own = points[ids % 20 == 0], ids[ids % 20 == 0]
        exact = [[sum(int(a) * int(b) for a, b in zip(q, p)) for p in points] for q in queries[:40]]
        queries, own = queries[:40], own[:40]
        clipped = [[max(-1 << 63, min((1 << 63) - 1, s)) for s in row] for row in exact]
        want = [sorted((-s, i) for s, i in zip(row, ids.tolist()) if i != o)[:20] for row, o in zip(clipped, own.tolist())]
        trees = [kd_search.KDTree(ids[half], points[half]) for half in (slice(0, 1400), slice(1400, None))]
        none = np.zeros(len(own), np.int64)
        best = kd_search.Best(own, none > 0, none, none, 20)
        for tree in trees:
            tree.search(queries, best)
            assert list(tree.kinds) == [kind]
        best.settle()
        got = [[(-s, i) for r, s, i in zip(best.rows.tolist(), best.scores.tolist(), best.ids.tolist()) if r == n] for n in range(len(own))]
        assert got == want
        # What other shards have found turns away all that comes after it, and nothing else.
        kth = [w[9] for w in want]
        best = kd_search.Best(own, none == 0, np.array([-s for s, _ in kth]), np.array([i for _, i in kth]), 20)
        for tree in trees:
            tree.search(queries, best)
        best.settle()
        got = [[(-s, i) for r, s, i in zip(best.rows.tolist(), best.scores.tolist(), best.ids.tolist()) if r == n] for n in range(len(own))]
        assert got == [w[:9] for w in want]


def test_vectors_are_packed_as_narrow_as_they_are(spark):
    rows = [(1, [1.0, -0.001]), (2, [1.99, -2.0]), (3, [3.0]), (4, [600.0, 0.0]), (5, [1e9, 0.0]), (6, []), (7, [1.0, None]), (8, None), (None, [1.0]), (9, [float("inf")])]
    packed = kd_search.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 64).collect()
    got = {r.id: np.frombuffer(r.vector, kd_search.STORED[r.width]).tolist() for r in packed}
    assert got == {1: [64, -1], 2: [127, -128], 3: [192], 4: [38400, 0], 5: [64e9, 0], 6: []}
    assert {r.id: r.width for r in packed} == {1: 1, 2: 2, 3: 2, 4: 4, 5: 8, 6: 1} and all(r.size == len(got[r.id]) for r in packed)


def test_packed_products_miss_no_score(monkeypatch):
    """Sums of four or three scores: whatever reaches its limit is found, also beside scores far below theirs."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(kd_search, "FEW", 2)
    far = cases = 0
    for fields, spread, n in ((4, 12, 8), (4, 17, 40), (4, 18, 1), (4, 19, 27), (3, 60, 7), (3, 75, 32), (4, 1, 3), (3, 2, 257)):
        for shift in (0, 3, -3):
            queries = np.clip(rng.integers(-spread, spread + 1, (n, 24)) + shift, -spread, spread).astype(float)
            points = np.clip(rng.integers(-spread, spread + 1, (900, 24)) + shift, -spread, spread).astype(float)
            points[:n], points[300:300 + n] = queries, -queries  # the highest and the lowest scores there can be
            most = np.ceil(kd_search.length(queries) * kd_search.length(points).max()).astype(int) + 1
            scores = queries @ points.T
            packed = kd_search.Packed(queries, most, np.floor(scores.mean(axis=1)).astype(int), fields)
            for rank in (1, 2, 20, 300):
                limits = -np.sort(-scores, axis=1)[:, rank - 1].astype(int) + (rank == 2)
                at = np.minimum(limits, packed.highest)
                if (at < packed.lowest).any():
                    continue
                found = packed.reached(points, limits)
                got = set(zip(*(x.tolist() for x in found)))
                assert set(zip(*(x.tolist() for x in np.nonzero(scores >= limits[:, None])))) <= got and len(found[0]) == len(got)
                below = scores < at[:, None] - packed.half
                far, cases = far + below.sum(), cases + 1
                if not below.any():
                    assert got <= set(zip(*(x.tolist() for x in np.nonzero(scores >= at[:, None] - 1))))
    assert far > 50 and cases > 50
    # Limits that leave too wide a range have no packed product.
    assert kd_search.Packed.fitting(queries * 900, most * 900, most * 0, most * 0) is None


def test_blocks_use_packed_products(monkeypatch):
    """Vectors of length 1 with 64 components fit; the result is that of brute force, ties and equal points included."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(30_000, 64))
    points = np.floor(64 * points / np.linalg.norm(points, axis=1)[:, None]).astype(np.int8)
    points[7000:7300] = points[7000]
    ids = rng.permutation(40_000)[:30_000]
    used = []

    def reached(self, points, limits, plain=kd_search.Packed.reached):
        used.append((self.fields, self.count * len(points)))
        return plain(self, points, limits)

    monkeypatch.setattr(kd_search.Packed, "reached", reached)
    queries, own = points[6500:7100], ids[6500:7100]
    best = kd_search.Best(own, np.zeros(600, bool), np.zeros(600, np.int64), np.zeros(600, np.int64), 20)
    kd_search.KDTree(ids, points).search(queries, best)
    best.settle()
    scores = queries.astype(int) @ points.T.astype(int)
    for n in range(600):
        order = np.lexsort((ids, -scores[n]))
        order = order[ids[order] != own[n]][:20]
        assert best.ids[best.rows == n].tolist() == ids[order].tolist() and best.scores[best.rows == n].tolist() == scores[n, order].tolist()
    assert {fields for fields, _ in used} == {4} and sum(pairs for _, pairs in used) > 600 * 10_000
