import numpy as np
from pyspark.sql import functions as F

from staylake.llm import ann, hamming, queries
from tests.conftest import SF


def brute_codes(rows, asks, k):
    rows = sorted(set(rows))
    out = []
    for q, code in rows:
        if asks(q):
            best = {}
            for i, c in rows:
                if i != q:
                    d = bin((code ^ c) & (1 << 64) - 1).count("1")
                    best[i] = min(d, best.get(i, 99))
            for r, (d, i) in enumerate(sorted((d, i) for i, d in best.items())[:k]):
                out.append((q, r + 1, i, d))
    return sorted(out)


def test_hamming_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hamming, "PART_CODES", 40)
    rng = np.random.default_rng(2)
    base = rng.integers(-(1 << 63), 1 << 63, 30)
    codes = [int(base[rng.integers(30)]) ^ (1 << int(rng.integers(63))) * int(rng.integers(2)) for _ in range(300)] + [int(base[0])] * 60
    rows = [(i, c) for i, c in enumerate(codes)]
    frame = spark.createDataFrame([*rows, rows[0], rows[0], (None, 5), (7, None)], "id long, code long")
    got = sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in hamming.top_k(frame, F.col("id") % 20 == 0, 10).collect())
    assert got == brute_codes(rows, lambda q: q % 20 == 0, 10)


def test_hamming_few_rows_and_empty(spark):
    rows = [(0, 0), (1, -1), (20, 255)]
    frame = spark.createDataFrame(rows, "id long, code long")
    got = sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in hamming.top_k(frame, F.col("id") % 20 == 0, 10).collect())
    assert got == brute_codes(rows, lambda q: q % 20 == 0, 10)
    assert hamming.top_k(frame.where("id > 100"), F.col("id") % 20 == 0).count() == 0
    assert hamming.top_k(frame.where("id = 1"), F.col("id") % 20 == 0).count() == 0


def test_op6_matches_brute_force(spark):
    codes = [(r["id"], r["code"]) for r in hamming.sign_codes(queries.table(spark, SF, "embeddings"), "vec_id", "embedding").collect()]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["distance"]) for r in queries.op6_hamming(spark, SF).collect())
    assert got == brute_codes(codes, lambda q: q % 20 == 0, 10)


def edge_vectors(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, None), (3, [0.0, 0.0, 0.0]), (4, [float("nan"), 1.0, 0.0]), (5, [float("inf"), 1.0, 0.0]), (6, [None, 1.0, 0.0]),
            (7, []), (8, [1.0, 1.0]), (50, [1.0, 0.5, 0.0]), (50, [1.0, 0.5, 0.0]), (51, [-1.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0])]
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label string")


def test_sign_codes_edges(spark):
    got = {r["id"]: r["code"] for r in hamming.sign_codes(edge_vectors(spark), "vec_id", "embedding").collect()}
    assert set(got) == {0, 1, 3, 8, 50, 51, None} and got[0] == got[1] and got[0] == ~got[51]


def test_hadamard_is_an_orthonormal_rotation():
    x = np.random.default_rng(1).normal(size=(20, 48))
    y = ann.rotate(x, 3, 8)
    assert y.shape == (20, 64) and np.allclose(x @ x.T, y @ y.T)


def test_vector_recall_scores_and_order(spark):
    table = queries.table(spark, SF, "embeddings").toPandas()
    ids, v = table.vec_id.to_numpy(), np.array(table.embedding.tolist(), dtype=np.float64)
    got = queries.op8_vectors(spark, SF).toPandas()
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        a = v[ids == q][0]
        score = (v * a).sum(1) / (np.sqrt((v * v).sum(1)) * np.sqrt((a * a).sum()))
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5]
        at = np.searchsorted(ids, mine.vec_id)
        assert np.allclose(mine.score, score[at], rtol=0, atol=1e-15)
        assert sorted(zip(-mine.score, mine.vec_id, strict=True)) == list(zip(-mine.score, mine.vec_id, strict=True))
        order = np.lexsort((ids, -score))
        hits += len(set(ids[order[ids[order] != q]][:5]) & set(mine.vec_id))
        total += 5
    assert hits >= 0.9 * total


def test_vector_edges(spark):
    table = edge_vectors(spark)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.search(table, "vec_id", "embedding", F.col("vec_id") % 50 == 0, tables=4, probes=8).collect()}
    assert {k: v[0] for k, v in got.items()} == {(0, 1): 1, (0, 2): 50, (0, 3): 51, (50, 1): 0, (50, 2): 1, (50, 3): 51}
    assert got[(0, 1)][1] == 1.0 and abs(got[(50, 1)][1] - 1 / np.sqrt(1.25)) < 1e-15
    assert ann.search(table.where("vec_id > 100"), "vec_id", "embedding", F.col("vec_id") % 50 == 0).count() == 0


def test_few_spread_vectors_are_all_found(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_VECTORS", 3)
    v = np.random.default_rng(5).normal(size=(4, 64)).astype(np.float32)
    rows = [(k, x) for k, x in enumerate([v[0], -v[0], v[1], -v[1]])]  # fewer than k others
    rows += [(100, np.append(v[2], 1)), *((101 + k, np.append(v[2] * (k + 2), k + 2)) for k in range(3)), *((110 + k, np.append(-v[2] + v[3] * k / 100, -1)) for k in range(9))]  # another length, few near, the others opposite
    table = spark.createDataFrame([(k, x.tolist()) for k, x in rows], "vec_id long, embedding array<float>")
    asks = [0, 100]
    got = ann.search(table, "vec_id", "embedding", F.col("vec_id").isin(asks), k=5).collect()
    for q, a in rows:
        if q in asks:
            others = sorted((-float(ann.exact_cosines(a[None].astype(float), b[None].astype(float))[0]), k) for k, b in rows if k != q and len(b) == len(a))[:5]
            assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [k for _, k in others]
            assert np.allclose(sorted(-r["score"] for r in got if r["query_id"] == q), [s for s, _ in others], rtol=0, atol=1e-12)


def test_many_equal_vectors_tie_by_id(spark):
    table = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(120)] + [(200, [2.0, 1.0])], "vec_id long, embedding array<float>")
    got = ann.search(table, "vec_id", "embedding", F.col("vec_id") % 50 == 0, tables=4, probes=4).collect()
    by = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 50, 100, 200)}
    assert by == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4], 100: [0, 1, 2, 3, 4], 200: [0, 1, 2, 3, 4]}
