import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from staylake.llm import hard_negatives, line_dedup, queries, whitening
from staylake.llm._scratch import Scratch
from tests.conftest import SF
from tests.llm.conftest import EDGE_TEXTS


@pytest.mark.parametrize("name", ["op11_line_dedup", "op12_hard_negatives"])
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    frame = queries.QUERIES[name](spark, SF)
    rel = con.sql(queries.ORACLES[name])
    assert sorted(rel.columns) == sorted(frame.columns)
    order = [rel.columns.index(c) for c in frame.columns]
    expected = sorted(tuple(r[k] for k in order) for r in rel.fetchall())
    assert expected and sorted(tuple(r) for r in frame.collect()) == expected


# ---- lines

def key_of(line):
    bare = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare)


def kept(rows, min_chars=10):
    """(doc_id, n_lines, n_dropped, kept text) of every row, by dictionaries."""
    place = lambda d: (d is None, d or 0)
    first = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            k = key_of(line)
            first[k] = min(first.get(k, place(d)), place(d))
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key_of(x)) < min_chars or first[key_of(x)] == place(d)]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


LINE = "All rights reserved, no part may be copied"
ROWS = [
    (5, f"{LINE}\nfirst of five\n{LINE}"), (2, f"  {LINE.upper()}\t\nown line of two\nshort\n\n{LINE} "), (2, f"again under two\n{LINE}"),
    (9, LINE), (9, LINE), (None, f"{LINE}\nnobody has this one\nshort"), (None, "nobody has this one\nshort"), (7, "short\nÉTÉ ÀÉÎ ÇÑØ capitals\nété àéî çñø capitals\n"),
    (8, "été àéî çñø capitals\nété àéî çñø CAPITALS\n\x0b\x0cété àéî çñø capitals \r"), (11, "ΣΊΣΥΦΟΣ line ⅣⒶ"), (12, "σίσυφος line ⅳⓐ"), (13, "ΣΊΣΥΦΟΣ LINE ⅣⒶ"),
    (20, "123456789"), (21, "123456789"), (22, "1234567890"), (23, "1234567890"), (24, "日本語の文章です。はい"), (25, "日本語の文章です。はい\n"), (30, None), (30, ""),
    *((100 + k, t) for k, t in enumerate(EDGE_TEXTS)), *((200 + k, t) for k, t in enumerate(EDGE_TEXTS)),
]


def texts(frame):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in frame.collect()), key=str)


def test_lines_against_brute_force(make_docs):
    assert texts(line_dedup.kept_texts(make_docs(ROWS))) == kept(ROWS)


def test_hot_lines_are_marked_alike(make_docs, monkeypatch):
    rows = [(k, "\n".join([LINE, f"line {k % 40} of many", f"line number {k} alone", LINE])) for k in range(300)]
    expected = kept(rows)
    assert texts(line_dedup.kept_texts(make_docs(rows))) == expected
    monkeypatch.setattr(line_dedup, "HOT_LINES", 1)  # a sketch that reports one line
    assert texts(line_dedup.kept_texts(make_docs(rows))) == expected


def test_bitmaps_name_the_kept_lines(make_docs):
    frame = line_dedup.keep_bitmaps(make_docs(ROWS))
    assert frame.columns == ["doc_id", "text_key", "n_lines", "n_dropped", "keep"]
    got = sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], sum(x["n"] for x in r["keep"])) for r in frame.collect())
    assert got == sorted((str(d), n, gone, n - gone) for d, n, gone, _ in kept(ROWS))
    assert all(a["start"] + a["n"] < b["start"] for r in frame.collect() for a, b in zip(r["keep"], r["keep"][1:]))


def test_native_plan_has_one_range_exchange(spark, make_docs, capsys):
    """The window streams over the range partitions: no second exchange, no Python."""
    rows = line_dedup.line_rows(make_docs(ROWS))
    by_place = line_dedup.Window.partitionBy("h1", "h2").orderBy(F.col("doc_id").asc_nulls_last(), "pos")
    rows.repartitionByRange(4, "h1", "h2").withColumn("f", F.first("doc_id").over(by_place)).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan and "Python" not in plan


def test_line_keys_lower_ascii_only(spark):
    """Of every code point that ``lower`` would change, only A-Z is changed."""
    chars = [(k, f"xy{chr(k)}Ab") for k in range(1, 0x3000) if k != 10] + [(k, f"xy{chr(k)}Ab") for k in range(0xA000, 0x1F000) if not 0xD800 <= k < 0xE000]
    frame = spark.createDataFrame(chars, "id long, line string")
    got = {r["id"]: r["k"] for r in frame.select("id", F.element_at(line_dedup.line_keys(F.array("line")), 1).alias("k")).collect()}
    assert got == {k: key_of(s) for k, s in chars}


def test_very_long_text(make_docs):
    long = "\n".join(f"line {k % 5000} of a long text" for k in range(60_000))
    rows = [(1, "line 7 of a long text\nline 8 of a long text"), (2, long), (3, long)]
    assert texts(line_dedup.kept_texts(make_docs(rows))) == kept(rows)


def test_no_documents(make_docs):
    assert line_dedup.kept_texts(make_docs([])).collect() == []
    assert line_dedup.keep_bitmaps(make_docs([])).collect() == []


# ---- hard negatives

def mined(rows, positives=5, negatives=10, low=30, high=90, every=5):
    out = []
    for a, la, xa in (r for r in rows if r[0] % every == 0):
        score = [(-int(np.dot(xa, x)), i, la == lb) for i, lb, x in rows if i != a]
        for p, pid, _ in sorted(s for s in score if s[2])[:positives]:
            inside = sorted(s for s in score if not s[2] and low * -p <= 100 * -s[0] <= high * -p)
            out += [(a, pid, k + 1, i, -p, -n) for k, (n, i, _) in enumerate(inside[:negatives])]
    return sorted(out)


def as_frame(spark, rows):
    full = [(i, label, x if x is None else [None if c is None else int(c) for c in x], 1.0, "a") for i, label, x in rows]
    return spark.createDataFrame(full, "id long, label long, x array<long>, score double, cell string").repartition(3)


def test_mining_against_brute_force(spark, monkeypatch):
    for name, value in (("CELL_ROWS", 16), ("PART_ROWS", 20), ("SEED_ROWS", 60), ("BLOCK_ANCHORS", 30)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(3)
    centers = rng.normal(0, 200, (6, 9))
    rows = [(i, int(rng.integers(0, 4)), np.floor(centers[rng.integers(0, 6)] + rng.normal(0, 60, 9)).astype(int)) for i in range(600)]
    rows += [(i, i % 4, rows[0][2]) for i in range(600, 800)]  # one vector of very many rows: ties by id
    got = hard_negatives.mine(as_frame(spark, rows), F.col("id") % 5 == 0)
    assert sorted(map(tuple, got.collect())) == mined(rows)


def test_mining_skips_and_defines_odd_rows(spark):
    good = [(0, 1, [3, 4]), (1, 1, [2, 2]), (2, 2, [1, 2]), (3, 2, [1, 1]), (4, 2, [1, 2]), (5, 3, [-1, -2]), (10, 3, [0, 0]), (15, 3, [-5, -5]), (20, 9, [1, 0])]
    odd = [(None, 1, [9, 9]), (30, None, [9, 9]), (35, 1, None), (40, 1, [9, None]), (45, 1, []), (50, 1, [1, 2, 3]), (2, 2, [1, 2]), (2, 2, [7, 7])]
    got = hard_negatives.mine(as_frame(spark, good + odd), F.col("id") % 5 == 0)
    assert sorted(map(tuple, got.collect())) == mined(good)
    none = hard_negatives.mine(as_frame(spark, []), F.col("id") % 5 == 0)
    assert none.columns == got.columns and none.collect() == []
    assert hard_negatives.mine(as_frame(spark, good), F.lit(False)).collect() == []


def test_large_integers_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 2, rng.integers(-(1 << 29), 1 << 29, 3)) for i in range(60)]
    assert sorted(map(tuple, hard_negatives.mine(as_frame(spark, rows), F.col("id") % 5 == 0).collect())) == mined(rows)
    with pytest.raises(ArithmeticError):
        hard_negatives.mine(as_frame(spark, [(0, 1, [1 << 40, 0]), (1, 1, [1, 1])]), F.col("id") % 5 == 0)


def test_walk_and_bounds_hold():
    rng = np.random.default_rng(5)
    u, v = rng.normal(size=7), rng.normal(size=5)
    got = list(hard_negatives.walk(u, v))
    assert len(got) == 35 and len({(i, j) for _, i, j in got}) == 35
    assert all(abs(s - (u[i] + v[j])) < 1e-12 for s, i, j in got) and all(a[0] >= b[0] for a, b in zip(got, got[1:]))
    x = rng.integers(-50, 50, (400, 8))
    books = hard_negatives.codebook(x[:, :4], 6), hard_negatives.codebook(x[:, 4:], 6)
    (i, r1), (j, r2) = (hard_negatives.nearest(part, b) for part, b in zip((x[:, :4], x[:, 4:]), books))
    radii = [np.array([r[c == k].max(initial=0) for k in range(6)]) for c, r in ((i, r1), (j, r2))]
    for q in rng.normal(0, 30, (20, 8)):
        (a, b), (c, d) = hard_negatives.bounds(books, radii, q), hard_negatives.bounds(books, radii, q, -1)
        assert (x @ q <= a[i] + b[j] + 1e-6).all() and (x @ q >= c[i] + d[j] - 1e-6).all()


def test_search_prunes_cells(spark, monkeypatch):
    """With separated groups most cells are never asked for."""
    for name, value in (("CELL_ROWS", 8), ("SEED_ROWS", 40)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(6)
    centers = rng.normal(0, 500, (12, 6))
    rows = [(i, int(i % 3), np.floor(centers[i % 12] + rng.normal(0, 5, 6)).astype(int)) for i in range(480)]
    asked = []
    plain = hard_negatives._requests
    monkeypatch.setattr(hard_negatives, "_requests", lambda *a: asked.append(plain(*a)) or asked[-1])
    assert sorted(map(tuple, hard_negatives.mine(as_frame(spark, rows), F.col("id") % 5 == 0).collect())) == mined(rows)
    cells = {r["id"]: r["n"] for r in asked[0].unionByName(asked[1]).groupBy("id").agg(F.countDistinct("cell").alias("n")).collect()}
    assert np.mean(list(cells.values())) < 0.5 * 12


# ---- whitening

def covariance(x):
    c = x - x.mean(0)
    return c.T @ c / len(x)


def scaled(vectors):
    return np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000


def vec_frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0.5, 1) for i, v in rows], "vec_id long, embedding array<double>, whitened double, n int").repartition(3)


def check_whitened(spark, rows, usable):
    frame = whitening.whiten(vec_frame(spark, rows), "vec_id", "embedding")
    x = scaled([v for _, v in usable])
    n, v = len(x), covariance(scaled([v for _, v in usable]))
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    got = defaultdict(dict)
    for r in frame.collect():
        got[r["vec_id"]][r["component"]] = r
        assert r["n"] == n and r["identity_error"] < 1e-6
    sums = x.sum(0)
    assert set(got) == {i for i, _ in usable}
    for (i, _), row in zip(usable, x, strict=True):
        assert sorted(got[i]) == list(range(1, len(got[i]) + 1))
        assert got[i][1]["deviation"] == sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True))
    many = len(next(iter(got.values())))
    assert many == np.count_nonzero(values > values[0] * 1e-12)
    white = np.array([[got[i][k + 1]["whitened"] for k in range(many)] for i, _ in usable])
    assert np.abs(covariance(white) - np.eye(many)).max() < 1e-6
    np.testing.assert_allclose([got[usable[0][0]][k + 1]["explained"] for k in range(many)], values[:many] / np.trace(v), rtol=1e-9)
    return white, ((x - x.mean(0)) @ vectors[:, :many]) / np.sqrt(values[:many])


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=40) * np.linspace(1, 3, 40)) for i in range(300)]
    odd = [(900, None), (901, [None] * 40), (902, [float("nan")] * 40), (903, [float("inf")] * 40), (904, []), (905, [1.0, 2.0])]
    white, expected = check_whitened(spark, rows + odd, rows)
    np.testing.assert_allclose(np.abs(white), np.abs(expected), atol=1e-7)


def test_whitening_with_equal_eigenvalues_and_low_rank(spark):
    corners = [(k, 2.0 * np.eye(12)[k % 12] * (1 if k < 12 else -1)) for k in range(24)]  # twelve equal variances
    check_whitened(spark, corners, corners)
    rng = np.random.default_rng(8)
    base = np.floor(64 * rng.normal(size=(200, 3)))
    flat = [(k, np.r_[b, b[0] + b[1], 5 * 64].astype(float) / 64) for k, b in enumerate(base)]  # rank 3 in 5 dimensions
    white, _ = check_whitened(spark, flat, flat)
    assert white.shape[1] == 3


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None), (2, [])]])
def test_whitening_without_variance_is_empty(spark, rows):
    frame = whitening.whiten(vec_frame(spark, rows), "vec_id", "embedding")
    assert frame.collect() == [] and frame.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


@pytest.mark.parametrize("n,many", [(1, 1), (2, 2), (3, 3), (30, 12), (60, 60)])
@pytest.mark.parametrize("kind", ["full", "equal", "two", "low", "diagonal"])
def test_eigenproblem(n, many, kind):
    rng = np.random.default_rng(n)
    a = rng.standard_normal((n, n))
    q, _ = np.linalg.qr(a)
    a = {"full": a @ a.T, "equal": 3 * np.eye(n), "two": (q * np.where(np.arange(n) < n / 2, 5.0, 2.0)) @ q.T, "low": a[:, : max(1, n // 3)] @ a[:, : max(1, n // 3)].T, "diagonal": np.diag(np.arange(n) + 1.0)}[kind]
    a = (a + a.T) / 2
    values, vectors = whitening.leading_components(a, many)
    size = np.abs(np.linalg.eigvalsh(a)).max()
    np.testing.assert_allclose(values, np.linalg.eigvalsh(a)[::-1][:many], atol=1e-13 * size)
    np.testing.assert_allclose(a @ vectors, vectors * values, atol=1e-12 * size)
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(many), atol=1e-12)


def test_sturm_counts():
    rng = np.random.default_rng(1)
    d, e = rng.normal(size=20), rng.normal(size=19)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(values[0] - 1, values[-1] + 1, 57)
    assert whitening.sturm_counts(d, e, at).tolist() == [(values < t).sum() for t in at]


def test_deviation_beyond_int64_products_is_exact(spark):
    rows = [(k, [150_000.0 * (-1) ** k * (k % 3), 1.0 * k]) for k in range(90)]
    check_whitened(spark, rows, rows)


def test_kept_digest_of_the_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").collect()]
    got = sorted(map(tuple, queries.op11_line_dedup(spark, SF).collect()))
    assert got == sorted((d, n, gone, hashlib.sha256(t.encode()).hexdigest()) for d, n, gone, t in kept(rows))
