import random
import re

import numpy as np
import pyarrow as pa
import pytest

from staylake.llm import _graph, _text as X

ALPHABET = "ab \n\tZé.1"


@pytest.fixture(params=[64, 1 << 20])
def texts(request, monkeypatch):
    """Random texts, hashed in small and in large pieces."""
    monkeypatch.setattr(X, "SEGMENT", request.param)
    rng = random.Random(1)
    return [None, "", " ", "a", "A b", "z" * 300] + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80))) for _ in range(300)]


def same_grouping(items, hashes):
    seen = {}
    for item, h in zip(items, hashes, strict=True):
        assert seen.setdefault(item, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("lut, pattern", [(X.NOT_SPACE, rb"[^\x20\x09-\x0D]+"), (X.ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_and_shingles(texts, lut, pattern):
    data, offsets = X.utf8(pa.array(texts))
    h, counts = X.words(data, offsets, lut)
    expected = [re.findall(pattern, (t or "").encode().lower()) for t in texts]
    assert counts.tolist() == [len(w) for w in expected]
    same_grouping([w for e in expected for w in e], h.tolist())
    for n in (1, 3):
        s, many = X.shingles(h, counts, n)
        grams = [[tuple(e[i:i + n]) for i in range(len(e) - n + 1)] or ([tuple(e)] if e else []) for e in expected]
        assert many.tolist() == [len(g) for g in grams]
        same_grouping([g for e in grams for g in e], s.tolist())
        _, distinct = X.distinct(s, many)
        assert distinct.tolist() == [len(set(g)) for g in grams]


def test_shingles_of_two_words_do_not_collide():
    import itertools

    texts = [" ".join(w) for w in itertools.product("ab", repeat=8)]
    s, _ = X.shingles(*X.words(*X.utf8(pa.array(texts)), X.NOT_SPACE), 8)
    assert len(set(s.tolist())) == len(texts)


def test_sliced_and_empty_columns():
    whole = pa.array(["ab c", "d", None, "e f"])
    data, offsets = X.utf8(whole.slice(1, 3))
    assert data.tobytes() == b"de f" and offsets.tolist() == [0, 1, 1, 4]
    data, offsets = X.utf8(pa.array([], pa.string()))
    assert X.words(data, offsets, X.NOT_SPACE)[1].tolist() == []


def test_lines(texts):
    data, offsets = X.utf8(pa.array(texts))
    line_offsets, counts = X.lines(data, offsets)
    assert counts.tolist() == [(t or "").count("\n") + 1 for t in texts]
    lines = [line for t in texts for line in (t or "").split("\n")]
    cut = [data[a:b].tobytes().decode().removesuffix("\n") for a, b in zip(line_offsets[:-1], line_offsets[1:], strict=True)]
    assert cut == lines


def test_set_keys_ignore_order_and_tell_sets_apart():
    h = np.array([1, 2, 3, 3, 2, 1, 1, 2, 4], dtype=np.uint64)
    keys = X.set_keys(h, np.array([3, 3, 3, 0]))
    assert keys[0] == keys[1] and len(set(keys.tolist())) == 3


@pytest.mark.parametrize("percent", [80, 90])
def test_overlaps_match_brute_force(percent, monkeypatch):
    monkeypatch.setattr(_graph, "COLUMNS_PER_BLOCK", 7)
    rng = random.Random(3)
    base = [rng.sample(range(200), 30) for _ in range(4)]
    sets = []
    for _ in range(40):
        s = set(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            s.discard(rng.choice(sorted(s)))
            s.add(rng.randint(0, 500))
        sets.append(np.array(sorted(s), dtype=np.uint64))
    size = np.array([len(s) for s in sets])
    link = lambda x, y: 100 * len(set(x) & set(y)) >= percent * len(set(x) | set(y))
    square = _graph._overlaps(sets, None, size, size, percent)
    assert square.tolist() == [[i != j and link(x.tolist(), y.tolist()) for j, y in enumerate(sets)] for i, x in enumerate(sets)]
    across = _graph._overlaps(sets[:15], sets[15:], size[:15], size[15:], percent)
    assert across.tolist() == [[link(x.tolist(), y.tolist()) for y in sets[15:]] for x in sets[:15]]


def test_components(spark):
    from staylake.llm._scratch import Scratch

    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(7, 7)]
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in _graph.components(frame, Scratch(spark), "t").collect()}
    assert got == {n: find(n) for n in parent if find(n) != n}
    assert _graph.components(frame.where("a < 0"), Scratch(spark), "t").count() == 0
