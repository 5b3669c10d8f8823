import re
import textwrap

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staylake.llm import language, license_scan, quality, queries
from tests.conftest import SF
from tests.llm.conftest import EDGE_TEXTS

SF_MID = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    got = queries.op2_language(spark, SF_MID).join(queries.table(spark, SF_MID, "documents").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert len(rows) > 100
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_document_vectors_are_bundles_of_bound_letters():
    text = "Ab, éa b"
    v, has = language.document_vectors([text, "", "…"])
    first, second, third = (t.astype(np.float32) for t in language._letter_vectors())
    sym = language._symbols()
    expected = np.zeros(language.DIMENSIONS, np.float32)
    for word in re.findall(r"\w+", text.lower()):
        s = [0, *(int(sym[ord(c)]) for c in word), 0]
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            expected += first[a] * second[b] * third[c]
    assert np.array_equal(v[0], expected)
    assert has.tolist() == [True, False, False] and not v[1:].any()


def test_long_text_is_bundled_whole(monkeypatch):
    text = "the cat and dog " * 40 + "abc"
    whole, _ = language.document_vectors([text])
    monkeypatch.setattr(language, "_PIECE_CHARS", 50)
    (_, _, pieces, has), = language._vectors([text])
    assert has[0] and np.array_equal(pieces, whole)


def test_language_edges(make_docs, spark):
    rows = [(k, t) for k, t in enumerate(EDGE_TEXTS)] + [(3, "a"), (None, "the cat")]
    docs = make_docs(rows)
    train = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "fr"), (4, "text", None)], "doc_id long, text string, lang string")
    langs, prototypes = language.learn_prototypes(train)
    assert langs == ["en", "fr"]
    got = language.identify(docs, langs, prototypes).collect()
    by_text = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for k, t in enumerate(EDGE_TEXTS):
        letters = any(c.isalpha() for c in t or "")
        assert by_text[k]["lang_pred"] in (langs if letters else ["und"])
        assert letters or by_text[k]["score"] == 0
    langs, prototypes = language.learn_prototypes(train.where("lang is null"))
    assert {r["lang_pred"] for r in language.identify(docs, langs, prototypes).collect()} == {"und"}
    assert language.identify(docs.where("doc_id > 100"), langs, prototypes).count() == 0


def brute_scan(text, threshold):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    words = [w.decode() for w in words]
    places, base = [], set()
    for label, phrase in license_scan.BASE_PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    labels, best = set(base), 1.0 if places else 0.0
    for line in (text or "").split("\n"):
        w = [x.decode() for x in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line.encode().lower())]
        half = license_scan.WINDOW // 2
        for lo in range(0, max(1, len(w) - half), half):
            block = w[lo:lo + license_scan.WINDOW]
            for label, t in license_scan.TEMPLATES:
                t = set(t.split())
                c = len(t & set(block)) / len(t)
                if c >= threshold:
                    labels.add(label)
                    best = max(best, c)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best


def test_license_scan_matches_brute_force(spark, make_docs):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").collect()]
    rows += [(10_000 + k, t) for k, t in enumerate(EDGE_TEXTS)]
    rows += [(20_000 + k, t) for k, (_, t) in enumerate(license_scan.TEMPLATES)]
    filler = " ".join(f"w{k}" for k in range(150))
    rows += [(30_000, f"{filler} Under the MIT license {filler} {license_scan.TEMPLATES[4][1]} {filler}"), (30_001, "under the\nMIT License, under the mit license; CC-BY-NC"),
             (30_001, "Apache License Version 2.0"), (None, "cc by nc")]
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    got = license_scan.scan(make_docs(rows)).collect()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(((r["doc_id"], *(r[c] for c in names)) for r in got), key=key) == sorted(((d, *brute_scan(t, license_scan.THRESHOLD)) for d, t in rows), key=key)
    assert license_scan.scan(make_docs(rows).where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("width", [30, 72, 80])
def test_wrapped_templates_are_found(make_docs, width):
    filler = " ".join(f"w{k}" for k in range(100))
    rows = [(2 * k + (before != ""), "\n".join(textwrap.wrap(f"{before} {t} {filler}", width))) for k, (_, t) in enumerate(license_scan.TEMPLATES) for before in ("", filler)]
    got = {r["doc_id"]: r for r in license_scan.scan(make_docs(rows)).collect()}
    for d, text in rows:
        label, template = license_scan.TEMPLATES[d // 2]
        assert label in got[d]["labels"].split(",") and got[d]["score"] == 1.0, text
        assert any(b["label"] == label and b["containment"] == 1.0 for b in got[d]["blocks"])


def test_quality_held_out(spark):
    labels = queries.table(spark, SF_MID, "labels").select("doc_id", "quality")
    rows = queries.op5_quality(spark, SF_MID).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    assert sum(r["predicted"] == 0 and r["quality"] == 1 for r in rows) <= 0.02 * len(rows)


def network():
    rng = np.random.default_rng(0)
    n = quality.FILTERS
    return quality.Network(rng.normal(size=(quality.WIDTH, 512, n)).astype(np.float32), rng.normal(size=n).astype(np.float32), np.zeros(2 * n), np.ones(2 * n), rng.normal(size=2 * n).astype(np.float32), 0.1)


def test_convolution_matches_brute_force(monkeypatch):
    monkeypatch.setattr(quality, "_PIECE", 2 * quality.STRIDE)
    net = network()
    texts = ["", None, "a", "the the cat", "Ab é " * 200, "x" * quality.STRIDE, "y y " * 97]
    got = quality.features(net, *quality.X.utf8(pa.array(texts)))
    for f, text in zip(got, texts, strict=True):
        raw = (text or "").encode()
        x = np.frombuffer(raw, np.uint8).astype(int)
        previous = None
        for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw):
            if previous == m[0].lower():
                x[m.start():m.end()] += 256
            previous = m[0].lower()
        strides = max(2, -(-(len(x) + quality.WIDTH - 1) // quality.STRIDE))
        x = np.concatenate([x, np.zeros(strides * quality.STRIDE + quality.WIDTH, int)])
        chunks = []
        for c in range(strides - 1):
            r = np.stack([sum(net.filters[k][x[t + k]] for k in range(quality.WIDTH)) for t in range(c * quality.STRIDE, min(c * quality.STRIDE + quality.CHUNK, strides * quality.STRIDE - quality.WIDTH + 1))])
            chunks.append(np.maximum(r.max(0) + net.bias, 0))
        assert np.allclose(f, np.concatenate([np.mean(chunks, 0), np.max(chunks, 0)]), atol=1e-4)


def test_quality_edges(make_docs, spark):
    docs = make_docs([(k, t) for k, t in enumerate(EDGE_TEXTS)] + [(1, ""), (None, None)])
    scored = quality.score(docs, network())
    rows = scored.collect()
    assert scored.columns == [*docs.columns, "_quality"]
    assert len(rows) == len(EDGE_TEXTS) + 2 and all(0 <= r["_quality"] <= 1 for r in rows)
    assert len({r["_quality"] for r in rows if not r["text"]}) == 1
    assert quality.score(docs.where("doc_id > 100"), network()).count() == 0
    none = spark.createDataFrame([], "doc_id long, label int")
    assert quality.fit(docs, none) == 1.0
    assert quality.fit(docs, spark.createDataFrame([(1, 0), (2, 0), (3, None)], "doc_id long, label int")) == 0.0
    assert {r["_quality"] for r in quality.score(docs, 0.5).collect()} == {0.5}
    assert quality.fit(docs, spark.createDataFrame([(900, 0), (901, 1)], "doc_id long, label int")) == 0.5  # labels without documents


def test_held_out_fold(spark):
    import zlib

    rows = spark.range(50).select("id", quality.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)
