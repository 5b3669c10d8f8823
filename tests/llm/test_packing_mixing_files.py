import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staylake.llm import mixing, packing, queries, token_files
from staylake.llm._scratch import Scratch
from tests.conftest import SF
from tests.llm.conftest import EDGE_TEXTS


def padding(bounds, lengths):
    return sum(min(b for b in bounds if b >= x) - x for x in lengths)


@pytest.mark.parametrize("buckets", [1, 2, 3, 4])
def test_boundaries_are_optimal(buckets):
    rng = np.random.default_rng(buckets)
    for _ in range(20):
        lengths = rng.integers(0, 30, rng.integers(1, 25))
        g, n = np.unique(lengths, return_counts=True)
        got = packing.best_boundaries(g, n, g * n, buckets)
        assert len(got) <= buckets and got == sorted(set(got)) and got[-1] == g[-1]
        best = min(padding((*c, g[-1]), lengths) for c in itertools.combinations(g[:-1].tolist(), min(buckets, len(g)) - 1))
        assert padding(got, lengths) == best


def test_grid_rounds_long_lengths_up(spark):
    values = [0, 1, 4095, 4096, 4097, 8191, 8193, 10 ** 6, 2 ** 40 + 1]
    rows = spark.createDataFrame([(v,) for v in values], "_length long").withColumn("g", packing.grid_length(F.col("_length"))).collect()
    assert [r["g"] for r in rows][:4] == [0, 1, 4095, 4096]
    assert all(0 <= r["g"] - r["_length"] <= r["_length"] / 2048 for r in rows)


def test_packing_batches(spark, make_docs):
    rng = np.random.default_rng(3)
    rows = [(int(i), "w " * int(n)) for i, n in enumerate(rng.integers(0, 300, 400))] + [(5, "w " * 10)] * 30 + [(900, None), (None, "a b"), (901, "w " * 9000)]
    got = packing.pack(make_docs(rows), mixing.word_count(F.col("text")), buckets=4, token_budget=1000).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter((d, len((t or "").split())) for d, t in rows)
    batches = defaultdict(list)
    for r in got:
        assert r["padding"] == r["bucket_length"] - r["n_tokens"] >= 0
        batches[r["bucket"], r["batch"]].append(r)
    last = {b: max(k for x, k in batches if x == b) for b, _ in batches}
    for (b, k), members in batches.items():
        most = max(1, 1000 // max(1, members[0]["bucket_length"]))
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
        assert len(members) == most or k == last[b] and len(members) < most
    lengths = [r["n_tokens"] for r in got]
    g, n = np.unique([r["bucket_length"] if r["n_tokens"] > 4095 else r["n_tokens"] for r in got], return_counts=True)
    assert sum(r["padding"] for r in got) <= padding(packing.best_boundaries(g, n, g * n, 4), lengths)
    assert packing.pack(make_docs(rows).where("doc_id < 0"), F.length("text")).count() == 0


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, capped, target = sum(sizes.values()), set(), {}
    while True:
        rest, w = total - sum(3 * sizes[s] for s in capped), sum(weight[s] for s in names if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / w for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mixing(make_docs):
    rng = np.random.default_rng(4)
    rows = []
    for s, n in (("a", 300), ("b", 40), ("é", 5), ("Z", 80), (None, 25), ("zero", 3)):
        rows += [(len(rows) + k, None if s == "zero" else "w " * int(rng.integers(1, 60)), s) for k in range(n)]
    docs = make_docs(rows)
    got = mixing.mix_sources(docs)
    assert got.columns == [*docs.columns, "_mix"]
    got = got.collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    target, taken = brute_targets(dict(sizes)), Counter()
    for r in got:
        m = r["_mix"]
        assert m["size"] == len((r["text"] or "").split()) and m["source_size"] == sizes[r["source"]]
        assert abs(m["target"] - target[r["source"]]) < 1e-6 and 0 <= m["copies"] <= 3
        taken[r["source"]] += m["copies"] * m["size"]
    assert len(got) == len(rows)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 60
    again = mixing.mix_sources(make_docs(rows, 7)).collect()
    key = lambda r: (r["doc_id"], r["_mix"]["copies"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixing_inclusion_follows_importance(make_docs):
    rows = [(k, "w " * 10, s) for k, s in enumerate(["a"] * 600 + ["b"] * 50 + ["c"] * 50)]
    heavy = F.when(F.col("doc_id") % 2 == 0, F.lit(4.0)).otherwise(F.lit(1.0))
    got = [r for r in mixing.mix_sources(make_docs(rows), importance=heavy).collect() if r["source"] == "a"]
    even, odd = (sum(r["_mix"]["copies"] for r in got if r["doc_id"] % 2 == p) for p in (0, 1))
    assert even > 2 * odd > 0


def test_mixing_edges(make_docs):
    one = mixing.mix_sources(make_docs([(1, "a b c", None), (1, "a b c", None), (None, "x", None)])).collect()
    assert Counter((r["doc_id"], r["_mix"]["copies"]) for r in one) == Counter({(1, 1): 2, (None, 1): 1})
    nothing = mixing.mix_sources(make_docs([(k, t, "s") for k, t in enumerate([None, "", " "])])).collect()
    assert [(r["_mix"]["copies"], r["_mix"]["target"]) for r in nothing] == [(0, 0.0)] * 3
    assert mixing.mix_sources(make_docs([(1, "a", "s")]).where("doc_id < 0")).count() == 0


@pytest.fixture(scope="module")
def tokenizer_file():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path(queries.TOKENIZER)


TRICKY = [*EDGE_TEXTS, "a  b", "a\n\nb", "don't, isn't; 3.5kg (x) [y]", "x y z", "tab\tend ", " lead", "é, ü. ×, ÷.", "<|endoftext|> ok", "!!!", "a\r\nb", "emoji 🙂, ok.", "١٢ 3",
          "it's 's, we'll", "end.\nNext ,x", "\x85 a", "a  b", "x ' y", "A.B.C"]


def test_pieces_give_the_library_ids(tokenizer_file):
    import random

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file)
    plain.encode_special_tokens = True
    rng = random.Random(6)
    pool = " \n\t.,'!-09azAZé×  1²🙂"
    texts = TRICKY + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    enc = token_files.Encoder(tokenizer_file)
    for _ in range(2):  # the second time from memory
        ids, counts = enc.encode(*token_files.X.utf8(pa.array(texts)))
        ends = np.cumsum(counts)
        for t, a, b in zip(texts, ends - counts, ends, strict=True):
            assert ids[a:b].tolist() == plain.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_op7_gives_the_ids_of_the_tokenizer_as_loaded(spark, tmp_path, make_docs, tokenizer_file):
    import random

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file)
    rng = random.Random(7)
    pool = ["<|endoftext|>", "<|endoftext", "|>", " ", "\n", "a", "Z9", ".", "é", "🙂"]
    texts = [*TRICKY, "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endof", "text|> x"] + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 20))) for _ in range(500)]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert want[len(TRICKY)] == [64, 220, 50256, 275]
    enc = token_files.Encoder(tokenizer_file, special_as_text=False)
    for _ in range(2):
        ids, counts = enc.encode(*token_files.X.utf8(pa.array(texts)))
        assert [ids[b - n:b].tolist() for n, b in zip(counts, np.cumsum(counts), strict=True)] == want
    make_docs(list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in queries.op7_token_files(spark, str(tmp_path)).collect()}
    assert got == {k: (len(x) + 1, zlib.crc32(np.array([*x, token_files.END_ID], "<u4").tobytes())) for k, x in enumerate(want)}


@pytest.mark.parametrize("rows_per_batch", [64, 2])
def test_files_round_trip(spark, make_docs, tokenizer_file, rows_per_batch):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file)
    plain.encode_special_tokens = True
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").limit(60).collect()]
    rows += [(1000 + k, t) for k, t in enumerate(TRICKY)] + [(7, "again"), (7, "again"), (None, "none")]
    folder = Scratch(spark).path("tokens")
    manifest = token_files.write_token_files(make_docs(rows), folder, tokenizer_file, length=16, rows=rows_per_batch)
    got = sorted(token_files.read_documents(manifest, folder).collect(), key=lambda r: r["start"])
    ids = {}
    for _, t in rows:
        ids[t] = [*plain.encode(t or "", add_special_tokens=False).ids, token_files.END_ID]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((d, len(ids[t]), crc(ids[t])) for d, t in rows)
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    for part in manifest.collect():
        reader, _ = token_files.open_sequences(folder, part["name"])
        n = -(-part["n_ids"] // 16)
        stream, masks = zip(*(token_files.sequence(reader, k) for k in range(n)), strict=True)
        assert all(len(s) == 16 for s in stream)
        assert sum(m.to_numpy(zero_copy_only=False).sum() for m in masks) == part["n_ids"]
    empty = make_docs(rows).where("doc_id < 0")
    folder = Scratch(spark).path("none")
    assert token_files.read_documents(token_files.write_token_files(empty, folder, tokenizer_file), folder).count() == 0


def test_word_count(spark, make_docs):
    got = make_docs(list(enumerate(EDGE_TEXTS))).select("text", mixing.word_count(F.col("text")).alias("n")).collect()
    assert all(r["n"] == len(re.findall(rb"[^\x20\x09-\x0D]+", (r["text"] or "").encode())) for r in got)


def unit(doc_id, seed):
    return (int(hashlib.md5(f"{seed}:{doc_id}".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)


def greedy(rows, rest):
    """Words that a walk in the given order takes, document by document, and the nearest document's that closes the gap."""
    gap = rest
    left = []
    for size in rows:
        if 0 < size <= gap:
            gap -= size
        else:
            left.append(size)
    close = [s for s in left if abs(gap - s) < gap]
    return rest - gap + (min(close, key=lambda s: abs(gap - s)) if close else 0)


@pytest.mark.parametrize("seed", range(4))
def test_sources_with_one_very_long_document_meet_their_targets(make_docs, seed):
    """The long document holds half of the words of its source; the sources' target is half of theirs."""
    word = lambda n: "w " * n
    rows = [(k, word(300), "a") for k in range(400)] + [(400, word(120_000), "a")]
    rows += [(1000 + k, word(300), "b") for k in range(800)] + [(2000 + k, word(1 + k % 37 * 40), "c") for k in range(300)] + [(3000, word(90_000), "c")]
    mixed = mixing.mix_sources(make_docs(rows), cycle=(1, 3, 2), seed=seed).select("doc_id", "source", "_mix.*").collect()
    by = defaultdict(list)
    for r in mixed:
        by[r["source"]].append(r)
    for of in by.values():
        taken = sum(r["copies"] * r["size"] for r in of)
        certain = int(of[0]["target"] // of[0]["source_size"])
        left = [r["size"] for r in of if r["copies"] == certain]
        assert abs(taken - of[0]["target"]) <= max(0.02 * of[0]["target"], min(left, default=0) / 2 + 1)
        order = sorted(of, key=lambda r: (unit(r["doc_id"], seed), r["doc_id"]))  # equal chances: the rank order is that of the units
        assert taken - certain * of[0]["source_size"] == greedy([r["size"] for r in order], of[0]["target"] - certain * of[0]["source_size"])


def test_importance_makes_documents_certain_and_shares_the_rest_again(make_docs):
    """Documents whose share is a copy or more are always taken; the others' chances add up to what is left."""
    rows = [(k, "w " * 100, "a") for k in range(200)] + [(1000 + k, "w " * 100, "b") for k in range(600)]
    docs = make_docs(rows)
    weight = F.when(F.col("doc_id") % 20 == 0, 1000.0).when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)
    often = Counter()
    for seed in range(12):
        mixed = mixing.mix_sources(docs, cycle=(1, 9), seed=seed, importance=weight).select("doc_id", "source", "_mix.*").collect()
        a = [r for r in mixed if r["source"] == "a"]
        rest = a[0]["target"]  # 8,000 of 20,000 words: below one copy
        assert rest < a[0]["source_size"] and abs(sum(r["copies"] * r["size"] for r in a) - rest) <= 50
        assert all(r["copies"] == 1 for r in a if r["doc_id"] % 20 == 0)
        often.update(("even" if r["doc_id"] % 2 == 0 else "odd") for r in a if r["copies"] and r["doc_id"] % 20)
    assert 1.8 <= (often["even"] / 90) / (often["odd"] / 100) <= 3.6  # shares 3 to 1 of 70 documents, less near certainty


def test_mixing_refuses_a_taken_name(make_docs):
    docs = make_docs([(1, "a b", "s")]).withColumn("_mix", F.lit(1))
    with pytest.raises(ValueError):
        mixing.mix_sources(docs)
    assert mixing.mix_sources(docs, name="_more").columns == [*docs.columns, "_more"]
