import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from staylake.llm import queries
from tests.conftest import SF
from tests.llm.test_near_duplicates import WORD, labels, paragraph_components, runs_of, shared_runs, shingle_set


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage at the smallest size."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = queries.table(spark, SF, "documents"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(folder / str(k))
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_keep_the_columns_of_documents(stages):
    assert len(stages) == 5
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_quality_rejects_bad_and_keeps_good(stages, spark):
    _, before, after = stages[0]
    quality = {r["doc_id"]: r["quality"] for r in queries.table(spark, SF, "labels").collect()}
    kept = {r["doc_id"] for r in after.collect()}
    good = [d for d, y in quality.items() if y == 1]
    bad = [d for d, y in quality.items() if y == 0]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    assert sum(d in kept for d in bad) <= 0.2 * len(bad)
    assert after.subtract(before).count() == 0


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[1]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    roots = labels([shingle_set(t, 5) for _, t in rows], 80)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({rows[k][0] for k in roots})
    assert after.subtract(before).count() == 0


def test_repeated_paragraphs_and_passages_are_cut(stages):
    """Paragraphs as brute force has them; else only words of runs that two documents share, over newlines too, go."""
    _, before, after = stages[2]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    gone = {p for p, (kept, _) in paragraph_components(rows, 5, 80, 20).items() if p != kept}
    one_line = [(d, " ".join(t.split("\n"))) for d, t in rows]
    shared = shared_runs(one_line, 25)
    got = {r["doc_id"]: r for r in after.collect()}
    assert set(got) <= {d for d, _ in rows}
    untouched = 0
    for (d, t), (_, flat) in zip(rows, one_line, strict=True):
        lines = t.split("\n")
        in_gone = [i for i, line in enumerate(lines) for _ in re.findall(WORD, line.encode()) if (d, i) in gone]
        words = [(i, w) for i, line in enumerate(lines) for w in re.findall(WORD, line.encode())]
        in_runs = {k + j for _, k, run in runs_of(flat, 25) if run in shared for j in range(25)}
        text = got[d]["text"] if d in got else ""
        if not in_runs and not in_gone:
            assert text == t
            untouched += 1
        stay = Counter(w for k, (i, w) in enumerate(words) if k not in in_runs and (d, i) not in gone)
        left = Counter(re.findall(WORD, text.encode()))
        assert not stay - left and not left - Counter(w for i, w in words if (d, i) not in gone)
    assert untouched >= 0.3 * len(rows)
    assert not shared_runs([(d, " ".join(r["text"].split("\n"))) for d, r in got.items()], 50)
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:4]])
def test_stages_with_odd_rows_and_clashing_columns(spark, make_docs, stage):
    """Null and empty texts, null ids and sources, repeated rows, columns called like the operators' own, an empty table."""
    text = "the quick brown fox jumps over the lazy dog and runs away from the farm where nobody lives any more"
    rows = [(1, text, "a"), (1, text, "a"), (2, None, None), (3, "", "a"), (None, text + " now", None), (4, "x " * 3000, "b"), (5, f"{text}\n\n{text}", "b")]
    names = ["_quality", "_mix", "_doc", "_copy", "_id", "_gone", "_text", "rank", "size", "of", "label", "rounds", "id"]
    docs = make_docs(rows).select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns
    kept = out.collect()
    assert kept and all(r[c] == k for r in kept for k, c in enumerate(names))
    assert {r["doc_id"] for r in kept} <= {r[0] for r in rows}
    empty = stage(spark, docs.where("doc_id > 100"), SF)
    assert empty.columns == docs.columns and empty.collect() == []


def test_mixture_repeats_whole_documents(stages):
    _, before, after = stages[3]
    assert after.subtract(before).count() == 0
    assert max(Counter(r["doc_id"] for r in after.collect()).values()) <= 3
    total = lambda df: sum(len((r["text"] or "").split()) for r in df.collect())
    assert 0.8 <= total(after) / total(before) <= 1.2


def test_packing_covers_the_mixture(stages):
    _, before, after = stages[4]
    assert Counter(r["doc_id"] for r in after.collect()) == Counter(r["doc_id"] for r in before.collect())


def test_join_stage_with_repeated_and_idless_rows(spark, make_docs):
    text = "the quick brown fox jumps over the lazy dog and runs away from the farm"
    docs = make_docs([(1, text), (1, text), (2, text + " now"), (None, text), (3, "another one"), (3, "another one"), (4, None), (4, None)])
    got = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.ngram_jaccard_join(spark, docs, SF).collect())
    assert got == Counter({(1, text): 1, (None, text): 1, (3, "another one"): 1, (4, None): 1})


def test_run_gives_the_last_stage(stages, spark):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, stages[-1][2].collect()), key=str)


def test_every_registered_query_runs(spark):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


def test_mixing_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    frame = queries.op10_mixing(spark, SF)
    rel = con.sql(queries.ORACLES["op10_mixing"])
    assert sorted(rel.columns) == sorted(frame.columns)
    order = [rel.columns.index(c) for c in frame.columns]
    expected = sorted(tuple(r[k] for k in order) for r in rel.fetchall())
    assert sorted(tuple(r) for r in frame.collect()) == expected
