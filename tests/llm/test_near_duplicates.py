import random
import re
from collections import Counter, defaultdict

import pytest

from staylake.llm import _graph, ngram_join, paragraphs
from tests.llm.conftest import EDGE_TEXTS

WORD = rb"[^\x20\x09-\x0D]+"


def shingle_set(text, n):
    w = re.findall(WORD, (text or "").encode().lower())
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def linked(x, y, percent):
    return bool(x) and bool(y) and 100 * len(x & y) >= percent * len(x | y)


def labels(sets, percent):
    """Component representative (index) of each set, by comparing all pairs."""
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, x in enumerate(sets):
        for j in range(i):
            if linked(x, sets[j], percent):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def family(rng, n_words, copies, edits):
    base = [f"w{rng.randint(0, 400)}" for _ in range(n_words)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"v{rng.randint(0, 10 ** 6)}"
        out.append(" ".join(w))
    return out


def corpus(seed=5):
    rng = random.Random(seed)
    texts = [*EDGE_TEXTS, "One two", "ONE  TWO\n", "one two three", "one two three", None]
    for copies in (2, 3, 5, 12, 40):
        texts += family(rng, rng.randint(30, 120), copies, 4)
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randint(0, 10 ** 6)}" for _ in range(rng.randint(1, 60))) for _ in range(15)]
    texts += [" ".join(rng.choice(["a", "b"]) for _ in range(rng.randint(3, 12))) for _ in range(40)]
    return list(enumerate(texts))


@pytest.mark.parametrize("n, percent, block", [(3, 90, 1024), (5, 80, 7)])
def test_jaccard_components_match_brute_force(make_docs, monkeypatch, n, percent, block):
    monkeypatch.setattr(_graph, "ROWS_PER_BLOCK", block)
    rows = corpus()
    got = {r["doc_id"]: r for r in ngram_join.jaccard_components(make_docs(rows), n, percent).collect()}
    sets = [shingle_set(t, n) for _, t in rows]
    expected = labels(sets, percent)
    assert {k: r["component_id"] for k, r in got.items()} == dict(enumerate(expected))
    assert [got[i]["n_shingles"] for i in range(len(rows))] == [len(s) for s in sets]
    classes = {frozenset(s) for s in sets if s}
    assert [got[i]["n_links"] for i in range(len(rows))] == [sum(linked(set(c), s, percent) for c in classes if c != s) if s else 0 for s in sets]


def test_jaccard_repeated_rows_null_ids_and_empty_table(make_docs):
    text = "the quick brown fox jumps over the lazy dog"
    rows = [(4, text), (4, text), (None, text), (9, text.upper()), (None, "alone here"), (2, None), (2, None), (4, "another text under the same id")]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(make_docs(rows), 3, 90).collect())
    assert got == Counter({(4, 7, 4): 2, (None, 7, 4): 1, (9, 7, 4): 1, (None, 1, None): 1, (2, 0, 2): 2, (4, 4, 4): 1})
    assert ngram_join.jaccard_components(make_docs(rows).where("doc_id > 100")).count() == 0


def paragraph_components(rows, n, percent, min_words):
    place, sets = [], []
    for doc, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            if len(re.findall(WORD, line.encode())) >= min_words:
                place.append((doc, i))
                sets.append(shingle_set(line, n))
    groups = defaultdict(list)
    for k, root in enumerate(labels(sets, percent)):
        groups[root].append(place[k])
    return {p: (min(g), len(g)) for g in groups.values() if len(g) > 1 for p in g}


def test_repeated_paragraphs_match_brute_force(make_docs):
    rng = random.Random(8)
    lines = [line for copies in (2, 4, 9, 30) for line in family(rng, rng.randint(25, 90), copies, 2)]
    lines += [" ".join(f"u{rng.randint(0, 10 ** 6)}" for _ in range(30)) for _ in range(20)] + ["short line that repeats"] * 6
    rng.shuffle(lines)
    rows = [(d, "\n".join(rng.sample(lines, 4))) for d in range(25)] + [(100 + k, t) for k, t in enumerate(EDGE_TEXTS)]
    got = paragraphs.repeated_paragraphs(make_docs(rows)).collect()
    expected = paragraph_components(rows, 5, 80, paragraphs.MIN_WORDS)
    assert {(r["doc_id"], r["line"]): ((r["kept_doc_id"], r["kept_line"]), r["copies"]) for r in got} == expected
    assert all(r["removed"] == ((r["doc_id"], r["line"]) != (r["kept_doc_id"], r["kept_line"])) for r in got)


def test_remove_lines(make_docs, spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, f"intro\n{long}\nend"), (2, f"{long}"), (3, None), (4, f"{long}\n\nlast"), (None, f"{long}"), (5, ""), (1, f"intro\n{long}\nend")]
    docs = make_docs(rows)
    repeats = paragraphs.repeated_paragraphs(docs)
    assert {(r["doc_id"], r["line"], r["removed"]) for r in repeats.collect()} == {(1, 1, False), (2, 0, True), (4, 0, True), (None, 0, True)}
    out = paragraphs.remove_lines(docs, repeats)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter({(1, f"intro\n{long}\nend"): 2, (3, None): 1, (4, "\nlast"): 1, (None, long): 1, (5, ""): 1})
    empty = docs.where("doc_id > 100")
    assert paragraphs.remove_lines(empty, paragraphs.repeated_paragraphs(empty)).count() == 0


def runs_of(text, n):
    """(line, first word, words) of every run of n words inside a line."""
    for i, line in enumerate((text or "").split("\n")):
        w = re.findall(WORD, line.encode().lower())
        for k in range(len(w) - n + 1):
            yield i, k, tuple(w[k:k + n])


def shared_runs(rows, n):
    """Runs of n words inside a line that two documents have."""
    docs = defaultdict(set)
    for doc, text in rows:
        for _, _, run in runs_of(text, n):
            docs[run].add(doc)
    return {run for run, ids in docs.items() if len(ids) > 1}


def passage_corpus():
    rng = random.Random(3)
    words = lambda n: [f"x{rng.randint(0, 10 ** 7)}" for _ in range(n)]
    passages = [words(n) for n in (40, 51, 60, 300)]
    rows = []
    for d in range(60):
        p = passages[d % 4]
        before, after = (words(len(p) // 3 + rng.randint(0, 70)) for _ in range(2))  # too much for a link of the whole lines
        rows.append((d, "\n".join([" ".join(words(30)), " ".join(before + [w.upper() for w in p] + after), "end"])))
    rows += [(60 + d, " ".join(words(120))) for d in range(10)]
    return rows, passages


def test_passages_inside_longer_lines(make_docs):
    rows, passages = passage_corpus()
    docs = make_docs(rows)
    got = paragraphs.repeats(docs).collect()
    assert {r["doc_id"] for r in got} == set(range(60))
    assert all(r["removed"] is False for r in got if r["doc_id"] < 4)
    exact = shared_runs(rows, paragraphs.PASSAGE_WORDS)
    have = {(d, i, k): run for d, t in rows for i, k, run in runs_of(t, paragraphs.PASSAGE_WORDS)}
    found, cut = defaultdict(set), defaultdict(set)
    for r in got:
        assert r["line"] == 1 and r["kept_doc_id"] % 4 == r["doc_id"] % 4 and 1 < r["copies"] <= 15
        assert all(have[r["doc_id"], 1, k] in exact for k in range(r["first_word"], r["first_word"] + r["n_words"] - paragraphs.PASSAGE_WORDS + 1))
        for words in (found, cut) if r["removed"] else (found,):
            words[r["doc_id"]] |= set(range(r["first_word"], r["first_word"] + r["n_words"]))
    assert all(len(passages[d % 4]) - 2 * (paragraphs.NEIGHBOURS - 1) <= len(found[d]) <= len(passages[d % 4]) for d in range(60))
    assert {d for d in range(4, 60) if any(r["removed"] and r["doc_id"] == d and r["kept_doc_id"] == d % 4 and r["copies"] == 15 for r in got)} == set(range(4, 60))
    out = {r["doc_id"]: r["text"] for r in paragraphs.remove_lines(docs, paragraphs.repeats(docs)).collect()}
    assert not shared_runs(out.items(), 40) and len(out) == len(rows)
    assert all(out[d] == t for d, t in rows if d < 4 or d >= 60)
    for d, t in rows[4:60]:
        lines = t.split("\n")
        lines[1] = " ".join(w for k, w in enumerate(lines[1].split()) if k not in cut[d])
        assert out[d] == "\n".join(lines)


def wrapped(words, at):
    """The words in lines of ``at`` words."""
    return "\n".join(" ".join(words[k:k + at]) for k in range(0, len(words), at))


def test_passages_over_short_lines(make_docs):
    rng = random.Random(12)
    words = lambda n: [f"y{rng.randint(0, 10 ** 7)}" for _ in range(n)]
    passage = words(90)
    rows = [(d, wrapped(words(rng.randint(0, 30)) + passage + words(rng.randint(0, 30)), 5 + d)) for d in range(12)] + [(20 + d, wrapped(words(90), 9)) for d in range(4)]
    docs = make_docs(rows)
    got = paragraphs.repeats(docs).collect()
    assert {r["doc_id"] for r in got if r["removed"]} == set(range(1, 12)) and all(r["kept_doc_id"] == 0 for r in got if r["copies"] == 12)
    found = defaultdict(set)
    for r in got:
        here = dict(rows)[r["doc_id"]].split("\n")[r["line"]].split()[r["first_word"]:r["first_word"] + r["n_words"]]
        assert len(here) == r["n_words"] and set(here) <= set(passage)
        found[r["doc_id"]] |= set(here)
    assert all(len(found[d]) >= 90 - 2 * (paragraphs.NEIGHBOURS - 1) for d in range(12))
    out = {r["doc_id"]: (r["text"] or "").split() for r in paragraphs.remove_lines(docs, paragraphs.repeats(docs)).collect()}
    assert not shared_runs([(d, " ".join(w)) for d, w in out.items()], 40)
    assert all(out[d] == t.split() for d, t in rows if d == 0 or d >= 20)
    assert set(passage) <= set(out[0]) and all(set(t.split()) - set(passage) <= set(out.get(d, ())) for d, t in rows)


def test_passages_beside_removed_lines_keep_one_place(make_docs):
    rng = random.Random(13)
    words = lambda n: [f"z{rng.randint(0, 10 ** 7)}" for _ in range(n)]
    line, short, other = words(30), [words(12) for _ in range(5)], words(30)
    body = lambda *parts: "\n".join(" ".join(p) for p in parts)
    near = [*line[:-1], "changed"]
    rows = [(1, body(line, words(9))), (2, body(words(8), near, *short, words(7))), (3, body(*short[:3], line, *short[3:])), (4, body(other, line, *short, other)), (5, body(*short, near))]
    docs = make_docs(rows)
    out = {r["doc_id"]: (r["text"] or "").split() for r in paragraphs.remove_lines(docs, paragraphs.repeats(docs)).collect()}
    left = set().union(*out.values())
    assert {w for p in short for w in p} | set(line) | set(other) <= left
    assert not shared_runs([(d, " ".join(w)) for d, w in out.items()], 40)


def test_passages_of_odd_rows(make_docs, spark):
    p = " ".join(f"p{k}" for k in range(60))
    rows = [(1, "a b " + p), (1, "a b " + p), (2, p + " c d"), (None, "e " + p + " f"), (3, None), (4, ""), (5, "z " * 200), (6, p + " " + " ".join(f"q{k}" for k in range(40)) + " " + p)]
    docs = make_docs(rows)
    got = {(r["doc_id"], r["line"], r["removed"]) for r in paragraphs.repeated_passages(docs, paragraphs.repeated_paragraphs(docs)).collect()}
    line_level = {(r["doc_id"], r["line"]) for r in paragraphs.repeated_paragraphs(docs).where("removed").collect()}
    assert got == {(1, 0, False), (6, 0, True)} | ({(2, 0, True)} if (2, 0) not in line_level else set())
    clash = docs.selectExpr("*", "doc_id AS _id", "text AS _gone", "1 AS _cut", "2 AS _text", "3 AS _doc")
    out = paragraphs.remove_lines(clash, paragraphs.repeats(clash))
    assert out.columns == clash.columns and {r["doc_id"] for r in out.collect()} >= {1, None, 3, 4, 5, 6}
    empty = docs.where("doc_id > 100")
    assert paragraphs.repeats(empty).count() == 0


def test_band_tuning():
    for threshold in (0.7, 0.8, 0.9):
        bands, rows = paragraphs.tune_bands(threshold)
        assert 1 - (1 - threshold ** rows) ** bands >= paragraphs.RECALL
        assert 1 - (1 - paragraphs.FALSE_AT ** rows) ** bands <= paragraphs.FALSE_RATE


def test_parts_are_merged_before_they_are_rows(spark):
    """Runs over the same short lines give a row for a line, not one for each run and line; results as if each part were a row."""
    from staylake.llm.paragraphs import merged_parts

    def run(doc, first, kept, copies, removed=True):
        parts = [(line, max(first - 5 * line, 0), min(first + 25 - 5 * line, 5) - max(first - 5 * line, 0)) for line in range(20) if first < 5 * line + 5 and first + 25 > 5 * line]
        return doc, first // 5, first % 5, parts, kept, copies, removed

    rows = [run(7, k, (1, 0, k), 2 + k % 3) for k in range(0, 70, 2)] + [run(8, 0, (3, 1, 0), 2), run(8, 3, (2, 9, 9), 5, False), run(8, 60, (1, 1, 1), 4)]
    schema = ("doc_id long, line int, first_word int, parts array<struct<line:int,first_word:int,n_words:int>>, "
              "kept struct<doc_id:long,line:int,first_word:int>, copies long, removed boolean")
    got = merged_parts(spark.createDataFrame(rows, schema).repartition(3)).collect()
    lines = {}
    for doc, _, _, parts, kept, copies, removed in rows:
        for line, first, n in parts:
            words, places, most = lines.setdefault((doc, removed, line), (set(), [], []))
            words.update(range(first, first + n)), places.append(kept), most.append(copies)
    assert len(got) == len(lines) < sum(len(r[3]) for r in rows) / 3
    for r in got:
        words, places, most = lines.pop((r.doc_id, r.removed, r.line))
        assert set(range(r.first_word, r.first_word + r.n_words)) == words
        assert (tuple(r.kept), r.copies) == (min(places), max(most))
