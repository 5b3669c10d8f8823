"""License scans: exact set-similarity join of text blocks with license templates.

A template's distinct tokens are ordered by how often the whole corpus has them, rarest first. A
block can contain a template to the threshold only if it has one of the template's first
|T| - need + 1 tokens (prefix filter), has need words (length filter) and, at the first token they
share, enough tokens are left on both sides (positional filter). Blocks that pass are verified
exactly. Blocks are the lines of a text, a line longer than WINDOW words in windows that overlap by
half, and such windows of the whole text, wherever its lines end: every run of WINDOW / 2 words,
also of a notice wrapped over several lines, lies in some block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staylake.llm import _text as X
from staylake.llm._ship import ship

WINDOW = 64
THRESHOLD = 0.8

#: Phrases whose words must stand consecutively.
BASE_PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

#: Notices of public licenses.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this work is licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
]


def _hashes(text: str) -> np.ndarray:
    return X.words(*X.utf8(pa.array([text])), X.ALNUM)[0]


def _template_tokens() -> np.ndarray:
    return np.unique(np.concatenate([_hashes(t) for _, t in TEMPLATES]))


def token_frequencies(docs: DataFrame) -> dict[int, int]:
    """Occurrences of each template token in the whole corpus (one row per token reaches the driver)."""
    ship(docs.sparkSession)
    tokens = _template_tokens()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tokens), dtype=np.int64)
        for batch in X.slices(batches):
            h, _ = X.words(*X.utf8(X.column(batch, "text")), X.ALNUM)
            at = np.minimum(np.searchsorted(tokens, h), len(tokens) - 1)
            total += np.bincount(at[tokens[at] == h], minlength=len(tokens))
        yield pa.record_batch({"token": tokens.view(np.int64), "n": total})

    return {r["token"]: r["n"] for r in docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()}


class Matcher:
    """Templates in global frequency order."""

    def __init__(self, frequencies: dict[int, int], threshold: float):
        tokens = _template_tokens()
        count = np.array([frequencies.get(int(t), 0) for t in tokens.view(np.int64)])
        order = np.lexsort((tokens, count))
        self.tokens = tokens
        self.rank = np.empty(len(tokens), dtype=np.int64)
        self.rank[order] = np.arange(len(tokens))
        self.templates = []
        trigger = np.zeros(len(tokens), dtype=bool)
        by_rank = {int(r): i for i, r in enumerate(self.rank)}
        for label, text in TEMPLATES:
            ranks = np.sort(self.rank[np.searchsorted(tokens, np.unique(_hashes(text)))])
            need = int(np.ceil(threshold * len(ranks) - 1e-9))
            prefix = ranks[: len(ranks) - need + 1]
            trigger[[by_rank[int(r)] for r in prefix]] = True
            self.templates.append((label, ranks, need, {int(r): k for k, r in enumerate(prefix)}))
        self.trigger = trigger
        self.phrases = [(label, _hashes(p)) for label, p in BASE_PHRASES.items()]

    def block(self, ranks: np.ndarray, length: int) -> list[tuple[str, float]]:
        """Labels and containments of the templates that a block with these template tokens (sorted ranks) and so many words holds."""
        found = []
        for label, template, need, prefix in self.templates:
            if length < need or len(ranks) < need:
                continue
            j = next((j for j, r in enumerate(ranks.tolist()) if r in prefix), None)
            if j is None:
                continue
            if 1 + min(len(template) - prefix[int(ranks[j])] - 1, len(ranks) - j - 1) < need:
                continue
            overlap = len(np.intersect1d(template, ranks, assume_unique=True))
            if overlap >= need:
                found.append((label, overlap / len(template)))
        return found


def windows(firsts: np.ndarray, sizes: np.ndarray, hits: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first word of the span, start and end in it) of every window that holds a hit: WINDOW words each, overlapping by half."""
    half = WINDOW // 2
    span = np.searchsorted(firsts, hits, "right") - 1
    at, n = hits - firsts[span], sizes[span]
    last = np.maximum(0, -(-(n - WINDOW) // half))  # number of the span's last window
    late = np.minimum(at // half, last)
    early = np.clip((at - WINDOW) // half + 1, 0, late)
    for i, k in np.unique(np.concatenate([np.stack([span, x], axis=1) for x in (early, late)]), axis=0).tolist():
        a, lo = int(firsts[i]), k * half
        yield a, lo, min(lo + WINDOW, int(sizes[i]))


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks of every row.

    ``docs`` needs doc_id and text; other columns are ignored. labels holds the base labels and
    those of every template contained in some block to ``threshold``; score is 1 with a base
    phrase, else the best containment found (0 if none); blocks lists the blocks that hold a
    template as (label, first word, number of words, containment).

    Null and empty texts have 0 words, no place and empty label strings. Phrases and blocks are
    found in the whole text, however long. Repeated rows each get a row; ties between templates
    keep all labels. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    frequencies = token_frequencies(docs)
    block_type = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(frequencies, threshold)
        for batch in X.slices(batches):
            data, offsets = X.utf8(X.column(batch, "text"))
            line_offsets, n_lines = X.lines(data, offsets)
            h, line_words = X.words(data, line_offsets, X.ALNUM)
            rows = batch.num_rows
            line_row = np.repeat(np.arange(rows), n_lines)
            n_words = np.bincount(line_row, weights=line_words, minlength=rows).astype(np.int64)
            first_of = np.cumsum(n_words) - n_words
            row = np.repeat(np.arange(rows), n_words)
            n_base, low, high = np.zeros(rows, np.int64), np.full(rows, np.iinfo(np.int64).max), np.full(rows, -1)
            base: list[set] = [set() for _ in range(rows)]
            for label, phrase in m.phrases:
                k = len(phrase)
                if len(h) < k:
                    continue
                at = np.flatnonzero(h[: len(h) - k + 1] == phrase[0])
                for i in range(1, k):
                    at = at[h[at + i] == phrase[i]]
                at = at[row[at] == row[at + k - 1]]
                r, start = row[at], at - first_of[row[at]]
                n_base += np.bincount(r, minlength=rows)
                np.minimum.at(low, r, start)
                np.maximum.at(high, r, start)
                for x in set(r.tolist()):
                    base[x].add(label)
            labels, best = [set(x) for x in base], np.where(n_base > 0, 1.0, 0.0)
            blocks: list[list] = [[] for _ in range(rows)]
            place = np.minimum(np.searchsorted(m.tokens, h), len(m.tokens) - 1)
            known = m.tokens[place] == h
            hits = np.flatnonzero(known & m.trigger[place])
            seen: set[tuple[int, int]] = set()
            for firsts, sizes in ((np.cumsum(line_words) - line_words, line_words), (first_of, n_words)):  # lines, then whole texts
                for a, lo, hi in windows(firsts, sizes, hits):
                    if (a + lo, a + hi) in seen:
                        continue
                    seen.add((a + lo, a + hi))
                    r = int(row[a + lo])
                    here = slice(a + lo, a + hi)
                    ranks = np.unique(m.rank[place[here][known[here]]])
                    for label, c in m.block(ranks, hi - lo):
                        labels[r].add(label)
                        best[r] = max(best[r], c)
                        blocks[r].append({"label": label, "first_word": int(a + lo - first_of[r]), "n_words": hi - lo, "containment": c})
            if rows:
                yield pa.record_batch({
                    "doc_id": X.column(batch, "doc_id").cast(pa.int64()), "n_words": n_words, "n_base": n_base,
                    "first_word": pa.array(low, mask=n_base == 0), "last_word": pa.array(high, mask=n_base == 0),
                    "base_labels": pa.array([",".join(sorted(x)) for x in base]), "labels": pa.array([",".join(sorted(x)) for x in labels]),
                    "score": best, "blocks": pa.array(blocks, type=block_type)})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, blocks array<struct<label:string,first_word:long,n_words:long,containment:double>>")
