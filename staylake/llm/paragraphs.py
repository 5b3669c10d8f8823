"""Substring dedup: paragraphs that repeat, within or across documents, and passages inside them.

A paragraph is a line of the text. Paragraphs with equal words are one class; MinHash signatures of
the classes' word shingles are cut into bands tuned for high recall, classes that collide in a band
form candidate clusters, exact Jaccard similarity (blocks of set rows, ``_graph``) keeps the true
links, and every component of linked paragraphs keeps its first paragraph and loses the others.

A passage that is only part of a longer line leaves its line's similarity low, and one that is
wrapped over short lines fills no paragraph. So what stays is covered once more by runs of
PASSAGE_WORDS words, taken over the whole document's words and inside every line, that start at the
minima of the runs' hashes (the same minima wherever the passage stands): a MinHash of every
neighbourhood of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from staylake.llm import _text as X
from staylake.llm._graph import as_batches, components, verify_clusters
from staylake.llm._scratch import Scratch, small_side

#: Shorter paragraphs (headings, notices, single sentences) are found only as parts of a repeated passage.
MIN_WORDS = 20
RECALL, FALSE_AT, FALSE_RATE = 0.998, 0.3, 0.1
#: Words of a run, and starts (a power of two) of which the smallest hash is taken: any shared passage of at least
#: PASSAGE_WORDS + NEIGHBOURS - 1 words holds a run that is taken in both places.
PASSAGE_WORDS, NEIGHBOURS = 25, 16


def tune_bands(threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): the fewest signature values with the recall at the threshold and few collisions at FALSE_AT."""
    choices = []
    for rows in range(1, 13):
        for bands in range(1, 129):
            if 1 - (1 - threshold ** rows) ** bands >= recall:
                if 1 - (1 - FALSE_AT ** rows) ** bands <= FALSE_RATE:
                    choices.append((bands, rows))
                break
    return min(choices, key=lambda c: (c[0] * c[1], c[0]))


def _paragraphs(batch: pa.RecordBatch, min_words: int) -> tuple[np.ndarray, ...]:
    """Word hashes and counts of the long enough paragraphs, their rows, line numbers and keys (of the word sequence)."""
    data, offsets = X.utf8(X.column(batch, "text"))
    line_offsets, n_lines = X.lines(data, offsets)
    h, counts = X.words(data, line_offsets, X.NOT_SPACE)
    keep = counts >= min_words
    h, row, line = h[np.repeat(keep, counts)], np.repeat(np.arange(batch.num_rows), n_lines)[keep], X.within(n_lines)[keep]
    counts = counts[keep]
    order = X.mix(h + X.within(counts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    key = X.mix(X.row_sums(order, counts) + counts.astype(np.uint64))
    return h, counts, row, line, key.view(np.int64)


def _signatures(h: np.ndarray, counts: np.ndarray, n: int, bands: int, rows: int) -> list[bytes]:
    """Band hashes of each paragraph (at least one shingle each)."""
    s, many = X.shingles(h, counts, n)
    if not len(many):
        return []
    first = np.cumsum(many) - many
    rng = np.random.Generator(np.random.PCG64(9))
    factor, shift = rng.integers(0, 1 << 63, (2, bands * rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    band = np.empty((len(many), bands), dtype=np.uint64)
    for b in range(bands):
        value = np.full(len(many), b + 1, dtype=np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            value = X.mix(value + np.minimum.reduceat((s * factor[k] + shift[k]) >> np.uint64(24), first))
        band[:, b] = value
    return [r.tobytes() for r in band]


def paragraph_table(docs: DataFrame, n: int, min_words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, line, n_words, key of every long enough paragraph, and its band hashes where a batch has it first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches):
            h, counts, row, line, key = _paragraphs(batch, min_words)
            _, first = np.unique(key, return_index=True)
            lead = np.zeros(len(key), dtype=bool)
            lead[first] = True
            some = np.repeat(lead, counts)
            blobs = np.empty(len(key), dtype=object)
            blobs[lead] = _signatures(h[some], counts[lead], n, bands, rows)
            yield from pa.table({
                "doc_id": X.column(batch, "doc_id").take(pa.array(row)), "line": line.astype(np.int32), "n_words": counts.astype(np.int32), "key": key,
                "bands": pa.array(blobs.tolist(), pa.binary())}).to_batches(max_chunksize=5000)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, line int, n_words int, key long, bands binary")


def _band_rows(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = X.column(batch, "bands").to_pylist()
            yield from as_batches({"band": np.frombuffer(b"".join(blobs), dtype=np.int64), "key": np.repeat(X.column(batch, "key").to_numpy(), [len(b) // 8 for b in blobs])})

    return classes.select("key", "bands").mapInArrow(run, "band long, key long")


def _shingle_sets(docs: DataFrame, keys: DataFrame, n: int, min_words: int) -> DataFrame:
    """key, n, tokens of the wanted paragraph classes, from the documents that hold their first paragraph."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches):
            h, counts, _, _, key = _paragraphs(batch, min_words)
            _, first = np.unique(key, return_index=True)
            lead = np.zeros(len(key), dtype=bool)
            lead[first] = True
            s, many = X.distinct(*X.shingles(h[np.repeat(lead, counts)], counts[lead], n))
            ends = np.cumsum(many)
            blobs = [s[e - m: e].tobytes() for e, m in zip(ends.tolist(), many.tolist(), strict=True)]
            yield from pa.table({"key": key[lead], "n": many.astype(np.int64), "tokens": pa.array(blobs, pa.binary())}).to_batches(max_chunksize=2000)

    sets = docs.select("doc_id", "text").mapInArrow(run, "key long, n long, tokens binary")
    return sets.join(keys, "key", "left_semi")


def repeated_paragraphs(docs: DataFrame, n: int = 5, percent: int = 80, min_words: int = MIN_WORDS) -> DataFrame:
    """Every paragraph that repeats: doc_id, line, n_words, kept_doc_id, kept_line, copies, removed.

    ``docs`` needs doc_id and text; other columns are ignored. Paragraphs of ``min_words`` words or
    more repeat if they are linked, directly or through others, by Jaccard similarity >=
    percent / 100 of their n-word shingles (letters A-Z lower-cased). Of each component the first
    paragraph by (doc_id, line) stays and the others are removed; ``copies`` counts the
    paragraphs of the component.

    Null and empty texts have no paragraphs. Rows repeated under one doc_id are one document: their
    equal lines are one paragraph. Paragraphs without doc_id come last, and are removed unless the
    whole component has none. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    bands, rows = tune_bands(percent / 100)
    table = scratch.write(paragraph_table(docs, n, min_words, bands, rows), "paragraphs")
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), "line")
    firsts = table.groupBy("key").agg(F.min(place).alias("place"), F.count("*").alias("rows"))
    signed = table.where("bands is not null").groupBy("key").agg(F.min("bands").alias("bands"))
    band_rows = _band_rows(signed)
    centre = band_rows.groupBy("band").agg(F.min("key").alias("b"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    clusters = components(band_rows.join(centre, "band").select(F.col("key").alias("a"), "b"), scratch, "near")
    wanted = scratch.write(clusters.select(F.col("node").alias("key")).unionByName(clusters.select(F.col("root").alias("key"))).distinct(), "wanted")
    holders = table.where("bands is not null").join(wanted, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").select("doc_id").distinct()
    holders = scratch.write(holders, "holders")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_side(holders, holders.count()), "doc_id", "left_semi")
    sets = scratch.write(_shingle_sets(texts, wanted, n, min_words).groupBy("key").agg(F.max("n").alias("n"), F.min("tokens").alias("tokens")), "sets")
    links = scratch.write(verify_clusters(clusters, sets, percent, scratch, "check"), "links")
    linked = components(links.select("a", "b"), scratch, "linked")
    roots = linked.select("root").distinct().select(F.col("root").alias("node"), "root")
    root_of = linked.unionByName(roots).withColumnRenamed("node", "key")
    classes = firsts.join(root_of, "key", "left").withColumn("root", F.coalesce("root", "key"))
    groups = classes.groupBy("root").agg(F.min("place").alias("kept"), F.sum("rows").alias("copies")).where("copies > 1")
    label = scratch.write(classes.join(groups, "root").select("key", "kept", "copies"), "label")
    scratch.drop("sets", "links", "wanted", "holders", "check-members", "check-pairs")
    kept_doc = F.when(F.col("kept.doc") < (1 << 63) - 1, F.col("kept.doc"))
    stays = F.col("doc_id").eqNullSafe(F.col("kept_doc_id")) & (F.col("line") == F.col("kept_line"))
    out = table.select("doc_id", "line", "n_words", "key").join(label, "key")
    return out.select("doc_id", "line", "n_words", kept_doc.alias("kept_doc_id"), F.col("kept.line").alias("kept_line"), "copies").withColumn("removed", ~stays)


def _minima(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which values are the smallest of some NEIGHBOURS consecutive values of their row (of the whole row, if shorter)."""
    place = X.within(counts)
    at = place + np.repeat(np.arange(len(counts)) * (NEIGHBOURS - 1) + np.cumsum(counts) - counts, counts)
    low = np.full(len(h) + NEIGHBOURS * (len(counts) + 1), np.iinfo(np.uint64).max, dtype=np.uint64)
    low[at] = h
    step = 1
    while step < NEIGHBOURS:
        low[:-step] = np.minimum(low[:-step], low[step:])
        step *= 2
    starts = at[(place == 0) | (place + NEIGHBOURS <= np.repeat(counts, counts))]
    high = np.zeros_like(low)
    high[starts] = low[starts]
    step = 1
    while step < NEIGHBOURS:
        high[step:] = np.maximum(high[step:], high[:-step])
        step *= 2
    return high[at] == h


def passage_table(docs: DataFrame, words: int, across_lines: bool = True) -> DataFrame:
    """doc_id, line, first_word (of its first word), key (hash of ``words`` words) and parts of the runs taken from every document (``across_lines``) and every line.

    parts are the pieces of lines that a run over several lines consists of (null for a run inside one line).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches):
            data, offsets = X.utf8(X.column(batch, "text"))
            line_offsets, n_lines = X.lines(data, offsets)
            h, line_words = X.words(data, line_offsets, X.NOT_SPACE)
            line_row, line_number = np.repeat(np.arange(batch.num_rows), n_lines), X.within(n_lines)
            line_first, line_of = np.cumsum(line_words) - line_words, np.repeat(np.arange(len(line_words)), line_words)
            counts = np.bincount(line_row, weights=line_words, minlength=batch.num_rows).astype(np.int64)
            long = counts >= words
            key, many = X.shingles(h[np.repeat(long, counts)], counts[long], words)
            at = np.repeat((np.cumsum(counts) - counts)[long], many) + X.within(many)
            taken = _minima(key, many) if across_lines else np.zeros(len(key), dtype=bool)
            inside = line_of[at] == line_of[at + words - 1]
            taken[inside] |= _minima(key[inside], line_words[line_words >= words] - words + 1)
            at, key = at[taken], key[taken]
            line, last = line_of[at], line_of[at + words - 1]
            filled = np.cumsum(line_words > 0) - 1  # number of a line among those with words
            pieces = np.where(line < last, filled[last] - filled[line] + 1, 0)
            piece_line = np.flatnonzero(line_words)[np.repeat(filled[line], pieces) + X.within(pieces)]
            run_start = np.repeat(at, pieces)
            start = np.maximum(run_start, line_first[piece_line])
            n = np.minimum(run_start + words, line_first[piece_line] + line_words[piece_line]) - start
            parts = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (line_number[piece_line], start - line_first[piece_line], n)], ["line", "first_word", "n_words"])
            ends = pa.array(np.concatenate([[0], np.cumsum(pieces)]).astype(np.int32))
            yield from pa.table({
                "doc_id": X.column(batch, "doc_id").take(pa.array(line_row[line])), "line": line_number[line].astype(np.int32),
                "first_word": (at - line_first[line]).astype(np.int32), "key": key.view(np.int64),
                "parts": pa.ListArray.from_arrays(ends, parts, mask=pa.array(pieces == 0))}).to_batches(max_chunksize=50_000)

    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return known.mapInArrow(run, "doc_id long, line int, first_word int, key long, parts array<struct<line:int,first_word:int,n_words:int>>")


def _merge(batch: pa.RecordBatch) -> pa.Table:
    """The parts of a batch of runs, overlapping and touching ones of a document's line as one (smallest kept, most copies)."""
    parts = X.column(batch, "parts")
    row = np.repeat(np.arange(batch.num_rows), parts.value_lengths().to_numpy(zero_copy_only=False))
    flat = parts.flatten()
    line, first, n = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("line", "first_word", "n_words"))
    kept = X.column(batch, "kept")
    by_place = np.lexsort([kept.field(c).to_numpy(zero_copy_only=False) for c in ("first_word", "line", "doc_id")])
    place = np.empty(len(by_place), dtype=np.int64)
    place[by_place] = np.arange(len(by_place))
    doc = X.column(batch, "doc_id").to_numpy(zero_copy_only=False)[row]
    removed = X.column(batch, "removed").to_numpy(zero_copy_only=False)[row]
    copies, place = X.column(batch, "copies").to_numpy(zero_copy_only=False)[row], place[row]
    order = np.lexsort([first, line, removed, doc])
    row, line, first, n, doc, removed, copies, place = (a[order] for a in (row, line, first, n, doc, removed, copies, place))
    other = np.concatenate([[True], (doc[1:] != doc[:-1]) | (removed[1:] != removed[:-1]) | (line[1:] != line[:-1])])
    end = first + n
    shift = (np.cumsum(other) - 1) * (end.max() + 1)  # a line's places lie after those of all lines before
    reach = np.maximum.accumulate(end + shift)
    start = np.flatnonzero(other | np.concatenate([[True], (first + shift)[1:] > reach[:-1]]))
    low = pa.array(by_place[np.minimum.reduceat(place, start)])
    return pa.table({
        "doc_id": doc[start], "line": line[start].astype(np.int32), "first_word": first[start].astype(np.int32),
        "n_words": (np.maximum.reduceat(end, start) - first[start]).astype(np.int32), "kept": kept.take(low),
        "copies": np.maximum.reduceat(copies, start), "removed": removed[start]})


def merged_parts(runs: DataFrame) -> DataFrame:
    """doc_id, line, first_word, n_words, kept, copies, removed of the runs' parts by line.

    Runs overlap, and each has a part in every line that it meets. They are sorted by document and the parts of a batch
    merged before they become rows, so there are about as many rows as lines and not one for each run and line. A
    document over two batches may have parts that still overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _merge(batch).to_batches()

    kept = "struct<doc_id:long,line:int,first_word:int>"
    by_document = runs.withColumn("kept", F.col("kept").cast(kept)).repartition("doc_id").sortWithinPartitions("doc_id", "line", "first_word")
    by_document = by_document.select("doc_id", "parts", "kept", F.col("copies").cast("long").alias("copies"), "removed")
    return by_document.mapInArrow(run, f"doc_id long, line int, first_word int, n_words int, kept {kept}, copies long, removed boolean")


def repeated_passages(docs: DataFrame, lines: DataFrame, words: int = PASSAGE_WORDS, across_lines: bool = True) -> DataFrame:
    """Passages that other documents have too, by line: doc_id, line, first_word, n_words, kept_doc_id, kept_line, copies, removed.

    ``docs`` needs doc_id and text; ``lines`` is ``repeated_paragraphs(docs)``, whose removed lines
    are left out. A passage consists of overlapping runs of ``words`` equal words (letters A-Z
    lower-cased) that stand in at least two documents, wherever their lines end (only inside lines without ``across_lines``); every passage of
    ``words`` + NEIGHBOURS - 1 words or more is found, its ends may be missed by less than
    NEIGHBOURS words. A passage over several lines has a row for its part of each line. Of each run the
    first place by (doc_id, line, first_word) that meets no removed line stays, and later ones are
    removed; ``copies`` is the largest number of places of a run, kept_doc_id and kept_line are the
    smallest place (where the run begins) that its runs keep.
    Words beside a passage decide which of its outermost runs are taken, so a run that its first
    document does not take can have its first place in a later one; every word keeps one place.

    Runs that only one document repeats are no passages. Null and empty texts have no runs, and
    rows without doc_id take no part. Rows repeated under one doc_id are one document. An empty
    table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    table = scratch.write(passage_table(docs, words, across_lines), "runs")
    shared = table.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("key")
    gone = lines.where("removed and doc_id is not null").select("doc_id", F.col("line").alias("in_line")).distinct().withColumn("gone", F.lit(True))
    whole = F.array(F.struct("line", "first_word", F.lit(words).alias("n_words")))
    pieces = table.join(shared, "key", "left_semi").withColumn("part", F.explode(F.coalesce("parts", whole))).drop("parts").withColumn("in_line", F.col("part.line"))
    pieces = pieces.join(gone, ["doc_id", "in_line"], "left")
    hits = pieces.groupBy("doc_id", "line", "first_word", "key").agg(F.max("gone").alias("touched"), F.collect_set(F.when(F.col("gone").isNull(), F.col("part"))).alias("parts"))
    hits = scratch.write(hits.where(F.size("parts") > 0), "shared")
    scratch.drop("runs")
    place = F.struct("doc_id", "line", "first_word")
    firsts = hits.groupBy("key").agg(F.min(F.when(F.col("touched").isNull(), place)).alias("kept"), F.max("doc_id").alias("high"), F.count("*").alias("copies"))
    firsts = firsts.where(F.col("high") > F.col("kept.doc_id")).drop("high")
    # a word goes only for the sake of an earlier place, so one of its places always stays
    runs = hits.join(firsts, "key").where(place >= F.col("kept")).withColumn("removed", place != F.col("kept"))
    parts = merged_parts(runs.select("doc_id", "line", "first_word", "parts", "kept", "copies", "removed"))
    in_line = Window.partitionBy("doc_id", "line", "removed").orderBy("first_word", "n_words")
    end = F.col("first_word") + F.col("n_words")
    apart = F.col("first_word") > F.max(end).over(in_line.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("part", F.sum("apart").over(in_line.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.min("first_word")
    passages = parts.groupBy("doc_id", "line", "removed", "part").agg(
        first.alias("first_word"), (F.max(end) - first).alias("n_words"), F.min("kept").alias("kept"), F.max("copies").alias("copies"))
    return passages.select("doc_id", "line", "first_word", "n_words", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.line").alias("kept_line"), "copies", "removed")


def repeats(docs: DataFrame, across_lines: bool = True) -> DataFrame:
    """Repeated paragraphs (from word 0 of their line) and the repeated passages of what stays."""
    lines = repeated_paragraphs(docs)
    return lines.withColumn("first_word", F.lit(0)).unionByName(repeated_passages(docs, lines, across_lines=across_lines))


def _cut(text: str, gone: list) -> str:
    """The text without the given (line, first_word, n_words); a line that loses all words goes, one that loses some has single blanks."""
    spans: dict[int, list] = {}
    for line, first, n in gone:
        spans.setdefault(line, []).append((first, first + n))
    out = []
    for i, line in enumerate(text.split("\n")):
        if i in spans:
            words = re.findall(r"[^\x20\x09-\x0D]+", line)
            keep = np.ones(len(words), dtype=bool)
            for a, b in spans[i]:
                keep[a:b] = False
            if not keep.any():
                continue
            line = " ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k)
        out.append(line)
    return "\n".join(out)


def _without(text: Column, gone: Column) -> Column:
    @F.pandas_udf("string")
    def cut(text: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _cut(t, [(g["line"], g["first_word"], g["n_words"]) for g in s]) for t, s in zip(text, gone, strict=True)], dtype=object)

    return cut.asNondeterministic()(text, gone)  # a filter on its result must not run it a second time, in workers of its own


def remove_lines(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """``docs`` without the removed paragraphs, and passages, of ``repeats``; a document that keeps nothing goes.

    ``repeats`` comes from ``repeated_paragraphs`` or from ``repeats``. All columns stay; a column
    n_chars follows the new text. Documents without repeats, null texts and null doc_ids are
    returned as they are.
    """
    scratch = Scratch(docs.sparkSession)
    if "first_word" not in repeats.columns:
        repeats = repeats.withColumn("first_word", F.lit(0))
    spans = F.collect_set(F.struct("line", "first_word", "n_words")).alias("_gone")
    gone = scratch.write(repeats.where("removed and doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(spans), "gone")
    size = gone.agg(F.sum(F.size("_gone"))).first()[0] or 0
    out = docs.select(F.struct("*").alias("_doc")).join(small_side(gone, size), F.col("_doc.doc_id") == F.col("_id"), "left")
    before = F.col("_doc").getField("text")
    after = F.when(F.col("_gone").isNull(), before).otherwise(_without(F.when(F.col("_gone").isNotNull(), before), F.col("_gone")))
    out = out.select("_doc", "_gone", after.alias("_text")).where("_gone is null or trim(BOTH ' \\t\\n' FROM _text) <> ''")
    changed = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return out.select(*[changed.get(c, F.col("_doc").getField(c)).alias(c) for c in docs.columns])
