"""Line dedup: every repeated line stays in its first document only.

Lines travel as 128-bit hashes with their document and position, never as text. The hashes are
range-partitioned and each partition is sorted by hash, document and position, so one streaming
pass over a hash's rows meets its first occurrence first and marks the rows of later documents.
The result is a run-length compressed keep bitmap per document.

A hash that fills more than a task's fair share cannot be range-partitioned evenly. One mergeable
frequent-items sketch finds every such hash; their first documents come from a map-side combined
minimum (at most HOT_LINES rows) that is broadcast, and their rows are marked where they lie.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from staylake.llm._scratch import Scratch

#: Shorter lines (code points of the key) always stay.
MIN_CHARS = 10
#: Rows of a range partition, and the most lines that the sketch reports and tracks: any line with more than a
#: thousandth of all rows is among them (the sketch's error is below 4 / TRACKED of the rows).
PARTITION_ROWS, HOT_LINES, TRACKED = 1_000_000, 4000, 65536
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OTHER_CAPITAL = r"[\p{IsUppercase}\p{Lt}\p{Cn}&&[^A-Z]]"  # Cn: letters younger than the JVM's Unicode tables


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often (or deep in a lambda) it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_lines(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(lines: Column) -> Column:
    """The lines without blanks at their ends, A-Z lower-cased.

    ``lower`` changes A-Z alone unless a line has other capitals; only such lines need ``translate``,
    which looks up every character.
    """
    only_ascii = lambda s: F.octet_length(s) == F.char_length(s)
    lowered = lambda s: F.when(only_ascii(s) | ~F.rlike(s, F.lit(_OTHER_CAPITAL)), F.lower(s)).otherwise(F.translate(s, _UPPER, _UPPER.lower()))
    return F.transform(F.transform(lines, lambda s: F.btrim(s, F.lit(_BLANKS))), lowered)


def text_key(text: Column) -> Column:
    """Tells different texts under one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_key, n_lines, pos, h1, h2 of every line whose key is long enough."""
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), line_keys(split_lines(F.col("text"))).alias("keys"))
    split = split.withColumn("n_lines", F.size("keys"))  # before the generator, which would copy the keys into each row; the outer one infers no filter that splits again
    keyed = split.select("doc_id", "text_key", "n_lines", F.posexplode_outer("keys").alias("pos", "key")).where(F.char_length("key") >= min_chars)
    return keyed.select("doc_id", "text_key", "n_lines", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))


def _kept_runs(gone: Column, n_lines: Column) -> Column:
    """Runs (start, n) of kept lines from the ascending positions of the dropped ones; linear in their number."""
    first = lambda g: F.filter(g, lambda x, i: (i == 0) | (F.get(g, i - 1) != x - 1))
    last = lambda g: F.transform(F.filter(g, lambda x, i: (i == F.size(g) - 1) | (F.get(g, i + 1) != x + 1)), lambda x: x + 1)
    runs = let(gone, lambda g: F.zip_with(F.concat(F.array(F.lit(0)), last(g)), F.concat(first(g), F.array(n_lines)), lambda a, b: F.struct(a.alias("start"), (b - a).alias("n"))))
    return F.filter(runs, lambda r: r["n"] > 0)


def dropped_runs(docs: DataFrame, scratch: Scratch, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_key, n_dropped, keep of the documents that lose a line (a written table)."""
    spark = docs.sparkSession
    rows = scratch.write(line_rows(docs, min_chars), "lines")
    found = rows.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h1, {HOT_LINES}, {TRACKED})").alias("top")).first()
    total = found["n"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION_ROWS))
    fair = max(1, total // min(4 * parts, HOT_LINES))
    hot = spark.createDataFrame([(r["item"],) for r in found["top"] or [] if r["count"] > fair], "h1 long")
    hash_ = ["h1", "h2"]
    by_place = Window.partitionBy(*hash_).orderBy(F.col("doc_id").asc_nulls_last(), "pos").rowsBetween(Window.unboundedPreceding, 0)
    cold = rows.join(F.broadcast(hot), "h1", "left_anti").repartitionByRange(parts, *hash_)
    cold = cold.withColumn("first_doc", F.first("doc_id").over(by_place))
    common = rows.join(F.broadcast(hot), "h1", "left_semi")
    firsts = scratch.write(common.groupBy(*hash_).agg(F.min("doc_id").alias("first_doc")), "firsts")  # at most HOT_LINES rows
    common = common.join(F.broadcast(firsts), hash_).select(*cold.columns)
    later = cold.unionByName(common).where(~F.col("first_doc").eqNullSafe(F.col("doc_id")))
    gone = later.groupBy("doc_id", "text_key").agg(F.first("n_lines").alias("n_lines"), F.sort_array(F.collect_set("pos")).alias("gone"))
    out = scratch.write(gone.select("doc_id", "text_key", F.size("gone").cast("long").alias("n_dropped"), _kept_runs(F.col("gone"), F.col("n_lines")).alias("keep")), "dropped")
    scratch.drop("lines", "firsts")
    return out


def _with_runs(docs: DataFrame, dropped: DataFrame, *columns: Column) -> DataFrame:
    """Each row of ``docs`` with its runs; documents that lose nothing keep all lines in one run."""
    rows = docs.select(F.col("doc_id").alias("id"), text_key(F.col("text")).alias("tk"), F.size(split_lines(F.col("text"))).alias("n_lines"), *columns)
    out = rows.join(dropped, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("tk") == F.col("text_key")), "left")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_lines").alias("n")))
    return out.select(F.col("id").alias("doc_id"), F.col("tk").alias("text_key"), F.col("n_lines").cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
                      F.coalesce("keep", whole).alias("keep"), *[c for c in rows.columns if c == "text"])


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_lines, n_dropped and ``keep``, the keep bitmap of its lines as runs (start, n).

    ``docs`` needs doc_id and text; other columns, whatever their names, are ignored. A text is split
    at newlines; a line's key has no blanks at its ends and A-Z lower-cased. A key of ``min_chars``
    code points or more that stands in several documents stays in the one with the smallest doc_id,
    with all of its lines there, and its lines in all others are dropped.

    Null and empty texts are one empty line, which stays. Rows repeated under one doc_id are one
    document, also if their texts differ: they drop no line of each other. Rows without doc_id count
    as one document that comes after all others. Very long texts are split whole. An empty table
    gives an empty result. Two different lines are taken for one only if two 64-bit hashes agree.
    """
    return _with_runs(docs, dropped_runs(docs, Scratch(docs.sparkSession), min_chars))


def kept_texts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``keep_bitmaps`` applied: its columns and ``text``, the kept lines joined by newlines (no line kept: empty)."""
    runs = _with_runs(docs, dropped_runs(docs, Scratch(docs.sparkSession), min_chars), F.col("text"))
    pieces = lambda all_: F.transform(F.col("keep"), lambda r: F.slice(all_, r["start"] + 1, r["n"]))
    text = F.when(F.col("n_dropped") == 0, F.coalesce("text", F.lit(""))).otherwise(let(split_lines(F.col("text")), lambda all_: F.array_join(F.flatten(pieces(all_)), "\n")))
    return runs.withColumn("text", text)
