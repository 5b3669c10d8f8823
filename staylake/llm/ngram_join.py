"""N-gram Jaccard join: documents that share most of their word n-grams.

The document by n-gram incidence matrix is cut into column blocks (ranges of the n-gram hash). A
column that holds one document only cannot add to any overlap, so a first pass over the column
blocks keeps the others. A document keeps candidates only if enough of its n-grams are left to
reach the overlap that its size demands, and only its rarest remaining n-grams (the prefix that
any partner must meet) bring documents together. Inside the resulting clusters, blocks of rows
are multiplied (``_graph.verify_clusters``): overlap counts accumulate over column blocks and
pairs that can no longer reach their bound are dropped. All links are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staylake.llm import _text as X
from staylake.llm._graph import as_batches, components, verify_clusters
from staylake.llm._scratch import Scratch

#: Matrix entries of a column block, entries that a task gathers before it cuts them into blocks, and rows of a result batch.
ENTRIES, GATHERED, RESULT_ROWS = 1_500_000, 500_000, 50_000
_LOW48 = np.uint64((1 << 48) - 1)


def _document_sets(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = X.utf8(X.column(batch, "text"))
    h, counts = X.distinct(*X.shingles(*X.words(data, offsets, X.NOT_SPACE), n))
    return h, counts, X.set_keys(h, counts).view(np.int64)


def document_keys(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles and the 64-bit key of the shingle set (null if empty) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches):
            _, counts, keys = _document_sets(batch, n)
            yield pa.record_batch({"doc_id": X.column(batch, "doc_id").cast(pa.int64()), "n_shingles": pa.array(counts.astype(np.int64)), "key": pa.array(keys, mask=counts == 0)})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, key long")


def _column_blocks(docs: DataFrame, n: int, blocks: int) -> DataFrame:
    """The incidence matrix by column block: for each block and group of documents, keys, sizes,
    entries per document and the entries' 48-bit hashes. Equal sets within a task are sent once."""

    def cut(h: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> pa.Table:
        block = ((h >> np.uint64(48)) * np.uint64(blocks) >> np.uint64(16)).astype(np.int32)
        doc = np.repeat(np.arange(len(counts)), counts)
        order = np.argsort(block, kind="stable")
        h, doc, block = h[order], doc[order], block[order]
        out: dict[str, list] = {"block": [], "keys": [], "sizes": [], "per_doc": [], "hashes": []}
        at = np.flatnonzero(np.r_[True, np.diff(block) != 0]) if len(block) else []
        for lo, hi in zip(at, np.r_[at[1:], len(block)].astype(int) if len(block) else [], strict=True):
            d = doc[lo:hi]
            first = np.flatnonzero(np.r_[True, np.diff(d) != 0])
            out["block"].append(int(block[lo]))
            out["keys"].append(keys[d[first]].tobytes())
            out["sizes"].append(counts[d[first]].astype(np.int32).tobytes())
            out["per_doc"].append(np.diff(np.r_[first, hi - lo]).astype(np.int32).tobytes())
            out["hashes"].append(np.ascontiguousarray(h[lo:hi].view(np.uint8).reshape(-1, 8)[:, :6]).tobytes())
        return pa.table(out, schema=pa.schema([("block", pa.int32()), *((c, pa.binary()) for c in ("keys", "sizes", "per_doc", "hashes"))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size, seen = 0, set()
        for batch in X.slices(batches):
            h, counts, keys = _document_sets(batch, n)
            _, first = np.unique(keys, return_index=True)
            fresh = np.zeros(len(keys), dtype=bool)
            fresh[[k for k in first.tolist() if counts[k] and int(keys[k]) not in seen]] = True
            if len(seen) < 200_000:  # bounds this memory only: the column blocks tell repeats apart too
                seen.update(keys[fresh].tolist())
            held.append((h[np.repeat(fresh, counts)], counts[fresh], keys[fresh]))
            size += len(held[-1][0])
            if size >= GATHERED:
                yield from cut(*(np.concatenate(x) for x in zip(*held, strict=True))).to_batches(max_chunksize=64)
                held, size = [], 0
        if size:
            yield from cut(*(np.concatenate(x) for x in zip(*held, strict=True))).to_batches(max_chunksize=64)

    return docs.select("doc_id", "text").mapInArrow(run, "block int, keys binary, sizes binary, per_doc binary, hashes binary")


def _shared_entries(cells: DataFrame) -> DataFrame:
    """key, n, token and df of all entries in columns that more than one set has."""

    def run(table: pa.Table) -> pa.Table:
        def gather(name: str, kind: type) -> np.ndarray:
            column = pa.concat_arrays(table.column(name).chunks)
            _, offsets, data = column.buffers()
            at = np.frombuffer(offsets, dtype=np.int32)[column.offset: column.offset + len(column) + 1]
            return np.frombuffer(data, dtype=np.uint8)[at[0]: at[-1]].view(kind)

        keys, sizes, per_doc = gather("keys", np.int64), gather("sizes", np.int32), gather("per_doc", np.int32)
        raw = np.zeros((int(per_doc.sum()), 8), dtype=np.uint8)
        raw[:, :6] = gather("hashes", np.uint8).reshape(-1, 6)
        h = raw.view(np.uint64).ravel()
        _, first = np.unique(keys, return_index=True)
        once = np.zeros(len(keys), dtype=bool)
        once[first] = True
        keep = np.repeat(once, per_doc)
        h = h[keep]
        del raw
        order = np.argsort(h, kind="stable")
        h = h[order]
        doc = np.repeat(np.arange(len(keys), dtype=np.int32), np.where(once, per_doc, 0))[order]
        del order, keep
        start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        df = np.diff(np.r_[start, len(h)]).astype(np.int32)
        df = np.repeat(df, df)
        some = df > 1
        doc, h = doc[some], h[some]
        block = np.uint64(int(table.column("block")[0].as_py()) & 0xFFFF) << np.uint64(48)
        out = pa.table({"key": keys[doc], "n": sizes[doc], "token": (h | block).view(np.int64), "df": df[some]})
        return pa.Table.from_batches(out.to_batches(max_chunksize=RESULT_ROWS), out.schema)  # sent batch by batch

    return cells.groupBy("block").applyInArrow(run, "key long, n int, token long, df int")


def _with_prefix(entries: DataFrame, percent: int) -> DataFrame:
    """key, n, tokens, prefix of the sets that still can have a partner.

    A partner of a set of n shares at least ceil(percent * n / 100) columns, so a set with fewer
    shared columns goes. In the order (df, token), with columns of one set first, two linked sets
    meet in their first n - ceil(percent * n / 100) + 1 columns.
    """

    def settle(key, n, token, df):
        order = np.lexsort((token, df, key))
        key, n, token = key[order], n[order], token[order]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        have = np.diff(np.r_[start, len(key)])
        size = n[start].astype(np.int64)
        need = -(-size * percent // 100)
        prefix = have - need + 1  # the n - have columns of one set come first and meet nobody
        out = {"key": [], "n": [], "tokens": [], "prefix": []}
        for k in np.flatnonzero(prefix > 0).tolist():
            t = token[start[k]: start[k] + have[k]].view(np.uint64)
            out["key"].append(int(key[start[k]]))
            out["n"].append(int(size[k]))
            out["tokens"].append(np.sort(t).tobytes())
            out["prefix"].append(t[: prefix[k]].tobytes())
        return pa.table(out, schema=pa.schema([("key", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary()), ("prefix", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        rest = tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int32))
        for batch in batches:
            held.append(tuple(c.to_numpy() for c in batch.columns))
            size += batch.num_rows
            if size >= 200_000:
                key, n, token, df = (np.concatenate(x) for x in zip(rest, *held, strict=True))
                end = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
                if end:
                    yield from settle(key[:end], n[:end], token[:end], df[:end]).to_batches(max_chunksize=2000)
                rest, held, size = (key[end:], n[end:], token[end:], df[end:]), [], 0
        key, n, token, df = (np.concatenate(x) for x in zip(rest, *held, strict=True))
        if len(key):
            yield from settle(key, n, token, df).to_batches(max_chunksize=2000)

    return entries.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, n long, tokens binary, prefix binary")


def _prefix_rows(sets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = X.column(batch, "prefix").to_pylist()
            keys = np.repeat(X.column(batch, "key").to_numpy(), [len(b) // 8 for b in blobs])
            yield from as_batches({"token": np.frombuffer(b"".join(blobs), dtype=np.int64), "key": keys})

    return sets.select("key", "prefix").mapInArrow(run, "token long, key long")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents whose word n-gram sets have Jaccard similarity >= percent / 100.

    ``docs`` needs doc_id and text; other columns are ignored. Returns one row per input row:
    doc_id, n_shingles, component_id (smallest doc_id that links reach, its own included) and
    n_links (other sets that this document's set links with; copies count as one set).

    Null and empty texts, and texts without words, have no shingles: n_shingles 0, no links, and
    their own doc_id as component. Equal sets (exact copies, repeated rows) are one matrix row, so
    copies always share a component and cost nothing more. A null doc_id takes part; it is never
    the smallest unless no doc_id of the component is known. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    keyed = scratch.write(document_keys(docs, n), "keyed")
    classes = keyed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"))
    total = classes.agg(F.sum("n")).first()[0] or 0
    blocks = int(min(1 << 16, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ENTRIES))))
    entries = _shared_entries(_column_blocks(docs, n, blocks))
    sets = scratch.write(_with_prefix(entries, percent), "sets")
    prefix = _prefix_rows(sets)
    centre = prefix.groupBy("token").agg(F.min("key").alias("b"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    near = prefix.join(centre, "token").select(F.col("key").alias("a"), "b")
    clusters = components(near, scratch, "near")
    links = scratch.write(verify_clusters(clusters, sets, percent, scratch, "check"), "links")
    linked = components(links.select("a", "b"), scratch, "linked")
    roots = linked.select("root").distinct().select(F.col("root").alias("node"), "root")
    member = linked.unionByName(roots).join(classes, F.col("node") == F.col("key"))
    lowest = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    degree = links.groupBy(F.col("a").alias("node")).agg(F.sum("degree").alias("n_links"))
    label = member.join(lowest, "root").join(degree, "node", "left").select("key", "component_id", "n_links")
    label = classes.select("key", "first_id").join(label, "key", "left").select("key", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    label = scratch.write(label, "label")
    scratch.drop("sets", "links", "check-members", "check-pairs")
    return keyed.join(label, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
