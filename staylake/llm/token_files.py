"""Token ids in Arrow files of equal-length sequences.

Documents are tokenized in ascending doc_id order; their ids, each document closed by END_ID, form
one stream that is cut into sequences of a fixed length. A file holds the stream of one range of
documents as record batches with two fixed-size-list columns, ``ids`` and ``mask`` (false on the
padding of the file's last sequence). Batches have the same number of sequences, so sequence k of
a file is row k % rows of batch k // rows and can be read from a memory map without a copy. A
second Arrow file beside it tells where its documents start.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from staylake.llm import _text as X
from staylake.llm._scratch import Scratch

END_ID = 0
SEQUENCE = 1024
ROWS = 64
#: Pieces whose ids a worker remembers; beyond it the memory starts anew.
REMEMBERED = 1_500_000
#: Ids that a worker remembers.
POOL = 1 << 26
_CHUNK = 1 << 21
_encoders: dict[tuple[str, bool], Encoder] = {}


class Encoder:
    """Whole-text encoding with the tokenizers library, each distinct piece of text once.

    Texts are cut only where byte-level pre-tokenization always starts a new token: before a single
    space between two visible characters, around a single newline between them, and before ASCII
    punctuation that follows an ASCII letter or digit. Pieces are then independent of each other.
    With ``special_as_text`` the strings of special tokens are ordinary text; without it the
    tokenizer stays as loaded, and a text that holds an added token's string is one piece.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.added = [] if special_as_text else [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.id_type = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pool, self.ends = np.zeros(0, self.id_type), np.zeros(1, np.int64)

    @staticmethod
    def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Ascending starts of all pieces."""
        n = len(data)
        padded = np.concatenate([np.zeros(2, np.uint8), data, np.zeros(1, np.uint8)])
        here, before, before2, after = padded[2:-1], padded[1:-2], padded[:-3], padded[3:]
        visible = lambda b: (b > 32) & (b < 127)
        two_byte = lambda b: (b >= 0xC3) & (b <= 0xDF)  # noqa: E731  first byte of a 2-byte character that is no space
        ends_visible = visible(before) | ((before >= 0x80) & two_byte(before2))
        starts_visible = visible(after) | two_byte(after)
        alone = ends_visible & starts_visible
        space, newline = (here == 32) & alone, (here == 10) & alone
        letter_or_digit = ((before | 32) >= 97) & ((before | 32) <= 122) | (before >= 48) & (before <= 57)
        punctuation = visible(here) & ~(((here | 32) >= 97) & ((here | 32) <= 122)) & ~((here >= 48) & (here <= 57)) & (here != 39)
        start = space | newline | punctuation & letter_or_digit
        start[1:] |= newline[:-1]
        start[offsets[:-1][offsets[:-1] < n]] = True
        return np.flatnonzero(start)

    def holds_added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which rows hold the string of an added token."""
        raw, out = data.tobytes(), np.zeros(len(offsets) - 1, dtype=bool)
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                inside = at + len(token) <= offsets[row + 1]
                out[row] |= inside
                at = raw.find(token, int(offsets[row + 1]) if inside else at + 1)
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and their number per row."""
        s = self.cuts(data, offsets)
        if self.added and len(s):
            row = np.searchsorted(offsets, s, "right") - 1
            s = s[~self.holds_added(data, offsets)[row] | (s == offsets[row])]
        e = np.append(s[1:], len(data)) if len(s) else s
        h = X.span_hashes(data, s, e)
        distinct, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > REMEMBERED or len(self.pool) > POOL:
            self.forget()
        at = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
        new = np.flatnonzero(self.known[at] != distinct) if len(self.known) else np.arange(len(distinct))
        if len(new):
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(s[first[new]].tolist(), e[first[new]].tolist(), strict=True)]
            ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            slots = len(self.ends) - 1 + np.arange(len(new))
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(x) for x in ids])])
            self.pool = np.concatenate([self.pool, np.array([i for x in ids for i in x], dtype=self.id_type)])
            put = np.searchsorted(self.known, distinct[new])
            self.known, self.slot = np.insert(self.known, put, distinct[new]), np.insert(self.slot, put, slots)
        slot = self.slot[np.searchsorted(self.known, distinct)][inverse]
        lengths = self.ends[slot + 1] - self.ends[slot]
        ids = self.pool[np.repeat(self.ends[slot], lengths) + X.within(lengths)]
        until = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(until[np.searchsorted(s, offsets)])


def encoder(path: str, special_as_text: bool = True) -> Encoder:
    if (path, special_as_text) not in _encoders:
        _encoders[path, special_as_text] = Encoder(path, special_as_text)
    return _encoders[path, special_as_text]


def encode_rows(enc: Encoder, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, ids per row) for runs of rows of about 2 MB; a longer text is one run."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + _CHUNK, "right")) - 1)
        yield lo, hi, *enc.encode(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
        lo = hi


class _Files:
    """Writes one task's stream; names are unique, so another attempt of the task never meets them."""

    def __init__(self, root: str, id_type: np.dtype, length: int, rows: int):
        self.store, path = pafs.FileSystem.from_uri(root)
        self.rows = rows
        self.name, self.length = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", length
        self.store.create_dir(path, recursive=True)
        self.type = pa.from_numpy_dtype(id_type)
        self.schema = pa.schema([("ids", pa.list_(self.type, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out = self.store.open_output_stream(f"{path}/{self.name}.arrow")
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.docs_out = self.store.open_output_stream(f"{path}/{self.name}.docs.arrow")
        self.docs = pa.ipc.new_file(self.docs_out, pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]))
        self.held, self.size, self.total, self.n_docs = [], 0, 0, 0

    def _batch(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        full = np.zeros(rows * self.length, dtype=ids.dtype)
        full[: len(ids)] = ids
        mask = np.arange(len(full)) < len(ids)
        self.writer.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(full, self.type), self.length), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        start = self.total + np.cumsum(counts) - counts
        self.docs.write_batch(pa.record_batch([doc_ids.cast(pa.int64()), pa.array(start), pa.array(counts)], names=["doc_id", "start", "n_tokens"]))
        self.total += len(ids)
        self.n_docs += len(counts)
        self.held.append(ids)
        self.size += len(ids)
        step = self.rows * self.length
        if self.size >= step:
            every = np.concatenate(self.held)
            for lo in range(0, len(every) - step + 1, step):
                self._batch(every[lo: lo + step])
            self.held = [every[len(every) // step * step:]]
            self.size = len(self.held[0])

    def close(self) -> None:
        if self.size:
            self._batch(np.concatenate(self.held))
        for x in (self.writer, self.out, self.docs, self.docs_out):
            x.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer_file: str, length: int = SEQUENCE, rows: int = ROWS, special_as_text: bool = True) -> DataFrame:
    """Writes the files below ``folder`` (a path or URI that executors share) and returns their manifest.

    ``docs`` needs doc_id and text; other columns are ignored. Manifest: part (files ascend in
    doc_id with it), name, n_ids, n_docs, first_id (ids of all documents in files before).

    Null and empty texts are END_ID alone. Null doc_ids come first. Repeated ids are ordered by the
    hash of their text; whole ties are equal rows. A very long text is encoded whole. Without
    ``special_as_text`` the ids are those of the tokenizer as loaded, special tokens included. An empty table
    has an empty manifest. A repeated task writes files of other names, and only those of the
    attempt that succeeded are in the manifest.
    """
    scratch = Scratch(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, files = encoder(tokenizer_file, special_as_text), None
        for batch in batches:
            if not batch.num_rows:
                continue
            files = files or _Files(folder, enc.id_type, length, rows)
            for lo, hi, ids, counts in encode_rows(enc, *X.utf8(X.column(batch, "text"))):
                ends = np.cumsum(counts)
                files.add(X.column(batch, "doc_id").slice(lo, hi - lo), np.insert(ids, ends, END_ID), counts + 1)
        if files:
            files.close()
            yield pa.record_batch({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "name": [files.name], "n_ids": pa.array([files.total], pa.int64()), "n_docs": pa.array([files.n_docs], pa.int64())})

    written = scratch.write(ordered.select("doc_id", "text").mapInArrow(run, "part int, name string, n_ids long, n_docs long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return written.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def open_sequences(root: str, name: str) -> tuple[pa.ipc.RecordBatchFileReader, pa.ipc.RecordBatchFileReader]:
    """Readers of a part's sequences and of its document index (a memory map where the store is local)."""
    store, path = pafs.FileSystem.from_uri(root)
    local = isinstance(store, pafs.LocalFileSystem)
    opened = [pa.memory_map(f) if local else store.open_input_file(f) for f in (f"{path}/{name}.arrow", f"{path}/{name}.docs.arrow")]
    return pa.ipc.open_file(opened[0]), pa.ipc.open_file(opened[1])


def sequence(reader: pa.ipc.RecordBatchFileReader, k: int) -> tuple[np.ndarray, pa.Array]:
    """Ids and mask of the k-th sequence of a part: a view of the file, not a copy."""
    rows = reader.get_batch(0).num_rows  # of all batches but the last
    batch = reader.get_batch(k // rows)
    ids, mask = batch.column(0), batch.column(1)
    n = ids.type.list_size
    return ids.values.slice(k % rows * n, n).to_numpy(zero_copy_only=True), mask.values.slice(k % rows * n, n)


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files of a manifest.

    ids_crc32 is the crc32 of the document's ids (END_ID included) as little-endian uint32.
    """
    spark = manifest.sparkSession
    files = manifest.select("part", "name", "first_id").orderBy("part").collect()  # one row per file
    schema = "part int, name string, first_id long"
    listed = spark.createDataFrame([tuple(r) for r in files], schema).repartition(max(1, len(files)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(X.column(batch, "name").to_pylist(), X.column(batch, "first_id").to_pylist(), strict=True):
                ids, docs = open_sequences(folder, name)
                at, lo, held = 0, 0, np.zeros(0, np.uint32)  # held: ids from lo on; at: the next batch of sequences
                for k in range(docs.num_record_batches):
                    part = docs.get_batch(k)
                    start, count = part.column(1).to_numpy(), part.column(2).to_numpy()
                    crcs = np.empty(len(start), dtype=np.int64)
                    for i, (a, n) in enumerate(zip(start.tolist(), count.tolist(), strict=True)):
                        more = [held[a - lo:]]
                        have = len(more[0])
                        while have < n:
                            x = ids.get_batch(at).column(0).values.to_numpy().astype("<u4")
                            more.append(x)
                            have += len(x)
                            at += 1
                        held, lo = (np.concatenate(more) if len(more) > 1 else more[0]), a
                        crcs[i] = zlib.crc32(held[:n])
                    yield pa.record_batch({"doc_id": part.column(0), "start": pa.array(start + first), "n_tokens": part.column(2), "ids_crc32": crcs})

    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
