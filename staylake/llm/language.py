"""Language identification with hyperdimensional letter n-gram profiles.

Every letter has a fixed random vector of +1 and -1. The vector of an n-gram binds its letters'
vectors, each permuted (rolled) by its place; a document bundles (adds) the vectors of all its
n-grams, a language bundles its documents. A document gets the language whose bundle has the
largest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from staylake.llm import _text as X
from staylake.llm._ship import ship

DIMENSIONS = 1024
NGRAM = 3
#: Labelled documents that prototypes are learned from, as an expected number for each language:
#: a uniform sample by a hash of the id, all documents where there are fewer.
SAMPLE_PER_LANGUAGE = 4000
UNKNOWN = "und"
#: Letters have symbols 1 to _SYMBOLS - 1 (those beyond the Latin blocks share some), 0 is any gap between words.
_SYMBOLS, _LATIN = 1024, 0x250
_PIECE_CHARS = 400_000
_COLUMNS = 4096
_tables: dict[str, np.ndarray] = {}


def _symbols() -> np.ndarray:
    if "symbol" not in _tables:
        cps = np.arange(0x110000, dtype=np.int64)
        letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        own = np.where(cps < _LATIN, cps + 1, _LATIN + 1 + cps * 2654435761 % (_SYMBOLS - _LATIN - 1))
        _tables["symbol"] = np.where(letter, own, 0).astype(np.int32)
    return _tables["symbol"]


def _letter_vectors() -> np.ndarray:
    """Permuted letter vectors: one table for each place in the n-gram."""
    if "letters" not in _tables:
        signs = np.random.Generator(np.random.PCG64(20)).integers(0, 2, (_SYMBOLS, DIMENSIONS), dtype=np.int8) * 2 - 1
        _tables["letters"] = np.stack([np.roll(signs, NGRAM - 1 - k, axis=1) for k in range(NGRAM)]).astype(np.int8)
    return _tables["letters"]


def document_vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bundled n-gram vector of each text (float32) and whether it has any letter."""
    low = [t.lower() for t in texts]
    lengths = np.array([len(t) + 1 for t in low], dtype=np.int64)
    cps = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    s = _symbols()[cps]
    doc = np.concatenate([[0], np.repeat(np.arange(len(low)), lengths)])
    keep = (s > 0) | np.r_[True, s[:-1] > 0]
    s, doc = s[keep], doc[keep]
    middle = np.flatnonzero(s[1:-1] > 0) + 1
    out = np.zeros((len(low), DIMENSIONS), dtype=np.float32)
    has = np.zeros(len(low), dtype=bool)
    if not len(middle):
        return out, has
    doc = doc[middle]
    has[doc] = True
    active = np.flatnonzero(np.bincount(s, minlength=_SYMBOLS))
    narrow = np.zeros(_SYMBOLS, dtype=np.int64)
    narrow[active] = np.arange(len(active))
    t, a = narrow[s], len(active)
    code = (t[middle - 1] * a + t[middle]) * a + t[middle + 1]
    if a ** 3 <= 4_000_000:
        seen = np.flatnonzero(np.bincount(code, minlength=a ** 3))
        place = np.zeros(a ** 3, dtype=np.int64)
        place[seen] = np.arange(len(seen))
        code = place[code]
    else:
        seen, code = np.unique(code, return_inverse=True)
    first, second, third = _letter_vectors()
    for lo in range(0, len(seen), _COLUMNS):
        grams = seen[lo: lo + _COLUMNS]
        vectors = first[active[grams // (a * a)]] * second[active[grams // a % a]] * third[active[grams % a]]
        here = (code >= lo) & (code < lo + len(grams)) if len(seen) > _COLUMNS else slice(None)
        counts = np.bincount(doc[here] * len(grams) + code[here] - lo, minlength=len(low) * len(grams))
        out += counts.reshape(len(low), len(grams)).astype(np.float32) @ vectors.astype(np.float32)
    return out, has


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > lo and size + n > _PIECE_CHARS:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


def _vectors(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Document vectors for runs of rows; a very long text is bundled piece by piece, cut at white space where there is some."""
    for lo, hi in _pieces(texts):
        if hi - lo == 1 and len(texts[lo] or "") > 4 * _PIECE_CHARS:
            total, any_letter, at, text = np.zeros((1, DIMENSIONS), dtype=np.float64), False, 0, texts[lo]
            while at < len(text):
                end = min(at + _PIECE_CHARS, len(text))
                gap = text.find(" ", end)
                end = len(text) if end == len(text) or gap < 0 and len(text) - end < _PIECE_CHARS else (gap if 0 <= gap < end + _PIECE_CHARS else end)
                v, has = document_vectors([text[at:end]])
                total, any_letter, at = total + v, any_letter or bool(has[0]), end
            yield lo, hi, total, np.array([any_letter])
        else:
            yield lo, hi, *document_vectors([t or "" for t in texts[lo:hi]])


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=-1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


def learn_prototypes(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages in code point order and their unit prototypes, from ``labelled`` (doc_id, text, lang).

    One row per language and dimension reaches the driver. Rows with null lang are left out.
    """
    ship(labelled.sparkSession)
    known = labelled.where("lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n)))) if sizes else F.create_map(F.lit(""), F.lit(0.0))
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.where(place < F.element_at(share, F.col("lang")))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in X.slices(batches):
            langs = X.column(batch, "lang").to_pylist()
            for lo, hi, v, _ in _vectors(X.column(batch, "text").to_pylist()):
                v = _unit(v.astype(np.float64))
                for lang in set(langs[lo:hi]):
                    rows = [k for k in range(hi - lo) if langs[lo + k] == lang]
                    total[lang] = total.get(lang, 0) + v[rows].sum(0)
        for lang, v in total.items():
            yield pa.record_batch({"lang": pa.array([lang] * DIMENSIONS), "at": pa.array(np.arange(DIMENSIONS, dtype=np.int32)), "value": pa.array(np.round(v * 2.0 ** 32).astype(np.int64))})

    sums = sample.select("text", "lang").mapInArrow(bundle, "lang string, at int, value long").groupBy("lang", "at").agg(F.sum("value").alias("value")).collect()
    langs = sorted({r["lang"] for r in sums}, key=lambda x: x.encode())
    table = np.zeros((len(langs), DIMENSIONS))
    for r in sums:
        table[langs.index(r["lang"]), r["at"]] = r["value"]
    return langs, _unit(table)


def identify(docs: DataFrame, langs: list[str], prototypes: np.ndarray, extra: Column | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text; other columns are ignored).

    ``extra`` gives held_out (false by default). score is the cosine with the predicted language's
    prototype, 0 where negative. Null and empty texts, and texts without a letter, are ``und`` with
    score 0, and so is everything if no language was learned. Ties go to the language that is first
    in code point order. Very long texts count whole. Repeated rows each get a row.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches):
            names, scores = [], []
            for _, _, v, has in _vectors(X.column(batch, "text").to_pylist()):
                if langs:
                    cos = _unit(v) @ prototypes.T
                    best = cos.argmax(1)
                    names += [langs[k] if h else UNKNOWN for k, h in zip(best.tolist(), has, strict=True)]
                    scores.append(np.where(has, np.clip(cos.max(1), 0, 1), 0).astype(np.float64))
                else:
                    names += [UNKNOWN] * len(has)
                    scores.append(np.zeros(len(has)))
            if batch.num_rows:
                yield pa.record_batch({"doc_id": X.column(batch, "doc_id"), "held_out": X.column(batch, "held_out"), "lang_pred": pa.array(names, pa.string()), "score": np.concatenate(scores)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.lit(False) if extra is None else extra).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
