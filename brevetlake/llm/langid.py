"""Language identification by rank-order profiles of character n-grams.

Letters are lower-cased and coded in six bits: a-z, 36 codes that other letters share by a rule, and 0 for all that
is not a letter.  A document's 1- to 3-grams are ranked by frequency; the language whose profile has the smallest
out-of-place distance to that ranking is predicted.  Profiles come from a bounded sample of labelled documents.

Defined cases: a text that is null or has no letters is `und` with score 0; without any profile, too.  Equal distances
go to the first language by code point.  Labels are read in training only.  Repeated rows are judged alike, and learned from once;
rows without a doc_id are told apart by their text.  Very long texts are taken whole, in parts cut at spaces.  Extra columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import draws, scan
from .store import small_batches

#: Ranks of a profile, which is also the distance of an n-gram that a profile lacks.
RANKS = 400
#: Labelled documents of each language that profiles are learned from, about (a documented bound on training only).
TRAIN_DOCS = 1500
#: Documents of a chunk, so that their number fits in a key, and its bytes.
CHUNK_ROWS, CHUNK_BYTES = 4096, 1 << 18
UNKNOWN = "und"

_GRAM_BITS = 19
_BIGRAMS, _UNIGRAMS = 1 << 18, (1 << 18) + (1 << 12)
_letters: np.ndarray | None = None


def letter_codes() -> np.ndarray:
    """The code of every code point: 0 for no letter, 1 to 26 for a to z in either case, 27 to 62 for other letters."""
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, np.uint8)
        for point in range(0x110000):
            c = chr(point)
            if c.isalpha():
                low = ord(c.lower()[0])
                table[point] = low - 96 if 97 <= low <= 122 else 27 + (low * 7 + (low >> 6)) % 36
        _letters = table
    return _letters


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a chunk, and its offsets counted in them."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=starts[1:])
    return points, starts[offsets]


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, n-gram and count of the 1- to 3-grams of a chunk, ordered by document and n-gram."""
    points, offsets = code_points(data, offsets)
    n_docs = len(offsets) - 1
    # A boundary stands before each document and after the last.
    codes = np.zeros(len(points) + n_docs + 1, np.uint32)
    doc = np.repeat(np.arange(n_docs, dtype=np.uint32), np.diff(offsets))
    codes[np.arange(len(points)) + doc + 1] = letter_codes()[points]
    owner = np.zeros(len(codes), np.uint32)
    owner[offsets[:-1] + np.arange(n_docs)] = 1
    owner = np.cumsum(owner, dtype=np.uint32) - np.uint32(1)
    inner = np.flatnonzero(codes)
    before, at, after = codes[inner - 1], codes[inner], codes[inner + 1]
    base = owner[inner].astype(np.uint64) << np.uint64(_GRAM_BITS)
    opens = np.flatnonzero(before == 0)
    keys = np.concatenate([
        base | ((before << np.uint32(12)) | (at << np.uint32(6)) | after),
        base | (np.uint32(_BIGRAMS) + ((at << np.uint32(6)) | after)),
        base[opens] | (np.uint32(_BIGRAMS) + at[opens]),
        base | (np.uint32(_UNIGRAMS) + at),
    ])
    if n_docs <= 1 << (32 - _GRAM_BITS):
        keys = keys.astype(np.uint32)
    keys.sort()
    if not len(keys):
        return keys.astype(np.int64), keys.astype(np.int64), keys.astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first].astype(np.int64)
    return keys >> _GRAM_BITS, keys & ((1 << _GRAM_BITS) - 1), counts


def counts_of_chunk(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`gram_counts`; a very long document is cut at spaces, which n-grams never cross, and its parts are summed up."""
    if len(offsets) > 2 or len(data) <= 2 * CHUNK_BYTES:
        return gram_counts(data, offsets)
    sums, start = np.zeros(1 << _GRAM_BITS, np.int64), 0
    spaces = np.flatnonzero(data <= 0x20)
    while start < len(data):
        k = np.searchsorted(spaces, start + CHUNK_BYTES)
        end = int(spaces[k]) + 1 if k < len(spaces) else len(data)
        _, gram, n = gram_counts(data[start:end], np.array([0, end - start]))
        sums[gram] += n
        start = end
    found = np.flatnonzero(sums)
    return np.zeros(len(found), np.int64), found, sums[found]


def top_ranks(doc: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, n-gram and rank (from 0) of the `n` most frequent n-grams of each document; ties by n-gram."""
    order = np.lexsort((gram, -count, doc))
    doc, gram = doc[order], gram[order]
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else doc
    rank = np.arange(len(doc)) - np.repeat(starts, np.diff(np.append(starts, len(doc))))
    keep = rank < n
    return doc[keep], gram[keep], rank[keep]


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS, ranks: int = RANKS) -> dict[str, list[int]]:
    """The profile of each label of `docs` (text, lang): its most frequent n-grams in order.

    About `train_docs` different documents of each label are used, each once, chosen by a hash of doc_id and text; sums and ranks are Spark's.
    """
    labelled = docs.where("lang is not null")
    # One row for each label comes to the driver; text is filtered where it is read.
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").agg(draws.number()).collect()}
    if not sizes:
        return {}
    share = F.element_at(F.create_map(*[F.lit(x) for lang in sorted(sizes) for x in (lang, train_docs / sizes[lang])]), F.col("lang"))
    sample = labelled.where(draws.draw() < share).withColumn("of", draws.identity()).dropDuplicates(["lang", "of"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for a, b, data, offsets in chunks(batch.column(1)):
                doc, gram, n = counts_of_chunk(data, offsets)
                for lang in sorted(set(langs[a:b])):
                    of = langs[a:b][doc] == lang
                    sums = np.bincount(gram[of], n[of], 1 << _GRAM_BITS).astype(np.int64)
                    found = np.flatnonzero(sums)
                    yield pa.record_batch([pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int32)), pa.array(sums[found])], ["lang", "gram", "n"])

    sums = small_batches(sample).mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    # Bounded: `ranks` rows for each label come to the driver.
    best = sums.withColumn("rank", rank).where(F.col("rank") <= ranks).orderBy("lang", "rank").collect()
    return {lang: [r["gram"] for r in best if r["lang"] == lang] for lang in sorted(sizes)}


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for start in range(0, len(column), CHUNK_ROWS):
        for a, b, data, offsets in scan.chunks(column.slice(start, CHUNK_ROWS), CHUNK_BYTES):
            yield start + a, start + b, data, offsets


def classify(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, ranks: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest profile (-1 without letters) and score of each document of a chunk."""
    n_docs = len(offsets) - 1
    doc, gram, rank = top_ranks(*counts_of_chunk(data, offsets), ranks)
    n = np.bincount(doc, minlength=n_docs)
    if not len(table):
        return np.full(n_docs, -1), np.zeros(n_docs)
    distance = np.stack([np.bincount(doc, np.where(p[gram] < ranks, np.abs(p[gram] - rank), ranks), n_docs) for p in table.astype(np.int64)])
    distance = distance / np.maximum(n, 1)
    best = distance.argmin(0)
    least = distance.min(0)
    if len(table) > 1:
        second = np.partition(distance, 1, axis=0)[1]
        score = np.where(least + second > 0, second / np.maximum(least + second, 1e-9), 0.5)
    else:
        score = 1 - least / ranks
    return np.where(n > 0, best, -1), np.where(n > 0, np.clip(score, 0, 1), 0.0)


def predict(docs: DataFrame, profiles: dict[str, list[int]], ranks: int = RANKS, keep_text: bool = False) -> DataFrame:
    """`docs`, which has a text, with lang_pred and score; without the text, unless it is to be kept."""
    langs = sorted(profiles)
    rest = [c for c in docs.columns if keep_text or c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.full((len(langs), 1 << _GRAM_BITS), ranks, np.int16)
        for i, lang in enumerate(langs):
            table[i, profiles[lang]] = np.arange(len(profiles[lang]))
        names = np.array([*langs, UNKNOWN], object)
        for batch in batches:
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for a, b, data, offsets in chunks(batch.column("text")):
                best[a:b], score[a:b] = classify(data, offsets, table, ranks)
            yield pa.record_batch([*(batch.column(c) for c in rest), pa.array(names[best], pa.string()), pa.array(score)], [*rest, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in rest)
    return small_batches(docs).mapInArrow(run, f"{schema}, lang_pred string, score double")


def with_fold(docs: DataFrame, folds: int = 5) -> DataFrame:
    """`docs` with held_out: whether the checksum of doc_id, as text, falls in the first of `folds` folds."""
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False)))
