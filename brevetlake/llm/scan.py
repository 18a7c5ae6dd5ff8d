"""Vectorised scanning of UTF-8 text held in Arrow buffers.

Every helper works on a *chunk*: the concatenated bytes of some documents and their offsets.  Chunks are bounded
by ``CHUNK_BYTES`` (one longer document makes a chunk of its own), so memory does not depend on the batch size.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
#: Bytes of text in one part of a batch.
SHARD_BYTES = 4 << 20
#: Stands for a byte between words: one that UTF-8 never has.
SEPARATOR = 0xFF


pa.set_memory_pool(pa.system_memory_pool())
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def return_memory() -> None:
    """What has been freed goes back to the system, where the C library can do that: an idle worker is small."""
    if _trim is not None:
        _trim(0)

_U = np.uint64
_POWER = _U(0x9E3779B97F4A7C15)
_POWER_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def byte_values(seed: int) -> np.ndarray:
    """256 pseudo-random odd 64-bit values, one for each byte."""
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    key = "inverse" if inverse else "plain"
    if key not in _powers or len(_powers[key]) < n:
        base = np.full(max(n, CHUNK_BYTES + 1), _POWER_INVERSE if inverse else _POWER)
        base[0] = 1
        _powers[key] = np.cumprod(base, dtype=np.uint64)
    return _powers[key][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of value times power, from which `span_hash` gets the hash of any span."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=out[1:], dtype=np.uint64)
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(len(sums), inverse=True)[start] + (end - start).astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))


def as_text(column: pa.Array | pa.ChunkedArray) -> pa.LargeStringArray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive rows with at most `limit` bytes, one row at least."""
    text = as_text(column)
    n = len(text)
    if not n:
        return
    _, raw, data = text.buffers()
    offsets = np.frombuffer(raw, np.int64)[text.offset : text.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        end = min(end, n)
        yield row, end, whole[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def shards(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SHARD_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in parts with at most `limit` bytes of a text column, one row at least, so that what is gathered for a part stays small."""
    for batch in batches:
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())).to_numpy()
        row = 0
        while row < batch.num_rows:
            before = ends[row - 1] if row else 0
            end = max(row + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(row, end - row)
            row = end
    return_memory()


def word_table(is_word) -> np.ndarray:
    """256 entries: `SEPARATOR` for a byte between words, else the byte with A-Z lower-cased."""
    table = np.full(256, SEPARATOR, np.uint8)
    for b in range(256):
        low = b + 32 if 0x41 <= b <= 0x5A else b
        if is_word(low):
            table[b] = low
    return table


#: Words of anything but ASCII white space, U+0000 included.
SPACED = word_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words of ASCII letters and digits and of everything beyond ASCII.
ALNUM = word_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def word_spans(mapped: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of the document of each word; words never cross documents."""
    if not len(mapped):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = mapped != SEPARATOR
    first = np.zeros(len(mapped) + 1, bool)
    first[offsets[:-1]] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


#: Bytes of a word up to which its hash is a sum of powers.
LONG_WORD = 64
_BYTES = byte_values(11)


def word_hashes(mapped: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word, some bytes of a long text at a time.

    Sums of powers modulo 2 to the power of 64 are weak on long patterned strings (Thue-Morse words), so a word longer than
    `LONG_WORD` bytes has a digest of its bytes.
    """
    out = np.empty(len(start), np.uint64)
    first = 0
    while first < len(start):
        last = max(first + 1, int(np.searchsorted(end, start[first] + CHUNK_BYTES, side="right")))
        base = start[first]
        sums = prefix_sums(_BYTES[mapped[base : end[last - 1]]])
        out[first:last] = span_hash(sums, start[first:last] - base, end[first:last] - base)
        first = last
    for k in np.flatnonzero(end - start > LONG_WORD).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(mapped[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return out


_PLACES = byte_values(12)[:64]


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` consecutive words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += words[k : k + n] * _PLACES[k]
    return mix(total + _U(width))
