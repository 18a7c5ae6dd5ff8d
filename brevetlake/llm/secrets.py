"""Secret scans: patterns of known kinds, and character Markov models for random strings of any other.

Two first-order models, one of random strings and one of ordinary identifiers, are trained from labelled samples: strings
generated at random, and identifiers made of a list of words, to which come words that three different texts of a bounded sample
share, as no random string does.  What the patterns leave of a token, if it has 12 characters or more, is reported as
`markov` where its log-likelihood ratio for each character exceeds a threshold.  Shorter strings hold too little to tell.

Defined cases: a null text is the empty text; repeated rows are scanned alike; a match never crosses documents.  Offsets
count code points, the end is exclusive.  An empty table gives no row; very long texts are scanned whole; other columns are not read, whatever
their names.  Rows without a doc_id are told apart by their text in training.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import draws, scan
from .store import small_batches

KINDS = ("assign", "access", "hex", "markov")
#: On lower-cased bytes, as letters count in either case.
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
#: Characters that a token has for the models at least, as the shortest kind of the patterns, and the mean log-likelihood ratio that reports it.
MIN_TOKEN, THRESHOLD = MIN_ASSIGN, 1.0
#: Distinct words of the corpus that the model of ordinary identifiers is trained on at most, and documents they come from, about (documented bounds on training only).
TRAIN_WORDS, TRAIN_DOCS = 20_000, 500
#: Different texts that hold a word which counts as ordinary.
LEAST_TEXTS = 3
#: Pairs that the characters' own frequencies count for behind each character.
PRIOR = 5.0
#: The labelled sample of ordinary identifiers is made of these words.
IDENTIFIERS = """account action address amount answer archive array author balance batch before between billing block board border bottom branch bridge
browser buffer build button cache calendar camera cancel capture catalog category change channel character charge check children client
cloud cluster collection color column command comment common company complete component config connection contact container content context
control convert copy country create credit currency current customer daily database date default delete delivery description design detail
device digital direction discount display document domain download driver duration dynamic edition education element email employee engine
entry error estimate event example exchange execute export extension factory feature field figure filter final first folder follow format
forward frame function general global graph group handler header health height history holder image import index info input insert instance
integer interface internal invoice iterator journal keyboard keyword label language layout length level library license limit link list
local location logger machine manager market master member memory message method minimum mobile model module monitor month""".split()


def _mask(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


_DIGITS, _LOWERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_HEX = _mask(_DIGITS + "abcdef")
_TOKEN = _mask(_DIGITS + _LOWERS + _LOWERS.upper() + "+/_=-")


def runs(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of true entries that is long enough."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep = end - start >= least
    return start[keep], end[keep]


class Models:
    """Log-likelihood ratio of each pair of characters: random string against ordinary identifier."""

    def __init__(self, random: list[str], ordinary: list[str]):
        self.ratio = (self._fit(random) - self._fit(ordinary)).astype(np.float32)

    @staticmethod
    def _fit(samples: list[str]) -> np.ndarray:
        data = np.frombuffer("\n".join(samples).encode(), np.uint8).astype(np.int64)
        counts = np.bincount(data[:-1] * 256 + data[1:], minlength=1 << 16).reshape(256, 256).astype(float)
        counts[10] = 0
        counts[:, 10] = 0
        # A pair is as likely as its frequency says, and PRIOR pairs more that follow the characters' own frequencies: a small sample doesn't make all pairs alike.
        counts *= np.outer(_TOKEN, _TOKEN)
        single = (counts.sum(0) + 0.5) * _TOKEN
        single /= single.sum()
        likely = (counts + PRIOR * single) / (counts.sum(1, keepdims=True) + PRIOR)
        with np.errstate(divide="ignore"):
            return np.where(np.outer(_TOKEN, _TOKEN), np.log(likely), 0.0)

    def score(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mean ratio of the pairs of characters of each token (of two characters at least)."""
        n = end - start - 1
        at = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.add.reduceat(self.ratio[data[at], data[at + 1]], np.concatenate([[0], np.cumsum(n)[:-1]])) / n


def random_samples(n: int = 4000, seed: int = 5) -> list[str]:
    """Strings drawn evenly from the alphabets that keys are written in."""
    rng = np.random.default_rng(seed)
    alphabets = [_DIGITS + "abcdef", _DIGITS + _LOWERS, _DIGITS + _LOWERS + _LOWERS.upper(), _DIGITS + _LOWERS + _LOWERS.upper() + "+/_-", _DIGITS + _LOWERS.upper()]
    return ["".join(rng.choice(list(alphabets[k % len(alphabets)]), 20 + k % 40)) for k in range(n)]


def ordinary_samples(words: list[str], seed: int = 6) -> list[str]:
    """Words, and the identifiers they make: capitalised, in capitals, joined, numbered, and as parts of a path; numbers, dates and numbers in groups."""
    rng = np.random.default_rng(seed)
    words = sorted({*words, *IDENTIFIERS})
    out = list(words)
    for k, w in enumerate(words):
        a, b = (words[j] for j in rng.integers(0, len(words), 2))
        out += [w.capitalize(), w.upper(), (f"{w}_{a}", f"{w}-{a}-{b}", w + a.capitalize() + b.capitalize(), f"{w}{k % 1000}", f"/{w}/{a}/{b}", f"{a}={w}")[k % 6], "=" * 8, "-" * 8, "_" * 8]
    for k in range(len(words) // 4):
        date = f"{1900 + k % 150}-{1 + k % 12:02}-{1 + k % 31:02}"
        out += [str(1000 + 37 * k), (date, f"{date}T{k % 24:02}", f"978-{k % 10}-{10 + k % 90}-{100_003 * k % 1_000_000:06}-{k % 7}", date.replace("-", "/"))[k % 4]]
    return out


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, train_words: int = TRAIN_WORDS) -> Models:
    """Models from the labelled samples, and from words that at least `LEAST_TEXTS` different texts of a bounded sample of `docs` share."""
    # One number comes to the driver.
    n = docs.agg(draws.number()).first()[0]
    drawn = docs.where(draws.draw() * n < train_docs).select("text", draws.identity().alias("id")).dropDuplicates(["id"])
    sample = drawn.select(F.xxhash64("text").alias("of"), F.explode(F.array_distinct(F.split("text", "[^A-Za-z]+"))).alias("word"))
    shared = sample.where("length(word) between 2 and 30").groupBy("word").agg(F.count_distinct("of").alias("texts")).where(F.col("texts") >= LEAST_TEXTS)
    words = shared.select("word").orderBy(F.xxhash64("word"), "word").limit(train_words)
    return Models(random_samples(), ordinary_samples([r[0] for r in words.collect()]))


def separated(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chunk with a line end behind each document, which no pattern matches, and where documents start in it."""
    n_docs = len(offsets) - 1
    out = np.full(len(data) + n_docs, 10, np.uint8)
    keep = np.ones(len(out), bool)
    keep[offsets[1:] + np.arange(n_docs)] = False
    out[keep] = data
    return out, offsets + np.arange(n_docs + 1)


def code_points(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points between two places, for each pair of places."""
    places = np.unique(np.concatenate([[0], start, end]))
    firsts = np.append((data & 0xC0) != 0x80, False)
    before = np.concatenate([[0], np.cumsum(np.add.reduceat(firsts, places, dtype=np.int64))])
    return before[np.searchsorted(places, end)] - before[np.searchsorted(places, start)]


def spans(data: np.ndarray, models: Models, threshold: float) -> list[tuple[int, int, int]]:
    """Start, kind and end, in bytes, of all spans of a separated chunk, in order."""
    raw = data.tobytes()
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(raw.lower()) if m.end(1) - m.start(1) >= MIN_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= MIN_ACCESS]
    start, end = runs(_HEX[data], MIN_HEX)
    found += [(s, 2, e) for s, e in zip(start.tolist(), end.tolist(), strict=True)]
    # What the patterns have found is theirs; the rest of a token is a token.
    free = _TOKEN[data]
    for s, _, e in found:
        free[s:e] = False
    start, end = runs(free, MIN_TOKEN)
    if len(start):
        keep = models.score(data, start, end) > threshold
        found += [(s, 3, e) for s, e in zip(start[keep].tolist(), end[keep].tolist(), strict=True)]
    return sorted(found)


def find_secrets(docs: DataFrame, models: Models, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and spans (array of kind, start, end) of every row of `docs`, by start, then kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            out = [[] for _ in range(batch.num_rows)]
            for a, _, chunk, offsets in scan.chunks(batch.column("text")):
                data, starts = separated(chunk, offsets)
                found = spans(data, models, threshold)
                if not found:
                    continue
                at = np.array(found)
                doc = np.searchsorted(starts, at[:, 0], side="right") - 1
                first, last = code_points(data, starts[doc], at[:, 0]), code_points(data, starts[doc], at[:, 2])
                for d, k, s, e in zip(doc.tolist(), at[:, 1].tolist(), first.tolist(), last.tolist(), strict=True):
                    out[a + d].append({"kind": KINDS[k], "start": s, "end": e})
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, spans array<struct<kind: string, start: int, end: int>>")
