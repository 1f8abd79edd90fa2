"""Toxicity by averaged subword embeddings and a linear softmax.

A text, lower-cased, is cut at white space into words and those into windows of
``WINDOW``. The subwords of a word are its character n-grams of ``NGRAMS``, with
a space at both ends, hashed into ``BUCKETS`` rows of an embedding table. The
average of a window's subword vectors goes through a linear softmax of two
classes, and the worst window decides for the text, so that a few words count
alike in short and in very long texts. A misspelling shares most n-grams with
the word it stands for, and so its vectors.

Table and softmax are trained jointly in numpy by adaptive full-batch steps. The
loss is that of the text: it is clean if all its windows are. The table starts
along the softmax direction, by how much more often a bucket occurs in toxic
texts than by chance. With two classes only the difference of the softmax rows
matters, so it is kept as one vector; scores need one number a bucket.

The model is fitted on at most ``MAX_ROWS`` labelled rows and ``MAX_CHARS``
characters outside the held-out fold, taken whole in hash order; a text that
would go beyond the characters ends the sample. Of several labels of one doc_id
the greatest counts; null labels and null ids are not learned from. Without rows
of both classes the score is the share of toxic ones (0.5 without any).

Null, empty and blank texts have no window and get the score of the intercept.
Texts are worked on in blocks of words, however long they are. Repeated rows are
scored each for itself. An empty table gives an empty result. Only doc_id and
text of the documents are read, and doc_id and toxic of the labels.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablezones.llm.batches import pieces
from tablezones.llm.quality_gam import held_out
from tablezones.llm.words import mix

NGRAMS, BUCKETS, WIDTH, WINDOW = (3, 6), 1 << 18, 8, 8
ROUNDS, RATE = 25, 1.0
#: The intercept and the height of the table at the start.
OPENING, HEIGHT = -7.0, 100.0
MAX_ROWS, MAX_CHARS = 4_000, 16_000_000
TOXIC = 0.5
#: Words worked on at once, a multiple of the window.
BLOCK = 40_000
#: Subwords added up at once while fitting.
SLICE = 1 << 20
_RADIX = np.uint64(0x9E3779B97F4A7C15)


def subwords(words: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the words, and the number of the word that it is of."""
    points = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-32-le"), np.uint32)
    space = points == 32
    word = np.cumsum(~space & np.concatenate([[True], space[:-1]])) - 1
    hashes = points.astype(np.uint64) * _RADIX
    inside = np.ones(len(points), bool)  # no space between the first and the last character
    buckets, owners = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for k in range(1, NGRAMS[1]):
        n = len(points) - k
        if n <= 0:
            break
        hashes = (hashes[:n] + points[k:].astype(np.uint64) + np.uint64(1)) * _RADIX
        inside = inside[:n] & ~space[k - 1 : k - 1 + n] if k > 1 else inside[:n]
        if k + 1 >= NGRAMS[0]:
            at = np.flatnonzero(inside)
            buckets.append((mix(hashes[at] + np.uint64(k)) % np.uint64(BUCKETS)).astype(np.int32))
            owners.append(word[at + 1].astype(np.int32))
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass
class Toxicity:
    """``weights`` of each bucket (embedding times softmax direction) and the intercept."""

    intercept: float
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))

    def margins(self, texts: list[str]) -> np.ndarray:
        """Each text's worst window: the log-odds of toxic."""
        out = np.full(len(texts), -np.inf)
        for words, owner in _blocks(texts):
            bucket, word = subwords(words)
            n = -(-len(words) // WINDOW)
            total = np.bincount(word // WINDOW, self.weights[bucket], n)
            count = np.bincount(word // WINDOW, minlength=n)
            np.maximum.at(out, owner, total / np.maximum(1, count))
        return self.intercept + np.where(np.isfinite(out), out, 0.0)

    def scores(self, texts: list[str]) -> np.ndarray:
        z = self.margins(texts)
        return np.where(z >= 0, 1 / (1 + np.exp(-np.abs(z))), np.exp(-np.abs(z)) / (1 + np.exp(-np.abs(z))))


def _blocks(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Words in windows that belong to one text each, padded with empty words, and the texts of the windows."""
    words: list[str] = []
    owner: list[int] = []
    for k, text in enumerate(texts):
        own = text.lower().split()
        for a in range(0, len(own), BLOCK):
            some = own[a : a + BLOCK]
            some += ["\x00"] * (-len(some) % WINDOW)  # two spaces around one character: its n-gram is the same for all
            words += some
            owner += [k] * (len(some) // WINDOW)
            if len(words) >= BLOCK:
                yield words, np.array(owner)
                words, owner = [], []
    if words:
        yield words, np.array(owner)


def _sums(to: np.ndarray, values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The sums of ``values[at]`` by ``to``, a slice at a time."""
    out = np.zeros(n)
    for a in range(0, len(to), SLICE):
        out += np.bincount(to[a : a + SLICE], values[at[a : a + SLICE]], n)
    return out


def fit(texts: list[str], toxic: np.ndarray) -> Toxicity:
    """Embedding table and softmax, trained jointly."""
    y = np.asarray(toxic, float)
    if not len(y) or y.min() == y.max():
        p = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        return Toxicity(float(np.log(p / (1 - p))))
    numbers: dict[str, int] = {}
    tokens, windows_of = [], []
    for text in texts:
        own = [numbers.setdefault(w, len(numbers)) for w in text.lower().split()]
        own += [numbers.setdefault("\x00", len(numbers))] * (-len(own) % WINDOW)
        tokens.append(np.array(own, np.int32))
        windows_of.append(len(own) // WINDOW)
    token = np.concatenate(tokens)
    if not len(token):
        return Toxicity(float(np.log(y.mean() / (1 - y.mean()))))
    listed, parts = list(numbers), []
    for a in range(0, len(listed), BLOCK):
        some, owner = subwords(listed[a : a + BLOCK])
        parts.append((some, owner + np.int32(a)))
    bucket, word = (np.concatenate(x) for x in zip(*parts))
    del parts, listed
    size = np.bincount(word, minlength=len(numbers)).astype(float)
    text_of = np.repeat(np.arange(len(y)), windows_of)
    window = np.repeat(np.arange(len(text_of), dtype=np.int32), WINDOW)  # of each token
    per_window = lambda v: v[token].reshape(-1, WINDOW).sum(1)
    count = np.maximum(1, per_window(size))

    # how far the texts with a bucket's words are toxic beyond chance, and how purely
    pair = np.unique(np.repeat(text_of, WINDOW) * len(numbers) + token)
    in_toxic = np.bincount(pair % len(numbers), y[pair // len(numbers)], len(numbers))
    in_all = np.bincount(pair % len(numbers), minlength=len(numbers)).astype(float)
    hits, all_hits = _sums(bucket, in_toxic, word, BUCKETS), _sums(bucket, in_all, word, BUCKETS)
    del pair
    chance = all_hits * y.mean()
    start = HEIGHT * np.clip(((hits - chance) / np.sqrt(chance + 1) - 4) / 8, 0, 1) * np.clip(((hits + 0.25) / (all_hits + 1) - 0.5) * 2.5, 0, 1)
    rng = np.random.default_rng(0)
    softmax = rng.normal(0, 0.25, WIDTH)
    table = rng.normal(0, 1e-3, (BUCKETS, WIDTH)) + np.outer(start, softmax) / (softmax @ softmax)
    intercept, seen, seen_softmax, seen_intercept = OPENING, np.full(BUCKETS, 1e-8), np.full(WIDTH, 1e-12), 1e-12
    for _ in range(ROUNDS):
        z = per_window(_sums(word, table @ softmax, bucket, len(numbers))) / count + intercept
        clean = np.exp(-np.bincount(text_of, np.logaddexp(0, z), len(y)))  # the chance that all windows are
        slope = np.where(y > 0, -clean / np.maximum(1 - clean, 1e-9), 1.0) / len(y)
        g = slope[text_of] * np.exp(-np.logaddexp(0, -z))
        by_word = _sums(token, g / count, window, len(numbers))
        by_bucket = _sums(bucket, by_word, word, BUCKETS)
        down, down_softmax = np.outer(by_bucket, softmax), by_bucket @ table
        seen += (down**2).sum(1)
        seen_softmax += down_softmax**2
        seen_intercept += g.sum() ** 2
        table -= RATE * down / np.sqrt(seen)[:, None]
        softmax = softmax - 0.05 * down_softmax / np.sqrt(seen_softmax)
        intercept -= 0.2 * g.sum() / np.sqrt(seen_intercept)
    return Toxicity(float(intercept), table @ softmax)


def fit_toxicity(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> Toxicity:
    """Fit on a bounded sample of the labelled rows outside the held-out fold, in hash order."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id").where("text IS NOT NULL")
    order = (F.xxhash64("doc_id"), F.col("doc_id"), F.xxhash64("text"))
    rows = rows.orderBy(*order).limit(max_rows).withColumn("chars", F.char_length("text"))
    taken = rows.withColumn("upto", F.sum("chars").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    got = taken.where(F.col("upto") <= max_chars).select("toxic", "text").collect()  # at most max_rows and max_chars
    return fit([r["text"] for r in got], np.array([r["toxic"] for r in got]))


def score_toxicity(documents: DataFrame, model: Toxicity) -> DataFrame:
    """doc_id and score of every row, in one narrow pass."""

    def score(batches):
        for batch in batches:
            for rows, _, _ in pieces(batch, "text", 1 << 20):
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(model.scores(rows.column("text").to_pylist()))], ["doc_id", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``documents``."""
    scored = score_toxicity(documents, fit_toxicity(documents, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"))
