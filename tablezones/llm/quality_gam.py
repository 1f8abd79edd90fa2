"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn over single features, then over the feature
pairs that explain most of what is left; each tree is added into its feature's
(or pair's) lookup table, so the model is a set of small tables and a score is
a sum of table entries, gathered for whole batches at once.

Features are counts over the whole text, never its labels, language, source or
id. The model is fitted on at most ``max_rows`` labelled rows, taken in hash
order; scoring covers every row. Null texts count as empty and get the score of
an empty text. Rows with a null label are not learned from; with labels of one
kind or none the score is the same for all (their mean, or 0.5). Repeated rows
are scored each for itself. Columns that are not named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tablezones.llm.batches import pieces
from tablezones.llm.staging import fresh_name
from tablezones.llm.words import word_hashes, word_spans

FEATURES = (
    "bytes upper exclaim symbol bar stop newline digit wide word_bytes repeated distinct short words_per_line tail_repeat long"
).split()
#: Byte classes that are counted: capitals, shouting, symbols, bars, stops, newlines, digits, non-ASCII.
_CLASS = np.zeros(256, np.uint8)
for _k, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!", b"#$%&*@^~=+<>{}[]\\_", b"|", b".,;:?", b"\n", b"0123456789", bytes(range(128, 256))), 1):
    _CLASS[list(_bytes)] = _k

MAX_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, RATE, LEAVES, RIDGE = 120, 0.15, 4, 1.0
ACCEPT = 0.3


def _per_row(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each row's range."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return (total[at[1:]] - total[at[:-1]]).astype(np.float64)


def text_features(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each text; all are finite, also for empty texts."""
    size = np.diff(at).astype(np.float64)
    per_byte = 1 / np.maximum(size, 1)
    kind = _CLASS[text]
    rows = np.flatnonzero(kind)
    owner = np.searchsorted(at, rows, "right") - 1
    counts = np.bincount(owner * 9 + kind[rows], minlength=9 * len(size)).reshape(len(size), 9).astype(np.float64)
    starts, ends, word_at = word_spans(text, at)
    words, lengths = word_hashes(text, starts, ends), ends - starts
    n_words = np.diff(word_at).astype(np.float64)
    per_word = 1 / np.maximum(n_words, 1)
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    inner = word_at[:-1]
    again[inner[inner < len(words)]] = False
    last = np.zeros(len(words), bool)  # the same last byte as the word before, no letter
    if len(words):
        end_kind = kind[ends - 1]
        last = (end_kind > 0) & (end_kind < 5)
    distinct = np.array([len(np.unique(words[a:b])) for a, b in zip(word_at[:-1], word_at[1:])], np.float64)
    return np.column_stack(
        [
            np.log1p(size),
            *(counts[:, k] * per_byte for k in (1, 2, 3, 4, 5, 6, 7, 8)),
            _per_row(lengths, word_at) * per_word,
            _per_row(again, word_at) * per_word,
            # distinct words against what a text of this length usually has
            distinct / np.maximum(n_words, 1) ** 0.85,
            _per_row(lengths <= 3, word_at) * per_word,
            n_words / (counts[:, 6] + 1),
            _per_row(last, word_at) * per_word,
            _per_row(lengths >= 14, word_at) * per_word,
        ]
    )


@dataclass
class Gam:
    """Lookup tables by feature and by feature pair; ``cuts`` are the bin edges."""

    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], x[:, j], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_cuts[i], x[:, i], "right"), np.searchsorted(self.pair_cuts[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """A best-first tree over ordered bins: the value of each bin's leaf."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])

    def best(a, b):
        if b - a < 2:
            return 0.0, a
        k = np.arange(a + 1, b)
        gain = _gain(cg[k] - cg[a], ch[k] - ch[a]) + _gain(cg[b] - cg[k], ch[b] - ch[k]) - _gain(cg[b] - cg[a], ch[b] - ch[a])
        i = int(np.argmax(gain))
        return float(gain[i]), int(k[i])

    spans = [(0, len(g))]
    while len(spans) < leaves:
        (gain, cut), at = max((best(*s), i) for i, s in enumerate(spans))
        if gain <= 1e-9:
            break
        a, b = spans.pop(at)
        spans += [(a, cut), (cut, b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of depth two over a pair's grid: a cut of the first feature, then one of the second on each side."""
    cut = _tree(g.sum(1), h.sum(1), 2)
    out = np.zeros_like(g)
    for value in np.unique(cut):
        rows = cut == value
        out[rows] = _tree(g[rows].sum(0), h[rows].sum(0), 2)
    return out


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Cyclic boosting of the single features, then of the pairs that gain most."""
    if not len(y) or y.min() == y.max():
        p = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        return Gam(float(np.log(p / (1 - p))))
    p = y.mean()
    total = np.full(len(y), np.log(p / (1 - p)))
    model = Gam(float(total[0]), [_edges(x[:, j], BINS) for j in range(x.shape[1])])
    model.pair_cuts = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]

    def slopes():
        q = 1 / (1 + np.exp(-total))
        return y - q, q * (1 - q)

    for _ in range(ROUNDS):
        for b, table in zip(bins, model.tables):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b, g, len(table)), np.bincount(b, h, len(table)), LEAVES)
            table += step
            total += step[b]
    coarse = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.pair_cuts)]
    size = [len(c) + 1 for c in model.pair_cuts]
    grid = lambda v, i, j: np.bincount(coarse[i] * size[j] + coarse[j], v, size[i] * size[j]).reshape(size[i], size[j])
    g, h = slopes()
    gains = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            gg, hh = grid(g, i, j), grid(h, i, j)
            gains.append((float((_pair_tree(gg, hh) * gg).sum()), i, j))
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((size[i], size[j])) for i, j in model.pairs]
    for _ in range(ROUNDS // 2):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            step = RATE * _pair_tree(grid(g, i, j), grid(h, i, j))
            table += step
            total += step[coarse[i], coarse[j]]
    return model


def held_out(doc_id: str = "doc_id"):
    """True for the rows whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _features_of(batches):
    for batch in batches:
        for rows, text, at in pieces(batch, "text"):
            yield pa.RecordBatch.from_arrays([rows.column("quality"), pa.array(list(text_features(text, at)), pa.list_(pa.float64()))], ["quality", "x"])


def fit_quality(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Gam:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold, in hash order."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sample = known.select("doc_id", F.col("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows)
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("quality", "text")
    got = rows.mapInArrow(_features_of, "quality int, x array<double>").limit(max_rows).collect()
    got.sort(key=lambda r: (r["quality"], r["x"]))
    return fit(np.array([r["x"] for r in got]).reshape(len(got), len(FEATURES)), np.array([float(r["quality"]) for r in got]))


def score_quality(documents: DataFrame, model: Gam, column: str = "score") -> DataFrame:
    """Every row of ``documents`` with its score (higher: better) as a new ``column``, in one narrow pass."""

    if fresh_name(documents, column) != column:
        raise ValueError(f"there is a column {column}")
    schema = StructType([*documents.schema.fields, StructField(column, DoubleType())])

    def score(batches):
        for batch in batches:
            done = 0
            for rows, text, at in pieces(batch, "text"):
                own = batch.slice(done, len(rows))  # with null texts as they are
                done += len(rows)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(model.scores(text_features(text, at)))], [*own.schema.names, column])

    return documents.mapInArrow(score, schema)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``documents``."""
    model = fit_quality(documents, labels)
    scored = score_quality(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` without the rows that the classifier rejects."""
    column = fresh_name(documents, "quality_score")
    scored = score_quality(documents, fit_quality(documents, labels), column)
    return scored.where(F.col(column) >= ACCEPT).select(*documents.columns)
