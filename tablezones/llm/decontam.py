"""Benchmark decontamination by BM25 retrieval with block-max pruning.

The test items form an inverted index with BM25 impacts. Every training text is
cut into overlapping passages, and each passage is a query that retrieves all
items whose score reaches ``THRESHOLD`` of the score that the item gives
itself. Impacts are divided by that own score, so one threshold holds for all.
A passage is long enough for every item of the index; what it retrieves is then
judged in windows of the item's own size.

Items of similar length form blocks, and each term keeps its largest impact in
each block. As in block-max WAND, a block is skipped when the bounds of the
passage's terms stay under the threshold; the test is made for all passages of
a batch at once. In the blocks that are left, terms are added in descending
bound, and items are left as soon as the remaining bounds cannot lift them.
Pruning uses upper bounds only, so nothing above the threshold is missed.

A retrieved pair is then scored and verified in windows of two strides of the
item, a stride being its length rounded up to ``LEAST_STRIDE`` words times a power
of two: one window must reach the threshold and hold, in word order, ``OVERLAP`` of the item's question
five-word shingles, and of its answer's words. So a verdict depends on the item
and the text, and on other items by their document frequencies alone.
The answer is what follows an "answer:" mark, else the last sentence, else (one
sentence) the last quarter of the words; the question is the text before it. A
mark with no words on one side is passed over. An item of fewer than ``WORDS``
words that no mark splits must stand in the passage as it is, all words in
order; one of a single word, which any text may use, must be the whole text.

Windows overlap by half, so every item that stands in a text lies whole in one. A
passage is two strides of the longest item of the index and, as strides divide one
another, holds every window that begins in the first. The index is collected in shards of at most
``SHARD_ITEMS`` items, with document frequencies and mean length over all items;
a larger test set takes more passes.

Words are runs of ASCII letters and digits and of other characters, A-Z as a-z.
Null and empty texts or items match nothing; equal items are matched each for
itself, and items without an id are searched and reported under a null one. In
the list of matches rows of one doc_id count as one document and rows without one
cannot be named; ``drop_contaminated`` judges every row by itself, whatever its
id. An empty table on either side gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablezones.llm.batches import pieces
from tablezones.llm.staging import fresh_name, small_side, staged
from tablezones.llm.words import PUNCTUATED, shingles, word_hashes, word_spans

THRESHOLD, OVERLAP, WORDS = 0.5, 0.75, 5
K1, B = 1.2, 0.75
SHARD_ITEMS, BLOCKS, LEAST_STRIDE = 4_000, 64, 32
MATCH = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def words_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), PUNCTUATED)
    return word_hashes(data, starts, ends)


def _split(text: str) -> tuple[np.ndarray, np.ndarray, bool]:
    """Word hashes of an item's question and of its answer, and whether it is too short for that."""
    if mark := re.search(r"(?i)\banswer\s*:", text):
        question, answer = words_of(text[: mark.start()]), words_of(text[mark.end() :])
        if len(question) and len(answer):
            return question, answer, False
        return _split(f"{text[: mark.start()]} {text[mark.end() :]}")
    sentences = [m.end() for m in re.finditer(r"[.?!]+\s+(?=\S)", text)]
    question, answer = (words_of(text[: sentences[-1]]), words_of(text[sentences[-1] :])) if sentences else (words_of(text), np.zeros(0, np.uint64))
    if not len(question) or not len(answer):
        words = np.concatenate([question, answer])
        cut = len(words) - -(-len(words) // 4)
        question, answer = words[:cut], words[cut:]
    return question, answer, len(question) + len(answer) < WORDS


def question_and_answer(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of an item's question and of its answer."""
    return _split(text)[:2]


def _wanted(text: str, words: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """The shingles that a passage must hold in order, their size, and the words that it must hold."""
    question, answer, short = _split(text)
    size = len(words) if short else min(WORDS, len(question))
    return shingles(words if short else question, np.array([0, len(words if short else question)]), size)[0], size, np.unique(words if short else answer)


@dataclass
class Index:
    """Postings by term (``terms`` sorted): items and impacts in blocks of items."""

    ids: np.ndarray
    terms: np.ndarray
    first: np.ndarray  # of each term's postings, one more than terms
    items: np.ndarray
    impacts: np.ndarray
    block: np.ndarray  # of each item
    bound: np.ndarray  # terms x blocks: the largest impact
    questions: list[np.ndarray]
    sizes: list[int]  # of each question's shingles
    answers: list[np.ndarray]
    single: list[bool]  # items of one word
    stride: int  # of passages
    strides: list[int]  # of each item's windows
    own: list[tuple[np.ndarray, np.ndarray]]  # terms and impacts of each item
    named: list[bool]  # whether it has an id


def stride_of(words: int) -> int:
    stride = LEAST_STRIDE
    while stride < words:
        stride *= 2
    return stride


def build_index(items: list[tuple[int, str]], df: dict[int, int], total: int, mean: float) -> Index:
    parsed = sorted(((i, t, words_of(t)) for i, t in items), key=lambda x: (len(x[2]), x[0] is None, x[0] or 0, x[1]))
    parsed = [x for x in parsed if len(x[2])]
    rows = []
    for k, (_, _, w) in enumerate(parsed):
        term, tf = np.unique(w, return_counts=True)
        n = np.array([df[int(t)] for t in term.view(np.int64)], float)
        impact = np.log1p((total - n + 0.5) / (n + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
        rows.append((term, np.full(len(term), k), impact / impact.sum()))
    term = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.uint64)
    item = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, np.int64)
    impact = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0)
    order = np.lexsort((item, term))
    terms, first = np.unique(term[order], return_index=True)
    block = np.arange(len(parsed)) * BLOCKS // max(1, len(parsed))
    bound = np.zeros((len(terms), BLOCKS), np.float32)
    np.maximum.at(bound, (np.searchsorted(terms, term), block[item]), impact.astype(np.float32) * np.float32(1.000001))
    wanted = [_wanted(t, w) for _, t, w in parsed]
    return Index(
        np.array([i or 0 for i, _, _ in parsed], np.int64), terms, np.append(first, len(order)), item[order], impact[order], block, bound,
        [q for q, _, _ in wanted], [n for _, n, _ in wanted], [a for _, _, a in wanted], [len(w) == 1 for _, _, w in parsed],
        max([LEAST_STRIDE, *(stride_of(len(w)) for _, _, w in parsed)]), [stride_of(len(w)) for _, _, w in parsed],
        [(r[0], r[2]) for r in rows], [i is not None for i, _, _ in parsed],
    )


def _score_block(index: Index, terms: np.ndarray, block: int) -> list[tuple[int, float]]:
    """All items of a block that reach the threshold, terms taken in descending bound."""
    bounds = index.bound[terms, block]
    order = np.argsort(-bounds)
    order = order[bounds[order] > 0]
    left = np.cumsum(bounds[order][::-1])[::-1]
    scores: dict[int, float] = {}
    for at, k in enumerate(order):
        a, b = index.first[terms[k]], index.first[terms[k] + 1]
        mine = index.block[index.items[a:b]] == block
        open_to_new = left[at] >= THRESHOLD  # an item first met here could still get there
        for item, impact in zip(index.items[a:b][mine].tolist(), index.impacts[a:b][mine].tolist()):
            if item in scores:
                scores[item] += impact
            elif open_to_new:
                scores[item] = impact
        rest = left[at + 1] if at + 1 < len(left) else 0.0
        scores = {i: s for i, s in scores.items() if s + rest + 1e-9 >= THRESHOLD}
        if not scores and rest < THRESHOLD:
            return []
    return [(i, s) for i, s in scores.items() if s + 1e-9 >= THRESHOLD]


def _matches(index: Index):
    def match(batches):
        for batch in batches:
            for rows, text, at in pieces(batch, "text"):
                starts, ends, word_at = word_spans(text, at, PUNCTUATED)
                words = word_hashes(text, starts, ends)
                found: dict[tuple[int, int], tuple] = {}
                if len(words) and len(index.terms):
                    _search(index, words, word_at, rows.column("doc_id").to_pylist(), found)
                if found:
                    columns = [[k[0] for k in found], [k[1] for k in found], *([v[j] for v in found.values()] for j in range(3))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), *[pa.float64()] * 3))], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

    return match


def _search(index: Index, words: np.ndarray, word_at: np.ndarray, docs: list, found: dict) -> None:
    """Passages are pairs of neighbouring strides of one text; bounds are summed by stride."""
    place = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[place] == words)
    n = np.diff(word_at)
    strides = np.maximum(1, -(-n // index.stride))
    stride_at = np.concatenate([[0], np.cumsum(strides)])
    doc = np.searchsorted(word_at, known, "right") - 1
    stride = stride_at[doc] + (known - word_at[doc]) // index.stride
    pair = np.unique(stride * len(index.terms) + place[known])  # distinct terms of each stride
    of, term = pair // len(index.terms), pair % len(index.terms)
    if not len(of):
        return
    bound = np.zeros((int(stride_at[-1]), BLOCKS), np.float32)
    heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    for a in range(0, len(heads), 2_000):  # a slice of strides at a time: its rows of bounds are bounded memory
        cut = heads[a : a + 2_000]
        end = heads[a + 2_000] if a + 2_000 < len(heads) else len(of)
        bound[of[cut]] = np.add.reduceat(index.bound[term[cut[0] : end]], cut - cut[0], axis=0)
    passage = bound.copy()
    last = np.repeat(stride_at[1:], strides)  # of each stride's text
    inner = np.flatnonzero(np.arange(len(bound)) + 1 < last)
    passage[inner] += bound[inner + 1]
    first_of = np.searchsorted(of, np.arange(len(bound) + 1))
    for k, block in zip(*np.nonzero(passage >= THRESHOLD)):
        owner = int(np.searchsorted(stride_at, k, "right") - 1)
        end = min(k + 2, stride_at[owner + 1])
        for item, _ in _score_block(index, np.unique(term[first_of[k] : first_of[end]]), block):
            if docs[owner] is None or index.single[item] and n[owner] > 1:
                continue
            text = words[word_at[owner] : word_at[owner + 1]]
            best = _best_window(index, item, text, int(k - stride_at[owner]) * index.stride)
            key = (docs[owner], int(index.ids[item]) if index.named[item] else None)
            if best > found.get(key, (0, 0, 0)):
                found[key] = best


def _best_window(index: Index, item: int, text: np.ndarray, begin: int) -> tuple[float, float, float]:
    """Score and overlaps of the best of the item's windows that begin in the stride from ``begin`` on; zeros if none will do."""
    step, (terms, impacts) = index.strides[item], index.own[item]
    best = (0.0, 0.0, 0.0)
    for a in range(-(-begin // step) * step, min(begin + index.stride, len(text)), step):
        here = text[a : a + 2 * step]
        score = float(impacts[np.isin(terms, here)].sum())
        if score + 1e-9 < THRESHOLD:
            continue
        q = float(np.isin(index.questions[item], shingles(here, np.array([0, len(here)]), index.sizes[item])[0]).mean())
        w = float(np.isin(index.answers[item], here).mean())
        if q >= OVERLAP and w >= OVERLAP:
            best = max(best, (score, q, w))
    return best


def _terms_of(batches):
    for batch in batches:
        ids, terms, sizes = [], [], []
        for i, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
            w = words_of(text or "")
            u = np.unique(w).view(np.int64)
            ids += [i] * len(u)
            terms += u.tolist()
            sizes += [len(w), *[0] * (len(u) - 1)] if len(u) else []
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.int64()), pa.array(sizes, pa.int64())], ["item_id", "term", "words"])


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The verified pairs doc_id, item_id with their best passage's score and overlaps."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = staged(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL"), "items")
    total = items.count()
    shards = max(1, -(-total // SHARD_ITEMS))
    shard = F.pmod(F.xxhash64("item_id"), F.lit(shards))
    terms = staged(items.mapInArrow(_terms_of, "item_id long, term long, words long").withColumn("shard", shard), "item-terms")
    mean = float((terms.agg(F.sum("words").alias("w")).first()["w"] or 0) / max(1, total)) or 1.0
    df = terms.groupBy("term").agg(F.count("*").alias("df"), F.collect_set("shard").alias("shards"))
    found = None
    for k in range(shards):
        mine = items.where(shard == k).collect()  # about SHARD_ITEMS items
        counts = {r["term"]: r["df"] for r in df.where(F.array_contains("shards", F.lit(k).cast("long"))).select("term", "df").collect()}
        got = docs.mapInArrow(_matches(build_index([tuple(r) for r in mine], counts, total, mean)), MATCH)
        found = got if found is None else found.unionAll(got)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("x"))
    return best.select("doc_id", "item_id", "x.*")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without the rows that hold a test item, whatever their doc_id."""
    key = fresh_name(documents, "row_key")
    keyed = staged(documents.withColumn(key, F.monotonically_increasing_id()), "keyed")
    matches = contaminated(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark)
    flagged = staged(matches.select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return keyed.join(small_side(flagged), key, "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
