"""N-gram Jaccard join with token-combination prefixes.

A document's set is its distinct five-word shingles, as 64-bit tokens. Tokens
have one global order: rare ones by hash, then the frequent ones by hash. Two
sets with a Jaccard similarity of ``PERCENT`` or more share a token among the
first ``n - ceil(t n) + 1`` tokens of each; prefixes that are longer by a share
``EXTRA`` of the set share many.

* *Single tokens.* The rare tokens of the extended prefix are indexed one by
  one. Similar sets share at least ``c`` of them (a function of the sizes), so
  in order of their exact run lengths each document may leave out its ``c - 1``
  most frequent ones, and at the rarest token that a pair shares both must have
  ``c`` left. Shared passages and lines of otherwise different documents are
  left out that way, however many documents share them.
* *Token combinations.* A prefix that reaches the frequent tokens is extended
  to half the set and also indexed under all pairs of neighbouring tokens:
  similar sets differ in so few tokens that two shared ones must be neighbours
  in both extended prefixes. One popular token then makes no candidate.

Two documents that meet at one token mostly meet at many. Every row of a run
names the next rarer token that its document kept; where that is the same token
on both sides, the pair has met there, on no weaker terms, and is not made again.
A run whose rows all name one token makes no pair of its own and is left out.

Nothing is dropped. Candidates are tried in rounds. The first ones compare each
document with a few centres of its runs, which joins most groups of copies; the
last takes all remaining pairs of a run whose documents are not in one
component yet. A pair is left if the bitmaps of its sets (each token flips one
of ``FINE`` bits) differ in more bits than similar sets can differ in tokens;
the same bitmaps folded to ``BITS`` bits are compared first. All others are
verified on whole texts. The components are exact: a pair that is never compared
is too far apart or already connected.

Frequent tokens are found by counts over all documents. Each task counts all
its tokens in ``SKETCH`` tables of ``CELLS`` cells (a token has one cell in each)
and gives the cells that hold a quarter of ``SHARE`` of its documents, two at
least; these sums miss at most that quarter. A token is frequent if all its cells
sum to three quarters of ``SHARE`` of all documents. So tokens in that share of
the documents are frequent wherever they lie, and what is sent round is a bit a
cell, whatever the corpus. The split only moves work.

Null or empty texts have an empty set and link with nothing. Rows of one doc_id
are one document; a row without doc_id links with nothing. Long texts are one
row's work. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablezones.llm.batches import pieces
from tablezones.llm.components import components
from tablezones.llm.staging import fresh_name, small_side, staged
from tablezones.llm.words import mix, shingles, word_hashes, word_spans

WORDS, PERCENT = 5, 75
SHARE, LEAST = 1 / 256, 16
#: Count tables and their cells.
SKETCH, CELLS = 2, 1 << 20
#: Text bytes whose sets are built at once.
PIECE = 256 << 10
#: The extended prefix is longer than the plain one by n // EXTRA tokens.
EXTRA = 10
#: Rows of one token held to count them; longer runs all rank as equally frequent.
RUN_ROWS = 1 << 20
#: Rounds of centres before the exhaustive one, centres of a run, and those that a document tries in a round.
ROUNDS, RUN_CENTRES, CENTRES = 2, 5, 12
#: Text bytes of the pairs that are verified at once; one pair of longer texts is a slice of its own.
VERIFIED_BYTES = 1 << 20
#: Bits of a set's bitmap, and of what the rows of the runs carry of it: long sets need many to be told apart.
FINE, BITS = 2048, 512
PROFILE = "doc_id long, n int, sig binary, bits array<long>, cell int, times long"
POSTING = "token long, doc long, n int, combined boolean"
RUN = POSTING + ", df int"


def text_sets(rows: pa.RecordBatch, text: np.ndarray, at: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    starts, ends, word_at = word_spans(text, at)
    return shingles(word_hashes(text, starts, ends), word_at, words)


def cells_of(tokens: np.ndarray, table: int) -> np.ndarray:
    return (mix(tokens ^ np.uint64(0x51ED + table)) % np.uint64(CELLS)).astype(np.int64)


def _profile(words: int):
    """Each row's set size and signature; at the task's end, the cells that many of its documents share."""

    def profile(batches):
        counts, n_docs = np.zeros((SKETCH, CELLS), np.uint32), 0
        for batch in batches:
            for rows, text, at in pieces(batch, "text", PIECE):
                sets = text_sets(rows, text, at, words)
                tokens = np.concatenate(sets)
                for table in range(SKETCH):
                    cells, times = np.unique(cells_of(tokens, table), return_counts=True)
                    counts[table, cells] += times.astype(np.uint32)
                n_docs += len(sets)
                sigs = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
                bits = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate([bitmap(s) for s in sets])), FINE // 64).cast(pa.list_(pa.int64()))
                k = len(sets)
                yield _profile_rows(rows.column("doc_id"), pa.array(list(map(len, sets)), pa.int32()), pa.array(sigs, pa.binary()), bits, pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()))
        flat = counts.ravel()
        many = np.flatnonzero(flat >= max(2, SHARE * n_docs / 4))
        for a in range(0, len(many), 100_000):
            some = many[a : a + 100_000]
            k = len(some)
            bits = pa.nulls(k, pa.list_(pa.int64()))
            yield _profile_rows(pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), bits, pa.array(some, pa.int32()), pa.array(flat[some], pa.int64()))

    return profile


def _profile_rows(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), ["doc_id", "n", "sig", "bits", "cell", "times"])


def frequent_cells(cells: np.ndarray):
    """Whether tokens are frequent, from the frequent cells of all tables: a function over arrays."""
    bits = np.zeros(SKETCH * CELLS, bool)
    bits[cells] = True
    packed = np.packbits(bits)  # what tasks get

    def frequent(tokens: np.ndarray) -> np.ndarray:
        out = np.ones(len(tokens), bool)
        for table in range(SKETCH):
            cell = cells_of(tokens, table) + table * CELLS
            out &= (packed[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
        return out

    return frequent


def bitmap(s: np.ndarray) -> np.ndarray:
    """The parity of a set's tokens in each of ``FINE`` places, as 64-bit integers."""
    odd = np.bincount((mix(s) >> np.uint64(32)).astype(np.int64) % FINE, minlength=FINE) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def prefix_keys(s: np.ndarray, frequent, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The single and the combined index keys of a sorted set; ``frequent`` tells the frequent tokens, or lists them."""
    n = len(s)
    p = n - -(-n * percent // 100) + 1 + n // EXTRA
    common = frequent(s) if callable(frequent) else np.isin(s, frequent)
    rare = s[~common]
    if len(rare) >= p:
        return rare[:p], s[:0]
    order = np.concatenate([rare, s[common]])
    # Of the first 2 (1 - t) n + 2 tokens at most (1 - t) n are not shared, on either side, so two
    # shared ones are neighbours; a set of two tokens or less has no room for a pair.
    half = order[: min(n, 2 * (n - n * percent // 100) + 4)]
    pairs = mix(half[:-1] * np.uint64(0x9E3779B97F4A7C15) + half[1:])
    alone = mix(s[common] + np.uint64(1)) if n <= 8 else s[:0]
    return rare, np.concatenate([pairs, alone])


def _postings(frequent, words: int, percent: int):
    def index(batches):
        seen = set()  # a task indexes equal sets once; their signatures link them
        for batch in batches:
            for rows, text, at in pieces(batch, "text", PIECE):
                keys, docs, sizes, combined = [], [], [], []
                for doc, s in zip(rows.column("doc_id").to_pylist(), text_sets(rows, text, at, words)):
                    if doc is None or not len(s) or (sig := hashlib.md5(s.tobytes()).digest()) in seen:
                        continue
                    seen.add(sig)
                    for k, kind in zip(prefix_keys(s, frequent, percent), (False, True)):
                        keys.append(k)
                        docs.append(doc)
                        sizes.append(len(s))
                        combined.append(kind)
                if keys:
                    n = [len(k) for k in keys]
                    columns = [np.concatenate(keys).view(np.int64), np.repeat(docs, n).astype(np.int64), np.repeat(sizes, n).astype(np.int32), np.repeat(combined, n)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "doc", "n", "combined"])

    return index


def _runs():
    """Rows of tokens with two or more rows, from sorted postings, with the run's length.

    At most one unfinished run of ``RUN_ROWS`` rows is held; a longer one is
    passed on with that length."""
    names = ["token", "doc", "n", "combined"]
    most = RUN_ROWS

    def table(columns, df):
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.broadcast_to(df, len(columns[0])).astype(np.int32))], [*names, "df"])

    def runs(batches):
        held, streamed = None, None  # the last token's rows, or the token if its run is longer than that
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
                held = None
            t = columns[0]
            if not len(t):
                continue
            heads = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            ends = np.append(heads[1:], len(t))
            df = np.minimum(ends - heads, most)
            if streamed is not None and t[0] == streamed:
                df[0] = most
            give = df > 1
            streamed = t[-1] if df[-1] == most else None
            if streamed is None:
                give[-1] = False
                held = [c[heads[-1] :] for c in columns]
            rows = np.repeat(give, ends - heads)
            if rows.any():
                yield table([c[rows] for c in columns], np.repeat(df, ends - heads)[rows])
        if held is not None and len(held[0]) > 1:
            yield table(held, len(held[0]))

    return runs


def beyond(n, percent: int = PERCENT):
    """Tokens of a set of ``n`` that its extended prefix leaves out (a column)."""
    return F.ceil(n * percent / 100) - 1 - F.floor(n / EXTRA)


def shared_least(n, m, percent: int = PERCENT):
    """How many tokens the extended prefixes of similar sets of ``n`` and ``m`` share at least (a column)."""
    overlap = F.ceil((n + m) * percent / (100 + percent) - F.lit(1e-6))
    return F.greatest(F.lit(1), overlap - F.greatest(beyond(n, percent), beyond(m, percent)))


def kept_postings(runs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The runs' rows without each document's most frequent single tokens, as many as no similar pair
    needs; ``left`` counts a document's tokens from this one on, in order of frequency, and ``rarer``
    is the one after it (null after the last, and where texts of different sizes share a doc_id)."""
    n = F.col("n")
    # The bound falls towards both ends of the sizes that can be similar; 2 is for rounding.
    needs = F.least(shared_least(n, F.ceil(n * percent / 100), percent), shared_least(n, F.floor(n * 100 / percent), percent)) - 2
    by_doc = Window.partitionBy("doc", "combined").orderBy(F.desc("df"), F.desc("token"))
    rarer = F.when(F.lead("n").over(by_doc) == n, F.lead("token").over(by_doc))
    ranked = runs.withColumn("left", F.row_number().over(by_doc)).withColumn("rarer", rarer)
    return ranked.where(F.col("combined") | (F.col("left") >= needs)).drop("df")


def _verified(words: int, percent: int):
    def sets_of(rows, side):
        """Each row's set; a document that is in many rows is read once."""
        _, first, where = np.unique(rows.column(side).to_numpy(), return_index=True, return_inverse=True)
        sets = [x for some, text, at in pieces(rows.take(pa.array(first)), f"text_{side}", PIECE) for x in text_sets(some, text, at, words)]
        return (sets[i] for i in where)

    def verify(batches):
        for batch in batches:
            sizes = sum(pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("text_a", "text_b"))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            i = 0
            while i < len(batch):
                to = max(i + 1, int(np.searchsorted(ends, ends[i] + VERIFIED_BYTES, "right")) - 1)
                rows, ok = batch.slice(i, to - i), []
                for x, y in zip(sets_of(rows, "a"), sets_of(rows, "b")):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                keep = pa.array(ok, pa.bool_())
                yield pa.RecordBatch.from_arrays([rows.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])
                i = to

    return verify


def verify_pairs(documents: DataFrame, pairs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough."""
    pairs = staged(pairs.select("a", "b"), "candidates")
    ids = staged(pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select(F.col("b").alias("doc_id"))).distinct(), "candidate-ids")
    texts = staged(documents.join(small_side(ids), "doc_id", "left_semi"), "candidate-texts")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).join(small_side(pairs), "a")
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return staged(left.join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verified(words, percent), "a long, b long"), "similar")


def similar_components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profile = staged(docs.mapInArrow(_profile(words), PROFILE), "profile")
    rows = profile.where("times IS NULL")
    total = rows.count()
    heavy = profile.where("times IS NOT NULL").groupBy("cell").agg(F.sum("times").alias("df")).where(F.col("df") >= max(LEAST, SHARE * total * 3 / 4))
    # at most the mean set size / SHARE cells a table, and SKETCH * CELLS in all
    frequent = frequent_cells(heavy.select("cell").toPandas()["cell"].to_numpy(np.int64))

    postings = docs.mapInArrow(_postings(frequent, words, percent), POSTING)
    dealt = postings.repartition("token").sortWithinPartitions("token")
    runs = staged(kept_postings(dealt.mapInArrow(_runs(), RUN), percent), "runs")

    by_sig = rows.where("sig IS NOT NULL AND doc_id IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("first"), F.count("*").alias("k"))
    many = by_sig.where("k > 1").drop("k")
    equal = rows.join(many, "sig").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))

    links = staged(equal, "links")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    joined = staged(stars.distinct(), "components")  # of equal sets: each points at the first
    known = rows.where("doc_id IS NOT NULL AND n > 0").select(F.col("doc_id").alias("doc"), "n", F.col("bits").alias("fine")).distinct()

    def allowed(n, m, apart):
        """Whether sizes and differing bits allow the similarity."""
        return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (apart * (100 + percent) <= (n + m) * (100 - percent))

    def near(n, m, x, y):
        return allowed(n, m, sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(BITS // 64)), F.lit(0)))

    def near_finely(n, m, x, y):
        each = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q)))
        return allowed(n, m, F.aggregate(each, F.lit(0), lambda total, k: total + k))

    open_runs = staged(_open_runs(runs, joined).join(known.select("doc", "n", folded("fine").alias("bits")), ["doc", "n"]), "open-runs")
    known = staged(known.join(open_runs.select("doc", "n").distinct(), ["doc", "n"], "left_semi"), "bitmaps")
    sides = [known.select(F.col("doc").alias(c), F.col("n").alias(f"n_{c}"), F.col("fine").alias(f"fine_{c}")) for c in "ab"]
    for turn in range(ROUNDS + 1):
        if open_runs.isEmpty():
            break
        if turn < ROUNDS:
            # centres of each run: its smallest set at first, others by seeded hashes
            def centre(k, turn=turn):
                order = [F.col("n")] if turn == k == 0 else []
                seeded = F.xxhash64("doc", F.lit(turn * RUN_CENTRES + k)).alias("h")
                return F.min(F.struct(*order, seeded, F.col("doc").alias("to"), F.col("n").alias("m"), F.col("at").alias("there"), "bits")).alias(f"c{k}")

            def try_centre(k):
                c = F.col(f"c{k}")
                return F.when((F.col("at") != c["there"]) & near(F.col("n"), c["m"], F.col("bits"), c["bits"]), c["to"])

            with_centres = open_runs.join(open_runs.groupBy("token").agg(*map(centre, range(RUN_CENTRES))), "token")
            tried = with_centres.select("doc", F.explode(F.array_distinct(F.array_compact(F.array(*map(try_centre, range(RUN_CENTRES)))))).alias("to"))
            shared = tried.groupBy("doc", "to").agg(F.count("*").alias("shared"))
            rank = F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("shared"), "to"))
            pairs = shared.withColumn("rank", rank).where(F.col("rank") <= CENTRES).select(F.least("doc", "to").alias("a"), F.greatest("doc", "to").alias("b")).distinct()
            pairs = pairs.join(sides[0], "a").join(sides[1], "b").where(near_finely(F.col("n_a"), F.col("n_b"), F.col("fine_a"), F.col("fine_b"))).select("a", "b")
        else:
            last = open_runs.join(known, ["doc", "n"])
            x, y = (last.select("token", "combined", *[F.col(c).alias(f"{c}_{side}") for c in ("doc", "n", "left", "rarer", "at", "bits", "fine")]) for side in "ab")
            enough = F.col("combined") | (F.least("left_a", "left_b") >= shared_least(F.col("n_a"), F.col("n_b"), percent))
            apart = (F.col("doc_a") < F.col("doc_b")) & (F.col("at_a") != F.col("at_b")) & F.coalesce(F.col("rarer_a") != F.col("rarer_b"), F.lit(True))
            alike = near(F.col("n_a"), F.col("n_b"), F.col("bits_a"), F.col("bits_b")) & enough & near_finely(F.col("n_a"), F.col("n_b"), F.col("fine_a"), F.col("fine_b"))
            pairs = x.join(y, ["token", "combined"]).where(apart & alike).select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
        found = verify_pairs(docs, pairs.distinct(), words, percent)
        if not found.isEmpty():
            links = links.unionAll(found)
            joined = staged(components(links), "components")
            if turn < ROUNDS:
                open_runs = staged(_open_runs(open_runs.drop("at"), joined), "open-runs")
    return rows.join(joined, rows["doc_id"] == joined["node"], "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def folded(bits: str):
    """A column of bitmaps in ``BITS`` places, from one of ``FINE`` places."""
    k = BITS // 64
    return F.array(*[reduce(lambda x, y: x.bitwiseXOR(y), [F.col(bits)[j] for j in range(i, FINE // 64, k)]) for i in range(k)])


def _open_runs(runs: DataFrame, joined: DataFrame) -> DataFrame:
    """The runs that have documents of several components, with each document's component ``at``.

    Where all rows have the same rarer token, every pair of the run is one of that token's."""
    placed = runs.join(small_side(joined), runs["doc"] == joined["node"], "left").select(*runs.columns, F.coalesce("component", "doc").alias("at"))
    placed = staged(placed, "placed")
    ends = [F.min("at").alias("low"), F.max("at").alias("high"), F.min("rarer").alias("first"), F.max("rarer").alias("last"), (F.count("*") - F.count("rarer")).alias("without")]
    spread = placed.groupBy("token").agg(*ends).where("low < high AND (without > 0 OR first < last)").select("token")
    return placed.join(spread, "token", "left_semi")


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each group of near copies: of the smallest doc_id (null last), then text and row hash.

    Rows are judged each for itself: different texts of one doc_id stay, and copies without a doc_id go."""
    key = fresh_name(documents, "row_key")
    rest = [F.col(f"`{c}`") for c, kind in documents.dtypes if "map<" not in kind and "variant" not in kind]
    keyed = staged(documents.withColumn(key, F.monotonically_increasing_id()), "keyed")
    found = staged(similar_components(keyed.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias(key), "component_id"), "similar-components")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text"), F.xxhash64(*rest).alias("row"), F.col(key).alias("key"))
    # the component is its smallest key, so groups of several rows are those with another key
    others = found.where(F.col(key) != F.col("component_id"))
    members = staged(others.select(key, "component_id").unionAll(others.select(F.col("component_id").alias(key), "component_id").distinct()), "members")
    ranked = keyed.select(rank.alias("rank"), key).join(small_side(members), key)
    first = staged(ranked.groupBy("component_id").agg(F.min("rank").alias("rank")).select(F.col("rank.key").alias(key)), "kept")
    gone = staged(members.join(first, key, "left_anti").select(key), "gone")
    return keyed.join(small_side(gone), key, "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
