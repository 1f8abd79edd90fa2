"""The operators' cores against brute force, without Spark."""

import io
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablezones.llm import decontam, jaccard_join, packing, pii_crf, quality_gam, warc
from tablezones.llm.batches import pieces
from tablezones.llm.text_ids import TextEncoder, tokenizer_path
from tablezones.llm.words import shingles, word_hashes, word_spans

TEXT = st.text(alphabet=list("abAB .,é\n\t 12' >|<"), max_size=40)


@pytest.fixture(scope="module")
def coder():
    return TextEncoder(tokenizer_path())


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_cached_encoding_equals_the_library(coder, texts):
    texts = [*texts, "", " ", "\n", "a\n", " lead", "trail ", "it's <|endoftext|> 12,5", "x  y", "a \nb"]
    ids, at = coder.encode(pa.array(texts))
    assert len(at) == len(texts) + 1
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == coder.library.encode(text, add_special_tokens=False).ids


def test_strings_of_added_tokens_are_encoded_as_the_library_does(coder):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "no mark", "x<|endoftext|><|endoftext|>\ny", "<|endoftext|", "", "it's <|endoftext|>\n\n12"]
    ids, at = coder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids[at[0] : at[1]].tolist() == [64, 220, 50256, 275]


def test_the_word_table_is_bounded(coder, monkeypatch):
    from tablezones.llm import text_ids

    monkeypatch.setattr(text_ids, "CACHED_WORDS", 50)
    for k in range(5):
        texts = [" ".join(f"w{k}x{i}" for i in range(40)), "the same words"]
        ids, at = coder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [coder.library.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 30))
def test_pieces_keep_whole_texts(texts, limit):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "i": list(range(len(texts)))})
    got = [(i, bytes(data[a:b]).decode()) for rows, data, at in pieces(batch, "text", limit) for i, a, b in zip(rows.column("i").to_pylist(), at, at[1:])]
    assert got == [(i, t or "") for i, t in enumerate(texts)]


def _sets(texts, n=5):
    batch = pa.RecordBatch.from_pydict({"text": texts})
    return [s for rows, text, at in pieces(batch, "text", 64) for s in jaccard_join.text_sets(rows, text, at, n)]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_shingle_sets_equal_word_tuples(texts):
    def plain(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    got, want = _sets(texts), [plain(t) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for (a, x), (b, y) in itertools.combinations(zip(got, want), 2):
        assert len(set(a.tolist()) & set(b.tolist())) == len(x & y)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.floats(0, 1), st.sampled_from([0.0, 0.3, 0.8, 0.95, 1.0]))
def test_similar_sets_share_an_index_key(seed, n, cut, common):
    """For any frequent set, pairs at or over the threshold meet in the index."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 62, 2 * n + 4, dtype=np.int64).astype(np.uint64)
    x, y = list(base[:n]), list(base[:n])
    spare = list(base[n:])
    while True:  # take the pair as far apart as the threshold allows
        k, which = int(rng.integers(3)), rng.random() < 0.5
        p, q = list(x), list(y)
        side = p if which else q
        if k == 0 and len(side) > 1:
            side.pop(int(rng.integers(len(side))))
        elif k == 1 and spare:
            side.append(spare.pop())
        elif spare:
            side[int(rng.integers(len(side)))] = spare.pop()
        both = len(set(p) & set(q))
        if 100 * both < 75 * (len(p) + len(q) - both) or rng.random() < 0.02 * cut or not spare:
            break
        x, y = p, q
    x, y = np.unique(np.array(x, np.uint64)), np.unique(np.array(y, np.uint64))
    frequent = np.sort(base[rng.random(len(base)) < common])
    (sx, cx), (sy, cy) = jaccard_join.prefix_keys(x, frequent), jaccard_join.prefix_keys(y, frequent)
    shared = set(sx.tolist()) & set(sy.tolist())
    if len(cx) and len(cy):
        assert shared or set(cx.tolist()) & set(cy.tolist())
        return
    beyond = lambda k: -(-75 * k // 100) - 1 - k // jaccard_join.EXTRA
    least = lambda k, m: max(1, -(-75 * (k + m) // 175) - max(beyond(k), beyond(m)))
    assert len(shared) >= least(len(x), len(y))
    # the tokens that a document leaves out are bounded by what every similar size needs
    for k in (len(x), len(y)):
        needs = min(least(k, -(-75 * k // 100)), least(k, 100 * k // 75)) - 2
        assert all(needs <= least(k, m) for m in range(max(1, -(-75 * k // 100)), 100 * k // 75 + 1))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=60), st.integers(1, 7), st.sampled_from([3, 5, 1 << 20]))
def test_runs_are_whole_across_batches(tokens, step, most):
    tokens = sorted(tokens)
    columns = {"token": pa.array(tokens, pa.int64()), "doc": pa.array(range(len(tokens)), pa.int64()), "n": pa.array([9] * len(tokens), pa.int32()), "combined": pa.array([False] * len(tokens))}
    whole = pa.RecordBatch.from_pydict(columns)
    saved, jaccard_join.RUN_ROWS = jaccard_join.RUN_ROWS, most
    try:
        got = [r for b in jaccard_join._runs()(whole.slice(i, step) for i in range(0, len(tokens), step)) for r in b.to_pylist()]
    finally:
        jaccard_join.RUN_ROWS = saved
    want = [(t, i, min(tokens.count(t), most)) for i, t in enumerate(tokens) if tokens.count(t) > 1]
    assert [(r["token"], r["doc"], r["df"]) for r in got] == want


def _plan_is_sound(counts, runs, capacity):
    by_length, sequences = {}, {}
    for length, rank, first, offset in runs.tolist():
        by_length.setdefault(length, []).append((rank, first, offset))
    assert set(by_length) == {n for n, c in counts.items() if c}
    for length, found in by_length.items():
        found.sort()
        assert found[0][0] == 0 and len({f[0] for f in found}) == len(found)
        for (rank, first, offset), end in zip(found, [*[f[0] for f in found[1:]], counts[length]]):
            assert end > rank
            for k in range(end - rank):
                sequences.setdefault(first + k, []).append((offset, length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30), st.sampled_from([1, 3, 50]), st.sampled_from([1, 5, 20]))
def test_packing_plan_is_sound_and_near_the_bound(counts, groups, small):
    used = _plan_is_sound(counts, packing.plan_packing(counts, 64, groups, small), 64)
    assert used >= -(-sum(n * c for n, c in counts.items()) // 64)


def test_packing_is_as_tight_as_best_fit_decreasing():
    import bisect

    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.integers(1, 1025, 20_000), np.exp(rng.normal(6, 1, 20_000)).astype(int) + 1)
    values, times = np.unique(lengths, return_counts=True)
    counts = dict(zip(values.tolist(), times.tolist()))
    used = _plan_is_sound(counts, packing.plan_packing(counts), 1024)
    rooms, plain = [], 0
    for n in sorted(lengths.tolist(), reverse=True):
        i = bisect.bisect_left(rooms, n)
        room = rooms.pop(i) if i < len(rooms) else 1024
        plain += room == 1024
        if room > n:
            bisect.insort(rooms, room - n)
    assert used <= plain * 1.005 + 1


def test_block_scores_equal_plain_bm25():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words, int(rng.integers(4, 25))))) for i in range(150)]
    hashed = {i: decontam.words_of(t) for i, t in items}
    df: dict[int, int] = {}
    for w in hashed.values():
        for t in np.unique(w).view(np.int64).tolist():
            df[t] = df.get(t, 0) + 1
    mean = float(np.mean([len(w) for w in hashed.values()]))
    index = decontam.build_index(items, df, len(items), mean)

    def plain(passage, w):
        total = own = 0.0
        for t, tf in zip(*np.unique(w, return_counts=True)):
            n = df[int(t.view(np.int64))]
            x = np.log1p((150 - n + 0.5) / (n + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
            own += x
            total += x * (t in passage)
        return total / own

    for _ in range(30):
        passage = np.unique(decontam.words_of(" ".join(rng.choice(words, 20))))
        terms = np.searchsorted(index.terms, passage[np.isin(passage, index.terms)])
        got = {}
        for b in range(decontam.BLOCKS):
            assert index.bound[terms, b].sum() + 1e-6 >= max([plain(passage, hashed[i]) for k, i in enumerate(index.ids) if index.block[k] == b], default=0)
            got |= dict(decontam._score_block(index, terms, b))
        want = {k: plain(passage, hashed[i]) for k, i in enumerate(index.ids.tolist())}
        assert set(got) == {k for k, s in want.items() if s >= decontam.THRESHOLD}
        assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_question_and_answer_parts():
    split = lambda t: [len(x) for x in decontam.question_and_answer(t)]
    assert split("What is it? A small thing.") == [3, 3]
    assert split("What is it, Answer: forty two") == [3, 2]
    assert split("one two three four five six seven eight") == [6, 2]
    assert split("alone") == [0, 1] and split("") == [0, 0]


def test_items_without_a_question_or_an_answer():
    hashes = lambda t: [x.tolist() for x in decontam.question_and_answer(t)]
    both = lambda q, a: [decontam.words_of(q).tolist(), decontam.words_of(a).tolist()]
    assert hashes("What is the name of this? Answer:") == both("what is the name", "of this")
    assert hashes("A dog barks. What is its name? Answer:") == both("a dog barks", "what is its name")
    assert hashes("Answer: one two three four five six seven eight") == both("one two three four five six", "seven eight")
    assert hashes("Answer: What is it? Answer: forty two") == both("what is it", "forty two")
    assert hashes("... one two three four") == both("one two three", "four")


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    k = len(pii_crf.TAGS)
    model = pii_crf.Crf({}, np.zeros((0, k)), rng.normal(size=(k, k)), rng.normal(size=k))
    scores = rng.normal(size=(3, 4, k))
    lengths = np.array([4, 2, 1])
    got = model.viterbi(scores, lengths)
    for s, n, tags in zip(scores, lengths, got):
        value = lambda path: model.begin[path[0]] + sum(s[t, p] for t, p in enumerate(path)) + sum(model.move[a, b] for a, b in zip(path, path[1:]))  # noqa: B023, E731
        assert tuple(tags[:n]) == max(itertools.product(range(k), repeat=int(n)), key=value)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=list("ab1234+ ()-.@é%"), max_size=40))
def test_base_spans_equal_the_plain_patterns(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    want = [(m.start(), 0, m.end()) for m in pii_crf.EMAIL.finditer(text)]
    want += [(m.start(), 1, m.end()) for m in pii_crf.IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    want += [(m.start(), 2, m.end()) for m in pii_crf.CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and pii_crf.luhn(digits(m))]
    want += [(m.start(), 3, m.end()) for m in pii_crf.PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    assert pii_crf.base_spans(text) == sorted(want)


@pytest.mark.parametrize("run", ["7", "a", ".", "7.", "a@", "b.", "+1", "1-", "1 ", "(at"])
def test_base_spans_take_linear_time_on_long_runs(run):
    import time

    n = 1_000_000 // len(run)
    for text in (run * n, run * n + "@", "x@" + run * n, "a@b.c " + run * n + " 10.0.0.1"):
        began = time.process_time()
        spans = pii_crf.base_spans(text)
        assert time.process_time() - began < 4  # the plain patterns take hours on some of these
    assert spans[0] == (0, 0, 5) and spans[-1] == (len(text) - 8, 1, len(text))


@settings(max_examples=200, deadline=None)
@given(st.one_of(*[st.text(alphabet=list(a), max_size=60) for a in ("ab1@.-%", "12.@a", " +1234()-.@", "0129.", "1 -", "a@.b")]))
def test_base_spans_equal_the_plain_patterns_on_dense_texts(text):
    test_base_spans_equal_the_plain_patterns.hypothesis.inner_test(text)


def test_a_context_is_scored_alike_whether_kept_or_not(monkeypatch):
    model = pii_crf.train(pii_crf.labelled_table(40))
    chains = [list(pii_crf.TOKEN.finditer(t)) for t in ("call 555-1234 now", "mail a (at) b (dot) com", "call 555-1234 now")]
    first = model.scores(chains)
    monkeypatch.setattr(pii_crf, "KEPT_CONTEXTS", 2)
    model.known.clear()
    again = model.scores(chains)
    assert len(model.known) <= 2 and (first == again).all() and (first[0] == first[2]).all()


def test_the_field_learns_forms_that_the_patterns_miss():
    model = pii_crf.train(pii_crf.labelled_table())
    marks = lambda t: sorted({m.start() for m in re.finditer("[0-9@]", t)} | {m.start() for m in pii_crf._SPELLED.finditer(t)})
    spans = lambda t: pii_crf.added_spans(model, [t], [marks(t)])[0]
    found = right = wanted = 0
    for text, truth in pii_crf.labelled_table(200, seed=77):
        want = {s for s in truth if pii_crf.plausible(s[1], text[s[0] : s[2]])}
        got = set(spans(text))
        found, right, wanted = found + len(got), right + len(got & want), wanted + len(want)
    assert right >= 0.9 * wanted and right >= 0.95 * found
    for clean in ("see version 3.1.2 of 2024, page 12", "order 123456789012 at 12:30", "", "no digits here", "7" * 5000):
        assert spans(clean) == []


def test_every_mark_has_its_whole_context():
    model = pii_crf.train(pii_crf.labelled_table())
    address = "john (at) example (dot) com"
    for before in ("Call 555-1234 or write ", "See 12 of the pages, or write ", "Ask ann@b.org or write to ", "Tel 555-1234 or mail "):
        text = f"{before}{address} today"
        marks = sorted({m.start() for m in re.finditer("[0-9@]", text)} | {m.start() for m in pii_crf._SPELLED.finditer(text)})
        chains = pii_crf._chains(text, marks)
        assert all(any(a <= max(0, m - pii_crf.REACH) and b >= min(len(text), m + pii_crf.REACH) for a, b in chains) for m in marks)
        assert (len(before), 0, len(before) + len(address)) in pii_crf.added_spans(model, [text], [marks])[0]
    text = "7" * 300_000 + " end"
    assert pii_crf._chains(text, list(range(300_000))) == [(0, len(text))]


def test_additive_model_learns_an_interaction_and_degenerate_labels():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:2000], y[:2000])
    assert ((model.scores(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9
    for labels, score in ((np.ones(5), 1.0), (np.zeros(5), 0.0), (np.zeros(0), 0.5)):
        s = quality_gam.fit(x[: len(labels)], labels).scores(x[:3])
        assert np.allclose(s, score, atol=1e-5)


def test_features_are_finite_for_any_text():
    texts = ["", " ", "!", "a" * 10_000, "x\n" * 50, "é è", None]
    for rows, text, at in pieces(pa.RecordBatch.from_pydict({"text": texts}), "text"):
        f = quality_gam.text_features(text, at)
        assert f.shape == (len(rows), len(quality_gam.FEATURES)) and np.isfinite(f).all()
        assert (f[0, 1:] == f[1, 1:]).all() or f[0, 0] == 0


def _gzip(*members):
    out = b""
    for m in members:
        c = zlib.compressobj(1, zlib.DEFLATED, 31)
        out += c.compress(m) + c.flush()
    return out


def test_reader_streams_chunks_with_running_digests():
    import hashlib

    body = bytes(range(256)) * 40
    sha = hashlib.sha1(body).hexdigest()
    one = warc._head(7, "http://x/\r\n y", sha, len(body), None) + warc.HTTP + body + b"\r\n\r\n"
    two = warc._head(3, "", sha, len(body), 7) + warc.HTTP + b"\r\n\r\n"
    rows = list(warc.read_records(io.BytesIO(_gzip(one, two)), chunk_bytes=1000))
    assert [r[:5] for r in rows] == [*((7, "response", None, i, i == 10) for i in range(11)), (3, "revisit", 7, 0, True)]
    assert b"".join(r[5] for r in rows) == body and max(len(r[5]) for r in rows) == 1000
    for i, r in enumerate(rows[:11]):
        part = body[: 1000 * (i + 1)]
        assert r[6:] == (len(part), hashlib.sha1(part).hexdigest())
    assert rows[-1][6:] == (len(body), sha)
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(io.BytesIO(_gzip(one.replace(body[:10], b"0123456789", 1)))))
    with pytest.raises(EOFError):
        list(warc.read_records(io.BytesIO(_gzip(one, two)[:-30])))
    assert list(warc.read_records(io.BytesIO(b""))) == []


def test_words_stop_at_text_borders():
    text = np.frombuffer(b"abcd ef", np.uint8)
    starts, ends, at = word_spans(text, np.array([0, 2, 2, 7]))
    assert list(zip(starts, ends)) == [(0, 2), (2, 4), (5, 7)] and at.tolist() == [0, 1, 1, 3]
    a = word_hashes(np.frombuffer(b"Same same", np.uint8), np.array([0, 5]), np.array([4, 9]))
    assert a[0] == a[1]
    assert [len(s) for s in shingles(np.zeros(0, np.uint64), np.array([0, 0]), 5)] == [0]


def test_the_word_table_is_bounded_by_bytes(coder, monkeypatch):
    """Unspaced words of 200 kB are encoded whole and not kept; many short ones are dropped beyond the bound."""
    from tablezones.llm import text_ids

    monkeypatch.setattr(text_ids, "CACHED_BYTES", 1 << 20)
    for k in range(4):
        texts = [f"{'ab' * 100_000}{k} and {'q' * 50}", " ".join(f"w{k}y{i}" for i in range(5000)), "the same words"]
        ids, at = coder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [coder.library.encode(t, add_special_tokens=False).ids for t in texts]
        assert max(map(len, coder.code)) <= text_ids.KEPT_CHARS
        assert coder.cost <= (1 << 20) + 5100 * (text_ids.ENTRY_BYTES + 40) and len(coder.code) == len(coder.start) - 1


def test_words_met_in_most_pieces_stay_in_the_word_table(monkeypatch):
    from tablezones.llm import text_ids

    monkeypatch.setattr(text_ids, "CACHED_WORDS", 50)
    coder = TextEncoder(tokenizer_path())
    coder.encode(pa.array([" ".join(f"first{i}" for i in range(40))]))
    for k in range(6):
        texts = [" ".join(f"w{k}z{i}" for i in range(20)), "so late but common", "\nlate\nñ"]
        ids, at = coder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [coder.library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(coder.code) == len(coder.start) - 1 == len(coder.met) and list(coder.code.values()) == list(range(len(coder.code)))
    assert {"\nso", "late", "but", "common"} <= set(coder.code) and "first39" not in coder.code


def test_many_rare_words_take_bounded_memory():
    """Two workers of an executor hold 48 MB of words each at most, besides those of one piece of text."""
    coder = TextEncoder(tokenizer_path())
    for k in range(10):
        coder.encode(pa.array([" ".join(f"{k}a{i}" for i in range(k * 45_000, k * 45_000 + 45_000))]))
        assert len(coder.code) <= 345_002 and coder.cost <= 60 << 20


def test_each_word_of_a_piece_is_looked_up_once():
    class Counting(dict):
        n = 0

        def get(self, *key):
            Counting.n += 1
            return super().get(*key)

        def __getitem__(self, key):
            Counting.n += 1
            return super().__getitem__(key)

    coder = TextEncoder(tokenizer_path())
    coder.code = Counting(coder.code)
    texts = ["some words and some more words", "other words that are new"]
    for _ in range(2):
        Counting.n = 0
        ids, at = coder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [coder.library.encode(t, add_special_tokens=False).ids for t in texts]
        # the first word of each text is "\n" and its own; the empty word stands before it
        assert Counting.n == len({"", *(w for t in texts for w in ("\n" + t).split(" "))})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(-(1 << 63), (1 << 63) - 1)), min_size=1, max_size=60), st.lists(st.integers(-5, 5), max_size=8))
def test_parts_of_token_files_keep_the_order(rows, bounds):
    """Parts ascend with (id, place), also where one id is most of the rows."""
    from tablezones.llm.token_files import part_of

    rows.sort()
    part = part_of(np.array([i for i, _ in rows]), np.array([p for _, p in rows]), np.array(sorted(bounds), np.int64))
    assert (np.diff(part) >= 0).all() and part.min() >= 0 and part.max() <= len(bounds)


def test_staged_tables_hand_small_batches_to_python(spark):
    from tablezones.llm import staging

    def widest(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([len(batch)])], ["width", "n"])

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    wide = spark.range(40).repartition(1).selectExpr("id", "repeat('x', 1000000) AS text")
    got = staging.staged(wide.mapInArrow(widest, "width long, n long"), "widths").collect()
    assert sum(r.n for r in got) == 40 and max(r.width for r in got) <= staging.BATCH_BYTES + (2 << 20)
    assert spark.conf.get(setting) == before
    try:
        spark.conf.set(setting, "2m")
        with staging.small_batches(spark):
            assert spark.conf.get(setting) == "2m"  # a smaller one stays
        spark.conf.set(setting, "1g")
        with pytest.raises(ZeroDivisionError), staging.small_batches(spark):
            assert spark.conf.get(setting) == str(staging.BATCH_BYTES)
            1 / 0
        assert spark.conf.get(setting) == "1g"
    finally:
        spark.conf.set(setting, before)


def test_byte_arithmetic_on_a_batch_takes_bounded_memory():
    import tracemalloc

    from tablezones.llm.batches import worker_state

    text = "Some words of a text, told again and again. " * 40
    batch = pa.RecordBatch.from_pydict({"text": [text] * 2_400, "quality": pa.array([1] * 2_400, pa.int32())})  # 4 MB
    assert batch.nbytes > 4 << 20
    worker_state().pop("powers", None)
    tracemalloc.start()
    try:
        assert sum(map(len, quality_gam._features_of([batch]))) == 2_400
        assert tracemalloc.get_traced_memory()[1] < 60 << 20
    finally:
        tracemalloc.stop()


def test_an_encoder_stays_only_while_tasks_ask_for_it(monkeypatch):
    from tablezones.llm import batches
    from tablezones.llm.text_ids import encoder

    batch = pa.RecordBatch.from_pydict({"text": ["a text", None]})
    monkeypatch.setattr(batches, "_task", lambda: 1)
    first = encoder(tokenizer_path())
    assert len(list(pieces(batch, "text"))) == 1 and encoder(tokenizer_path()) is first
    monkeypatch.setattr(batches, "_task", lambda: 2)
    assert encoder(tokenizer_path()) is first  # the next task of the same operator
    list(pieces(batch, "text"))
    assert encoder(tokenizer_path()) is first
    monkeypatch.setattr(batches, "_task", lambda: 3)
    list(pieces(batch, "text"))  # a task of another operator
    assert encoder(tokenizer_path()) is not first
