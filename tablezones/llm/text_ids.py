"""Token ids of whole texts by a public byte-level BPE tokenizer.

The tokenizer splits a text into words before it merges bytes, and a word's ids
do not depend on its neighbours. So every distinct word is encoded once by the
``tokenizers`` library and kept in a per-worker table, bounded by its words and
by its bytes, from which the words met least go; ids of a text are gathered from it. Texts with unusual white space or with the string of an added
token, which the library gives that token's id, are encoded as a whole.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tablezones.llm.batches import worker_cache

#: Words kept per worker, and their cost in bytes (text, ids and table entry). Beyond either a third of them stays,
#: those met in most pieces of text.
CACHED_WORDS, CACHED_BYTES = 300_000, 48 << 20
#: Bytes of a word's entry in the table besides its text and ids, and words encoded in one call of the library.
ENTRY_BYTES, JOINED = 120, 500
#: Words of more characters are encoded anew for each piece of text.
KEPT_CHARS = 100
#: Text bytes encoded at once.
PIECE = 2 << 20
#: White space that the splitter joins with its neighbours, so that words are not independent.
UNUSUAL = (
    "[ \\n][ \\n]|[\\t\\x0b\\x0c\\r\\x1c-\\x1f]|[\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]|[ \n]$"
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class TextEncoder:
    """Encodes lists of texts; ``path`` is the tokenizer's JSON file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.unusual = "|".join([UNUSUAL, *(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values())])
        vocabulary = self.library.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that begin with white space
        self.opens[[i for t, i in vocabulary.items() if t[0] in "\u0120\u010a"]] = True
        self.code: dict[str, int] = {"": 0}
        self.start = np.zeros(2, np.int64)  # of each known word's ids; the empty word has none
        self.ids = np.zeros(0, np.uint32)
        self.met = np.zeros(1, np.int64)  # pieces of text with each known word
        self.cost = 0

    def _forget(self, keep: np.ndarray) -> None:
        """Keep only the words of these codes, in ascending order; the first is the empty word."""
        words = list(self.code)  # in order of their codes
        self.code = dict(zip(map(words.__getitem__, keep.tolist()), range(len(keep))))
        begin, size = self.start[keep], (self.start[1:] - self.start[:-1])[keep]
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.ids = self.ids[np.repeat(begin - self.start[:-1], size) + np.arange(self.start[-1])]
        self.met = self.met[keep] // 2  # so that words that became rare go in time
        self.cost = sum(map(len, self.code)) + ENTRY_BYTES * len(keep) + self.ids.nbytes

    def _learn(self, new: list[str]) -> None:
        """Encode unknown words, joined as in a text: a word starts with its newline or takes a space."""
        parts = []
        for a in range(0, len(new), JOINED):
            joined = "".join([w if w[0] == "\n" else " " + w for w in new[a : a + JOINED]])
            parts.append(np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32))
        ids = np.concatenate(parts)
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) != len(new):
            raise AssertionError("a word's ids depend on its neighbours")
        base = len(self.ids)
        self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
        self.start = np.concatenate([self.start[:-1], base + starts, [base + len(ids)]])
        self.ids = np.concatenate([self.ids, ids])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
        self.cost += sum(map(len, new)) + ENTRY_BYTES * len(new) + ids.nbytes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after one another, and each text's offset (one more than texts)."""
        texts = texts.cast(pa.large_string())
        odd = pc.match_substring_regex(texts, self.unusual).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._encode_by_word(texts)
        plain_ids, plain_at = self._encode_by_word(texts.filter(pa.array(~odd)))
        whole = [np.asarray(self.library.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts.filter(pa.array(odd)).to_pylist()]
        parts, k, w = [], 0, 0
        for x in odd:
            if x:
                parts.append(whole[w])
                w += 1
            else:
                parts.append(plain_ids[plain_at[k] : plain_at[k + 1]])
                k += 1
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)

    def _encode_by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        # every text gets a newline in front, so that each word begins with a space or a newline
        one, none = pa.scalar("\n", texts.type), pa.scalar("", texts.type)
        words = pc.split_pattern(pc.replace_substring(pc.binary_join_element_wise(one, texts, none), "\n", " \n"), " ")
        counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        words = pc.list_flatten(words).dictionary_encode()
        all_of_them = pa.ListArray.from_arrays(pa.array([0, len(words.dictionary)], pa.int32()), words.dictionary)
        distinct = pc.binary_join(all_of_them, pa.scalar(" ", texts.type))[0].as_py().split(" ")  # no word holds a space
        if len(self.code) > CACHED_WORDS or self.cost > CACHED_BYTES:
            most = np.argsort(-self.met[1:], kind="stable")[: len(self.code) // 3] + 1
            self._forget(np.concatenate([[0], np.sort(most)]))
        code = np.fromiter(map(self.code.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(code < 0)
        unknown = [distinct[i] for i in new]
        is_long = np.array([len(w) > KEPT_CHARS for w in unknown], bool)
        n_long = int(is_long.sum())
        if unknown:
            last = np.argsort(is_long, kind="stable")  # long words get the last codes
            code[new[last]] = len(self.code) + np.arange(len(new))
            self._learn([unknown[i] for i in last] if n_long else unknown)
        self.met[code] += 1
        del distinct, unknown, all_of_them  # the arrays below are as large again
        code = code[words.indices.to_numpy(zero_copy_only=False)]
        del words
        begin, size = self.start[code], (self.start[1:] - self.start[:-1])[code]
        # each text begins with an empty word and its added newline, one id
        at_word = np.concatenate([[0], np.cumsum(counts)])
        second = at_word[:-1] + 1
        begin[second] += 1
        size[second] -= 1
        to = np.concatenate([[0], np.cumsum(size)])
        at_text = to[at_word]
        live = np.flatnonzero(size)
        total = int(to[-1])
        if not total:
            return np.zeros(0, np.uint32), at_text
        steps = np.ones(total, np.int32 if len(self.ids) < 1 << 31 else np.int64)  # from one place in the table to the next
        begin, size = begin[live], size[live]
        steps[to[live]] = begin - np.concatenate([[0], begin[:-1] + size[:-1] - 1])
        del code, begin, size, to, live
        ids = self.ids[np.cumsum(steps, dtype=steps.dtype, out=steps)]
        if n_long:
            self._forget(np.arange(len(self.code) - n_long))
        return ids, at_text


def encoder(path: str) -> TextEncoder:
    """This worker's encoder for ``path``; a task asks for it before its first piece of text."""
    state = worker_cache("encoders")
    if path not in state:
        state[path] = TextEncoder(path)
    return state[path]


def crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
