"""Whole texts as token ids of a public tokenizer, word by word."""
from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 400_000
CHUNK = 4 << 20  # bytes of text split at once
# The tokenizer cuts between a letter or digit and a mark that follows it, so a space there changes nothing and words repeat more often.
BEFORE_MARK = "([a-z0-9])([.,!?;:|])"

# One word to the tokenizer whatever stands around it, in any case; its ids end with the only one that closes a word.
LETTERS = re.compile("[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
JOINED = 200  # words of letters encoded as one text, which costs a third less


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(pieces of all texts that the tokenizer encodes alike alone, how many each text has). It lower-cases, except for the names of its
    special tokens: texts that may hold one are cut at white space only."""
    special = pc.match_substring(texts, "<|")
    lower = pc.replace_substring_regex(pc.ascii_lower(texts), BEFORE_MARK, r"\1 \2")
    cut = pc.ascii_split_whitespace(pc.if_else(special, texts, lower))
    flat, row = cut.flatten(), pc.list_parent_indices(cut)
    full = pc.greater(pc.binary_length(flat), 0)  # white space at an end leaves an empty piece
    return flat.filter(full), np.bincount(row.filter(full).to_numpy(zero_copy_only=False), minlength=len(texts))


def chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Stretches of `texts` (NULL as empty) of about CHUNK bytes, or one longer text."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
        yield texts.slice(at, stop - at)
        at = stop


class Encoder:
    """Ids of texts. The tokenizer drops white space and never joins words across it, so each distinct word is encoded once and texts
    are put together from the words' ids (tests hold this against encoding whole texts). Known words are kept, up to `cache`."""

    def __init__(self, path: str, cache: int = CACHE) -> None:
        self.cache = cache
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.closes[[n for token, n in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.size = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has)."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int32, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths

    def joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """`encoded` of words of letters, many to a text; one by one where the vocabulary doesn't mark the ends of words."""
        ids, _ = self.encoded([" ".join(words[k:k + JOINED]) for k in range(0, len(words), JOINED)])
        stops = np.flatnonzero(self.closes[ids]) + 1
        if len(stops) != len(words) or len(ids) and stops[-1] != len(ids):
            return self.encoded(words)
        return ids, np.diff(stops, prepend=0).astype(np.int32)

    def learn(self, words: list[str]) -> None:
        if len(self.known) + len(words) > self.cache and self.known:
            self.clear()
        for k in range(0, len(words), 20_000):
            plain, other = [], []
            for w in words[k:k + 20_000]:
                (plain if LETTERS.fullmatch(w) else other).append(w)
            part = plain + other
            new, lengths = (np.concatenate(x) for x in zip(self.joined(plain), self.encoded(other)))
            first, n = len(self.known), len(part)
            while self.size + len(new) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            while first + n > len(self.start):
                self.start, self.length = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.length))
            self.flat[self.size:self.size + len(new)] = new
            self.length[first:first + n] = lengths
            self.start[first:first + n] = self.size + np.cumsum(lengths) - lengths
            self.size += len(new)
            self.known.update(zip(part, range(first, first + n)))

    def texts(self, texts: pa.Array, end: int) -> list[np.ndarray]:
        """Ids of each text followed by the id `end`; a NULL text is an empty one."""
        out = []
        for part in chunks(texts):
            words, counts = pieces(part)
            found = words.dictionary_encode()
            kinds = found.dictionary.to_pylist()
            at = [*map(self.known.get, kinds)]
            new = [w for w, n in zip(kinds, at) if n is None]
            if new:
                if len(self.known) + len(new) > self.cache:
                    self.clear()
                    new = kinds
                self.learn(new)
                at = [*map(self.known.get, kinds)]
            place = np.array(at, np.int64)[found.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
            lengths = self.length[place].astype(np.int64)
            ends = np.cumsum(lengths)
            at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths) + np.repeat(self.start[place], lengths)
            ids, stops, last = self.flat[at], np.concatenate([[0], ends])[np.cumsum(counts)], 0
            for stop in stops:
                out.append(np.append(ids[last:stop], np.uint32(end)).astype("<u4"))
                last = stop
        return out


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, cache: int = CACHE) -> Encoder:
    """The process's encoder of a vocabulary file; a Python worker keeps it from task to task."""
    if (path, cache) not in _ENCODERS:
        _ENCODERS[path, cache] = Encoder(path, cache)
    return _ENCODERS[path, cache]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
