"""License scans: templates with optional and replaceable regions, compiled into token automata."""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from placeloom.llm.blobs import text_bytes

# What parts words: every ASCII byte but digits and letters. A-Z are lower-cased.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
MARK = re.compile(r"<<(beginOptional|endOptional|var)(?:;match=\"([^\"]*)\")?>>")
SPAN = re.compile(r"\.\{(\d+),(\d+)\}")

# Wording of public licenses and of the notices they ask for, with the markup of license lists. `match` of a replaceable
# region is `.{a,b}`, from a to b words of any kind, or wordings parted by `|`. (template, label, text)
TEMPLATES = [
    ("apache-notice", "apache-2.0", '<<beginOptional>>this <<var;match="file|work|project|software|program|code">> is <<endOptional>>licensed under the apache license<<beginOptional>> version<<endOptional>> 2.0'),
    ("apache-header", "apache-2.0", 'licensed under the apache license version 2.0 the license you may not use <<var;match=".{1,6}">> except in compliance with the license you may obtain a copy of the license at <<beginOptional>>http <<endOptional>><<beginOptional>>https <<endOptional>>www apache org licenses license 2.0'),
    ("mit-notice", "mit", '<<var;match="released|licensed|distributed|available">> under the <<beginOptional>>terms of the <<endOptional>>mit license'),
    ("mit-grant", "mit", 'permission is hereby granted free of charge to any person obtaining a copy of <<var;match=".{1,8}">> the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so'),
    ("gpl-notice", "gpl-3.0", '<<beginOptional>>this <<var;match="file|work|project|software|program|code">> is <<endOptional>>licensed under the <<beginOptional>>terms of the <<endOptional>>gnu general public license <<beginOptional>>as published by the free software foundation <<endOptional>><<beginOptional>>either <<endOptional>>version 3'),
    ("gpl-2-notice", "gpl-2.0", 'licensed under the <<beginOptional>>terms of the <<endOptional>>gnu general public license <<beginOptional>>as published by the free software foundation <<endOptional>><<beginOptional>>either <<endOptional>>version 2'),
    ("gpl-grant", "gpl", 'is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation'),
    ("cc-notice", "cc-by-4.0", 'licensed under <<beginOptional>>the <<endOptional>><<var;match="cc by|creative commons attribution">> 4.0'),
    ("cc-nc-notice", "cc-by-nc-4.0", 'licensed under <<beginOptional>>the <<endOptional>><<var;match="cc by nc|creative commons attribution noncommercial|creative commons attribution non commercial">> 4.0'),
    ("cc-sa-notice", "cc-by-sa-4.0", 'licensed under <<beginOptional>>the <<endOptional>><<var;match="cc by sa|creative commons attribution sharealike|creative commons attribution share alike">> 4.0'),
    ("bsd-grant", "bsd", 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
    ("isc-grant", "isc", 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies'),
    ("tag", "spdx", 'spdx license identifier <<var;match="apache 2.0|mit|gpl 2.0|gpl 3.0|bsd 2 clause|bsd 3 clause|isc|cc by 4.0">>'),
]

# Phrases and their labels.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


# ---------------------------------------------------------------- markup
def parse(markup: str) -> list:
    """Nodes of a template: a word (bytes), ("any", a, b), ("one", wordings), ("opt", nodes)."""
    stack, at = [[]], 0
    take = lambda text: stack[-1].extend(words_of(text.encode()))
    for m in MARK.finditer(markup):
        take(markup[at:m.start()])
        at = m.end()
        if m[1] == "beginOptional":
            stack.append([])
        elif m[1] == "endOptional":
            if len(stack) == 1:
                raise ValueError("an optional region ends that never began")
            inner = stack.pop()
            stack[-1].append(("opt", inner))
        elif span := SPAN.fullmatch(m[2] or ""):
            stack[-1].append(("any", int(span[1]), int(span[2])))
        else:
            stack[-1].append(("one", [words_of(x.encode()) for x in (m[2] or "").split("|")]))
    take(markup[at:])
    if len(stack) > 1:
        raise ValueError("an optional region doesn't end")
    return stack[0]


@dataclass(frozen=True)
class Automaton:
    """Positions 0..m-1 each read one word. `heads`: where a match may begin, `after[p]`: where it may go on, as bit sets; `ends`: where it
    may stop; `reads[word]`: positions that accept the word, beside those in `wild`, which accept any."""
    heads: int
    after: tuple[int, ...]
    ends: int
    reads: dict[bytes, int]
    wild: int


def compiled(markup: str) -> Automaton:
    """The position automaton of a template. It has no loops: a match is no longer than its positions are many."""
    after: list[int] = []
    reads: dict[bytes, int] = {}
    wild = 0

    def position(word: bytes | None, before: list[int]) -> int:
        nonlocal wild
        p = len(after)
        after.append(0)
        for q in before:
            after[q] |= 1 << p
        if word is None:
            wild |= 1 << p
        else:
            reads[word] = reads.get(word, 0) | 1 << p
        return p

    heads = 0

    def chain(nodes: list, before: list[int], open_: bool) -> tuple[list[int], bool]:
        """Adds nodes behind the positions `before`; `open_`: nothing was read yet. Returns both for what follows."""
        nonlocal heads

        def read(word: bytes | None, b: list[int], o: bool) -> tuple[list[int], bool]:
            nonlocal heads
            p = position(word, b)
            heads |= o << p
            return [p], False

        for node in nodes:
            if isinstance(node, bytes):
                before, open_ = read(node, before, open_)
            elif node[0] == "opt":
                b, o = chain(node[1], before, open_)
                before, open_ = [*dict.fromkeys(before + b)], open_ or o
            elif node[0] == "one":
                ways = [chain(words, before, open_) for words in node[1]]
                before, open_ = [*dict.fromkeys(p for b, _ in ways for p in b)], any(o for _, o in ways)
            else:  # a run of b positions that may be entered at each of the first b - a + 1
                _, low, high = node
                came, opened, last = before, open_, []
                for k in range(high):
                    enter = k <= high - low
                    last, _ = read(None, last + (came if enter else []), opened and enter)
                before, open_ = [*dict.fromkeys(last + (came if low == 0 else []))], opened and low == 0
        return before, open_

    stops, empty = chain(parse(markup), [], True)
    if empty:
        raise ValueError("a template without mandatory words")
    return Automaton(heads, tuple(after), sum(1 << p for p in stops), reads, wild)


def longest_match(a: Automaton, words: list[bytes], start: int) -> int | None:
    """Where the longest match that begins at `start` stops; None without one."""
    alive, stop = a.heads, None
    for k in range(start, len(words)):
        here = alive & (a.reads.get(words[k], 0) | a.wild)
        if not here:
            break
        if here & a.ends:
            stop = k + 1
        alive = 0
        while here:
            low = here & -here
            alive |= a.after[low.bit_length() - 1]
            here ^= low
    return stop


class Matcher:
    """All templates over a text's words. A start is tried where its first two words can be read, told from one table of word pairs."""

    def __init__(self, templates: list[tuple[str, str, str]], phrases: list[tuple[str, str]]) -> None:
        self.automata = [(name, label, compiled(text)) for name, label, text in templates]
        self.phrases = [(label, words_of(text.encode())) for text, label in phrases]
        known = sorted({w for _, _, a in self.automata for w in a.reads} | {w for _, p in self.phrases for w in p})
        self.code = {w: k for k, w in enumerate(known)}
        self.other = len(known)
        n = self.other + 1
        self.pairs = np.zeros((len(self.automata), n, n), bool)
        for k, (_, _, a) in enumerate(self.automata):
            read = lambda w: (a.reads.get(w, 0) if w is not None else 0) | a.wild
            for i, first in enumerate([*known, None]):
                here = a.heads & read(first)
                next_ = 0
                for p in range(len(a.after)):
                    next_ |= a.after[p] if here >> p & 1 else 0
                if here:
                    self.pairs[k, i] = [bool(here & a.ends) or bool(next_ & read(w)) for w in [*known, None]]
        self.first = self.pairs.any(axis=0)

    def scan(self, words: list[bytes]) -> tuple[list[tuple], list[tuple]]:
        """(places of phrases (label, start, stop), accepted stretches (template, label, start, stop)), in order of start. An accepted stretch
        hides starts of the same template inside it."""
        n, get, other = len(words), self.code.get, self.other
        code = np.fromiter((get(w, other) for w in words), np.int32, n)
        if not n or (code == other).all() and not self.first[other].any():
            return [], []
        base = []
        for label, phrase in self.phrases:
            m = len(phrase)
            if n >= m:
                hit = np.logical_and.reduce([code[j:n - m + 1 + j] == self.code[w] for j, w in enumerate(phrase)])
                base += [(label, int(s), int(s) + m) for s in np.flatnonzero(hit)]
        after = np.append(code[1:], other)
        found = []
        starts = np.flatnonzero(self.first[code, after])
        for k, (name, label, automaton) in enumerate(self.automata if len(starts) else []):
            free = 0
            for s in starts[self.pairs[k][code[starts], after[starts]]].tolist():
                if s >= free and (stop := longest_match(automaton, words, s)) is not None:
                    found.append((name, label, s, stop))
                    free = stop
        return sorted(base, key=lambda x: x[1:]), sorted(found, key=lambda x: x[2:])


BASE = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
FOUND = pa.list_(pa.struct([("template", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def licence_matches(docs: DataFrame, templates: list[tuple[str, str, str]] | None = None, phrases: list[tuple[str, str]] | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(`carry`.., n_words, places, accepted): where phrases stand in each whole text and which stretches a template accepts, as word numbers.

    A stretch is accepted when its words are the template's mandatory wording, exactly and in order, with optional regions there or not and
    replaceable ones filled as their match allows; the longest from each start. Texts are scanned where they lie: no row travels.

    NULL and empty texts have no words and no matches; long texts are scanned whole, in time linear in their words (a try is at most as long as
    the template); repeated rows and NULL ids are rows like others; an empty table gives no rows; other columns are ignored."""
    made = Matcher(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)
    rows = docs.select(*carry, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places, accepted = [], [], []
            for text in text_bytes(batch):
                words = words_of(text)
                base, found = made.scan(words)
                counts.append(len(words))
                places.append([dict(zip(("label", "start", "stop"), x)) for x in base])
                accepted.append([dict(zip(("template", "label", "start", "stop"), x)) for x in found])
            kept = [batch.column(batch.schema.get_field_index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64()), pa.array(places, BASE), pa.array(accepted, FOUND)], names=[*carry, "n_words", "places", "accepted"])

    shape = rows.drop("text").schema.add("n_words", "long")
    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape) + ", places array<struct<label:string,start:long,stop:long>>, accepted array<struct<template:string,label:string,start:long,stop:long>>")


def as_pattern(markup: str) -> str:
    """The template as a regular expression over words that are each followed by one space, with a space before the first."""
    def of(nodes: list) -> str:
        out = ""
        for node in nodes:
            if isinstance(node, bytes):
                out += re.escape(node.decode()) + " "
            elif node[0] == "opt":
                out += f"(?:{of(node[1])})?"
            elif node[0] == "one":
                out += f"(?:{'|'.join(map(of, node[1]))})"
            else:
                out += f"(?:[^ ]+ ){{{node[1]},{node[2]}}}"
        return out
    return " " + of(parse(markup))
