"""License scan by template markup.

A template is mandatory wording with optional and replaceable regions:

    <<optional>> ... <<end>>      words that may be left out as a whole
    <<var max=N>>                 N words at most of any wording

Templates are compiled into one automaton over words, determinised as it is used.
It is run from every word a template can begin with; a place is accepted where all
mandatory words stand in order and nothing else stands between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import DOUBLE, LONG, STRING, map_rows, schema, whole_text

#: Base phrases of the contract: label, wording.
BASE = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))
#: Notices as their licenses word them (fixed values).
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License<<optional>> Version<<end>> 2.0"),
    ("gpl-2.0", "licensed under the <<optional>>terms of the<<end>> GNU General Public License <<optional>>version<<end>> 2"
                "<<optional>> or <<optional>>at your option<<end>> any later version<<end>>"),
    ("gpl-3.0", "licensed under the <<optional>>terms of the<<end>> GNU General Public License <<optional>>version<<end>> 3"
                "<<optional>> or <<optional>>at your option<<end>> any later version<<end>>"),
    ("cc-by-4.0", "licensed under <<optional>>a<<end>> CC BY 4.0"),
    ("cc-by-sa-4.0", "licensed under <<optional>>a<<end>> CC BY SA 4.0"),
    ("cc-by-nc-4.0", "licensed under <<optional>>a<<end>> CC BY NC 4.0"),
    ("cc-by-4.0", "licensed under <<optional>>a<<end>> Creative Commons Attribution 4.0 International <<optional>>Public<<end>> License"),
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of <<var max=12>> to deal in "
            "<<var max=4>> without restriction"),
    ("mit", "<<optional>>released<<end>> under the <<optional>>terms of the<<end>> MIT License"),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted provided that"),
    ("all-rights-reserved", "Copyright <<optional>>c<<end>> <<var max=8>> All rights reserved"),
)

#: Everything that isn't part of a word becomes a blank; A to Z become small letters.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
BLOCK = 4 << 20


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


@dataclass(frozen=True)
class Opt:
    body: tuple


@dataclass(frozen=True)
class Var:
    most: int


def parse_template(text: str) -> tuple:
    """Words, ``Opt`` and ``Var`` in order."""
    stack: list[list] = [[]]
    for part in re.split(r"(<<[^>]*>>)", text):
        if part == "<<optional>>":
            stack.append([])
        elif part == "<<end>>":
            if len(stack) == 1:
                raise ValueError("region closed but not opened")
            body = tuple(stack.pop())
            stack[-1].append(Opt(body))
        elif m := re.fullmatch(r"<<var max=(\d+)>>", part):
            stack[-1].append(Var(int(m[1])))
        elif part.startswith("<<"):
            raise ValueError(f"unknown markup {part}")
        else:
            stack[-1] += words_of(part)
    if len(stack) > 1:
        raise ValueError("region not closed")
    if not any(isinstance(x, bytes) for x in stack[0]):
        raise ValueError("a template needs mandatory words")
    return tuple(stack[0])


class TokenAutomaton:
    """All templates in one machine. ``words[s]`` are transitions by word, ``gaps[s]`` by
    any word, ``free[s]`` without one, ``ends[s]`` the template that is complete."""

    def __init__(self, templates):
        self.words: list[dict] = [{}]
        self.gaps: list[set] = [set()]
        self.free: list[set] = [set()]
        self.ends: list[int | None] = [None]
        trees = [parse_template(t) for t in templates]
        for i, tree in enumerate(trees):
            first = self._new()
            self.free[0].add(first)
            self.ends[self._add(tree, first)] = i
        # no match without its template's longest mandatory word
        self.needed = sorted({max((w for w in tree if isinstance(w, bytes)), key=len) for tree in trees})
        self.longest = max((self._size(t) for t in trees), default=0)
        self._states: dict[frozenset, tuple] = {}
        self.start = self._state(self._closed({0}))
        self.first = set() if self._starts_anywhere() else {w for s in self._closed({0}) for w in self.words[s]}

    def _new(self) -> int:
        for x, empty in ((self.words, {}), (self.gaps, set()), (self.free, set()), (self.ends, None)):
            x.append(empty)
        return len(self.words) - 1

    def _size(self, tree) -> int:
        return sum(1 if isinstance(x, bytes) else x.most if isinstance(x, Var) else self._size(x.body) for x in tree)

    def _add(self, tree, at: int) -> int:
        for x in tree:
            if isinstance(x, bytes):
                to = self._new()
                self.words[at].setdefault(x, set()).add(to)
                at = to
            elif isinstance(x, Opt):
                inner, after = self._new(), self._new()
                self.free[at] |= {inner, after}
                self.free[self._add(x.body, inner)].add(after)
                at = after
            else:
                after = self._new()
                for _ in range(x.most):
                    self.free[at].add(after)
                    to = self._new()
                    self.gaps[at].add(to)
                    at = to
                self.free[at].add(after)
                at = after
        return at

    def _closed(self, states) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for to in self.free[todo.pop()] - seen:
                seen.add(to)
                todo.append(to)
        return frozenset(seen)

    def _starts_anywhere(self) -> bool:
        return any(self.gaps[s] for s in self._closed({0}))

    def _state(self, states: frozenset) -> tuple:
        """(transitions met so far, transition of words without one, templates complete, states)."""
        found = self._states.get(states)
        if found is None:
            ends = tuple(sorted(e for e in (self.ends[s] for s in states) if e is not None))
            found = self._states[states] = ({}, [], ends, states)
        return found

    def _step(self, state: tuple, word: bytes) -> tuple | None:
        met, other, _, states = state
        if word in met:
            return met[word]
        named = {w for s in states for w in self.words[s]}
        if word not in named:
            if not other:
                to = {t for s in states for t in self.gaps[s]}
                other.append(self._state(self._closed(to)) if to else None)
            return other[0]
        to = {t for s in states for t in (*self.words[s].get(word, ()), *self.gaps[s])}
        met[word] = self._state(self._closed(to))
        return met[word]

    def places(self, words: list[bytes], stop: int) -> Iterator[tuple[int, int, int]]:
        """(template, first word, word after the last) for each start below ``stop``; the
        longest end of each template."""
        for at in range(stop):
            if self.first and words[at] not in self.first:
                continue
            state, best = self.start, {}
            for end in range(at, len(words)):
                state = self._step(state, words[end])
                if state is None:
                    break
                for template in state[2]:
                    best[template] = end + 1
            for template, end in sorted(best.items()):
                yield template, at, end

    def accepts(self, text: str) -> list[int]:
        """Templates that the whole text is an instance of."""
        state = self.start
        for word in words_of(text):
            state = self._step(state, word)
            if state is None:
                return []
        return list(state[2])


def blocks(data: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """Words of folded text in lists, so that a very long text is never all words at once."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        if end < len(data):
            cut = data.find(b" ", end)
            end = len(data) if cut < 0 else cut
        yield data[at:end].split()
        at = end


class Scanner:
    def __init__(self, base, templates):
        self.base, self.labels = len(base), [label for label, _ in (*base, *templates)]
        self.machine = TokenAutomaton([wording for _, wording in (*base, *templates)])

    def scan(self, text: str) -> tuple:
        """(n_words, base places, first, last start of them, base labels, labels, score)."""
        data = text.encode().translate(FOLD)
        m = self.machine
        if not any(w in data for w in m.needed):
            return sum(map(len, blocks(data))), 0, None, None, "", "", 0.0
        found, covered, done, n, carry = set(), 0, 0, 0, []
        spots = []
        parts = blocks(data)
        part = next(parts, None)
        while part is not None:
            after = next(parts, None)
            words = carry + part
            stop = len(words) if after is None else max(0, len(words) - m.longest)
            for template, a, b in m.places(words, stop):
                a, b = a + n, b + n
                found.add(template)
                if template < self.base:
                    spots.append(a)
                covered += max(0, b - max(a, done))
                done = max(done, b)
            n += stop
            carry, part = words[stop:], after
        base = sorted({self.labels[t] for t in found if t < self.base})
        labels = sorted({self.labels[t] for t in found})
        return (n, len(spots), min(spots, default=None), max(spots, default=None), ",".join(base), ",".join(labels),
                covered / n if n else 0.0)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, base=BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts the places of base phrases, ``labels`` adds those of accepted
    templates, ``score`` is the share of the text's words inside an accepted place.
    Null, empty and wordless texts have no words, no places and score 0. Repeated
    rows each keep a row; other columns are ignored.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def make():
        scanner = Scanner(base, templates)
        return lambda batch: [(i, *scanner.scan(t)) for i, t in zip(batch["doc_id"], batch["text"])]

    return map_rows(src, schema(doc_id=LONG, n_words=LONG, n_base=LONG, first_word=LONG, last_word=LONG,
                                base_labels=STRING, labels=STRING, score=DOUBLE), make)
