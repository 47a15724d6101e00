"""License scans: phrases, and templates whose optional and replaceable regions are compiled into token automata.

A template is a text with two kinds of markup: `<<optional>> ... <</optional>>` may be absent, `<<any:a-b>>` stands for a
to b words of any kind, and `<<one:x|y z>>` for one of the given wordings. Everything else is mandatory and must stand word
for word. An automaton is tried at each place of a text where one of its first words stands, and the longest accepted
run counts. Texts that lack a template's rarest mandatory word never reach its automaton.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The phrases asked for and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices of public licenses, with the markup above.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license <<optional>>, version<</optional>> 2.0",
    "apache-2.0-notice": (
        "licensed under the apache license, version 2.0 <<optional>>(the \"license\")<</optional>>; you may not use this "
        "<<one:file|work|software>> except in compliance with the license. you may obtain a copy of the license at "
        "<<optional>>http www apache org licenses license 2 0<</optional>> <<optional>>https www apache org licenses license 2 0<</optional>> "
        "unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an "
        "\"as is\" basis, without warranties or conditions of any kind, either express or implied."
    ),
    "mit": "<<one:released|licensed|distributed|available>> under the <<optional>>terms of the<</optional>> mit license",
    "mit-text": (
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"software\"), to deal in the software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit "
        "persons to whom the software is furnished to do so, subject to the following conditions: the above copyright notice and "
        "this permission notice <<optional>>(including the next paragraph)<</optional>> shall be included in all copies or "
        "substantial portions of the software."
    ),
    "bsd": (
        "redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: <<optional>>1.<</optional>> redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. <<optional>>2.<</optional>> redistributions in binary form "
        "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. <<optional>><<optional>>3.<</optional>> neither the name of "
        "<<any:1-12>> nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.<</optional>>"
    ),
    "gpl-2.0": "licensed under the gnu general public license <<optional>>as published by the free software foundation<</optional>> <<optional>>,<</optional>> <<one:version|v>> 2 <<optional>>0<</optional>>",
    "gpl-3.0": "licensed under the gnu general public license <<optional>>as published by the free software foundation<</optional>> <<optional>>,<</optional>> <<one:version|v>> 3 <<optional>>0<</optional>>",
    "lgpl": "gnu <<one:lesser|library>> general public license",
    "agpl": "gnu affero general public license",
    "mpl-2.0": "subject to the terms of the mozilla public license, v. 2.0",
    "cc-by-nc": "licensed under <<optional>>a<</optional>> <<one:cc|creative commons>> <<one:by|attribution>> <<one:nc|noncommercial|non commercial>> <<optional>><<any:1-2>><</optional>>",
    "cc-by-sa": "licensed under <<optional>>a<</optional>> <<one:cc|creative commons>> <<one:by|attribution>> <<one:sa|sharealike|share alike>>",
    "cc0": "<<one:cc0|cc zero>> <<optional>>1.0<</optional>> <<optional>>universal<</optional>>",
    "copyright-reserved": "copyright <<optional>>c<</optional>> <<any:1-8>> all rights reserved",
}

_MARKUP = re.compile(r"<<(/?optional|any:\d+-\d+|one:[^>]*)>>")
#: Every byte that can't be part of a word becomes a space; A-Z become lower case.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, lower-cased in A-Z."""
    return (text or "").encode("utf-8", "replace").translate(_WORD_BYTES).split()


class Automaton:
    """A template as states over words. `steps[s]` has the words that lead on, `free[s]` the state after any word."""

    def __init__(self, template: str) -> None:
        self.steps: list[dict[bytes, set[int]]] = []
        self.free: list[set[int]] = []
        self.silent: list[set[int]] = []
        end = self._compile(_MARKUP.split(template))
        self.closed = [self._closure(s) for s in range(len(self.steps))]
        self.start, self.end = self.closed[0], end
        if end in self.start or any(self.free[s] for s in self.start):
            raise ValueError("a template must begin with a mandatory word")
        self.first = {w for s in self.start for w in self.steps[s]}

    def _state(self) -> int:
        self.steps.append({})
        self.free.append(set())
        self.silent.append(set())
        return len(self.steps) - 1

    def _wording(self, at: int, words: list[bytes]) -> int:
        for word in words:
            after = self._state()
            self.steps[at].setdefault(word, set()).add(after)
            at = after
        return at

    def _compile(self, parts: list[str]) -> int:
        at, opened, self.mandatory = self._state(), [], []
        for n, part in enumerate(parts):
            if n % 2 == 0:
                at = self._wording(at, words_of(part))
                self.mandatory += [] if opened else words_of(part)
            elif part == "optional":
                opened.append(at)
                inner = self._state()
                self.silent[at].add(inner)
                at = inner
            elif part == "/optional":
                after = self._state()
                self.silent[at].add(after)
                self.silent[opened.pop()].add(after)
                at = after
            elif part.startswith("any:"):
                least, most = map(int, part[4:].split("-"))
                after = self._state()
                for k in range(most):
                    if k >= least:
                        self.silent[at].add(after)
                    on = self._state()
                    self.free[at].add(on)
                    at = on
                self.silent[at].add(after)
                at = after
            else:
                after = self._state()
                for wording in part[4:].split("|"):
                    self.silent[self._wording(at, words_of(wording))].add(after)
                at = after
        if opened:
            raise ValueError("an optional region isn't closed")
        return at

    def _closure(self, state: int) -> frozenset[int]:
        found, todo = {state}, [state]
        while todo:
            new = self.silent[todo.pop()] - found
            found |= new
            todo += new
        return frozenset(found)

    def longest(self, words: list[bytes], at: int) -> int:
        """The end of the longest accepted run that begins at word `at`, or -1."""
        states, accepted = self.start, -1
        for n in range(at, len(words)):
            after: set[int] = set()
            for s in states:
                for on in self.steps[s].get(words[n], ()):
                    after |= self.closed[on]
                for on in self.free[s]:
                    after |= self.closed[on]
            if not after:
                break
            states = after
            if self.end in states:
                accepted = n + 1
        return accepted


def _places(joined: bytes, wording: bytes) -> Iterator[int]:
    """The numbers of the words at which `wording` begins; `joined` has a space before, between and after all words."""
    wanted, at, counted, number = b" " + wording + b" ", 0, 0, 0
    while (at := joined.find(wanted, at)) >= 0:
        number += joined.count(b" ", counted, at)
        yield number
        counted, at = at, at + 1


class Scanner:
    """All phrases and templates, compiled."""

    def __init__(self, phrases: Mapping[str, str], templates: Mapping[str, str]) -> None:
        self.phrases = [(b" ".join(words_of(p)), len(words_of(p)), label) for p, label in phrases.items()]
        self.automata = [(Automaton(t), label) for label, t in templates.items()]
        # The longest mandatory word is as good as the rarest, and needs no corpus.
        self.needed = [b" " + max(a.mandatory, key=len, default=b"") + b" " if a.mandatory else b" " for a, _ in self.automata]

    def spans(self, text: str | None) -> tuple[int, list[tuple[int, int, str, bool]]]:
        """The number of words, and (first word, end, label, whether of a phrase) of each place, in order."""
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        found = [(at, at + n, label, True) for wording, n, label in self.phrases for at in _places(joined, wording)]
        for (automaton, label), needed in zip(self.automata, self.needed, strict=True):
            if needed in joined:
                done = 0
                for at in sorted({at for first in automaton.first for at in _places(joined, first)}):
                    if at >= done and (end := automaton.longest(words, at)) >= 0:
                        found.append((at, end, label, False))
                        done = end
        return len(words), sorted(found)


@lru_cache(maxsize=4)
def _scanner(phrases: tuple, templates: tuple) -> Scanner:
    return Scanner(dict(phrases), dict(templates))


SPANS = "n_words long, spans array<struct<first:long, end:long, label:string, phrase:boolean>>"


def scan(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, and spans: each place of a phrase or an accepted template, with word numbers from 0.

    A NULL text is empty: no words, no spans. Overlapping phrases count one by one; a template's runs don't overlap each
    other. Repeated rows are scanned as often as they come; other columns are ignored.
    """
    plan = tuple(phrases.items()), tuple(templates.items())

    @F.pandas_udf(f"struct<{SPANS.replace('n_words long', 'n_words:long').replace('spans array', 'spans:array')}>")
    def of(texts: pd.Series) -> pd.DataFrame:
        scanner = _scanner(*plan)
        results = [scanner.spans(t) for t in texts]
        rows = [[{"first": a, "end": b, "label": c, "phrase": d} for a, b, c, d in spans] for _, spans in results]
        return pd.DataFrame({"n_words": [n for n, _ in results], "spans": rows})

    return docs.select("doc_id", of(F.col("text").cast("string")).alias("s")).select("doc_id", "s.n_words", "s.spans")


def report(scanned: DataFrame) -> DataFrame:
    """Counts, labels and score of each scanned text; score is the share of its words inside license wording."""
    base = F.filter("spans", lambda s: s["phrase"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    # The spans come sorted by their first word, so each adds what lies beyond the furthest end so far.
    start = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate(
        "spans",
        start,
        lambda acc, s: F.struct(
            (acc["covered"] + F.greatest(s["end"] - F.greatest(s["first"], acc["end"]), F.lit(0))).alias("covered"),
            F.greatest(acc["end"], s["end"]).alias("end"),
        ),
        lambda acc: acc["covered"],
    )
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["first"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.when(F.col("n_words") > 0, covered / F.col("n_words")).otherwise(F.lit(0.0)).alias("score"),
    )
