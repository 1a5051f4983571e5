"""Licence scans: matching statistics against a suffix automaton of licence words.

The automaton holds every run of words of every template. A text streams
through it once; at each word it knows the longest run ending there that some
template has. Long runs that follow one another in a text and in a template
are chained, and the share of a template that a chain covers decides: a run may
stand at several places of a template and follow any earlier run near enough,
and a text may hold a template several times.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from .common import per_text, table

# The phrases that always count, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices as their licences ask for them.
TEMPLATES = {
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    "cc-by": """This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of
        this license, visit https://creativecommons.org/licenses/by/4.0/""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
        Public License for more details.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
# A run of words counts from this length on; a template is found when this share of it is covered.
LEAST_RUN = 4
LEAST_COVER = 0.5
# Words that may lie between two runs of a chain, in the text and in the template.
MAX_GAP = 30

words_of = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall


def license_words(text: str) -> list[bytes]:
    """Words in lower case (A-Z only), as bytes: bytes.lower changes ASCII letters alone."""
    return words_of(text.encode("utf-8", "surrogatepass").lower())


class SuffixAutomaton:
    """Generalised suffix automaton of several word lists."""

    def __init__(self, lists: list[list[bytes]]) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]  # per state: (list number, end) wherever its runs stand
        for number, words in enumerate(lists):
            last = 0
            for at, word in enumerate(words, 1):
                last = self._extend(last, word, ends)
                ends[last].add((number, at))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        self.ends = [sorted(found) for found in ends]

    def _extend(self, last: int, word: bytes, ends) -> int:
        nxt, link, length = self.next, self.link, self.length

        def split(p: int, q: int) -> int:
            clone = len(link)
            nxt.append(dict(nxt[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            ends.append(set())
            link[q] = clone
            while p >= 0 and nxt[p].get(word) == q:
                nxt[p][word] = clone
                p = link[p]
            return clone

        if word in nxt[last]:  # another list has been this way
            q = nxt[last][word]
            return q if length[q] == length[last] + 1 else split(last, q)
        state = len(link)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        ends.append(set())
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = state
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            link[state] = q if length[q] == length[p] + 1 else split(p, q)
        return state


class LicenseScanner:
    def __init__(self) -> None:
        self.labels = [*PHRASES.values(), *TEMPLATES]
        self.lists = [license_words(x) for x in (*PHRASES, *TEMPLATES.values())]
        self.phrases = len(PHRASES)
        auto = self.automaton = SuffixAutomaton(self.lists)
        # Per state: the phrases that end every run of it, with their lengths.
        own: dict[int, int] = {}
        for number, words in enumerate(self.lists[: self.phrases]):
            state = 0
            for word in words:
                state = auto.next[state][word]
            own[state] = number
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(auto.link)
        for state in sorted(range(1, len(auto.link)), key=lambda s: auto.length[s]):
            mine = ((own[state], len(self.lists[own[state]])),) if state in own else ()
            self.ending[state] = mine + self.ending[auto.link[state]]

    def statistics(self, words: list[bytes]):
        """Places of phrases (phrase, first word), and maximal runs (start, end, state) of LEAST_RUN words on."""
        nxt, link, length, ending = self.automaton.next, self.automaton.link, self.automaton.length, self.ending
        places, runs = [], []
        state = size = 0
        for at, word in enumerate(words):
            to = nxt[state].get(word)
            if to is None:
                if not state:
                    continue
                if size >= LEAST_RUN:
                    runs.append((at - size, at, state))
                while state and to is None:
                    state = link[state]
                    size = length[state]
                    to = nxt[state].get(word)
                if to is None:
                    size = 0
                    continue
            state = to
            size += 1
            for phrase, count in ending[state]:
                if count <= size:
                    places.append((phrase, at + 1 - count))
        if size >= LEAST_RUN:
            runs.append((len(words) - size, len(words), state))
        return places, runs

    def best_chains(self, runs) -> dict[int, list[tuple[int, int, int]]]:
        """Per template, for each place of each run: (words covered, first word, end) of the best chain that ends there.

        A run follows one that ends before it does, in the text and in the template,
        with at most MAX_GAP words between them in either; words that both cover
        count once. Among chains covering as much, the one that starts last is best.
        """
        found: dict[int, list[tuple[int, int, int]]] = {}
        near: dict[int, list[tuple[int, int, int, int]]] = {}  # per template: text end, template end, covered, first word
        for start, end, state in runs:
            size = end - start
            here: dict[int, list[tuple[int, int, int, int]]] = {}
            for number, to in self.automaton.ends[state]:
                if number < self.phrases:
                    continue
                if number not in here:
                    # Runs come by rising start and end: what is too far now stays so.
                    near[number] = [x for x in near.get(number, ()) if start - x[0] <= MAX_GAP]
                best = (size, start)
                for text_end, template_end, covered, first in near[number]:
                    if template_end < to <= template_end + size + MAX_GAP:
                        best = max(best, (covered + min(size, to - template_end, end - text_end), first))
                here.setdefault(number, []).append((end, to, *best))
                found.setdefault(number, []).append((*best, end))
            for number, places in here.items():
                near[number] += places
        return found

    def chains(self, runs) -> tuple[list[tuple[float, int, int, int]], float]:
        """(share of the template, template, first word, end) of the chains found, and the largest share of any.

        Of the chains that cover LEAST_COVER of a template, those are found that do not
        overlap and have the largest sum of squared shares, which one whole notice
        gives rather than its two halves.
        """
        found, largest = [], 0.0
        for number, ended in self.best_chains(runs).items():
            words = len(self.lists[number])
            shares = [(min(1.0, covered / words), first, end) for covered, first, end in ended]
            largest = max(largest, max(shares)[0])
            ends, chosen = [0], [(0.0, None, None)]  # best choice among chains up to an end: sum, chain, choice before it
            for share, first, end in shares:
                if share < LEAST_COVER:
                    continue
                before = chosen[bisect_right(ends, first) - 1]
                if before[0] + share * share > chosen[-1][0]:
                    ends.append(end)
                    chosen.append((before[0] + share * share, (share, number, first, end), before))
            choice = chosen[-1]
            while choice[1]:
                found.append(choice[1])
                choice = choice[2]
        return sorted(found, key=lambda x: (x[2], x[3], x[1])), largest

    def scan(self, text: str):
        """Number of words, phrase places, chains found, largest share of a template in any chain."""
        words = license_words(text)
        places, runs = self.statistics(words)
        return len(words), places, *self.chains(runs)


@lru_cache(1)
def scanner() -> LicenseScanner:
    """Built from the constants above, once in each worker."""
    return LicenseScanner()


def license_spans(docs: DataFrame) -> DataFrame:
    """doc_id, spans array<struct<label, first_word, end_word, share>> of every row.

    A phrase gives one span for each place, with share 1; a template gives one
    span for each chain that covers LEAST_COVER of it and overlaps no better one. Words count from
    0, ends are exclusive; spans are ordered by start, end, label. A null or empty text has none;
    repeated rows and null doc_ids come out as they are; an empty table gives no
    rows; other columns are not read. No shuffle, nothing but constants goes to the tasks.
    """

    def measure(text: str):
        tool = scanner()
        _, places, chains, _ = tool.scan(text)
        spans = [(at, at + len(tool.lists[p]), tool.labels[p], 1.0) for p, at in places]
        spans += [(start, end, tool.labels[number], share) for share, number, start, end in chains]
        return ([{"label": label, "first_word": a, "end_word": b, "share": share} for a, b, label, share in sorted(spans)],)

    return per_text(docs, measure, "spans array<struct<label:string,first_word:bigint,end_word:bigint,share:double>>")


def op9_license_chains(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and template chains of all documents.

    ``score`` is 1 where a phrase stands, else the best chain's share of its template.
    """

    def measure(text: str):
        tool = scanner()
        n, places, chains, share = tool.scan(text)
        starts = [at for _, at in places]
        base = {tool.labels[p] for p, _ in places}
        both = base | {tool.labels[number] for _, number, _, _ in chains}
        first, last = (min(starts), max(starts)) if starts else (None, None)
        return n, len(places), first, last, ",".join(sorted(base)), ",".join(sorted(both)), 1.0 if places else share

    schema = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return per_text(table(spark, folder, "documents"), measure, schema)
