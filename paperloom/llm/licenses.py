"""License scans by template-markup matching (operator 9).

A template is license wording with SPDX-like markup: `<<beginOptional>> ... <<endOptional>>` for words that may be
missing and `<<var;min;max>>` for replaceable wording of so many words. Each template is compiled into an automaton
over words (states with word edges, any-word edges and empty edges). It accepts where its mandatory wording stands word
by word; whatever lies in optional or replaceable regions may differ. The base phrases are templates without markup,
so they run through the same automaton.

All templates share one deterministic automaton, built state by state on demand, so a text is read once whatever the
number of templates. Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z in lower case.

Nulls count as the empty text. A text without words has no labels, null positions and score 0. Repeated rows give
repeated results; other columns of the input are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from paperloom.llm.tables import id_text, map_texts

BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}

_REDISTRIBUTION = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
    " conditions are met <<beginOptional>> 1 <<endOptional>> redistributions of source code must retain the above copyright"
    " notice this list of conditions and the following disclaimer <<beginOptional>> 2 <<endOptional>> redistributions in"
    " binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the"
    " documentation and or other materials provided with the distribution"
)
_NO_ENDORSEMENT = (
    " <<beginOptional>> 3 <<endOptional>> neither the name of <<var;1;12>> nor the names of <<var;1;4>> contributors may be used"
    " to endorse or promote products derived from this software without specific prior written permission"
)
_DISCLAIMER = (
    " this software is provided by <<var;1;12>> as is and any express or implied warranties including but not limited to the"
    " implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<var;1;12>>"
    " be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to"
    " procurement of substitute goods or services loss of use data or profits or business interruption however caused and on"
    " any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any"
    " way out of the use of this software even if advised of the possibility of such damage"
)

# Whole licenses and notices in public use, as templates (fixed values; wording must match).
TEMPLATES = {
    "apache-2-header": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the"
        " license you may obtain a copy of the license at http <<beginOptional>> s <<endOptional>> www apache org licenses"
        " license 2 0 <<beginOptional>> txt <<endOptional>> unless required by applicable law or agreed to in writing software"
        " distributed under the license is distributed on an as is basis without warranties or conditions of any kind either"
        " express or implied see the license for the specific language governing permissions and limitations under the license"
    ),
    "bsd-2-clause": _REDISTRIBUTION + _DISCLAIMER,
    "bsd-3-clause": _REDISTRIBUTION + _NO_ENDORSEMENT + _DISCLAIMER,
    "isc-license": (
        "permission to use copy modify and <<beginOptional>> or <<endOptional>> distribute this software for any purpose with or"
        " without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"
        " the software is provided as is and <<var;1;12>> disclaims all warranties with regard to this software including all"
        " implied warranties of merchantability and fitness in no event shall <<var;1;12>> be liable for any special direct"
        " indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an"
        " action of contract negligence or other tortious action arising out of or in connection with the use or performance of"
        " this software"
    ),
    "mit-license": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation the rights"
        " to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to"
        " whom the software is furnished to do so subject to the following conditions the above copyright notice and this"
        " permission notice <<beginOptional>> including the next paragraph <<endOptional>> shall be included in all copies or"
        " substantial portions of the software the software is provided as is without warranty of any kind express or implied"
        " including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
        " in no event shall <<var;1;12>> be liable for any claim damages or other liability whether in an action of contract"
        " tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
    ),
    "apache-2-notice": (
        "licensed under the apache license version 2 0 <<beginOptional>> the license <<endOptional>>"
        " <<beginOptional>> you may not use this file except in compliance with the license <<endOptional>>"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met"
    ),
    "cc-by-nc": "licensed under <<beginOptional>> the <<endOptional>> <<beginOptional>> a <<endOptional>> cc by nc <<var;1;2>>",
    "cc-by-nc-long": "creative commons attribution noncommercial <<beginOptional>> <<var;1;3>> international <<endOptional>> license",
    "gpl": (
        "gnu <<beginOptional>> affero <<endOptional>> <<beginOptional>> lesser <<endOptional>> general public license"
        " <<beginOptional>> as published by the free software foundation <<endOptional>>"
        " <<beginOptional>> either <<endOptional>> version <<var;1;1>>"
    ),
    "isc": (
        "permission to use copy modify and <<beginOptional>> or <<endOptional>> distribute this software for any purpose"
        " with or without fee is hereby granted"
    ),
    "mit-notice": "released under the <<beginOptional>> terms of the <<endOptional>> mit license",
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software <<beginOptional>> to deal in the software without restriction <<endOptional>>"
    ),
    "mpl": "mozilla public license <<beginOptional>> v <<endOptional>> <<beginOptional>> version <<endOptional>> <<var;1;1>> 0",
    "rights-reserved": "copyright <<beginOptional>> c <<endOptional>> <<var;1;8>> all rights reserved",
}

# Bytes that are not part of a word become blanks; A-Z become a-z. Bytes from 0x80 on belong to words.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256)
)
_MARK = re.compile(r"<<(\w+)(?:;(\d+);(\d+))?>>|(\S+)")
ANY = None  # an edge any word may take


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class Automaton:
    """Word automaton of several templates; `feed` gives what ends at each word."""

    def __init__(self, templates: dict[str, str]):
        self.edges: list[list[tuple[bytes | None, int]]] = []
        self.empty: list[list[int]] = []
        self.accepts: dict[int, str] = {}
        self.mandatory: dict[str, int] = {}
        starts = []
        for label, markup in templates.items():
            start = self._state()
            starts.append(start)
            self.accepts[self._compile(label, markup, start)] = label
        self.start = self._close(starts)
        # Deterministic states are sets of states, made when first met; few are, since texts are mostly other words.
        self.alphabet = {word for edges in self.edges for word, _ in edges if word is not ANY}
        self.first = {word for state in self.start for word, _ in self.edges[state]}
        self.any_first = ANY in self.first  # a template begins with a replaceable region
        self.known: dict[frozenset, dict] = {}
        self.ends: dict[frozenset, list[str]] = {}

    def _state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def _compile(self, label: str, markup: str, at: int) -> int:
        opened, mandatory = [], 0
        for kind, low, high, word in _MARK.findall(markup):
            if word:
                nxt = self._state()
                self.edges[at].append((word.encode(), nxt))
                at, mandatory = nxt, mandatory + (not opened)
            elif kind == "beginOptional":
                opened.append(at)
            elif kind == "endOptional":
                nxt = self._state()
                self.empty[at].append(nxt)
                self.empty[opened.pop()].append(nxt)
                at = nxt
            elif kind == "var":
                exits = []
                for n in range(int(high)):
                    if n >= int(low):
                        exits.append(at)
                    nxt = self._state()
                    self.edges[at].append((ANY, nxt))
                    at = nxt
                for state in exits:
                    self.empty[state].append(at)
            else:
                raise ValueError(f"unknown markup {kind!r} in template {label!r}")
        if opened:
            raise ValueError(f"optional region without an end in template {label!r}")
        self.mandatory[label] = mandatory
        return at

    def _close(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in self.empty[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        """The next deterministic state; a match may begin at any word, so the start is always in it."""
        word = word if word in self.alphabet else b""
        row = self.known.setdefault(states, {})
        if word not in row:
            to = [nxt for s in states for w, nxt in self.edges[s] if w is ANY or w == word]
            row[word] = self._close(to) | self.start
        return row[word]

    def labels_at(self, states: frozenset) -> list[str]:
        if states not in self.ends:
            self.ends[states] = [self.accepts[s] for s in states if s in self.accepts]
        return self.ends[states]

    def scan(self, words: list[bytes]) -> dict[str, list[int]]:
        """Positions of the last word of every accepted place, by label."""
        found: dict[str, list[int]] = {}
        states, start, first, any_first = self.start, self.start, self.first, self.any_first
        step, labels_at = self.step, self.labels_at
        for at, word in enumerate(words):
            if states is start and word not in first and not any_first:
                continue
            states = step(states, word)
            if states == start:
                states = start
                continue
            for label in labels_at(states):
                found.setdefault(label, []).append(at)
        return found


def scanner(base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES):
    """A function from a text to n_words, n_base, first_word, last_word, base_labels, labels, score."""
    automaton = Automaton({f"base:{k}": v for k, v in base.items()} | {f"more:{k}": v for k, v in templates.items()})
    lengths = {f"base:{k}": len(v.split()) for k, v in base.items()}

    def scan(text):
        words = words_of(text)
        found = automaton.scan(words)
        starts = [at - lengths[label] + 1 for label, places in found.items() if label in lengths for at in places]
        base_labels = sorted({label[5:] for label in found if label in lengths})
        labels = sorted({label[5:] for label in found})
        # The longest mandatory wording met, against eight words, beyond which a match can hardly be by chance.
        score = min(1.0, max((automaton.mandatory[label] for label in found), default=0) / 8)
        first, last = (min(starts), max(starts)) if starts else (None, None)
        return len(words), len(starts), first, last, ",".join(base_labels), ",".join(labels), score

    return scan


def scan_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES,
) -> DataFrame:
    """License labels of each whole text, in one pass and without a shuffle."""
    return map_texts(
        id_text(docs, id_col, text_col), lambda: scanner(base, templates),
        "doc_id long,n_words long,n_base long,first_word long,last_word long,base_labels string,labels string,score double",
    )
