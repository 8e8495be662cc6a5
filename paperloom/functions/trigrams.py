"""Trigrams of texts, and the trigrams that a text must have if a regex occurs in it.

Texts and regexes are compared without case, in ASCII letters: the few other letters that a case-insensitive search takes
for ASCII ones are folded as well, and all further characters are in no trigram.

A requirement is a formula: a trigram's number, ("and", parts), ("or", parts), or ALWAYS where a regex requires nothing
that an index could tell. It is necessary, not sufficient: what fulfils it is searched with the regex itself.
"""

from __future__ import annotations

import re
from re import _constants as kinds
from re import _parser as regexes

from pyspark.sql import Column
from pyspark.sql import functions as F

ALWAYS = "always"
Formula = str | int | tuple
ASCII = 128
# Letters that match ASCII ones without regard to case (Kelvin sign, long s, dotted and dotless i), and those (fixed values).
FOLDED, FOLDED_TO = "Kſİı", "ksii"
# Alternatives that are followed at once, and characters of each; beyond it a requirement is cut into several.
ALTERNATIVES, LENGTH = 64, 64


def number(trigram: str) -> int:
    a, b, c = map(ord, trigram)
    return (a * ASCII + b) * ASCII + c


def trigrams(text: Column) -> Column:
    """Numbers of the distinct trigrams of ASCII characters in a text, without case; none for a null text."""
    folded = F.lower(F.translate(F.coalesce(text, F.lit("")), FOLDED, FOLDED_TO))
    codes = F.transform(F.split(folded, ""), F.ascii)

    def at(codes: Column) -> Column:
        second, third = (lambda i, k=k: F.get(codes, i + k) for k in (1, 2))
        own = lambda c, i: F.when(
            F.greatest(c, second(i), third(i)) < ASCII, (c * ASCII + second(i)) * ASCII + third(i)
        )
        # At the end of a text get() is null, which greatest() passes over and the sum does not.
        return F.array_distinct(F.array_compact(F.transform(codes, own)))

    return F.element_at(F.transform(F.array(codes), at), 1)


def _both(parts: list[Formula]) -> Formula:
    parts = list(dict.fromkeys(p for p in parts if p is not ALWAYS))
    return ALWAYS if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _either(parts: list[Formula]) -> Formula:
    parts = list(dict.fromkeys(parts))
    return ALWAYS if any(p is ALWAYS for p in parts) else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_texts(texts: frozenset[str]) -> Formula:
    """One of the texts occurs."""
    return _either([_both([number(t[i : i + 3]) for i in range(len(t) - 2)]) for t in sorted(texts)])


# What is known of a part of a regex: all texts it can match (None: too many or not known), and else what it requires.
Known = tuple[frozenset[str] | None, Formula]
NOTHING: Known = (frozenset([""]), ALWAYS)
ANYTHING: Known = (None, ALWAYS)


def _requirement(known: Known) -> Formula:
    texts, formula = known
    return formula if texts is None else _of_texts(texts)


def _sequence(items) -> Known:
    texts, formulas = frozenset([""]), []
    for item in items:
        more, formula = _part(item)
        joined = None
        if more is not None and len(texts) * len(more) <= ALTERNATIVES:
            joined = frozenset(a + b for a in texts for b in more)
        if joined is not None and max(map(len, joined)) <= LENGTH:
            texts = joined
            continue
        formulas += [_of_texts(texts), formula]
        texts = more if more is not None else frozenset([""])
    if not formulas:
        return texts, ALWAYS
    return None, _both([*formulas, _of_texts(texts)])


def _part(item) -> Known:
    kind, value = item
    if kind is kinds.LITERAL:
        return (frozenset([chr(value).lower()]), ALWAYS) if value < ASCII else ANYTHING
    if kind is kinds.IN:
        codes: set[int] = set()
        for own, members in value:
            if own is kinds.LITERAL:
                codes.add(members)
            elif own is kinds.RANGE and members[1] - members[0] < ALTERNATIVES:
                codes.update(range(members[0], members[1] + 1))
            else:
                return ANYTHING
        return (frozenset(chr(c).lower() for c in codes), ALWAYS) if all(c < ASCII for c in codes) else ANYTHING
    if kind is kinds.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        if all(texts is not None for texts, _ in parts):
            texts = frozenset().union(*(texts for texts, _ in parts))
            if len(texts) <= ALTERNATIVES:
                return texts, ALWAYS
        return None, _either([_requirement(part) for part in parts])
    if kind is kinds.SUBPATTERN:
        return _sequence(value[-1])
    if kind is kinds.ATOMIC_GROUP:
        return _sequence(value)
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
        low, high, inner = value
        texts, formula = _sequence(inner)
        if low == 0:
            return (texts | {""}, ALWAYS) if high == 1 and texts is not None else ANYTHING
        return (texts, ALWAYS) if low == high == 1 and texts is not None else (None, _requirement((texts, formula)))
    if kind in (kinds.AT, kinds.ASSERT, kinds.ASSERT_NOT):
        return NOTHING
    return ANYTHING


def required(regex: str) -> Formula:
    """The trigrams that a text in which the regex occurs (without regard to case) must have; ALWAYS if none are known."""
    try:
        parsed = regexes.parse(regex, re.IGNORECASE | re.MULTILINE)
    except (re.error, OverflowError, RecursionError):
        return ALWAYS  # a regex in a dialect of its own
    if parsed.state.flags & re.VERBOSE or "\\Q" in regex or "&&" in regex:
        return ALWAYS  # constructs that the two dialects read differently
    return _requirement(_sequence(parsed))


def numbers(formula: Formula) -> set[int]:
    """All trigrams of a formula."""
    if formula is ALWAYS:
        return set()
    return {formula} if isinstance(formula, int) else set().union(*map(numbers, formula[1]))


def holds(formula: Formula, present: Column) -> Column:
    """Whether the formula holds for an array of trigrams."""
    if formula is ALWAYS:
        return F.lit(True)
    if isinstance(formula, int):
        return F.array_contains(present, formula)
    parts = [holds(part, present) for part in formula[1]]
    out = parts[0]
    for part in parts[1:]:
        out = out & part if formula[0] == "and" else out | part
    return out
