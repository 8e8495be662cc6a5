"""Secret scans with column functions only (operator 2).

Base patterns find assignments, access keys and hex runs. Beside them, every candidate string (a run of 20 or more
characters of the base64 or of the hex alphabet that holds a digit; without one it can't be told from joined words) is
judged by the Shannon entropy of a window that slides over it. The counts of all characters in the window are packed
into a few integers; moving the window by one character changes two counts, and the entropy follows from the change of
two terms. A candidate whose windows reach the threshold of its character class is a span from the first such window to
the last, unless the span lies within a base span. The allow-list has two parts: a candidate that is a plain number, a
public identifier or words joined by dashes is suppressed as a whole; a placeholder word suppresses what stands between
the `=` and `/` around it, so that a key beside such a word is still found.

Positions come from marked copies of the text: each match is enclosed in private characters, the text is split at them
and the lengths of the pieces are added up, block by block so that the work stays in proportion to the pieces. Private
characters in the text itself are replaced one for one first, which changes no position, as no pattern knows them.
Positions count code points; ends are exclusive.

Nulls count as the empty text, which has no spans. Repeated rows give repeated results; other columns are ignored or
passed on, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK, INNER, STAND_IN = "\ue000", "\ue001", "\ue002"
KINDS = ("assign", "access", "hex", "entropy_base64", "entropy_hex")  # in the order of spans that start together

# Fixed values.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = "(AKIA[A-Z0-9]+)"
HEX = "([0-9a-f]{16,})"  # runs are whole matches, so the least length may stand in the pattern
LEAST = {"assign": 12, "access": 18, "hex": 16}


@dataclass(frozen=True)
class CharacterClass:
    """An alphabet with the window and the entropy (bits a character) that mark a secret."""

    kind: str
    pattern: str
    alphabet: str
    window: int
    threshold: float


CLASSES = (
    CharacterClass(
        "entropy_base64", "([A-Za-z0-9+/_=-]{20,})",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 20, 3.66,
    ),
    CharacterClass("entropy_hex", "([0-9A-Fa-f]{20,})", "0123456789abcdefABCDEF", 20, 3.06),
)
ALLOWED = (
    "^[0-9]+$",
    "^[A-Za-z]+([-_/][A-Za-z]+)*[-_/]?[0-9]{0,4}$",
    "^[0-9A-Fa-f]{8}-([0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$",
)
# A stretch between separators that holds one of these is no part of a secret.
PLACEHOLDERS = "(?i)(example|sample|placeholder|changeme|abcdefgh|01234567|xxxxxx)"
STRETCH = "[=/]|[^=/]+"
SUPPRESSED = "."  # stands for a character of such a stretch; in no alphabet
BLOCK = 256  # elements of a list that one inner fold goes through


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pieces(text: str, pattern: str, replacement: str) -> str:
    """The text cut at the borders of all matches: matches are at the odd places."""
    return f"split(regexp_replace({text}, {_sql(pattern)}, '{MARK}{replacement}{MARK}'), '{MARK}')"


def _let(value: str, name: str, body: str) -> str:
    """`body` with `name` bound to the value, which is then computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _fold(items: str, state: str, kind: str, step: str, found: str) -> str:
    """Fold a list into one of structs of `kind`, block by block.

    `step` makes the state of `a` and `x`, `found` the list of structs (none or one) that x adds. A fold that appended to
    one list would copy it for each element; here lists of a block are copied, and then a list of blocks.
    """
    nothing = f"cast(array() as array<{kind}>)"
    inner = f"""aggregate(block, struct(a0.s as s, {nothing} as found), (b, x) -> {_let('b.s', 'a',
        f"struct({step} as s, concat(b.found, {found}) as found)")})"""
    blocks = f"transform(sequence(0, size(l) - 1, {BLOCK}), k -> slice(l, k + 1, {BLOCK}))"
    outer = f"""aggregate({blocks}, struct({state} as s, cast(array() as array<array<{kind}>>) as found),
        (a0, block) -> {_let(inner, 'r', 'struct(r.s as s, concat(a0.found, array(r.found)) as found)')},
        a0 -> flatten(a0.found))"""
    return _let(items, "l", f"if(size(l) = 0, {nothing}, {outer})")


def _places(pieces: str, kind: str, inner: bool = False) -> str:
    """Array of (start, kind, stop, offset, word) of the odd pieces; `inner` is cut out of the word, keeping the second group.

    `offset` is the start in bytes of the text.
    """
    word = f"substring_index(x, '{INNER}', -1)" if inner else "x"
    length = f"length(x) - {1 if inner else 0}"
    octets = f"octet_length(x) - {len(INNER.encode()) if inner else 0}"
    number = KINDS.index(kind)
    items = f"""transform({pieces}, (x, i) -> if(i % 2 = 0, struct(length(x) as n, octet_length(x) as o, '' as word, false as hit),
        struct({length} as n, {octets} as o, {word} as word, true as hit)))"""
    hit = f"struct(a.at as start, {number} as kind, a.at + x.n as stop, a.byte as offset, x.word as word)"
    fields = "struct<start: int, kind: int, stop: int, offset: int, word: string>"
    found = f"if(x.hit, array({hit}), cast(array() as array<{fields}>))"
    return _fold(items, "struct(0 as at, 0 as byte)", fields, "struct(a.at + x.n as at, a.byte + x.o as byte)", found)


def _hot_windows(word: str, own: CharacterClass) -> str:
    """(first, last): starts of the first and last window that reach the threshold, null if none does.

    Counts are packed: `per` of them in each of the integers c0, c1, ... Entropy of a window is log2(w) - total / w, where
    total adds c * log2(c) over the counts c; tables hold how a term changes when its count goes up or down by one.
    """
    w, size = own.window, len(own.alphabet)
    bits = w.bit_length()
    per = 60 // bits
    packs = range(-(-size // per))

    term = [c * math.log2(c) if c > 1 else 0.0 for c in range(w + 2)]
    table = lambda values: "array(" + ", ".join(f"{v!r}D" for v in values) + ")"
    up, down = table([term[c + 1] - term[c] for c in range(w + 1)]), table([0.0, *(term[c - 1] - term[c] for c in range(1, w + 1))])
    most = w * (math.log2(w) - own.threshold)
    # Where each character's count is; -1 for a suppressed one.
    at = f"transform(split({word}, ''), c -> instr('{own.alphabet}', c) - 1)"
    place = lambda k, name: f"if({k} < 0, -1, {k} div {per}) as {name}j, {bits} * pmod({k}, {per}) as {name}b"
    steps = f"transform(p, (k, i) -> struct({place('k', 'c')}, {place(f'coalesce(get(p, i - {w}), -1)', 'g')}, i >= {w} as moves))"

    def count(pack: str, bit: str) -> str:
        chosen = " ".join(f"when {n} then a.c{n}" for n in packs)
        return f"cast(shiftright(case {pack} {chosen} else 0L end, {bit}) & {(1 << bits) - 1} as int) + 1"

    changed = ", ".join(
        f"a.c{n} + if(x.cj = {n}, shiftleft(1L, x.cb), 0L) - if(x.gj = {n}, shiftleft(1L, x.gb), 0L) as c{n}" for n in packs
    )
    same = "x.cj = x.gj and x.cb = x.gb"
    come, go = f"if(x.cj < 0, 0D, element_at({up}, {count('x.cj', 'x.cb')}))", f"if(x.gj < 0, 0D, element_at({down}, {count('x.gj', 'x.gb')}))"
    # Whether the window before this step is hot is noted in this step, and that of the last step at the end.
    hot = f"a.n >= {w} and a.gaps = 0 and a.total <= {most!r}D"
    start = ", ".join(f"0L as c{n}" for n in packs)
    return _let(at, "p", f"""aggregate({steps},
        struct({start}, 0D as total, 0 as gaps, 0 as n, cast(null as int) as first, cast(null as int) as last),
        (a, x) -> struct({changed}, if({same}, a.total, a.total + {come} + {go}) as total,
            a.gaps + if(x.cj < 0, 1, 0) - if(x.moves and x.gj < 0, 1, 0) as gaps, a.n + 1 as n,
            if({hot}, coalesce(a.first, a.n - {w} + 1), a.first) as first, if({hot}, a.n - {w} + 1, a.last) as last),
        a -> struct(if({hot}, coalesce(a.first, a.n - {w} + 1), a.first) as first, if({hot}, a.n - {w} + 1, a.last) as last))""")


def _entropy_spans(text: str, own: CharacterClass, allowed: tuple[str, ...], placeholders: str) -> str:
    suppressed = " or ".join(f"s.word rlike {_sql(pattern)}" for pattern in allowed) or "false"
    candidates = f"filter({_places(_pieces(text, own.pattern, '$1'), own.kind)}, s -> s.word rlike '[0-9]' and not ({suppressed}))"
    judged = "s.word"
    if placeholders:
        judged = f"""if(s.word rlike {_sql(placeholders)}, array_join(transform(regexp_extract_all(s.word, {_sql(STRETCH)}, 0),
            x -> if(x rlike {_sql(placeholders)}, repeat('{SUPPRESSED}', length(x)), x)), ''), s.word)"""
    return f"""filter(transform(transform({candidates}, s -> struct(s as s, {_hot_windows(judged, own)} as h)),
        c -> struct(c.s.start + c.h.first - 1 as start, c.s.kind as kind, c.s.start + c.h.last - 1 + {own.window} as stop,
            c.s.offset + c.h.first - 1 as offset)), s -> s.start is not null)"""


def with_spans(
    docs: DataFrame, text_col: str = "text", spans_col: str = "spans", allowed: tuple[str, ...] = ALLOWED,
    classes: tuple[CharacterClass, ...] = CLASSES, placeholders: str = PLACEHOLDERS,
) -> DataFrame:
    """Add an array of (start, kind, stop, offset) structs, sorted by start and kind.

    kind is the number in KINDS, offset the start in bytes. A column named `spans_col` is replaced.
    """
    t = f"replace(replace(coalesce(`{text_col}`, ''), '{MARK}', '{STAND_IN}'), '{INNER}', '{STAND_IN}')"
    base = [
        f"filter({_places(_pieces(t, ASSIGN, f'$1{INNER}$2'), 'assign', inner=True)}, s -> length(s.word) >= {LEAST['assign']})",
        f"filter({_places(_pieces(t, ACCESS, '$1'), 'access')}, s -> length(s.word) >= {LEAST['access']})",
        f"filter({_places(_pieces(t, HEX, '$1'), 'hex')}, s -> length(s.word) >= {LEAST['hex']})",
    ]
    plain = "struct(s.start as start, s.kind as kind, s.stop as stop, s.offset as offset)"
    base = f"transform(concat({', '.join(base)}), s -> {plain})"
    more = ", ".join(_entropy_spans(t, own, allowed, placeholders) for own in classes)
    # In order of starts, base spans first, a further span is within a base span if one before it reaches its end.
    fields = "struct<start: int, kind: int, stop: int, offset: int>"
    within = f"x.kind >= {len(LEAST)} and x.stop <= a"
    outer = _fold(
        f"array_sort(concat({base}, {more}))", "-1", fields, f"if(x.kind < {len(LEAST)}, greatest(a, x.stop), a)",
        f"if({within}, cast(array() as array<{fields}>), array(x))",
    )
    return docs.withColumn(spans_col, F.expr(outer))


def _listed(spans: str) -> str:
    names = f"array({', '.join(map(repr, KINDS))})"
    return f"array_join(transform({spans}, s -> concat_ws(':', {names}[s.kind], s.start, s.stop)), ',')"


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans as text."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spans = with_spans(narrow, "text", "found").select("doc_id", "found")
    count = lambda n: F.expr(f"cast(size(filter(found, s -> s.kind = {n})) as bigint)")
    return spans.select(
        "doc_id", *(count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS[:3])),
        F.sha2(F.expr(_listed("filter(found, s -> s.kind < 3)")), 256).alias("base_sha256"),
        F.expr(_listed("found")).alias("spans"),
    )


def redacted(text: Column, spans: Column, stand_in: str = "[SECRET]") -> Column:
    """The text with each span (overlapping ones together) replaced by `stand_in`; unchanged without spans."""
    nothing = F.array().cast("array<string>")

    def walked(raw: Column) -> Column:
        def add(b: Column, s: Column) -> Column:
            stop = s.offset + s.stop - s.start  # spans are of one-byte characters
            kept = F.substring(raw, b.at + 1, s.offset - b.at).cast("string")
            return F.when(
                s.offset >= b.at, F.struct(stop.alias("at"), F.concat(b.out, F.array(kept, F.lit(stand_in))).alias("out"))
            ).otherwise(F.struct(F.greatest(b.at, stop).alias("at"), b.out.alias("out")))

        def add_block(a: Column, block: Column) -> Column:
            inner = F.aggregate(block, F.struct(a.at.alias("at"), nothing.alias("out")), add)
            return F.struct(inner.at.alias("at"), F.concat(a.out, F.array(F.array_join(inner.out, ""))).alias("out"))

        blocks = F.transform(F.sequence(F.lit(0), F.size(spans) - 1, F.lit(BLOCK)), lambda k: F.slice(spans, k + 1, BLOCK))
        rest = lambda a: F.concat(F.array_join(a.out, ""), F.substring(raw, a.at + 1, F.octet_length(raw)).cast("string"))
        return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), nothing.alias("out")), add_block, rest)

    # The bytes of the text are bound once: a substring of bytes is found by its place, one of a string by counting.
    replaced = F.element_at(F.transform(F.array(text.cast("binary")), walked), 1)
    return F.when(F.size(spans) == 0, text).otherwise(replaced)
