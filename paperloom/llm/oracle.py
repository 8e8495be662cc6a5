"""DuckDB SQL of the registered queries that SQL can express.

The SQL takes another road wherever there is one: license templates as regular expressions instead of automata, entropies
of windows counted from scratch, repeated windows by grouping their words, scores by a join.
"""

from __future__ import annotations

import re

EXACT_TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores
QUALIFY rank <= 20
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
    SELECT row, words, unnest(range(1, len(words) - 33)) AS s FROM d WHERE len(words) >= 35
), windows AS (
    SELECT row, s, count(*) OVER (PARTITION BY md5(array_to_string(list_slice(words, s, s + 34), ' '))) AS n FROM starts
), covered AS (
    SELECT DISTINCT row, unnest(range(s, s + 35)) AS p FROM windows WHERE n > 1
), w AS (
    SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d
), kept AS (
    SELECT row, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM w ANTI JOIN covered USING (row, p) GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row)
"""


def license_scan(base: dict[str, str], templates: dict[str, str]) -> str:
    """Templates as regular expressions over the words, each with a blank before it."""

    def pattern(markup: str) -> tuple[str, int]:
        out, mandatory, depth = "", 0, 0
        for kind, low, high, word in re.findall(r"<<(\w+)(?:;(\d+);(\d+))?>>|(\S+)", markup):
            if word:
                out, mandatory = f"{out} {word}", mandatory + (not depth)
            elif kind == "var":
                out += f"(?: [^ ]+){{{low},{high}}}"
            else:
                out, depth = (f"{out}(?:", depth + 1) if kind == "beginOptional" else (f"{out})?", depth - 1)
        return out + " ", mandatory

    places = []
    for phrase in base.values():
        words = phrase.split()
        listed = ", ".join(f"'{w}'" for w in words)
        places.append(f"list_filter(range(1, len(words) + 1), lambda i: list_slice(words, i, i + {len(words) - 1}) = [{listed}])")
    labels, weights = [], []
    for label, markup in [*base.items(), *templates.items()]:
        regex, mandatory = pattern(markup)
        labels.append(f"CASE WHEN regexp_matches(line, '{regex}') THEN '{label}' END")
        weights.append(f"CASE WHEN regexp_matches(line, '{regex}') THEN {mandatory} ELSE 0 END")
    text = lambda parts: f"array_to_string(list_sort(list_distinct(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL))), ',')"
    return rf"""
    WITH w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ), p AS (
        SELECT doc_id, words, ' ' || array_to_string(words, ' ') || ' ' AS line, list_concat({', '.join(places)}) AS places FROM w
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
        CAST(list_min(places) - 1 AS BIGINT) AS first_word, CAST(list_max(places) - 1 AS BIGINT) AS last_word,
        {text(labels[: len(base)])} AS base_labels, {text(labels)} AS labels,
        least(1.0, CAST(greatest({', '.join(weights)}) AS DOUBLE) / 8) AS score
    FROM p
    """


def secret_scan(kinds, patterns: dict[str, tuple[str, int, int]], classes, allowed, placeholders: str, stretch: str) -> str:
    """`patterns`: regular expression, number of groups and least length of its last group, for each base kind."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def matches(name: str, regex: str, groups: int) -> str:
        marked = "chr(57344) || '\\1' || " + ("chr(57345) || '\\2' || " if groups == 2 else "") + "chr(57344)"
        return f"""{name}_pieces AS (
            SELECT row, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i
            FROM (SELECT row, string_split(regexp_replace(t, {quoted(regex)}, {marked}, 'g'), chr(57344)) AS pieces FROM d)
        ), {name} AS (
            SELECT * FROM (
                SELECT row, i, replace(piece, chr(57345), '') AS whole,
                    CASE WHEN contains(piece, chr(57345)) THEN string_split(piece, chr(57345))[2] ELSE piece END AS word,
                    CAST(sum(length(replace(piece, chr(57345), ''))) OVER (PARTITION BY row ORDER BY i) AS BIGINT) AS stop
                FROM {name}_pieces)
            WHERE i % 2 = 0
        )"""

    parts = [matches(kind, regex, groups) for kind, (regex, groups, _) in patterns.items()]
    base = " UNION ALL ".join(
        f"SELECT row, {kinds.index(kind)} AS kind, stop - length(whole) AS start, stop FROM {kind} WHERE length(word) >= {least}"
        for kind, (_, _, least) in patterns.items()
    )
    more = []
    for own in classes:
        parts.append(matches(own.kind, own.pattern, 1))
        suppressed = " OR ".join(f"regexp_matches(word, {quoted(a)})" for a in allowed)
        parts.append(f"""{own.kind}_windows AS (
            SELECT row, i, origin, s, part FROM (
                SELECT row, i, stop - length(whole) AS origin, s, substr(array_to_string(list_transform(
                        regexp_extract_all(word, {quoted(stretch)}),
                        lambda x: CASE WHEN regexp_matches(x, {quoted(placeholders)}) THEN repeat('.', length(x)) ELSE x END), ''),
                    s, {own.window}) AS part
                FROM (SELECT *, unnest(range(1, length(word) - {own.window} + 2)) AS s FROM {own.kind}
                      WHERE regexp_matches(word, '[0-9]') AND NOT ({suppressed})))
            WHERE NOT contains(part, '.')
        ), {own.kind}_entropies AS (
            SELECT row, i, origin, s, -sum(n / {own.window}.0 * log2(n / {own.window}.0)) AS h
            FROM (SELECT row, i, origin, s, c, count(*) AS n FROM
                    (SELECT row, i, origin, s, unnest(string_split(part, '')) AS c FROM {own.kind}_windows) WHERE c <> '' GROUP BY ALL)
            GROUP BY row, i, origin, s
        )""")
        more.append(
            f"SELECT row, {kinds.index(own.kind)} AS kind, origin + min(s) - 1 AS start, origin + max(s) - 1 + {own.window} AS stop"
            f" FROM {own.kind}_entropies WHERE h >= {own.threshold} GROUP BY row, i, origin"
        )
    names = "[" + ", ".join(f"'{k}'" for k in kinds) + "]"
    span = f"{names}[kind + 1] || ':' || start || ':' || stop"
    return f"""
    WITH d AS (
        SELECT row_number() OVER () AS row, doc_id,
            translate(coalesce(text, ''), chr(57344) || chr(57345), chr(57346) || chr(57346)) AS t
        FROM documents
    ), {', '.join(parts)},
    base AS ({base}),
    more AS ({' UNION ALL '.join(more)}),
    spans AS (
        SELECT * FROM base UNION ALL
        SELECT * FROM more m WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row = m.row AND b.start <= m.start AND b.stop >= m.stop)
    ), listed AS (
        SELECT row, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h,
            string_agg({span}, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg({span}, ',' ORDER BY start, kind) AS spans
        FROM spans GROUP BY row
    )
    SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN listed USING (row)
    """
