"""The registered queries once more, as plain DuckDB SQL over the same tables.

Nothing is imported from the engine: a wrong label, regex or seed there must show as a difference here.
"""

from __future__ import annotations

import zlib

# Fixed values, written out a second time: codes in registry order, the labels made of them, topic and seed.
CODES = (
    "AI", "LG", "CV", "CL", "AR", "CC", "CE", "CG", "CR", "CY", "DB", "DC", "DL", "DM", "DS", "ET", "FL", "GL", "GR", "GT",
    "HC", "IR", "IT", "LO", "MA", "MM", "MS", "NA", "NE", "NI", "OH", "OS", "PF", "PL", "RO", "SC", "SD", "SE", "SI", "SY",
)
LABELS = [("cs" + code.lower(), rf"cs\.{code}") for code in CODES]
REGISTRY = [("cs", r"(^cs\.)|( cs\.)"), *LABELS]
TOPIC = "and( |-)the"
SEED = 42


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _registry(registry: list[tuple[str, str]]) -> str:
    rows = ", ".join(f"({_text(name)}, {_text(regex)}, {i})" for i, (name, regex) in enumerate(registry))
    return f"(VALUES {rows}) r(cate, regex, ord)"


def _with(sql: str, *names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in names) + " " + sql


_CODES = "[" + ", ".join(_text(c) for c in CODES) + "]"
_KEY = r"lower(regexp_replace(title, '[^\p{L}]', '', 'g'))"
_TOPIC = f"(regexp_matches(title, {_text('(?im)' + TOPIC)}) OR regexp_matches(abstract, {_text('(?im)' + TOPIC)}))"

CTES = {
    "papers": """
        SELECT doc_id AS id, 's' || doc_id AS s2_id, split_part(text, chr(10), 1) AS title, text AS abstract,
               split_part(split_part(text, chr(10), 1), ' ', 1) || '|' ||
               split_part(split_part(text, chr(10), 1), ' ', 2) AS authors,
               source AS venue, CAST(1990 + doc_id % 35 AS INT) AS year, CAST(n_chars % 100 AS INT) AS n_citations,
               source AS partition
        FROM documents""",
    "snapshot": f"""
        SELECT CAST(doc_id AS VARCHAR) AS id, split_part(text, chr(10), 1) AS title, text AS abstract, source, lang,
               'cs.' || {_CODES}[CAST(substr(source, 4) AS INT) + 1] ||
               CASE lang WHEN 'en' THEN ' cs.LG' WHEN 'fr' THEN ' stat.ML' WHEN 'de' THEN ' math.OC cs.PL'
                    ELSE ' physics.plasm-ph' END AS categories
        FROM documents""",
    "labelled": f"SELECT s.*, r.cate FROM snapshot s JOIN {_registry(LABELS)} ON regexp_matches(s.categories, r.regex)",
    "corpus_titles": """
        SELECT doc_id AS id, split_part(text, chr(10), 1) AS title FROM documents
        UNION ALL
        SELECT -page_id - 1, regexp_extract(html, '<title>([^<]*)</title>', 1) FROM pages""",
    "title_index": f"""
        SELECT cate, title_key, id AS arxiv_id, title AS a_title, categories FROM (
            SELECT *, {_KEY} AS title_key,
                   row_number() OVER (PARTITION BY cate, {_KEY} ORDER BY CAST(id AS BIGINT) DESC) AS rn
            FROM labelled) WHERE rn = 1""",
    "matches": f"""
        SELECT i.cate, c.id, i.arxiv_id, i.categories, i.a_title, c.title AS s_title
        FROM (SELECT *, {_KEY} AS title_key FROM corpus_titles) c JOIN title_index i USING (title_key)""",
    "label_rows": f"""
        SELECT r.cate, count(m.id) AS count, CAST(r.ord AS INT) AS ord
        FROM {_registry(LABELS)} LEFT JOIN matches m ON m.cate = r.cate GROUP BY r.cate, r.ord""",
    "gappy": """
        SELECT p.id, title,
               CASE WHEN toxic = 1 THEN '' WHEN year = 1999 THEN NULL ELSE abstract END AS abstract,
               CASE WHEN quality = 0 THEN '' WHEN quality = 1 THEN venue END AS venue,
               CASE WHEN n_citations < 90 THEN year END AS year, n_citations, p.s2_id, p.authors
        FROM papers p LEFT JOIN labels l ON l.doc_id = p.id""",
    "shard_records": """
        SELECT 's' || doc_id AS s2_id, split_part(text, chr(10), 1) AS title, text AS abstract,
               string_split(split_part(text, chr(10), 1), ' ') AS words,
               CASE lang WHEN 'en' THEN ['Computer Science'] WHEN 'fr' THEN ['Mathematics', 'Computer Science']
                    WHEN 'de' THEN ['Physics'] END AS fields,
               CASE WHEN source = 'src7' THEN '' ELSE source END AS venue,
               CASE WHEN n_chars >= 300 THEN CAST(1990 + doc_id % 35 AS INT) END AS year, n_chars,
               source AS partition
        FROM documents""",
    "shaped": f"""
        SELECT s2_id, title, abstract, array_to_string(words, '|') AS authors, venue, year,
               CASE WHEN n_chars >= 500 THEN CAST(len(words) AS INT) ELSE 0 END AS n_citations,
               {_KEY} AS title_key, partition
        FROM shard_records
        WHERE list_contains(fields, 'Computer Science') AND venue IS DISTINCT FROM '' AND abstract <> ''
          AND year IS NOT NULL""",
    "worklist": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CASE WHEN o_orderstatus = 'F' THEN CASE substr(o_orderpriority, 1, 1) WHEN '4' THEN ''
                    WHEN '2' THEN NULL ELSE o_orderpriority END END AS venue,
               CASE WHEN o_orderstatus = 'F' THEN CAST(year(o_orderdate) AS INT) END AS year,
               CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS INT) END AS n_citations,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 0 WHEN '5' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 2
                    END AS partition,
               CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS filled
        FROM orders""",
    "staging": """
        SELECT CAST(l_orderkey AS VARCHAR) AS id,
               CASE WHEN max(l_returnflag) = 'R' THEN min(l_linestatus) END AS venue,
               CASE WHEN max(l_returnflag) = 'R' THEN CAST(max(year(l_shipdate)) AS INT) END AS year,
               CASE WHEN max(l_returnflag) = 'R' THEN CAST(count(*) AS INT) END AS n_citations,
               CASE min(l_linenumber) WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 END AS partition,
               CASE max(l_returnflag) WHEN 'R' THEN 1 WHEN 'N' THEN 2 ELSE 0 END AS filled
        FROM lineitem GROUP BY l_orderkey""",
    "pending": """
        SELECT id, partition FROM worklist w
        WHERE partition IN (0, 1, 2) AND filled = 0 AND NOT EXISTS (
            SELECT 1 FROM staging s WHERE s.id = w.id AND s.partition IN (0, 1, 2) AND s.filled IS DISTINCT FROM 0)""",
    "complete_bodies": """
        SELECT event_id, event_type AS kind, value, props, CAST(user_id AS VARCHAR) AS usr,
               '{"venue": "v' || user_id || '", "year": ' || CASE WHEN value < 5 THEN 'null' ELSE '2001' END ||
               ', "citationCount": ' || user_id || '}' AS ok
        FROM events""",
    "responses": """
        SELECT CAST(event_id AS VARCHAR) AS id,
               CASE kind WHEN 'error' THEN 403 WHEN 'purchase' THEN 404 ELSE 200 END AS status,
               CASE WHEN kind = 'click' THEN ok
                    WHEN kind = 'view' THEN replace(ok, 'citationCount', 'citations')
                    WHEN kind = 'signup' AND value < 5 THEN '[' || usr || ']'
                    WHEN kind = 'signup' THEN '{"error": "no paper ' || usr || '"}'
                    WHEN kind = 'error' AND value < 5 THEN '<html>forbidden</html>'
                    WHEN kind = 'error' AND value < 10 THEN '[403]'
                    WHEN kind = 'purchase' AND value < 5 THEN 'null'
                    ELSE props END AS body
        FROM complete_bodies""",
    "classified": """
        SELECT id, body, CAST(CASE
            WHEN NOT json_valid(body) THEN 2
            WHEN status = 403 THEN 0
            WHEN json_type(body) <> 'OBJECT' THEN 2
            WHEN coalesce(json_type(body, '$.error'), 'NULL') <> 'NULL' THEN 2
            WHEN json_exists(body, '$.venue') AND json_exists(body, '$.year')
                 AND json_exists(body, '$.citationCount') THEN 1
            ELSE 2 END AS INT) AS state
        FROM responses""",
    "seeds": """
        SELECT item_id AS seed_id, 'documents' AS source, item_id AS id, 'seed' || item_id AS s2_id,
               split_part(text, chr(10), 1) AS title, text AS abstract, 'seed venue' AS venue, 'A|B' AS authors
        FROM benchmark""",
    "toxic_french": """
        SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE lang = 'fr' AND toxic = 1""",
    "repeated_staging": """
        SELECT * FROM staging UNION ALL SELECT * FROM staging UNION ALL
        SELECT id, NULL, NULL, NULL, partition, 2 FROM staging WHERE CAST(id AS BIGINT) % 2 = 0""",
    "folded_staging": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE filled WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END,
            (venue IS NULL)::INT + (year IS NULL)::INT + (n_citations IS NULL)::INT) AS rn FROM repeated_staging) WHERE rn = 1""",
    "asked_again": """
        SELECT * FROM classified
        UNION ALL
        SELECT id, CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN '{"error": "gone"}'
                   ELSE regexp_replace(body, '"venue": "v[0-9]+"', '"venue": null') END,
               CAST(CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN 2 ELSE state END AS INT) FROM classified""",
    "settled": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY state,
            (CASE WHEN state = 1 THEN body ->> '$.venue' END IS NULL)::INT) AS rn FROM asked_again WHERE state <> 0) WHERE rn = 1""",
    "checklist": """
        SELECT source AS partition, CAST(max(CASE WHEN lang = 'de' AND n_chars > 3000 THEN 1
            WHEN source IN (SELECT source FROM toxic_french) THEN 1 ELSE 0 END) AS INT) AS is_checked
        FROM documents GROUP BY source""",
    "page_parts": """
        SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS lang, regexp_extract(url, '[^/]*$') AS last
        FROM pages""",
}

_MATCH = ("snapshot", "labelled", "corpus_titles", "title_index", "matches")


def _ordered(table: str, key: str) -> str:
    return f"row_number() OVER (ORDER BY md5('{SEED}:' || {key}), {key}) AS pos FROM {table}"


def _three_way(position: str, total: str) -> str:
    return f"CAST(CASE WHEN {position} <= {total} // 3 THEN 0 WHEN {position} <= 2 * ({total} // 3) THEN 1 ELSE 2 END AS INT)"


def _present(field: str) -> str:
    return f"SELECT id, '{field}' AS field, CAST({field} AS VARCHAR) AS value FROM gappy WHERE {field} IS NOT NULL"


def _status(part: int) -> str:
    wanted = "(0, 1, 2)" if part == -1 else f"({part})"
    return f"""
        SELECT {part} AS part, *, printf('%d hrs %02d min %02d sec', unfilled * 3 // 3600,
               unfilled * 3 % 3600 // 60, unfilled * 3 % 60) AS eta
        FROM (SELECT
            (SELECT count(DISTINCT id) FROM both_tables WHERE filled = 1 AND partition IN {wanted}) AS filled,
            (SELECT count(DISTINCT id) FROM both_tables WHERE filled = 2 AND partition IN {wanted}) AS error,
            (SELECT count(*) FROM worklist WHERE filled = 0 AND partition IN {wanted}) AS unfilled,
            (SELECT count(*) FROM worklist WHERE filled IN (0, 1, 2) AND partition IN {wanted}) AS total,
            (SELECT count(*) FROM worklist w WHERE filled = 0 AND partition IN {wanted} AND NOT EXISTS (
                SELECT 1 FROM staging s WHERE s.id = w.id AND s.filled IN (1, 2)
                AND s.partition IN {wanted})) AS pending_net)"""


def _comparable(rows: str) -> str:
    return f"""SELECT id, venue, CAST(year AS VARCHAR) AS year, CAST(n_citations AS VARCHAR) AS n_citations,
        CAST(partition AS VARCHAR) AS partition, filled FROM ({rows})"""


def _masked(mask: str) -> str:
    values = {"title": "' '", "abstract": "' '", "venue": "' '", "year": "' '", "authors": "''", "n_citations": "0"}
    year = "' '" if mask == "year" else "CAST(year AS VARCHAR)"
    cols = [f"{values[c] if c == mask else c} AS {c}" for c in ("title", "abstract", "venue", "authors", "n_citations")]
    return f"SELECT '{mask}' AS masking, s2_id, {year} AS year, {', '.join(cols)} FROM gappy"


def _text_variants() -> str:
    fields = ("title", "abstract", "venue", "authors")
    seed = {"title": "split_part(r_name, chr(10), 1)", "abstract": "r_name", "venue": "'seed venue'", "authors": "'A|B'"}
    selects = []
    for feature in fields:
        cols = ", ".join(f"{'p.' + f if f == feature else seed[f]} AS {f}" for f in fields)
        selects.append(
            f"""SELECT CAST(r_regionkey AS BIGINT) AS seed_id, 'documents' AS source, '{feature}' AS feature,
                CAST(r_regionkey AS BIGINT) AS id, 'seed' || r_regionkey AS s2_id, {cols}, 2000 AS year, 7 AS n_citations
                FROM region CROSS JOIN papers p"""
        )
    return " UNION ALL ".join(selects)


SQL: dict[str, str] = {
    "category_filter": _with(
        f"SELECT id, title, categories FROM snapshot WHERE regexp_matches(categories, {_text(dict(REGISTRY)['cspl'])})",
        "snapshot",
    ),
    "category_labels": _with(
        f"SELECT s.id, r.cate FROM snapshot s JOIN {_registry(REGISTRY)} ON regexp_matches(s.categories, r.regex)",
        "snapshot",
    ),
    "category_count": _with(
        r"SELECT count(*) FILTER (WHERE regexp_matches(categories, 'cs\.LG')) AS matched, count(*) AS total FROM snapshot",
        "snapshot",
    ),
    "topic_filter": _with(f"SELECT id, title, abstract FROM papers WHERE {_TOPIC}", "papers"),
    "topic_filter_indexed": _with(f"SELECT id, title, abstract FROM papers WHERE {_TOPIC}", "papers"),
    # All trigrams of "and the" or all of "and-the" occur somewhere in the titles and abstracts of 128 ids.
    "topic_candidates": _with(
        f"""SELECT CAST(granule AS BIGINT) AS granule FROM (
               SELECT id // 128 AS granule, translate(lower(coalesce(title, '') || chr(128) || coalesce(abstract, '')), '\u212a\u017f\u0131', 'ksi') AS t
               FROM papers WHERE partition IN (SELECT partition FROM checklist WHERE is_checked = 1))
           GROUP BY granule
           HAVING bool_or(contains(t, 'and')) AND bool_or(contains(t, 'the'))
               AND ((bool_or(contains(t, 'nd ')) AND bool_or(contains(t, 'd t')) AND bool_or(contains(t, ' th')))
                 OR (bool_or(contains(t, 'nd-')) AND bool_or(contains(t, 'd-t')) AND bool_or(contains(t, '-th'))))""",
        "papers", "toxic_french", "checklist",
    ),
    "topic_count": _with(
        f"SELECT count(*) FILTER (WHERE {_TOPIC}) AS matched, count(*) AS total FROM papers", "papers"
    ),
    "drop_columns": _with(
        r"""SELECT id, title, abstract, source AS report_no,
            '[["' || split_part(title, ' ', 2) || '","' || split_part(title, ' ', 1) || '"],["' || source || '","' ||
            lang || '","jr"]]' AS authors_parsed, 'abstract authors_parsed id report-no title' AS kept
            FROM snapshot WHERE regexp_matches(categories, '(^cs\.)|( cs\.)')""",
        "snapshot",
    ),
    "completeness_filter": _with(
        """SELECT id, title, abstract, venue, year, n_citations FROM gappy
           WHERE venue IS DISTINCT FROM '' AND abstract <> '' AND year IS NOT NULL""",
        "papers", "gappy",
    ),
    "array_membership": _with("SELECT * FROM shaped", "shard_records", "shaped"),
    "author_names": _with(
        """SELECT id, split_part(title, ' ', 1) || ' ' || split_part(title, ' ', 2) || '|' || lang || ' ' || source
           AS authors FROM snapshot""",
        "snapshot",
    ),
    "authors_decode": _with(
        """SELECT id, 0 AS pos, split_part(title, ' ', 1) AS author FROM papers
           UNION ALL SELECT id, 1, split_part(title, ' ', 2) FROM papers""",
        "papers",
    ),
    "drop_null_fields": _with(
        " UNION ALL ".join(_present(f) for f in ("id", "title", "abstract", "venue", "year", "n_citations")),
        "papers", "gappy",
    ),
    "title_key": _with(f"SELECT id, {_KEY} AS title_key FROM corpus_titles", "corpus_titles"),
    "extract_topic": _with(
        f"""SELECT DISTINCT id, (SELECT count(*) FROM papers WHERE {_TOPIC}) AS matched, (SELECT count(*) FROM papers) AS total,
            (SELECT count(DISTINCT id) FROM papers WHERE {_TOPIC}) AS picked FROM papers WHERE {_TOPIC}""",
        "papers",
    ),
    "derived_names": _with(
        "SELECT page_id, last || '.' || lang AS shard, host AS source, split_part(lang, '_', 1) AS cate FROM page_parts",
        "page_parts",
    ),
    "audit_cleanup": """
        SELECT doc_id, replace(replace(replace(text, ' ', '  '), chr(10), ''), '  ', ' ') AS a_title,
               replace(replace(text, ' ', '  '), chr(10), '') AS s_title FROM documents""",
    # CRC-32 of the four languages, from the standard checksum.
    "crc_tokens": f"""
        SELECT lang, CASE lang {' '.join(f"WHEN '{c}' THEN '{hex(zlib.crc32(c.encode()))}'" for c in ('en', 'fr', 'de', 'es'))} END
        AS token, count(*) AS n FROM documents GROUP BY lang""",
    "title_match": _with("SELECT cate, id, arxiv_id FROM matches", *_MATCH),
    "title_match_shuffled": _with("SELECT cate, id, arxiv_id FROM matches", *_MATCH),
    "match_rate": _with(
        f"""SELECT r.cate, coalesce(n_keys, 0) AS n_keys, coalesce(n_matches, 0) AS n_matches,
                  CAST(round(100.0 * coalesce(n_matches, 0) / nullif(n_keys, 0), 2) AS DOUBLE) AS rate
           FROM {_registry(LABELS)} LEFT JOIN (SELECT cate, count(*) AS n_keys FROM title_index GROUP BY cate) k USING (cate)
           LEFT JOIN (SELECT cate, count(*) AS n_matches FROM matches GROUP BY cate) m USING (cate)""",
        *_MATCH,
    ),
    "match_audit": _with(
        """SELECT cate, id, categories, replace(replace(a_title, chr(10), ''), '  ', ' ') AS a_title,
           replace(s_title, chr(10), '') AS s_title FROM matches""",
        *_MATCH,
    ),
    "label_counts": _with("SELECT * FROM label_rows ORDER BY count DESC, ord", *_MATCH, "label_rows"),
    "label_totals": _with(
        """SELECT cate, CAST(sum(count) AS BIGINT) AS count, count(*) AS n_labels FROM label_rows
           GROUP BY ROLLUP (cate)""",
        *_MATCH, "label_rows",
    ),
    "corpus_count": "SELECT count(*) AS n_papers FROM documents",
    "corpus_topic_count": _with(
        f"""SELECT count(*) AS n_papers FROM papers WHERE {_TOPIC} AND partition IN (
            SELECT partition FROM papers WHERE id IN (SELECT doc_id FROM labels WHERE toxic = 1))""",
        "papers",
    ),
    "id_list_export": """
        SELECT o_orderkey AS id, o_custkey, o_orderpriority FROM orders
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "id_list_export_in_ranges": """
        SELECT o_orderkey AS id, o_custkey, o_orderpriority FROM orders
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "label_export": _with(
        """SELECT id, s2_id, title, abstract, venue, authors, year, n_citations FROM papers
           WHERE id IN (SELECT id FROM matches WHERE cate = 'cspl')""",
        "papers", *_MATCH,
    ),
    "label_random_export": _with(
        f"""SELECT id, s2_id, title, abstract FROM papers WHERE id IN (
            SELECT id FROM (SELECT DISTINCT id FROM matches WHERE cate = 'cslg')
            ORDER BY md5('{SEED}:' || id) LIMIT 50)""",
        "papers", *_MATCH,
    ),
    "dense_id": f"SELECT c_custkey, c_name, pos AS id FROM (SELECT *, {_ordered('customer', 'c_custkey')})",
    "range_export": f"""
        SELECT pos AS id, o_orderkey, o_orderpriority FROM (SELECT *, {_ordered('orders', 'o_orderkey')})
        WHERE pos > 100 AND pos <= 1100""",
    "paged_export": f"""
        SELECT pos AS id, o_orderkey, (pos - 1) // 1000 AS page FROM (SELECT *, {_ordered('orders', 'o_orderkey')})""",
    "random_sample": f"SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('{SEED}:' || o_orderkey) LIMIT 1000",
    **dict.fromkeys(("label_sample", "label_sample_joined"), _with(
        f"""SELECT id, cate FROM (
            SELECT s.id, r.cate, row_number() OVER (PARTITION BY r.cate ORDER BY md5('{SEED}:' || s.id), s.id) AS rn
            FROM snapshot s JOIN {_registry(REGISTRY)} ON regexp_matches(s.categories, r.regex)) WHERE rn <= 20""",
        "snapshot",
    )),
    "three_way_split": f"""
        SELECT o_orderkey, {_three_way('pos', 'n')} AS partition
        FROM (SELECT o_orderkey, count(*) OVER () AS n, {_ordered('orders', 'o_orderkey')})""",
    "insert_or_ignore": _with(
        """SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id FROM lineitem
           WHERE CAST(l_orderkey AS VARCHAR) NOT IN (SELECT id FROM worklist WHERE filled = 1)""",
        "worklist",
    ),
    "create_worklist": _with(
        _comparable(f"""SELECT * FROM worklist WHERE filled = 1
            UNION ALL
            SELECT id, NULL, NULL, NULL, {_three_way('pos', 'n')}, 0
            FROM (SELECT id, count(*) OVER () AS n,
                         {_ordered('(SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id FROM lineitem)', 'id')})
            WHERE id NOT IN (SELECT id FROM worklist WHERE filled = 1)"""),
        "worklist",
    ),
    "pending_work": _with("SELECT * FROM pending", "worklist", "staging", "pending"),
    "fill_status": _with(
        "SELECT * FROM (" + " UNION ALL ".join(_status(p) for p in (-1, 0, 1, 2)) + ")",
        "worklist", "staging",
    ).replace(" SELECT * FROM (", ", both_tables AS (SELECT * FROM worklist UNION ALL SELECT * FROM staging)"
              " SELECT * FROM (", 1),
    "eta": """
        SELECT o_orderkey, printf('%d hrs %02d min %02d sec', o_orderkey * 3 // 3600, o_orderkey * 3 % 3600 // 60,
               o_orderkey * 3 % 60) AS eta FROM orders""",
    "classify_responses": _with("SELECT id, state FROM classified", "complete_bodies", "responses", "classified"),
    "complete_staging": _with(
        _comparable("""SELECT p.id, CASE WHEN state = 1 THEN body ->> '$.venue' END AS venue,
                  CASE WHEN state = 1 THEN CAST(body ->> '$.year' AS INT) END AS year,
                  CASE WHEN state = 1 THEN CAST(body ->> '$.citationCount' AS INT) END AS n_citations,
                  partition, state AS filled
           FROM pending p JOIN settled c ON c.id = p.id"""),
        "worklist", "staging", "pending", "complete_bodies", "responses", "classified", "asked_again", "settled",
    ),
    "complete_staging_stream": _with(
        _comparable("""SELECT p.id, CASE WHEN state = 1 THEN body ->> '$.venue' END AS venue,
                  CASE WHEN state = 1 THEN CAST(body ->> '$.year' AS INT) END AS year,
                  CASE WHEN state = 1 THEN CAST(body ->> '$.citationCount' AS INT) END AS n_citations,
                  partition, state AS filled
           FROM pending p JOIN settled c ON c.id = p.id"""),
        "worklist", "staging", "pending", "complete_bodies", "responses", "classified", "asked_again", "settled",
    ),
    "merge_staging": _with(
        _comparable("""SELECT w.id, CASE WHEN t THEN s.venue ELSE w.venue END AS venue,
                  CASE WHEN t THEN s.year ELSE w.year END AS year,
                  CASE WHEN t THEN s.n_citations ELSE w.n_citations END AS n_citations, w.partition,
                  CASE WHEN t THEN s.filled ELSE w.filled END AS filled
           FROM (SELECT w.*, w.filled = 0 AND s.id IS NOT NULL AS t FROM worklist w LEFT JOIN folded_staging s USING (id)) w
           LEFT JOIN folded_staging s USING (id)"""),
        "worklist", "staging", "repeated_staging", "folded_staging",
    ),
    "state_changes": _with(
        _comparable("""SELECT id, CASE WHEN partition IS NOT DISTINCT FROM 1 THEN venue END AS venue,
                  CASE WHEN partition IS NOT DISTINCT FROM 1 THEN year END AS year,
                  CASE WHEN partition IS NOT DISTINCT FROM 1 THEN n_citations END AS n_citations, partition,
                  CASE WHEN partition IS NOT DISTINCT FROM 1 THEN filled ELSE 0 END AS filled
           FROM (SELECT w.id, CASE WHEN t THEN s.venue ELSE w.venue END AS venue,
                     CASE WHEN t THEN s.year ELSE w.year END AS year,
                     CASE WHEN t THEN s.n_citations ELSE w.n_citations END AS n_citations, w.partition,
                     CASE WHEN t THEN s.filled ELSE w.filled END AS filled
                 FROM (SELECT w.*, w.filled = 0 AND s.id IS NOT NULL AS t FROM worklist w LEFT JOIN folded_staging s USING (id)) w
                 LEFT JOIN folded_staging s USING (id))"""),
        "worklist", "staging", "repeated_staging", "folded_staging",
    ),
    "merged_count": _with("SELECT count(*) AS merged FROM staging WHERE filled <> 0", "staging"),
    "reset_partition": _with(
        _comparable("""SELECT id, CASE WHEN partition IS NOT DISTINCT FROM 1 THEN venue END AS venue,
                  CASE WHEN partition IS NOT DISTINCT FROM 1 THEN year END AS year,
                  CASE WHEN partition IS NOT DISTINCT FROM 1 THEN n_citations END AS n_citations, partition,
                  CASE WHEN partition IS NOT DISTINCT FROM 1 THEN filled ELSE 0 END AS filled
           FROM worklist"""),
        "worklist",
    ),
    "complete_join": _with(
        """SELECT s.id, s.title, split_part(title, ' ', 1) || ' ' || split_part(title, ' ', 2) || '|' || lang || ' ' ||
                  source AS authors, w.year, w.venue, w.n_citations
           FROM snapshot s JOIN worklist w USING (id) WHERE w.filled = 1 AND w.venue IS DISTINCT FROM ''""",
        "snapshot", "worklist",
    ),
    "shard_checklist": _with("SELECT * FROM checklist", "toxic_french", "checklist"),
    "unchecked_shards": _with("SELECT partition FROM checklist WHERE is_checked = 0", "toxic_french", "checklist"),
    "variant_text": _with(_text_variants(), "papers"),
    "variant_text_fragmented": _with(f"SELECT *, 'n' || id AS note FROM ({_text_variants()})", "papers"),
    "variant_year": _with(
        """SELECT seed_id, source, 'year' AS feature, id, s2_id, title, abstract, venue, authors, CAST(v AS INT) AS year,
                  7 AS n_citations
           FROM seeds CROSS JOIN range(2050) t(v)""",
        "seeds",
    ),
    "variant_citations": _with(
        """SELECT seed_id, source, 'citation' AS feature, id, s2_id, title, abstract, venue, authors, 2000 AS year,
                  CAST(v AS INT) AS n_citations
           FROM seeds CROSS JOIN range(10000) t(v)""",
        "seeds",
    ),
    "mask_features": _with(
        """SELECT *, CAST((title IS NOT NULL)::INT + (abstract IS NOT NULL)::INT + (venue IS NOT NULL)::INT +
                  (year IS NOT NULL)::INT + (authors IS NOT NULL)::INT + (n_citations IS NOT NULL)::INT + 1 AS BIGINT)
                  AS n_keys
           FROM (""" + " UNION ALL ".join(
            _masked(m) for m in ("title", "abstract", "venue", "authors", "year", "n_citations", "full")
        ) + ")",
        "papers", "gappy",
    ),
    "records_sink": _with("SELECT id, s2_id, title, abstract, venue, authors, year, n_citations FROM papers", "papers"),
    "category_sink": _with(
        f"""SELECT s.id, r.cate, s.title, s.abstract, s.source AS report_no
            FROM snapshot s JOIN {_registry(REGISTRY)} ON regexp_matches(s.categories, r.regex)""",
        "snapshot",
    ),
    "label_index_sink": _with(
        "SELECT id, count(*) AS n_labels, count(*) AS n_listed FROM matches GROUP BY id", *_MATCH
    ),
    "audit_sink": _with(
        """SELECT cate, id, categories, replace(replace(a_title, chr(10), ''), '  ', ' ') AS a_title,
           replace(s_title, chr(10), '') AS s_title FROM matches""",
        *_MATCH,
    ),
    "variant_sink": _with(_text_variants(), "papers"),
    "masked_sink": _with(
        """SELECT masking, s2_id, CASE masking WHEN 'year' THEN ' ' ELSE CAST(year AS VARCHAR) END AS year,
                  CASE masking WHEN 'title' THEN ' ' ELSE title END AS title,
                  CASE masking WHEN 'abstract' THEN ' ' ELSE abstract END AS abstract,
                  CASE masking WHEN 'venue' THEN ' ' ELSE venue END AS venue,
                  CASE masking WHEN 'authors' THEN '' ELSE authors END AS authors,
                  CASE masking WHEN 'n_citations' THEN 0 ELSE n_citations END AS n_citations
           FROM papers CROSS JOIN (VALUES ('title'), ('abstract'), ('venue'), ('authors'), ('year'), ('n_citations'),
                                          ('full')) m(masking)""",
        "papers",
    ),
    "completed_sink": _with(
        """SELECT 'abstract authors id n_citations ' || CASE lang WHEN 'fr' THEN '' ELSE 'report-no ' END || 'title venue year'
                  AS keys, s.id, title, abstract,
                  '["' || split_part(title, ' ', 1) || ' ' || split_part(title, ' ', 2) || '","' || lang || ' ' || source || '"]'
                  AS authors, CAST(w.year AS VARCHAR) AS year, w.venue, CAST(w.n_citations AS VARCHAR) AS n_citations
           FROM snapshot s JOIN worklist w USING (id) WHERE w.filled = 1 AND w.venue IS DISTINCT FROM ''""",
        "snapshot", "worklist",
    ),
    "snapshot_scan": _with(
        "SELECT id, title, abstract, categories, '10.1/' || id AS doi, 'x' || id AS extra FROM snapshot", "snapshot"
    ),
    "json_array_scan": _with(
        """SELECT id, title, abstract, CAST(NULL AS VARCHAR) AS "report-no",
            '[["' || split_part(title, ' ', 2) || '","' || split_part(title, ' ', 1) || '"],["' || source || '","' ||
            lang || '","jr"]]' AS authors_parsed FROM snapshot""",
        "snapshot",
    ),
    "json_array_layouts": _with(
        """SELECT id, title, abstract, source AS report_no, layout,
            '[["' || split_part(title, ' ', 2) || '","' || split_part(title, ' ', 1) || '"],["' || source || '","' ||
            lang || '","jr"]]' AS authors_parsed FROM snapshot, (VALUES ('one line'), ('pretty')) l(layout)""",
        "snapshot",
    ),
    "manifest_scan": "SELECT DISTINCT source AS partition FROM documents",
    "corpus_scan": _with(
        f"""SELECT id, {_KEY} AS title_key, year, partition FROM papers
            WHERE partition IN (SELECT partition FROM checklist WHERE is_checked = 1)""",
        "papers", "toxic_french", "checklist",
    ),
    "responses_scan": _with("SELECT id, CAST(status AS INT) AS status, body FROM responses", "complete_bodies", "responses"),
    "append_sink": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders UNION SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem""",
    "unusable_counts": """
        SELECT count(*) AS total, CAST(0 AS BIGINT) AS unparsable,
               count(*) FILTER (WHERE lang NOT IN ('en', 'fr', 'de')) AS no_field_of_study,
               count(*) FILTER (WHERE source = 'src7') AS no_title, count(*) FILTER (WHERE n_chars < 300) AS no_abstract
        FROM documents""",
    "incremental_ingest": _with(
        """SELECT s2_id, title, abstract, venue, year, n_citations, title_key, authors,
                  CASE WHEN CAST(substr(partition, 4) AS INT) % 2 = 1 THEN partition
                       ELSE replace(partition, 'src', 'src ') || '.v2' END AS partition,
                  1 AS is_checked, count(*) OVER (PARTITION BY partition) AS shard_rows,
                  count(*) OVER (PARTITION BY partition) AS shard_ids, count(*) OVER (PARTITION BY partition) AS shard_span,
                  CAST(1 AS BIGINT) AS first_id, count(*) OVER () AS last_id, count(*) OVER () AS n_ids FROM shaped""",
        "shard_records", "shaped",
    ),
}
# Queries that take another way to the same rows.
SQL["id_list_export_bucketed"] = SQL["id_list_export"]
SQL["merge_staging_bucketed"] = SQL["merge_staging"]
