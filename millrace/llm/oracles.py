"""The result of the operators' queries that SQL can express, as SQL for DuckDB on the same tables."""

from __future__ import annotations

from millrace.llm.licenses import KNOWN, PHRASES, SPELLINGS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WORDS = f"regexp_extract_all({_FOLD.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_DECONTAMINATE = f"""
    WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
    b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    spans AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
    windows AS (
        SELECT DISTINCT item_id, n, array_to_string(w[s + 1 : s + n], ' ') AS words
        FROM (SELECT *, unnest(range(0, len(w) - n + 1)) AS s FROM spans)),
    sizes AS (SELECT DISTINCT n FROM windows),
    places AS (
        SELECT doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') AS words
        FROM (SELECT doc_id, n, w, unnest(range(0, len(w) - n + 1)) AS s FROM d, sizes)),
    found AS (SELECT doc_id, s, n, item_id FROM places JOIN windows USING (n, words)),
    hits AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id),
    ids AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS listed
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id),
    pos AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
    counts AS (SELECT word, count(*) AS n FROM pos GROUP BY word),
    rare AS (
        SELECT item_id, word, coalesce(n, 0) AS n, row_number() OVER (
            PARTITION BY item_id ORDER BY coalesce(n, 0), word) AS k
        FROM (SELECT DISTINCT item_id, unnest(w) AS word FROM b) LEFT JOIN counts USING (word)
        QUALIFY k <= 3),
    firsts AS (
        SELECT item_id, doc_id, p FROM rare JOIN pos USING (word) WHERE k = 1),
    others AS (
        SELECT DISTINCT f.item_id, f.doc_id, f.p, r.k
        FROM firsts f JOIN rare r ON r.item_id = f.item_id AND r.k > 1
        JOIN pos q ON q.doc_id = f.doc_id AND q.word = r.word AND abs(q.p - f.p) <= 10),
    near AS (
        SELECT doc_id, count(DISTINCT item_id) AS n_near FROM (
            SELECT item_id, doc_id, p, count(o.k) AS n_met FROM firsts f
            LEFT JOIN others o USING (item_id, doc_id, p) GROUP BY item_id, doc_id, p)
        JOIN (SELECT item_id, count(*) AS n_asked FROM rare GROUP BY item_id) USING (item_id)
        WHERE n_met = n_asked - 1 GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
           n_hit IS NOT NULL AS contaminated, coalesce(n_near, 0) AS n_near
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id) LEFT JOIN near USING (doc_id)
"""

_COPYRIGHT = r"(?m)^[ \t#*/;-]*(copyright|\(c\)|©)[^\n]*((19|20)[0-9][0-9]|\(c\)|©)[^\n]*$"


def _digest(text: str) -> str:
    plain = f"regexp_replace({_FOLD.format(text)}, {_text(_COPYRIGHT)}, ' ', 'g')"
    plain = f"' ' || regexp_replace({plain}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g') || ' '"
    plain = f"regexp_replace({plain}, ' +', ' ', 'g')"
    for phrase, other in PHRASES.items():
        plain = f"replace({plain}, ' {phrase} ', '{f' {other} ' if other else ' '}')"
    spellings = ", ".join(f"'{a}': '{b}'" for a, b in SPELLINGS.items())
    words = f"list_transform(string_split({plain}, ' '), lambda w: coalesce(map_extract_value(MAP {{{spellings}}}, w), w))"
    form = f"trim(array_to_string({words}, ' '))"
    return f"CASE WHEN {form} <> '' THEN sha256({form}) END"


_KNOWN = ", ".join(f"({_text(i)}, {_text(t)})" for i, t in KNOWN)

_LICENSES = f"""
    WITH known AS (
        SELECT DISTINCT license_id, {_digest('text')} AS digest
        FROM (VALUES {_KNOWN}) AS k(license_id, text)),
    whole AS (SELECT doc_id, {_digest('text')} AS digest FROM documents),
    lines AS (
        SELECT doc_id, {_digest('line')} AS digest
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
    found AS (
        SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS license_ids
        FROM whole JOIN known USING (digest) GROUP BY doc_id),
    notices AS (
        SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids
        FROM lines JOIN known USING (digest) GROUP BY doc_id)
    SELECT doc_id, digest, coalesce(license_ids, '') AS license_ids, coalesce(notice_ids, '') AS notice_ids
    FROM whole LEFT JOIN found USING (doc_id) LEFT JOIN notices USING (doc_id)
"""

# The tables hold messages of plain text only; tool calls are tested on fixtures.
_MESSAGES = """
    SELECT conv_id, turn, role, turn AS order_turn, CAST(0 AS INTEGER) AS order_step,
           CAST(0 AS BIGINT) AS n_calls, CAST(0 AS BIGINT) AS n_linked, CAST(0 AS BIGINT) AS n_invalid,
           CASE WHEN role = 'tool' THEN false END AS answers, false AS cyclic,
           '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":'
               || CAST(to_json(role) AS VARCHAR) || '}' AS json
    FROM conversations
"""

_LINES = f"""
    WITH lines AS (
        SELECT row, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
        FROM (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS l
              FROM documents)),
    keyed AS (
        SELECT *, trim({_FOLD.format('line')}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
        FROM lines),
    shared AS (
        SELECT key, true AS gone FROM keyed WHERE length(key) >= 1
        GROUP BY key HAVING count(DISTINCT row) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
    FROM keyed LEFT JOIN shared USING (key) GROUP BY row, doc_id
"""

# crc32 of the id's decimal digits, a bit at a time.
_CRC = """
    xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda a, b: list_reduce(
            list_prepend(xor(a, b), range(8)),
            lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)),
        CAST(4294967295 AS BIGINT))
"""

_TRIE = f"""
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    heads AS (SELECT conv_id, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
    built AS (
        SELECT c.conv_id, role, text, 0 AS part, pos FROM heads c
        JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND pos < h
        UNION ALL SELECT conv_id, role, text, 1, pos FROM heads JOIN turns USING (conv_id) WHERE pos >= h),
    lists AS (
        SELECT h.conv_id, coalesce(list({{'r': role, 't': text}} ORDER BY part, pos) FILTER (role IS NOT NULL), []) AS l
        FROM heads h LEFT JOIN built USING (conv_id) GROUP BY h.conv_id),
    prefixes AS (
        SELECT conv_id, d AS depth, sha256(CAST(to_json(l[1:d]) AS VARCHAR)) AS key, d = len(l) AS ends,
               CASE WHEN d > 0 THEN length(l[d].t) ELSE 0 END AS chars
        FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM lists)),
    nodes AS (
        SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) * (count(*) - 1) AS own,
               string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ends
        FROM prefixes GROUP BY key, depth),
    ups AS (
        SELECT n.key, n.depth, u.key AS up_key, u.conv_id AS parent_conv_id
        FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
        JOIN nodes u ON u.key = p.key AND u.depth = p.depth),
    children AS (SELECT up_key AS key, count(*) AS n_children FROM ups GROUP BY up_key),
    sums AS (
        SELECT p.key, sum(own) AS saved, count(*) FILTER (c.key IS NULL) AS n_leaves
        FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth
        LEFT JOIN children c ON c.key = n.key GROUP BY p.key)
    SELECT n.conv_id, n.depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
           CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
    FROM nodes n LEFT JOIN ups USING (key) LEFT JOIN children USING (key) JOIN sums USING (key)
"""

ORACLES = {
    "op1_decontaminate": _DECONTAMINATE,
    "op2_license_scan": _LICENSES,
    "op8_tool_linking": _MESSAGES,
    "op10_line_dedup": _LINES,
    "op13_prefix_trie": _TRIE,
}
