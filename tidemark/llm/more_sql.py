"""DuckDB SQL of structure repair, fill-in-middle and the URL filter."""

from __future__ import annotations

import math

from tidemark.llm.url_filter import LINK, RULES

# --- op11: one step of the program per row, four states with cost, audit and text so far


def _edit(state: str, cost: str, letter: str, said: str) -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || {letter}, 'o': {state}.o || {said}}} END"


def _least(*ways: str) -> str:
    return "list_min([" + ", ".join(ways) + "])"


def _insert(state: str, said: str) -> str:
    n = said.count("\n")
    return _edit(state, str(5 * n), f"'{'I' * n}'", f"'{said}'")


_U, _A, _UA = "user:\n", "assistant:\n", "user:\nassistant:\n"
_BEFORE_U = _least("s2", _insert("s0", _U), _insert("s1", _U), _insert("s3", _U))
_BEFORE_A = _least("s3", _insert("s2", _A), _insert("s0", _UA), _insert("s1", _UA))


def _say(state: str, initial: str, role: str) -> str:
    keep = _edit(state, "more", "'K'", "role || ':' || text || chr(10)")
    again = _edit(state, "1 + more", "'R'", f"'{role}:' || text || chr(10)")
    return f"CASE WHEN NOT gone THEN CASE WHEN i = '{initial}' THEN {keep} ELSE {again} END END"


def _drop(state: str) -> str:
    return _edit(state, "2", "'D'", "''")


_KEEP_S = "CASE WHEN NOT gone AND i = 's' THEN " + _edit("g0", "more", "'K'", "role || ':' || text || chr(10)") + " END"
_STATE = "STRUCT(c BIGINT, a VARCHAR, o VARCHAR)"
_CRC_TABLE = "list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x))"
_CRC = "xor(list_reduce(list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT)), lambda a, b: xor(t[1 + (xor(a, b) & 255)], a >> 8), 4294967295), 4294967295)"

REPAIR_SQL = rf"""
    WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t),
    keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
    ), hashed AS (SELECT keyed.*, {_CRC} % 20 AS h FROM keyed, crc),
    damaged AS (
        SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
            CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM hashed
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS p FROM damaged
    ), marked AS (
        SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS b,
            NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again,
            NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut
        FROM placed
    ), f AS (SELECT *, blank OR again AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS more FROM marked),
    walk AS (
        SELECT conv_id, CAST(0 AS BIGINT) AS p, CAST({{'c': 0, 'a': '', 'o': ''}} AS {_STATE}) AS s0,
            CAST(NULL AS {_STATE}) AS s1, CAST(NULL AS {_STATE}) AS s2, CAST(NULL AS {_STATE}) AS s3
        FROM (SELECT DISTINCT conv_id FROM conversations)
        UNION ALL
        SELECT conv_id, p, CAST({_drop("g0")} AS {_STATE}), CAST({_least(_drop("g1"), _KEEP_S)} AS {_STATE}),
            CAST({_least(_drop("g2"), _say("g0", "u", "user"), _say("g1", "u", "user"), _say("g3", "u", "user"))} AS {_STATE}),
            CAST({_least(_drop("g3"), _say("g2", "a", "assistant"))} AS {_STATE})
        FROM (
            SELECT f.conv_id, f.p, f.role, f.text, f.i, f.gone, f.more, s0 AS g0, s1 AS g1, {_BEFORE_U} AS g2, {_BEFORE_A} AS g3
            FROM walk JOIN f ON walk.conv_id IS NOT DISTINCT FROM f.conv_id AND f.p = walk.p + 1
        )
    ), best AS (
        SELECT conv_id, {_least("s0", _BEFORE_A)} AS s FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY p DESC) = 1
    ), counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
            count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (NOT gone AND cut) AS truncated,
            count(*) FILTER (b IS NOT NULL AND b || i NOT IN ('su', 'ua', 'au')) AS illegal
        FROM f GROUP BY conv_id
    )
    SELECT best.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, s.c AS cost, s.a AS audit,
        sha256(substr(s.o, 1, greatest(length(s.o) - 1, 0))) AS repaired_sha256
    FROM best LEFT JOIN counts ON best.conv_id IS NOT DISTINCT FROM counts.conv_id
"""

# --- op12

MIDDLES_SQL = """
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
            sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
    ), k AS (
        SELECT *, CAST(len(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
            CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d
    ), c AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM k
    ), s AS (
        SELECT *, array_to_string(t[1:a], '') AS prefix, array_to_string(t[a + 1:b], '') AS middle, array_to_string(t[b + 1:], '') AS suffix FROM c
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM s
"""

# --- op13

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LONGEST = sorted(RULES, key=lambda r: (len(r.name), r.name), reverse=True)


def _first_fit(value: str) -> str:
    return "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, value)}'" for r in _LONGEST
    ) + " END"


_ROUNDS = math.ceil(math.log(0.01) / math.log(0.85))

URL_SQL = rf"""
    WITH RECURSIVE p AS (
        SELECT row_number() OVER () AS row, page_id, html, {_LOWER.format("coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')")} AS host,
            coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
    ), j AS (SELECT page_id, host, path, {_first_fit("name")} AS rule, {_first_fit("verdict")} AS by_rule FROM p),
    edges AS (
        SELECT src, dst, count(*) AS pages FROM (
            SELECT DISTINCT row, host AS src, {_LOWER.format("u")} AS dst
            FROM (SELECT row, host, unnest(regexp_extract_all(html, '{LINK.replace("'", "''")}', 1)) AS u FROM p)
        ) WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
    ), ways AS (SELECT 'trust' AS kind, src AS host, dst AS next, pages FROM edges UNION ALL SELECT 'distrust', dst, src, pages FROM edges),
    steps AS (SELECT kind, host, next, CAST(0.85 AS DOUBLE) * pages / sum(pages) OVER (PARTITION BY kind, host) AS p FROM ways),
    seeds AS (
        SELECT CASE WHEN 2 * a > n THEN 'trust' WHEN 2 * b > n THEN 'distrust' END AS kind, host FROM (
            SELECT host, count(*) AS n, count(*) FILTER (by_rule = 'allow') AS a, count(*) FILTER (by_rule = 'block') AS b FROM j WHERE host <> '' GROUP BY host
        )
    ), sent AS (
        SELECT 0 AS k, kind, host, CAST(1 AS DOUBLE) AS score FROM seeds WHERE kind IS NOT NULL
        UNION ALL
        SELECT k + 1, kind, host, sum(score) FROM (
            SELECT sent.k, steps.kind, steps.next AS host, sent.score * steps.p AS score FROM sent JOIN steps ON sent.kind = steps.kind AND sent.host = steps.host
        ) WHERE k < {_ROUNDS} GROUP BY k, kind, host
    ), hosts AS (
        SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS trust, coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS distrust FROM sent GROUP BY host
    ), shares AS (
        SELECT host, coalesce(round(trust / nullif(sum(trust) OVER (), 0), 9), 0) AS trust, coalesce(round(distrust / nullif(sum(distrust) OVER (), 0), 9), 0) AS distrust,
            round(CAST(0.5 AS DOUBLE) / count(*) OVER (), 9) AS least
        FROM hosts
    ), bad AS (SELECT host AS bad FROM shares WHERE distrust > trust AND distrust >= least)
    SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN bad IS NULL THEN 'allow' ELSE 'block' END) AS verdict FROM j LEFT JOIN bad ON host = bad
"""

MORE_ORACLES = {"op11_structure_repair": REPAIR_SQL, "op12_fill_in_middle": MIDDLES_SQL, "op13_url_filter": URL_SQL}
