"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from docketry.llm import pii, revisits, secret_scan

# The base patterns as the contract states them; runs are maximal, so
# the least length of a run may be asked for at once.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "assign": r"""(?:(?i:password|passwd|secret|token|api_?key))["']? *[:=] *["']?[A-Za-z0-9+/_.=-]+""",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "entropy": "[A-Za-z0-9+/_=-]{20,}",
}


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def spans(pattern: str, least: int = 1) -> str:
    """SQL for a list of {s, e, m}: the matches' places, from the text between them."""
    p = quoted(pattern)
    return f"""(SELECT list({{'s': fin - length(m), 'e': fin, 'm': m}} ORDER BY fin) FROM (
        SELECT m, CAST(sum(length(m) + length(p)) OVER (ORDER BY k) AS BIGINT) AS fin FROM (
            SELECT unnest(ms) AS m, unnest(ps[1:len(ms)]) AS p, unnest(range(1, len(ms) + 1)) AS k
            FROM (SELECT regexp_extract_all(text, {p}) AS ms, string_split_regex(text, {p}) AS ps))) WHERE length(m) >= {least})"""


def around(width: int) -> str:
    return (
        f"lower(substr(text, greatest(x.s - {width}, 0) + 1, least(x.s, {width})) || ' ' || chr(1) || ' ' || "
        f"substr(text, x.e + 1, {width}))"
    )


def pii_sql() -> str:
    bare = "regexp_replace(x.m, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(range(1, length({bare}) + 1), lambda i: "
        f"list_extract([0,1,2,3,4,5,6,7,8,9,0,2,4,6,8,1,3,5,7,9], CAST(substr({bare}, -i, 1) AS INT) + 1 + 10 * ((i + 1) % 2)))) % 10 = 0"
    )
    plain = "replace(x.m, ' ', '')"
    moved = f"(substr({plain}, 5) || left({plain}, 4))"
    spelt = (
        f"list_aggregate(list_transform(string_split({moved}, ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c "
        "ELSE CAST(ascii(c) - 55 AS VARCHAR) END), 'string_agg', '')"
    )
    mod97 = f"list_reduce(list_transform(string_split({spelt}, ''), lambda c: CAST(c AS INT)), lambda a, c: (a * 10 + c) % 97, 0) = 1"
    valid = {
        "email": "true",
        "ip": "list_bool_and(list_transform(string_split(x.m, '.'), lambda q: length(ltrim(q, '0')) <= 3 AND coalesce(TRY_CAST(ltrim(q, '0') AS INT), 0) <= 255))",
        "card": f"length({bare}) BETWEEN 13 AND 19 AND {luhn}",
        "phone": f"length({bare}) BETWEEN 9 AND 15",
        "iban": f"length({plain}) BETWEEN 15 AND 34 AND {mod97}",
        "ssn": "substr(x.m, 1, 3) NOT IN ('000', '666') AND substr(x.m, 1, 3) < '900' AND substr(x.m, 5, 2) <> '00' AND substr(x.m, 8, 4) <> '0000'",
    }
    columns = []
    for kind in pii.KINDS:
        keep = valid[kind]
        prior, up, down = pii.CONTEXT[kind]
        score = (
            f"{prior} + CASE WHEN regexp_matches({around(pii.WINDOW)}, {quoted(up)}) THEN {pii.RAISE} ELSE 0 END"
            f" - CASE WHEN regexp_matches({around(pii.WINDOW)}, {quoted(down)}) THEN {pii.LOWER} ELSE 0 END"
        )
        score = f"CAST(round(least(greatest({score}, 0.0), 1.0), 2) AS DECIMAL(3, 2))"
        if kind not in pii.BASE:
            keep += f" AND {score} >= {pii.KEEP}"
        pattern = PLAIN.get(kind, pii.PATTERNS[kind])
        columns.append(
            f"list_transform(list_filter(coalesce({spans(pattern)}, []), lambda x: {keep}), "
            f"lambda x: {{'v': '{kind}:' || x.s || ':' || x.e, 'c': CAST({score} AS VARCHAR)}}) AS c_{kind}"
        )
    base = " || ".join(f"c_{k}" for k in pii.BASE)
    every = " || ".join(f"c_{k}" for k in pii.KINDS)
    counts = ", ".join(f"CAST(len(c_{k}) AS BIGINT) AS n_{k}" for k in pii.BASE)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        f AS (SELECT doc_id, {", ".join(columns)} FROM d)
        SELECT doc_id, {counts}, sha256(array_to_string(list_transform({base}, lambda x: x.v), ',')) AS base_sha256,
            array_to_string(list_transform({every}, lambda x: x.v), ',') AS spans,
            array_to_string(list_transform({every}, lambda x: x.c), ',') AS scores FROM f"""


def secrets_sql() -> str:
    head = quoted(secret_scan.HEAD.replace("*+", "*"))
    w = secret_scan.WINDOW
    chars = f"list_filter(string_split(x.m, ''), lambda c: c <> '')"
    peak = (
        f"list_max(list_transform(range(0, greatest(len({chars}) - {w}, 0) + 1), "
        f"lambda i: list_aggregate(({chars})[i + 1 : i + {w}], 'entropy')))"
    )
    least = "CASE " + " ".join(
        f"WHEN regexp_matches(x.m, {quoted(a)}) THEN {t}" for _, a, t in secret_scan.CLASSES
    ) + " ELSE 99.0 END"
    # RE2 has no back-references: eight equal characters in a row, spelt out.
    same = "list_bool_or(list_transform(range(1, length(x.m) - 6), lambda i: substr(x.m, i, 8) = repeat(substr(x.m, i, 1), 8)))"
    allow = " OR ".join(
        same if r"\1" in a else f"regexp_matches(x.m, {quoted(a)})" for a in secret_scan.ALLOW
    )
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        a AS (SELECT doc_id, text,
            list_filter(coalesce({spans(PLAIN["assign"])}, []), lambda x: length(regexp_replace(x.m, {head}, '')) >= 6) AS c_assign,
            coalesce({spans(PLAIN["access"], 20)}, []) AS c_access,
            coalesce({spans(PLAIN["hex"], 24)}, []) AS c_hex,
            list_filter(coalesce({spans(PLAIN["entropy"], 20)}, []), lambda x: NOT ({allow})) AS c_more FROM d),
        b AS (SELECT *, list_filter(c_more, lambda x: {peak} >= {least} AND len(list_filter(c_assign || c_access || c_hex,
            lambda y: y.s < x.e AND x.s < y.e)) = 0) AS c_entropy FROM a),
        f AS (SELECT doc_id, len(c_assign) AS n_assign, len(c_access) AS n_access, len(c_hex) AS n_hex,
            list_transform(c_assign, lambda x: {{'s': x.s, 'r': 0, 'v': 'assign:' || x.s || ':' || x.e}})
            || list_transform(c_access, lambda x: {{'s': x.s, 'r': 1, 'v': 'access:' || x.s || ':' || x.e}})
            || list_transform(c_hex, lambda x: {{'s': x.s, 'r': 2, 'v': 'hex:' || x.s || ':' || x.e}}) AS base,
            list_transform(c_entropy, lambda x: {{'s': x.s, 'r': 3, 'v': 'entropy:' || x.s || ':' || x.e}}) AS more FROM b)
        SELECT doc_id, CAST(n_assign AS BIGINT) AS n_assign, CAST(n_access AS BIGINT) AS n_access, CAST(n_hex AS BIGINT) AS n_hex,
            sha256(array_to_string(list_transform(list_sort(base), lambda x: x.v), ',')) AS base_sha256,
            array_to_string(list_transform(list_sort(base || more), lambda x: x.v), ',') AS spans FROM f"""


def revisits_sql() -> str:
    bare = "regexp_replace(trim(url), '#.*$', '')"
    rest = f"regexp_replace({bare}, '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    site = f"lower(regexp_extract({rest}, '^([^/?]*)', 1))"
    site = f"regexp_replace(regexp_replace({site}, '^[^@]*@', ''), '^www[0-9]*\\.', '')"
    site = f"regexp_replace({site}, ':(?:80|443)$', '')"
    path = f"regexp_replace(regexp_extract({rest}, '^[^/?]*([^?]*)', 1), '(?:/index\\.html?)?/*$', '')"
    kept = (
        f"list_sort(list_filter(string_split(regexp_extract({rest}, '\\?(.*)$', 1), '&'), "
        f"lambda p: p <> '' AND NOT regexp_matches(lower(p), {quoted(revisits.TRACKING)})))"
    )
    return f"""WITH p AS (SELECT page_id, {site} || {path} || CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END AS site,
            '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag, length(coalesce(html, '')) AS size,
            sha1(coalesce(html, '')) AS sha FROM pages),
        f AS (SELECT page_id * 2 AS id, site, page_id * 60 AS ts, tag, sha, page_id % 7 AS age, size FROM p),
        v AS (SELECT page_id * 2 + 1 AS id, site, page_id * 60 + 30 + 60 * (page_id % 5000) AS ts,
            CASE WHEN page_id % 7 = 6 THEN NULL WHEN page_id % 5 = 4 THEN '"changed"' ELSE tag END AS tag,
            CASE WHEN page_id % 2 = 0 THEN sha END AS sha FROM p),
        j AS (SELECT v.id AS revisit_id, v.site AS site, v.ts AS revisit_s, f.id AS response_id, f.ts AS response_s,
            CASE WHEN f.id IS NULL THEN 'no_response' WHEN v.tag IS NOT NULL THEN CASE WHEN v.tag = f.tag THEN 'etag' ELSE 'mismatch' END
                WHEN v.sha IS NOT NULL THEN CASE WHEN v.sha = f.sha THEN 'digest' ELSE 'mismatch' END ELSE 'no_validator' END AS verdict,
            'cache-control: max-age=60; content-length: ' || f.size || '; content-type: text/html; etag: ' || f.tag AS headers
            FROM v ASOF LEFT JOIN f ON v.site = f.site AND v.ts > f.ts)
        SELECT revisit_id, site, revisit_s, response_id, response_s, verdict,
            CASE WHEN verdict IN ('etag', 'digest') THEN headers END AS headers FROM j"""
