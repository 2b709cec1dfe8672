"""The English stemming rules as DuckDB CTEs over the terms of ``tok``."""

from __future__ import annotations

_IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
_SUFFIX_2 = {
    "ational": "ate", "fulness": "ful", "iveness": "ive", "ization": "ize", "ousness": "ous", "biliti": "ble",
    "lessli": "less", "tional": "tion", "alism": "al", "aliti": "al", "ation": "ate", "entli": "ent", "fulli": "ful",
    "iviti": "ive", "ousli": "ous", "abli": "able", "alli": "al", "anci": "ance", "ator": "ate", "enci": "ence",
    "izer": "ize", "bli": "ble", "ogi": "og", "li": "",
}
_SUFFIX_3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "ative": "", "icate": "ic", "iciti": "ic", "ical": "ic", "ness": "",
    "ful": "",
}
_SUFFIX_4 = "ement|able|ance|ence|ible|ment|ant|ate|ent|ion|ism|iti|ive|ize|ous|al|er|ic"


def _cases(column: str, table: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


def _step(name: str, before: str, pattern: str, result: str) -> str:
    """A step that looks at the longest suffix ``x`` with ``b`` before it; a word marked done passes."""
    return (
        f"{name} AS (SELECT term, r1, r2, done, CASE WHEN done OR x = '' THEN w ELSE {result} END AS w FROM (SELECT *,"
        f" left(w, length(w) - length(x)) AS b FROM (SELECT *, regexp_extract(w, '({pattern})$', 1) AS x FROM {before})))"
    )


_SHORT = "regexp_matches(b, '([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$')"
_PREFIX = "regexp_extract(w, '^(gener|commun|arsen)')"


def _region(text: str) -> str:
    return f"length(regexp_extract({text}, '^.*?[aeiouy][^aeiouy]'))"


STEMS = (
    r"word AS (SELECT term, regexp_replace(regexp_replace(term, '^''', ''), '(^|[aeiouy])y', '\1Y', 'g') AS w"
    " FROM (SELECT DISTINCT term FROM tok) WHERE length(term) > 2)",
    f"region1 AS (SELECT term, w, CASE WHEN {_PREFIX} <> '' THEN length({_PREFIX}) WHEN {_region('w')} > 0"
    f" THEN {_region('w')} ELSE length(w) END AS r1 FROM word)",
    f"region2 AS (SELECT term, w, r1, CASE WHEN {_region('substr(w, r1 + 1)')} > 0 THEN r1 + {_region('substr(w, r1 + 1)')}"
    " ELSE length(w) END AS r2 FROM region1)",
    "s0 AS (SELECT term, r1, r2, regexp_replace(w, '(''s''|''s|'')$', '') AS w FROM region2)",
    "s1a0 AS (SELECT term, r1, r2, CASE WHEN w LIKE '%sses' THEN left(w, -2) WHEN (w LIKE '%ied' OR w LIKE '%ies')"
    " THEN CASE WHEN length(w) > 4 THEN left(w, -2) ELSE left(w, -1) END WHEN w LIKE '%us' OR w LIKE '%ss' THEN w"
    " WHEN w LIKE '%s' AND regexp_matches(left(w, length(w) - 2), '[aeiouy]') THEN left(w, -1) ELSE w END AS w FROM s0)",
    "s1a AS (SELECT *, w IN ('inning', 'outing', 'canning', 'herring', 'earring', 'proceed', 'exceed', 'succeed') AS done"
    " FROM s1a0)",
    _step(
        "s1b", "s1a", "eedly|ingly|edly|eed|ing|ed",
        "CASE WHEN x LIKE 'eed%' THEN CASE WHEN length(b) >= r1 THEN b || 'ee' ELSE w END"
        " WHEN NOT regexp_matches(b, '[aeiouy]') THEN w WHEN regexp_matches(b, '(at|bl|iz)$') THEN b || 'e'"
        " WHEN regexp_matches(b, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(b, -1)"
        f" WHEN length(b) <= r1 AND {_SHORT} THEN b || 'e' ELSE b END",
    ),
    r"s1c AS (SELECT term, r1, r2, done, CASE WHEN done THEN w ELSE regexp_replace(w, '(.[^aeiouy])[yY]$', '\1i') END AS w"
    " FROM s1b)",
    _step(
        "s2", "s1c", "|".join(_SUFFIX_2),
        "CASE WHEN length(b) < r1 OR (x = 'ogi' AND NOT regexp_matches(b, 'l$')) OR (x = 'li' AND NOT"
        f" regexp_matches(b, '[cdeghkmnrt]$')) THEN w ELSE b || {_cases('x', _SUFFIX_2)} END",
    ),
    _step(
        "s3", "s2", "|".join(_SUFFIX_3),
        "CASE WHEN length(b) < CASE WHEN x = 'ative' THEN r2 ELSE r1 END THEN w ELSE b || "
        + _cases("x", _SUFFIX_3) + " END",
    ),
    _step(
        "s4", "s3", _SUFFIX_4,
        "CASE WHEN length(b) < r2 OR (x = 'ion' AND NOT regexp_matches(b, '[st]$')) THEN w ELSE b END",
    ),
    _step(
        "s5", "s4", "e|l",
        f"CASE WHEN x = 'e' AND (length(b) >= r2 OR (length(b) >= r1 AND NOT {_SHORT})) THEN b"
        " WHEN x = 'l' AND length(b) >= r2 AND b LIKE '%l' THEN b ELSE w END",
    ),
    "stem AS (SELECT t.term, CASE WHEN length(t.term) <= 2 THEN t.term ELSE coalesce(" + _cases("t.term", _IRREGULAR)
    + ", replace(s5.w, 'Y', 'y')) END AS stem FROM (SELECT DISTINCT term FROM tok) t LEFT JOIN s5 USING (term))",
    "stemmed AS (SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS tokens, count(*) AS n FROM tok JOIN stem USING (term)"
    " GROUP BY doc_id)",
)
