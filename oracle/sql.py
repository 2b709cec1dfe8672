"""DuckDB SQL for the registered queries, written apart from the Spark code.

Statements share CTEs: ``doc`` (documents with token lists), ``tok`` (one row per token), ``post`` and ``bipost``
(postings), ``q``/``qt`` (queries and their terms).
"""

from __future__ import annotations

from oracle.stemmer import STEMS
from wordtrawl.functions.stopwords import STOP_WORDS

WORD = "[a-zA-Z0-9@#*&'']+"
STOP = "(" + ",".join(f"'{w}'" for w in STOP_WORDS) + ")"


def tokens(text: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '{WORD}'), lambda x: lower(x))"


def with_ctes(*ctes: str, select: str) -> str:
    head = ", ".join(c.replace(" AS (", " AS MATERIALIZED (", 1) for c in ctes)
    return f"WITH RECURSIVE {head} {select}"


DOC = f"doc AS (SELECT doc_id, {tokens('text')} AS tokens FROM documents)"
TOK = "tok AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) - 1 AS pos FROM doc)"
BI = (
    "bi AS (SELECT * FROM (SELECT doc_id, pos, term AS t1, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS t2 FROM tok)"
    " WHERE t2 IS NOT NULL)"
)
POST = (
    "post AS (SELECT term, doc_id, count(*) AS tf, string_agg(pos::VARCHAR, ' ' ORDER BY pos) AS positions FROM tok GROUP BY ALL)"
)
BIPOST = (
    "bipost AS (SELECT t1, t2, doc_id, count(*) AS tf, string_agg(pos::VARCHAR, ' ' ORDER BY pos) AS positions FROM bi"
    " GROUP BY ALL)"
)
N = "n AS (SELECT count(*) AS n FROM doc)"

# Queries: every benchmark text as a whole, and literal ones.
LITERAL_QUERIES = (
    "of the is",
    "that was",
    "to the to",
    "zzzzunknown the in",
    "zzzzunknown",
    "cristina lopes",
    "machine learning",
    "ACM",
    "master of software engineering",
    "de la que",
)
LITERAL_BASE = 1_000_000
# Document ids per block of the registered block lists: so few that every corpus fills several.
SMALL_BLOCK = 64
_VALUES = ",".join(f"({LITERAL_BASE + i}, '{t}')" for i, t in enumerate(LITERAL_QUERIES))
Q = f"q AS (SELECT item_id AS qid, text AS query FROM benchmark UNION ALL SELECT * FROM (VALUES {_VALUES}) v(qid, query))"
QT = (
    "qt AS (SELECT qid, unnest(a) AS term, generate_subscripts(a, 1) - 1 AS ord"
    f" FROM (SELECT qid, {tokens('query')} AS a FROM q))"
)
QP = (
    "qp AS (SELECT * FROM (SELECT qid, ord, term AS t1, lead(term) OVER (PARTITION BY qid ORDER BY ord) AS t2 FROM qt)"
    " WHERE t2 IS NOT NULL)"
)
DF = "df AS (SELECT term, count(*) AS df FROM post GROUP BY term)"
BIDF = "bidf AS (SELECT t1, t2, count(*) AS df FROM bipost GROUP BY ALL)"
KNOWN = (
    "known AS (SELECT qid, term, df, count(*) OVER (PARTITION BY qid) AS n_known"
    " FROM (SELECT DISTINCT qid, term FROM qt) JOIN df USING (term))"
)
HITS = "hits AS (SELECT k.qid, p.doc_id, p.term, p.tf, k.df, k.n_known FROM known k JOIN post p USING (term))"
CAND = "cand AS (SELECT qid, doc_id FROM hits GROUP BY qid, doc_id HAVING count(*) = max(n_known))"
UNI = (
    "uni AS (SELECT qid, doc_id, sum((1 + log10(tf)) * log10(n.n / df)) AS uni FROM hits, n GROUP BY qid, doc_id"
    " HAVING count(*) = max(n_known))"
)
BIHITS = (
    "bihits AS (SELECT p.qid, p.ord, p.t1, p.t2, b.doc_id, b.tf, d.df"
    " FROM (SELECT qid, t1, t2, max(ord) AS ord FROM qp GROUP BY ALL) p"
    " JOIN bipost b USING (t1, t2) JOIN bidf d USING (t1, t2))"
)
BIW = (
    f"biw AS (SELECT qid, ord, t1, t2, doc_id, (CASE WHEN t1 IN {STOP} THEN 0.5 ELSE 1.0 END::DOUBLE)"
    f" * (CASE WHEN t2 IN {STOP} THEN 0.5 ELSE 1.0 END::DOUBLE) * (1 + log10(tf)) * log10(n.n / df) AS weight FROM bihits, n)"
)
LAST = "last AS (SELECT qid, doc_id, arg_max(weight, ord) AS bi FROM biw GROUP BY qid, doc_id)"
SCORE = (
    "score AS (SELECT qid, doc_id, 0.4::DOUBLE * uni + 0.6::DOUBLE * coalesce(bi, 0) AS score"
    " FROM uni LEFT JOIN last USING (qid, doc_id))"
)
RANKED = (
    "ranked AS (SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id) AS rank, doc_id, score"
    " FROM score QUALIFY rank <= 5)"
)
INDEX = (DOC, TOK, BI, POST, BIPOST, N)
QUERY = (Q, QT, QP, DF, BIDF, KNOWN, HITS)
FULL = INDEX + QUERY + (UNI, BIHITS, BIW, LAST, SCORE, RANKED)

# Pages with duplicates: each page again under a URL with one more fragment, its content changed.
PAGES2 = (
    "pages2 AS (SELECT page_id AS seq, url, html AS content FROM pages"
    " UNION ALL SELECT page_id + 1000000, url || '#dup', html || '<p>copy</p>' FROM pages)"
)
PAGES3 = (
    "pages3 AS (SELECT page_id AS seq, url, html AS content FROM pages"
    " UNION ALL SELECT page_id + 1000000, url, html || '<p>copy</p>' FROM pages)"
)


def defragment(url: str) -> str:
    base = f"split_part({url}, '#', 1)"
    rebuilt = f"lower(regexp_extract({base}, '^[A-Za-z][A-Za-z0-9+.-]*:')) || regexp_replace(regexp_replace({base}, '^[A-Za-z][A-Za-z0-9+.-]*:', ''), '\\?$', '')"
    return f"CASE WHEN contains({url}, '#') THEN {rebuilt} ELSE {url} END"


def page_text(html: str) -> str:
    text = f"regexp_replace({html}, '(?s)<!--.*?-->', '', 'g')"
    for element in ("script", "style", "template"):
        text = f"regexp_replace({text}, '(?is)<{element}\\b.*?</{element}\\s*>', '', 'g')"
    text = f"regexp_replace({text}, '(?s)<[!/?a-zA-Z](?:[^>=]|=\\s*(?:\"[^\"]*\"|''[^'']*'')?)*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "),
                         ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


def treebank(text: str, abbreviations: str | None = None) -> str:
    """Spaces go where words end; then split, keep what has a letter or digit, lower-case.

    Words of the list ``abbreviations`` have a private character for their period meanwhile, but for the last of a text.
    """
    closers = "[\\])}>\"''»”’]*"
    boundary = f"([^.\\s])\\.({closers}\\s+[\"''(\\[{{<«“‘]*[\\p{{Lu}}\\p{{Nd}}])"
    steps = [
        ("([«»“”„‘’]|`+)", " \\1 "),
        (boundary, "\\1 . \\2"),
        (boundary, "\\1 . \\2"),
        (f"([^.\\s])\\.({closers}\\s*)$", "\\1 . \\2"),
        ("([:,])([^\\p{Nd}])", " \\1 \\2"),
        ("(\\.\\.+)", " \\1 "),
        ("([;@#$%&?!*\\[\\](){}<>])", " \\1 "),
        ("--", " -- "),
        ("(\"|'''')", " \\1 "),
        ("([^''])'' ", "\\1 '' "),
        ("\\s+", " "),
        ("(?i)([^'' ])(''s|''m|''d|'') ", "\\1 \\2 "),
        ("([^'' ])(''ll|''LL|''re|''RE|''ve|''VE|n''t|N''T) ", "\\1 \\2 "),
        ("(?i)\\b(can)(not)\\b", "\\1 \\2"),
        ("(?i)\\b(d)(''ye)\\b", "\\1 \\2"),
        ("(?i)\\b(gim|lem)(me)\\b", "\\1 \\2"),
        ("(?i)\\b(gon|wan)(na)\\b", "\\1 \\2"),
        ("(?i)\\b(got)(ta)\\b", "\\1 \\2"),
        ("(?i)\\b(more)(''n)\\b", "\\1 \\2"),
        ("(?i)( )(''t)(is|was)\\b", "\\1\\2 \\3"),
    ]
    out = f"' ' || regexp_replace({text}, '[\\s\\p{{Z}}]+', ' ', 'g') || ' '"
    if abbreviations:
        word = "lower(regexp_extract(x, '(?:^|[^\\p{L}])(\\p{L}+(?:\\.\\p{L}+)*)\\.\\z', 1))"
        piece = f"CASE WHEN ends_with(x, '.') AND list_contains({abbreviations}, {word}) THEN x[:-2] || chr(57344) ELSE x END"
        out = f"array_to_string(list_transform(string_split({out}, ' '), lambda x: {piece}), ' ')"
        out = f"regexp_replace({out}, chr(57344) || '({closers}\\s*)$', '.\\1')"
    for pattern, replacement in steps:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    if abbreviations:
        out = f"replace({out}, chr(57344), '.')"
    kept = f"list_filter(regexp_split_to_array({out}, '\\s+'), lambda x: regexp_matches(x, '[a-zA-Z\\p{{Nd}}]'))"
    return f"list_transform({kept}, lambda x: lower(x))"


# Documents with a title before the capitals inside their sentences; how often words have a period behind them.
TITLED = "titled AS (SELECT doc_id, regexp_replace(text, '([a-z,]) ([A-Z])', '\\1 Dr. \\2', 'g') AS text FROM documents)"
PERIODS = (
    "periods AS (SELECT rtrim(w, '.') AS word, count(*) FILTER (ends_with(w, '.') AND NOT ends_with(w, '..')) AS k, count(*) AS n FROM"
    " (SELECT lower(unnest(regexp_extract_all(text, '\\p{L}+(?:\\.\\p{L}+)*\\.*'))) AS w FROM titled) GROUP BY 1)"
)
ABBREVIATIONS = (
    "scored AS (SELECT word, k AS with_period, n - k AS without_period, 2 * ((k * ln(0.99) + (n - k) * ln(0.01)) - (k * ln(p) + (n - k) * ln(1 - p)))"
    " * exp(-length(replace(word, '.', ''))::DOUBLE) * (1 + length(word) - length(replace(word, '.', '')))"
    " * pow(length(replace(word, '.', ''))::DOUBLE, k - n) AS score"
    " FROM periods, (SELECT sum(k) / sum(n) AS p FROM periods) WHERE k > 0)"
)


def mark(html: str, word: str) -> str:
    """One word marked in text pieces; references stand as single private characters meanwhile."""
    pattern = f"(?i)(^|[^a-zA-Z\\p{{Nd}}]+)({word})($|[^a-zA-Z\\p{{Nd}}]+)"
    replaced = f"regexp_replace(p, '{pattern}', '\\1<mark>\\2</mark>\\3', 'g')"
    pieces = f"regexp_extract_all({html}, '(?s)<!--.*?-->|<[!/?a-zA-Z](?:[^>=]|=\\s*(?:\"[^\"]*\"|''[^'']*'')?)*>|[^<]+|<')"
    return (
        f"array_to_string(list_transform({pieces}, lambda p: CASE WHEN starts_with(p, '<') THEN p ELSE {replaced} END), '')"
    )


_REFERENCES = tuple(
    (reference, chr(0xE000 + i))
    for i, reference in enumerate(("&amp;", "&copy;", "&middot;", "&quot;", "&lt;", "&gt;", "&#39;", "&nbsp;"))
)


def highlight(html: str, words: list[str]) -> str:
    out = html
    for entity, char in _REFERENCES:
        out = f"replace({out}, '{entity}', '{char}')"
    for word in sorted(words):
        out = mark(out, word)
    for entity, char in _REFERENCES:
        out = f"replace({out}, '{char}', '{entity}')"
    return out


def signature_ctes(source: str = "tok", key: str = "doc_id", all_keys: str = "SELECT doc_id FROM doc") -> tuple[str, ...]:
    sums = ", ".join(
        [f"sum(CASE WHEN (lo >> {i}) & 1 = 1 THEN tf ELSE -tf END) AS l{i}" for i in range(32)]
        + [f"sum(CASE WHEN (hi >> {i}) & 1 = 1 THEN tf ELSE -tf END) AS h{i}" for i in range(32)]
    )
    lo = " + ".join(f"(CASE WHEN l{i} > 0 THEN {1 << i} ELSE 0 END)" for i in range(32))
    hi = " + ".join(f"(CASE WHEN h{i} > 0 THEN {1 << i} ELSE 0 END)" for i in range(32))
    return (
        f"w AS (SELECT {key}, term, count(*)::BIGINT AS tf FROM {source} GROUP BY ALL)",
        "hash AS (SELECT term, ('0x' || substr(md5(term), 17, 8))::BIGINT AS hi, ('0x' || substr(md5(term), 25, 8))::BIGINT AS lo"
        " FROM (SELECT DISTINCT term FROM w))",
        f"votes AS (SELECT {key}, {sums} FROM w JOIN hash USING (term) GROUP BY {key})",
        f"halves AS (SELECT {key}, ({hi})::BIGINT AS hi, ({lo})::BIGINT AS lo FROM votes)",
        f"sig AS (SELECT {key} AS seq, coalesce((CASE WHEN hi >= 2147483648 THEN hi - 4294967296 ELSE hi END) * 4294967296 + lo, 0)"
        f" AS sig, coalesce(hi, 0) AS hi, coalesce(lo, 0) AS lo FROM ({all_keys}) LEFT JOIN halves USING ({key}))",
    )


GREEDY = (
    "firsts AS (SELECT sig, any_value(hi) AS hi, any_value(lo) AS lo, min(seq) AS seq FROM sig GROUP BY sig)",
    "edges AS (SELECT a.seq AS earlier, b.seq AS later FROM firsts a JOIN firsts b ON a.seq < b.seq"
    " WHERE bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) <= 1)",
    "conflict AS (SELECT seq, row_number() OVER (ORDER BY seq) AS rn FROM (SELECT earlier AS seq FROM edges UNION SELECT later FROM edges))",
    "neighbours AS (SELECT c.seq, c.rn, coalesce(list(e.earlier) FILTER (e.earlier IS NOT NULL), []) AS nb"
    " FROM conflict c LEFT JOIN edges e ON e.later = c.seq GROUP BY ALL)",
    "walk(rn, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT c.rn,"
    " CASE WHEN list_has_any(w.kept, c.nb) THEN w.kept ELSE list_append(w.kept, c.seq) END"
    " FROM walk w JOIN neighbours c ON c.rn = w.rn + 1)",
    "kept AS (SELECT seq FROM firsts WHERE seq NOT IN (SELECT seq FROM conflict)"
    " UNION ALL SELECT unnest(kept) FROM (SELECT kept FROM walk ORDER BY rn DESC LIMIT 1))",
)


def greedy(*before: str, select: str, bits: int = 1) -> str:
    """The recursive CTE may not be materialised, so it is set apart."""
    rule = (c.replace("<= 1", f"<= {bits}") if c.startswith("edges") else c for c in GREEDY)
    head = ", ".join(c if c.startswith("walk") else c.replace(" AS (", " AS MATERIALIZED (", 1) for c in (*before, *rule))
    return f"WITH RECURSIVE {head} {select}"


def pairs_within(bits: int) -> str:
    """Copies with their first page, and first pages of all signatures at most ``bits`` apart."""
    return (
        "SELECT f.seq AS earlier, s.seq AS later, 0 AS distance FROM firsts f JOIN sig s ON s.sig = f.sig AND s.seq > f.seq"
        " UNION ALL SELECT * FROM (SELECT a.seq, b.seq, (bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)))::INTEGER AS distance"
        f" FROM firsts a JOIN firsts b ON a.seq < b.seq) WHERE distance <= {bits}"
    )


BUDGET = (
    f"qd AS (SELECT DISTINCT qid, term, term IN {STOP} AS is_common FROM qt)",
    "qn AS (SELECT *, count(*) OVER (PARTITION BY qid, is_common) AS same, count(*) OVER (PARTITION BY qid) AS total FROM qd)",
    "budget AS (SELECT qid, term, is_common, (CASE WHEN is_common THEN 50.0 WHEN same = total THEN 250.0 ELSE 200.0 END)::DOUBLE"
    " / same AS budget FROM qn)",
)
# The kept documents under dense ids, in place of the plain documents.
KEPT_INDEX = (
    "ids AS (SELECT seq, row_number() OVER (ORDER BY seq) - 1 AS doc_id FROM kept)",
    "doc2 AS (SELECT i.doc_id, i.seq, tokens FROM doc d JOIN ids i ON i.seq = d.doc_id)",
)
KEPT_TOK = "tok2 AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) - 1 AS pos FROM doc2)"


def over_kept(*ctes: str) -> tuple[str, ...]:
    return tuple(c.replace("FROM tok", "FROM tok2").replace("FROM doc)", "FROM doc2)") for c in ctes)


KEPT_RANKING = over_kept(BI, POST, BIPOST, N, *QUERY, UNI, BIHITS, BIW, LAST, SCORE, RANKED)

# Pages through the whole chain: text, Treebank tokens, first page per URL, near-duplicates, ids, index.
PAGE_DOC = (
    PAGES2,
    "first AS (SELECT min(seq) AS seq, u AS url FROM (SELECT seq, " + defragment("url") + " AS u FROM pages2) GROUP BY u)",
    f"doc AS (SELECT seq AS doc_id, url, {treebank(page_text('p.content'))} AS tokens FROM (SELECT f.seq, f.url, p2.content"
    " FROM first f JOIN pages2 p2 USING (seq)) p)",
)
PAGE_QUERIES = ("de la", "que le", "the and of", "in to The")
_PVALUES = ",".join(f"({i}, '{t}')" for i, t in enumerate(PAGE_QUERIES))
PAGE_Q = (
    f"q AS (SELECT * FROM (VALUES {_PVALUES}) v(qid, query))",
    f"qt AS (SELECT qid, unnest(a) AS term, generate_subscripts(a, 1) - 1 AS ord FROM (SELECT qid, {treebank('query')} AS a FROM q))",
    QP, DF, BIDF, KNOWN, HITS,
)
PAGE_RANKING = (
    "ids AS (SELECT seq, row_number() OVER (ORDER BY seq) - 1 AS doc_id FROM kept)",
    "doc2 AS (SELECT i.doc_id, i.seq, d.url, d.tokens FROM doc d JOIN ids i ON i.seq = d.doc_id)",
    KEPT_TOK,
) + over_kept(BI, POST, BIPOST, N, *PAGE_Q, UNI, BIHITS, BIW, LAST, SCORE, RANKED)

TURNS = (
    "turn AS (SELECT row_number() OVER (ORDER BY conv_id * 100000 + turn) - 1 AS doc_id, " + tokens("text") + " AS tokens"
    " FROM conversations)",
    "ctok AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) - 1 AS pos FROM turn)",
    "cbi AS (SELECT * FROM (SELECT doc_id, pos, term AS t1, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS t2 FROM ctok)"
    " WHERE t2 IS NOT NULL)",
)

# Two batches of pages as one: documents; then each again under its URL with another text, and under another URL with one more
# word, and the turns of conversations. The first page of a URL counts, in the order of batch and number.
GROWN_DOC = (
    "offered AS (SELECT 0 AS batch, doc_id AS seq, 'doc:' || doc_id AS url, text FROM documents"
    " UNION ALL SELECT 1, 3 * doc_id, 'doc:' || doc_id, 'changed ' || text FROM documents"
    " UNION ALL SELECT 1, 3 * doc_id + 1, 'again:' || doc_id, text || ' copy' FROM documents"
    " UNION ALL SELECT 1, 3 * (conv_id * 100000 + turn) + 2, 'turn:' || conv_id || '-' || turn, text FROM conversations)",
    "numbered AS (SELECT *, batch || '/' || seq AS disk_loc, row_number() OVER (ORDER BY batch, seq) AS n FROM offered)",
    "first AS (SELECT min(n) AS n FROM numbered GROUP BY url)",
    f"doc AS (SELECT n AS doc_id, url, disk_loc, {tokens('text')} AS tokens FROM numbered JOIN first USING (n))",
)
GROWN_INDEX = (
    KEPT_INDEX[0],
    "doc2 AS (SELECT i.doc_id, i.seq, d.url, d.disk_loc, d.tokens FROM doc d JOIN ids i ON i.seq = d.doc_id)",
    KEPT_TOK,
)


def grown(*ctes: str, select: str) -> str:
    after = "".join(", " + c.replace(" AS (", " AS MATERIALIZED (", 1) for c in (*GROWN_INDEX, *ctes))
    return greedy(*GROWN_DOC, TOK, *signature_ctes(), select=f"{after} {select}")


# Markup that is easily misread, and, written by hand, its text and what it is with "que" marked.
HARD_HTML = (
    "<p title=\"a > que\">que</p><!-- b > que -->1 < 2 que<a onclick='x => que'>&apos;&#0000000065;&copy 2020</a>"
    "<script>if (a<b) '</p>'</script>"
)
HARD_TEXT = "que1 < 2 que'A© 2020"
HARD_MARKED = (
    "<p title=\"a > que\"><mark>que</mark></p><!-- b > que -->1 < 2 <mark>que</mark><a onclick='x => que'>&apos;&#0000000065;&copy 2020</a>"
    "<script>if (a<b) '</p>'</script>"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STATEMENTS: dict[str, str] = {
    "page_text_hard": f"SELECT page_id, {quoted(HARD_TEXT)} || {page_text('html')} || {quoted(HARD_TEXT)} AS text FROM pages",
    "highlight_hard": (
        f"SELECT page_id, {quoted(HARD_MARKED)} || {highlight('html', ['que'])} || {quoted(HARD_MARKED)} AS html FROM pages"
    ),
    "page_text": f"SELECT page_id, {page_text('html')} AS text FROM pages",
    "tokens_regex": with_ctes(DOC, select="SELECT doc_id, array_to_string(tokens, ' ') AS tokens, len(tokens) AS n FROM doc"),
    "tokens_with_separators": (
        "SELECT doc_id, array_to_string(a, ' ') AS tokens, len(a) AS n FROM (SELECT doc_id, list_transform("
        f"regexp_extract_all(text, '{WORD}|[\\x00-\\x1f\\x21-\\x7f]'), lambda x: lower(x)) AS a FROM documents)"
    ),
    "sentence_abbreviations": with_ctes(
        TITLED, PERIODS, ABBREVIATIONS, select="SELECT word, with_period, without_period, round(score, 6) + 0.0 AS score FROM scored"
    ),
    "tokens_treebank_fitted": with_ctes(
        TITLED, PERIODS, ABBREVIATIONS,
        select="SELECT doc_id, array_to_string(a, ' ') AS tokens, len(a) AS n FROM (SELECT doc_id, "
        + treebank("text", "known") + " AS a FROM titled, (SELECT list(word) AS known FROM scored WHERE score >= 0.3))",
    ),
    "tokens_treebank": f"SELECT doc_id, array_to_string(a, ' ') AS tokens, len(a) AS n FROM (SELECT doc_id, {treebank('text')} AS a FROM documents)",
    "keep_alnum": (
        "SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda x: regexp_matches(x, '[a-zA-Z\\p{Nd}]')), ' ') AS tokens"
        " FROM documents"
    ),
    "lower_tokens": "SELECT doc_id, array_to_string(list_transform(string_split(text, ' '), lambda x: lower(x)), ' ') AS tokens FROM documents",
    "no_stop_words": with_ctes(
        DOC, select=f"SELECT doc_id, array_to_string(list_filter(tokens, lambda x: x NOT IN {STOP}), ' ') AS tokens FROM doc"
    ),
    "stem_terms": with_ctes(
        DOC, TOK, *STEMS,
        select="SELECT doc_id, coalesce(s.tokens, '') AS tokens, coalesce(n, 0) AS n FROM doc LEFT JOIN stemmed s USING (doc_id)",
    ),
    "token_positions": with_ctes(DOC, TOK, select="SELECT doc_id, pos, term FROM tok"),
    "bigrams": with_ctes(DOC, TOK, BI, select="SELECT doc_id, pos, t1, t2 FROM bi"),
    "query_terms": with_ctes(Q, QT, select="SELECT qid, ord, term FROM qt"),
    "flag_common": with_ctes(DOC, TOK, select=f"SELECT DISTINCT term, term IN {STOP} AS is_common FROM tok"),
    "defragment": f"SELECT page_id, url, {defragment('url')} AS clean_url, {defragment(chr(39) + 'HTTP' + chr(39) + ' || substr(url, 5) || ' + chr(39) + '?#x' + chr(39))} AS rebuilt FROM pages",
    "dedupe_url_first": with_ctes(
        PAGES2,
        select="SELECT seq, url, md5(content) AS content_md5 FROM pages2 QUALIFY row_number() OVER (PARTITION BY "
        + defragment("url") + " ORDER BY seq) = 1",
    ),
    "dedupe_url_exact": with_ctes(
        PAGES3,
        select="SELECT seq, url, row_number() OVER (ORDER BY seq) - 1 AS n, md5(content) AS content_md5 FROM (SELECT * FROM pages3"
        " QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq) = 1)",
    ),
    "snapshot_pages": with_ctes(
        PAGES3, select="SELECT url, min(seq) AS seq, md5(arg_max(content, seq)) AS content_md5 FROM pages3 GROUP BY url"
    ),
    "read_pages": "SELECT url, md5(html) AS content_md5, regexp_extract(url, '^https?://([^/]+)', 1) AS subdomain FROM pages",
    "token_weights": with_ctes(DOC, TOK, select="SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL"),
    "token_hash64": with_ctes(
        DOC, TOK, *signature_ctes()[:2],
        select="SELECT term, (CASE WHEN hi >= 2147483648 THEN hi - 4294967296 ELSE hi END) * 4294967296 + lo AS h FROM hash",
    ),
    "simhash64": with_ctes(DOC, TOK, *signature_ctes(), select="SELECT seq AS doc_id, sig FROM sig"),
    "bit_similarity": with_ctes(
        DOC, TOK, *signature_ctes(),
        select="SELECT a.seq AS a, b.seq AS b, 1 - (bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo))) / 64.0::DOUBLE AS similarity"
        " FROM sig a JOIN sig b ON b.seq = a.seq + 1",
    ),
    "near_duplicate_pairs": with_ctes(
        DOC, TOK, *signature_ctes(), GREEDY[0],
        select="SELECT f.seq AS earlier, s.seq AS later, 0 AS distance FROM firsts f JOIN sig s ON s.sig = f.sig AND s.seq > f.seq"
        " UNION ALL SELECT a.seq, b.seq, 1 FROM firsts a JOIN firsts b ON a.seq < b.seq"
        " WHERE bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) = 1",
    ),
    "drop_near_duplicates": greedy(DOC, TOK, *signature_ctes(), select="SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT seq FROM kept)"),
    "near_duplicate_pairs_90": with_ctes(DOC, TOK, *signature_ctes(), GREEDY[0], select=pairs_within(6)),
    "near_duplicate_pairs_85": with_ctes(DOC, TOK, *signature_ctes(), GREEDY[0], select=pairs_within(9)),
    "drop_near_duplicates_90": greedy(
        DOC, TOK, *signature_ctes(), select="SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT seq FROM kept)", bits=6
    ),
    "assign_doc_ids": greedy(
        DOC, TOK, *signature_ctes(), select="SELECT seq, row_number() OVER (ORDER BY seq) - 1 AS doc_id FROM kept"
    ),
    "cosine_similarity": with_ctes(
        DOC, TOK, "w AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL)",
        "norm AS (SELECT doc_id, sqrt(sum(tf * tf)) AS norm FROM w GROUP BY doc_id)",
        select="SELECT p.a, p.b, round(coalesce(d.dot / (x.norm * y.norm), 0), 9) AS cosine"
        " FROM (SELECT a.doc_id AS a, b.doc_id AS b FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1) p"
        " LEFT JOIN (SELECT u.doc_id AS a, v.doc_id AS b, sum(u.tf * v.tf)::DOUBLE AS dot FROM w u JOIN w v"
        " ON v.doc_id = u.doc_id + 1 AND v.term = u.term GROUP BY ALL) d USING (a, b)"
        " LEFT JOIN norm x ON x.doc_id = p.a LEFT JOIN norm y ON y.doc_id = p.b",
    ),
    "unigram_postings": with_ctes(DOC, TOK, POST, select="SELECT term, doc_id, tf, positions FROM post"),
    "bigram_postings": with_ctes(DOC, TOK, BI, BIPOST, select="SELECT t1, t2, doc_id, tf, positions FROM bipost"),
    "posting_lists": with_ctes(
        DOC, TOK, POST,
        select=f"SELECT term, doc_id // {SMALL_BLOCK} AS block, string_agg(doc_id || ':' || tf || ':' || positions, ';' ORDER BY doc_id) AS postings"
        " FROM post GROUP BY ALL",
    ),
    "doc_only_index": with_ctes(
        DOC, TOK,
        select=f"SELECT term, doc_id // {SMALL_BLOCK} AS block, string_agg(DISTINCT doc_id::VARCHAR, ' ' ORDER BY lpad(doc_id::VARCHAR, 12, '0')) AS docs"
        " FROM (SELECT DISTINCT term, doc_id FROM tok) GROUP BY ALL".replace("DISTINCT doc_id::VARCHAR", "doc_id::VARCHAR"),
    ),
    "doc_frequency": with_ctes(DOC, TOK, POST, DF, select="SELECT term, df FROM df"),
    "bigram_frequency": with_ctes(DOC, TOK, BI, BIPOST, BIDF, select="SELECT t1, t2, df FROM bidf"),
    "posting_size": with_ctes(DOC, TOK, POST, select="SELECT term, sum(3 * (2 + tf))::BIGINT AS size FROM post GROUP BY term"),
    "merge_segments": with_ctes(
        DOC, TOK, POST, N, *TURNS[:2],
        select="SELECT term, doc_id, tf, positions FROM post UNION ALL SELECT term, doc_id + n.n, count(*),"
        " string_agg(pos::VARCHAR, ' ' ORDER BY pos) FROM ctok, n GROUP BY term, doc_id, n.n",
    ),
    "merge_bigram_segments": with_ctes(
        DOC, TOK, BI, BIPOST, N, *TURNS,
        select="SELECT t1, t2, doc_id, tf, positions FROM bipost UNION ALL SELECT t1, t2, doc_id + n.n, count(*),"
        " string_agg(pos::VARCHAR, ' ' ORDER BY pos) FROM cbi, n GROUP BY t1, t2, doc_id, n.n",
    ),
    "merge_frequencies": with_ctes(
        DOC, TOK, *TURNS[:2],
        select="SELECT term, count(*) AS df FROM (SELECT DISTINCT term, doc_id FROM tok UNION ALL SELECT DISTINCT term, -1 - doc_id FROM ctok)"
        " GROUP BY term",
    ),
    "pair_dictionary": with_ctes(DOC, TOK, BI, BIPOST, BIDF, select="SELECT t1, t2, df FROM bidf"),
    "extend_index": grown(select="SELECT doc_id, url, disk_loc FROM doc2"),
    "extend_index_postings": grown(*over_kept(POST), select="SELECT term, doc_id, tf, positions FROM post"),
    "extend_index_pairs": grown(*over_kept(BI, BIPOST, BIDF), select="SELECT t1, t2, df FROM bidf"),
    "extend_index_search": grown(
        *KEPT_RANKING,
        select="SELECT r.qid, r.rank, r.doc_id, round(r.score, 6) AS score, d.url, d.disk_loc FROM ranked r JOIN doc2 d USING (doc_id)",
    ),
    "index_stats": with_ctes(
        DOC, TOK, POST,
        select="SELECT 'documents' AS metric, count(*) AS value FROM doc UNION ALL SELECT 'unique_tokens', count(DISTINCT term) FROM post"
        " UNION ALL SELECT 'postings', count(*) FROM post UNION ALL SELECT 'approximate_index_size', sum(3 * (2 + tf))::BIGINT FROM post",
    ),
    "lookup_terms": with_ctes(*INDEX, *QUERY, select="SELECT qid, term, doc_id, tf FROM hits"),
    "lookup_bigrams": with_ctes(*INDEX, *QUERY, BIHITS, select="SELECT qid, ord, t1, t2, doc_id, tf, df FROM bihits"),
    "term_budget": with_ctes(Q, QT, *BUDGET, select="SELECT qid, term, is_common, round(budget, 6) AS budget FROM budget"),
    "boolean_and": with_ctes(*INDEX, *QUERY, CAND, select="SELECT qid, doc_id FROM cand"),
    "unigram_tfidf": with_ctes(*INDEX, *QUERY, UNI, select="SELECT qid, doc_id, round(uni, 6) AS uni FROM uni"),
    "restrict_to_candidates": with_ctes(
        *INDEX, *QUERY, CAND, BIHITS,
        select="SELECT qid, ord, t1, t2, doc_id, tf, df FROM bihits SEMI JOIN cand USING (qid, doc_id)",
    ),
    "bigram_tfidf": with_ctes(
        *INDEX, *QUERY, BIHITS, BIW, select="SELECT qid, ord, t1, t2, doc_id, round(weight, 6) AS weight FROM biw"
    ),
    "last_bigram_wins": with_ctes(
        *INDEX, *QUERY, BIHITS, BIW, LAST, select="SELECT qid, doc_id, round(bi, 6) AS bi FROM last"
    ),
    "combine_scores": with_ctes(*FULL, select="SELECT qid, doc_id, round(score, 6) AS score FROM score"),
    "rank_top_k": with_ctes(*FULL, select="SELECT qid, rank, doc_id, round(score, 6) AS score FROM ranked"),
    "topk_unigram": with_ctes(
        *INDEX, *QUERY, UNI,
        select="SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY round(uni, 9) DESC, doc_id) AS rank, doc_id, round(uni, 6) AS score"
        " FROM uni QUALIFY rank <= 5",
    ),
    "resolve_docs": with_ctes(
        *FULL,
        select="SELECT qid, rank, doc_id, round(score, 6) AS score, 'doc:' || doc_id AS url, doc_id::VARCHAR AS disk_loc FROM ranked",
    ),
    "retrieve": greedy(
        DOC, TOK, *signature_ctes(),
        select=", ".join([""] + [c.replace(" AS (", " AS MATERIALIZED (", 1) for c in (*KEPT_INDEX, KEPT_TOK, *KEPT_RANKING)])
        + " SELECT r.qid, r.rank, r.doc_id, round(r.score, 6) AS score, 'doc:' || d.seq AS url, d.seq::VARCHAR AS disk_loc"
        " FROM ranked r JOIN doc2 d USING (doc_id)",
    ),
    "query_batch_report": with_ctes(
        *INDEX,
        "q AS (SELECT * FROM (VALUES (0, 'cristina lopes'), (1, 'machine learning'), (2, 'ACM'),"
        " (3, 'master of software engineering')) v(qid, query))",
        *QUERY[1:], UNI, BIHITS, BIW, LAST, SCORE, RANKED,
        select="SELECT qid, query, rank, 'doc:' || doc_id AS url, printf('generated_results/%d/result_%02d.html', qid, rank - 1) AS rel_path"
        " FROM ranked JOIN q USING (qid)",
    ),
    "query_batch_report_all": with_ctes(
        *FULL,
        select="SELECT qid, query, rank, 'doc:' || doc_id AS url, printf('generated_results/%d/result_%02d.html', qid, rank - 1) AS rel_path"
        " FROM ranked JOIN q USING (qid)",
    ),
    "highlight": f"SELECT page_id, {highlight('html', ['que', 'de', 'The'])} AS html FROM pages",
    "retrieve_pages": greedy(
        *PAGE_DOC, TOK, *signature_ctes(),
        select=", ".join([""] + [c.replace(" AS (", " AS MATERIALIZED (", 1) for c in PAGE_RANKING])
        + " SELECT r.qid, r.rank, r.doc_id, round(r.score, 6) AS score, d.url, d.seq::VARCHAR AS disk_loc FROM ranked r JOIN doc2 d USING (doc_id)",
    ),
    "search_results": greedy(
        *PAGE_DOC, TOK, *signature_ctes(),
        select=", ".join([""] + [c.replace(" AS (", " AS MATERIALIZED (", 1) for c in PAGE_RANKING])
        + " SELECT r.qid, q.query, r.rank, d.url, printf('generated_results/%d/result_%02d.html', r.qid, r.rank - 1) AS rel_path"
        " FROM ranked r JOIN doc2 d USING (doc_id) JOIN q USING (qid)",
    ),
    "result_pages": greedy(
        *PAGE_DOC, TOK, *signature_ctes(),
        select=", ".join([""] + [c.replace(" AS (", " AS MATERIALIZED (", 1) for c in PAGE_RANKING])
        + " SELECT r.qid, r.rank, printf('generated_results/%d/result_%02d.html', r.qid, r.rank - 1) AS rel_path, CASE r.qid"
        + " ".join([""] + [f"WHEN {i} THEN {highlight('p.content', t.split())}" for i, t in enumerate(PAGE_QUERIES)])
        + " END AS html FROM ranked r JOIN doc2 d USING (doc_id) JOIN pages2 p ON p.seq = d.seq",
    ),
}
