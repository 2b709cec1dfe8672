"""HTML columns: visible text and query highlighting.

Both work on whole pages with JVM regular expressions and share one pattern of tags. Groups are repeated possessively or not
at all, so a long run of markup or separators cannot exhaust the regex stack of an executor.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# What follows an equals sign may be quoted, and a quoted value may hold ">".
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_TAG = rf"<[!/?a-zA-Z]{_INSIDE}>"
# A comment or hidden element without an end reaches to the end of the page.
_COMMENT = r"<!--.*?(?:-->|\z)"
_HIDDEN = rf"<(script|style|template)\b{_INSIDE}>.*?(?:</\1\s*+>|\z)"

_ENTITY_PIECES = r"&#?[0-9A-Za-z]++;?|[^&]+|&"
_DECIMAL_ENTITY = r"^&#([0-9]+);?$"
_HEX_ENTITY = r"^&#[xX]([0-9a-fA-F]+);?$"
# Names that browsers know without a semicolon, longest first.
_BARE_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))

_TAG_PIECES = rf"(?s){_COMMENT}|{_TAG}|[^<]+|<"
_SEPARATORS = r"[^a-zA-Z\p{Nd}]+"


def _character(code: Column) -> Column:
    """The character of a Unicode code point; U+FFFD for one that is no character or too long a number."""
    code = F.coalesce(code, F.lit(0))
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
    return F.when(valid, F.decode(utf32, "UTF-32")).otherwise(F.lit("�"))


def decode_entities(text: Column) -> Column:
    """Replace character references (named, decimal, hexadecimal) in one pass; unknown ones stay as they are.

    Numbers may have leading zeros, and the old names need no semicolon: of ``&copyright`` the beginning is replaced.
    """
    known = {f"&{name};": chr(code) for name, code in name2codepoint.items()} | {"&apos;": "'"}
    known |= {f"&{name}": html5[name] for name in _BARE_NAMES}
    names = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
    bare = rf"^&(?:{'|'.join(_BARE_NAMES)})"

    def decode(piece: Column) -> Column:
        decimal = F.regexp_extract(piece, _DECIMAL_ENTITY, 1)
        hexadecimal = F.regexp_extract(piece, _HEX_ENTITY, 1)
        start = F.regexp_extract(piece, bare, 0)
        rest = F.concat(F.try_element_at(names, start), F.substring(piece, F.length(start) + 1, F.length(piece)))
        return (
            F.when(~F.startswith(piece, F.lit("&")), piece)
            .when(decimal != "", _character(decimal.try_cast("bigint")))
            .when(hexadecimal != "", _character(F.conv(hexadecimal, 16, 10).try_cast("bigint")))
            .otherwise(F.coalesce(F.try_element_at(names, piece), rest, piece))
        )

    pieces = F.regexp_extract_all(text, F.lit(_ENTITY_PIECES), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, decode), "")).otherwise(text)


def page_text(html: Column, sep: str = "") -> Column:
    """Visible text of an HTML page.

    Comments and the contents of script, style and template elements vanish; every other tag is replaced by ``sep``.
    The default is the empty string, so ``<li>a</li><li>b</li>`` gives ``ab``.
    """
    # One pass from left to right, so that neither a comment in a script nor a script in a comment counts.
    text = F.regexp_replace(html, rf"(?is){_COMMENT}|{_HIDDEN}|({_TAG})", "$2")
    text = F.regexp_replace(text, _TAG, sep.replace("\\", "\\\\").replace("$", "\\$"))
    return decode_entities(text)


def highlight_words(query: Column) -> Column:
    """Distinct whitespace-separated words of a query, in sorted order."""
    words = F.array_distinct(F.split(F.trim(F.regexp_replace(query, r"\s+", " ")), " "))
    return F.array_sort(F.filter(words, lambda w: w != ""))


def highlight_html(html: Column, words: Column) -> Column:
    """Wrap every whole-word occurrence of ``words`` in the text of a page in ``<mark>``, ignoring case.

    A match takes its neighbouring separators with it, so of two adjacent equal words only the first is marked. Words
    are matched literally; tags, comments and character references pass through untouched.
    """

    def mark(page: Column, word: Column) -> Column:
        literal = F.concat(F.lit(r"\Q"), F.replace(word, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        pattern = F.concat(
            F.lit(rf"(?iu)(^|{_SEPARATORS})(?!(?<=&|&#)\w+;)("),
            literal,
            F.lit(rf")($|{_SEPARATORS}(?:(?<=&|&#)\w+;[^a-zA-Z\p{{Nd}}]*+)*+)"),
        )
        pieces = F.regexp_extract_all(page, F.lit(_TAG_PIECES), F.lit(0))
        marked = F.transform(
            pieces,
            lambda p: F.when(F.startswith(p, F.lit("<")), p).otherwise(
                F.regexp_replace(p, pattern, F.lit("$1<mark>$2</mark>$3"))
            ),
        )
        return F.array_join(marked, "")

    return F.when(F.size(words) > 0, F.aggregate(words, html, mark)).otherwise(html)
