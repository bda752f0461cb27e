"""Text expressions. Every function takes and returns a Column, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace, the same as a pattern, and what breaks a word.
# In Java's patterns \s is [ \t\n\x0B\f\r] and \W is [^a-zA-Z0-9_]; spelled out, they run several times
# slower when many tasks of one executor match at once.
WHITESPACE_CHARS = " \t\n\x0b\f\r"
WHITESPACE = r"\s"
NON_WORD = r"\W"


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ws_tokens(text: Column) -> Column:
    """Lower-case and split on each whitespace character.

    Empty tokens at the front and inside are kept, trailing ones are dropped; blank text has no
    tokens, empty or null text has one empty token.
    """
    text = or_empty(text)
    kept = F.rtrim(text, F.lit(WHITESPACE_CHARS))
    blank = (kept == "") & (text != "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(F.lower(kept), WHITESPACE))


def word_tokens(text: Column) -> Column:
    """Lower-case, split on non-word characters (ASCII), drop empty tokens."""
    return F.array_remove(F.split(F.lower(or_empty(text)), NON_WORD + "+"), "")


def collapse_ws(text: Column) -> Column:
    """Each run of whitespace becomes one space; no trimming."""
    return F.regexp_replace(text, WHITESPACE + "+", " ")


# The named entities that are decoded, besides &amp;.
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "middot": "·", "hellip": "…",
    "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»",
    "euro": "€", "times": "×",
}


def _character(code: Column) -> Column:
    """The character of a code point; null outside of Unicode."""
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def numeric_entities(text: Column) -> Column:
    """Decode &#233; and &#xE9;; what is no such entity stays as it is."""

    def one(part: Column) -> Column:
        decimal = F.regexp_extract(part, r"^([0-9]{1,7});", 1)
        hexadecimal = F.regexp_extract(part, r"^[xX]([0-9a-fA-F]{1,6});", 1)
        code = F.when(decimal != "", decimal.cast("bigint")).when(hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("bigint"))
        rest = F.regexp_replace(part, r"^[^;]*;", "")
        return F.coalesce(F.concat(_character(code), rest), F.concat(F.lit("&#"), part))

    parts = F.split(text, "&#")
    decoded = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), one), ""))
    return F.when(F.contains(text, F.lit("&#")), decoded).otherwise(text)


def html_text(html: Column) -> Column:
    """Visible text of a page's body: the head, comments, scripts, styles and tags become spaces, entities are
    decoded (&amp; last), then whitespace collapses."""
    shown = html
    for gone in (
        r"(?s)<!--.*?-->",
        r"(?is)<(script|style)(\s[^>]*)?>.*?</(script|style)\s*>",
        r"(?is)<head(\s[^>]*)?>.*?</head\s*>",
        r"<[^>]*>",
    ):
        shown = F.regexp_replace(shown, gone, " ")
    for name, character in ENTITIES.items():
        shown = F.replace(shown, F.lit(f"&{name};"), F.lit(character))
    shown = F.replace(numeric_entities(shown), F.lit("&amp;"), F.lit("&"))
    return collapse_ws(shown)


def json_text(document: Column, path: str = "$.article.body") -> Column:
    """Text at a JSON path; empty when the document is malformed or the path is missing."""
    return or_empty(F.get_json_object(document, path))


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)


def scheme_and_rest(url: Column) -> tuple[Column, Column]:
    """Split an http(s) url; anything else has no scheme and is all rest."""
    scheme = F.regexp_extract(url, r"^(https?)://", 1)
    return scheme, F.regexp_replace(url, r"^https?:", "")


def post_key(author: Column, created: Column) -> Column:
    return F.concat(or_empty(author), F.lit("_"), or_empty(created))
