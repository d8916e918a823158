"""Simple field extraction from page markup with built-in regex functions.

Pages are not well-formed XML (``<br>``, unclosed ``<p>``), so SQL ``xpath``
is not usable. Single fields come out with regexes that Java and RE2 read the
same way (no look-around, no back-references); whole records go through
``voyra.operators.extract``.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from voyra.functions.text import comma_int

# --- fixed values --------------------------------------------------------
SCRIPT_OR_STYLE = r"(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
TAG = r"<[^>]*>"
H1 = r"(?is)<h1[^>]*>(.*?)</h1>"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
NOT_MARKUP = r"<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
LINK_HREF = r"(?is)" + NOT_MARKUP + r"|<a\s(?:[^>]*?\s)?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
LINK_AND_TEXT = LINK_HREF + r"[^>]*>(.*?)</a\s*>"
QUOTES = r"^[\"']|[\"']$"
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
PARAGRAPH = r"(?s)<p(?:\s[^>]*)?>(.*?)</p>"
PAGE_TOTAL = r"of ([0-9][0-9,]*)"
# --- end of fixed values -------------------------------------------------

# by the standard library's tables: names of characters, and what numbers from 128 to 159 stand for on pages
NAMED = {**name2codepoint, "apos": 39}
NUMBERED = {n: ord(bytes([n]).decode("cp1252")) for n in range(128, 160) if n not in (129, 141, 143, 144, 157)}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_scripts(c) -> Column:
    return F.regexp_replace(_c(c), SCRIPT_OR_STYLE, "")


def strip_tags(c) -> Column:
    return F.regexp_replace(_c(c), TAG, "")


def html_title(c) -> Column:
    """Text of the first <h1> (tags inside removed, entities decoded); NULL when there is none."""
    h = F.regexp_extract(_c(c), H1, 1)
    return F.when(_c(c).rlike(H1), html_unescape(F.trim(strip_tags(h))))


def html_links(c) -> Column:
    """Every ``href`` of an ``<a>`` tag, in page order: either quote or none, tags
    in either case, entities decoded. Comments, scripts and styles hold no tags."""
    found = F.filter(F.regexp_extract_all(_c(c), F.lit(LINK_HREF), 1), lambda h: h != "")
    return F.transform(found, lambda h: html_unescape(F.regexp_replace(h, QUOTES, "")))


def html_links_and_texts(c) -> Column:
    """Array of (href, label) of every ``<a>`` with an end tag, in page order; the label is
    the text inside, tags removed, entities decoded."""
    both = F.arrays_zip(F.regexp_extract_all(_c(c), F.lit(LINK_AND_TEXT), 1).alias("href"),
                        F.regexp_extract_all(_c(c), F.lit(LINK_AND_TEXT), 2).alias("label"))
    return F.transform(F.filter(both, lambda x: x["href"] != ""), lambda x: F.struct(
        html_unescape(F.regexp_replace(x["href"], QUOTES, "")).alias("href"),
        html_unescape(F.trim(strip_tags(x["label"]))).alias("label")))


def html_text_all(c) -> Column:
    """Text of every paragraph, scripts removed first (a script may hold "</p>")."""
    paras = F.regexp_extract_all(strip_scripts(c), F.lit(PARAGRAPH), 1)
    return F.transform(paras, lambda p: strip_tags(p))


def html_page_total(c) -> Column:
    """Total count from pager text such as "1-10 of 1,234 reviews"."""
    return comma_int(F.regexp_extract(_c(c), PAGE_TOTAL, 1))


def _character(code: Column) -> Column:
    """A code point as text; what is none (zero, surrogates, beyond the last) is U+FFFD."""
    moved = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in NUMBERED.items() for x in kv]), code.cast("int")), code)
    ok = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(ok, F.decode(F.unhex(F.lpad(F.hex(moved), 8, "0")), "UTF-32")).otherwise("\ufffd")


def _entity(e: Column) -> Column:
    names = F.create_map(*[F.lit(x) for name, code in NAMED.items() for x in (name, chr(code))])
    name = F.substr(e, F.lit(2), F.length(e) - 2)
    number = F.when(F.lower(name).startswith("#x"), F.conv(F.substr(name, F.lit(3)), 16, 10).cast("long")) \
        .when(name.startswith("#"), F.substr(name, F.lit(2)).cast("long"))
    return F.when(number.isNotNull(), _character(number)).otherwise(F.coalesce(F.try_element_at(names, name), e))


def html_unescape(c) -> Column:
    """Entities decoded, each once: named ones (those of HTML 4 and the apostrophe) and
    numbers in either base. A name that isn't known stays as it is."""
    c = _c(c)
    between = F.split(c, ENTITY, -1)
    found = F.regexp_extract_all(c, F.lit(ENTITY), 0)
    decoded = F.transform(F.arrays_zip(found.alias("e"), F.slice(between, F.lit(2), F.size(found)).alias("after")),
                          lambda x: F.concat(_entity(x["e"]), x["after"]))
    return F.when(c.contains("&") & c.rlike(ENTITY), F.concat(F.get(between, 0), F.array_join(decoded, ""))).otherwise(c)


def html_escape(c) -> Column:
    """Escape text for use inside markup (the inverse of what a parser undoes)."""
    c = _c(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c
