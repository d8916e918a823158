"""Text cleaning and field parsing as Spark column expressions.

All of these are built-in functions (regexp_replace, translate, split,
try_cast, try_to_date ...), so they run inside whole-stage codegen on the
executors; nothing here calls back into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------
# Page markers the site wraps around highlighted words; deleted before parsing.
MARKERS = ["<!--red_beg-->", "<!--red_end-->", "<em>", "</em>"]
MARKER_PATTERN = "<!--red_beg-->|<!--red_end-->|<em>|</em>"

# Characters kept by the ASCII filter: space (U+0020) through tilde (U+007E).
NON_PRINTABLE_ASCII = "[^ -~]"

# Characters deleted from a name before it is used as a folder name.
UNSAFE_NAME_CHARS = "'/,?:*<>|\""

# Emoji and their text aliases (Unicode CLDR short names, spaces as
# underscores, wrapped in colons). Sequences with a variation selector come
# before their bare base character so the longer form is replaced first.
EMOJI_ALIASES = [
    ("❤️", ":red_heart:"),
    ("❤", ":red_heart:"),
    ("☀️", ":sun:"),
    ("☀", ":sun:"),
    ("⭐", ":star:"),
    ("☕", ":hot_beverage:"),
    ("\U0001F600", ":grinning_face:"),
    ("\U0001F602", ":face_with_tears_of_joy:"),
    ("\U0001F60A", ":smiling_face_with_smiling_eyes:"),
    ("\U0001F60D", ":smiling_face_with_heart-eyes:"),
    ("\U0001F60E", ":smiling_face_with_sunglasses:"),
    ("\U0001F622", ":crying_face:"),
    ("\U0001F642", ":slightly_smiling_face:"),
    ("\U0001F44D", ":thumbs_up:"),
    ("\U0001F44E", ":thumbs_down:"),
    ("\U0001F44F", ":clapping_hands:"),
    ("\U0001F44C", ":OK_hand:"),
    ("\U0001F64F", ":folded_hands:"),
    ("\U0001F4AF", ":hundred_points:"),
    ("\U0001F389", ":party_popper:"),
    ("\U0001F31F", ":glowing_star:"),
    ("\U0001F525", ":fire:"),
    ("\U0001F3A1", ":ferris_wheel:"),
    ("\U0001F3F0", ":castle:"),
    ("\U0001F3AD", ":performing_arts:"),
    ("\U0001F4F7", ":camera:"),
    ("\U0001F37A", ":beer_mug:"),
    ("\U0001F687", ":metro:"),
    ("\U0001F929", ":star-struck:"),
]
# Sentinel the reference writes for a missing field.
NONE = "NONE"
# --- end of fixed values -------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_markers(c) -> Column:
    """Markers deleted; a text without the beginning of one is not looked through for them."""
    c = _c(c)
    may = c.contains("<!--red_") | c.contains("<em>") | c.contains("</em>")
    return F.when(may, F.regexp_replace(c, MARKER_PATTERN, "")).otherwise(c)


def _emoji_guard() -> str:
    """Character class that holds the first character of every alias key: a text
    without any of it has nothing to replace. Two ranges, below and beyond U+FFFF:
    a class of single characters costs a test for each of them."""
    firsts = sorted(ord(e[0]) for e, _ in EMOJI_ALIASES)
    low, high = [x for x in firsts if x < 0x10000], [x for x in firsts if x >= 0x10000]
    return f"[\\x{{{low[0]:X}}}-\\x{{{low[-1]:X}}}\\x{{{high[0]:X}}}-\\x{{{high[-1]:X}}}]"


def demojize(c) -> Column:
    """Replace each emoji of the alias table by its ``:alias:`` text. One
    character-class scan decides whether the replace chain runs at all."""
    col = _c(c)
    out = col
    for emo, alias in EMOJI_ALIASES:
        out = F.replace(out, F.lit(emo), F.lit(alias))
    return F.when(col.rlike(_emoji_guard()), out).otherwise(col)


def ascii_filter(c) -> Column:
    return F.regexp_replace(_c(c), NON_PRINTABLE_ASCII + "+", "")       # a run of them goes at once


def clean_text(c, enabled: bool = True) -> Column:
    """strip_markers, then demojize, then ascii_filter; ``enabled=False`` is
    the variant that leaves the page as fetched."""
    if not enabled:
        return _c(c)
    return ascii_filter(demojize(strip_markers(c)))


def safe_name(c) -> Column:
    return F.translate(_c(c), UNSAFE_NAME_CHARS, "")


def digits_only(c) -> Column:
    return F.regexp_replace(_c(c), "[^0-9]", "")


def to_int(c) -> Column:
    """String to a long; anything that is not a number becomes NULL."""
    return _c(c).try_cast("long")


def comma_int(c) -> Column:
    """"52,910" -> 52910."""
    return F.replace(_c(c), F.lit(","), F.lit("")).try_cast("long")


def page_count(n, size: int = 10, mode: str = "ceil") -> Column:
    """Number of pages for ``n`` items, ``size`` a page.

    ``ceil`` lists every item; ``floor`` and ``floor_plus_one`` reproduce the
    two truncating forms the crawlers used (the last drops the tail page, the
    other adds an empty one on exact multiples).
    """
    n = _c(n)
    if mode == "ceil":
        return F.floor((n + F.lit(size - 1)) / F.lit(size)).cast("long")
    if mode == "floor":
        return F.floor(n / F.lit(size)).cast("long")
    if mode == "floor_plus_one":
        return F.floor(n / F.lit(size)).cast("long") + F.lit(1)
    raise ValueError(mode)


def split_labels(c) -> Column:
    """Split on '&'; parts are not trimmed."""
    return F.split(_c(c), "&")


def split_visit(c) -> Column:
    """Visit string -> struct(time, type, extra).

    Accepts "Jul 2021  Family" (bullet already removed by the ASCII filter),
    "Jul 2021 • Family" (uncleaned) and "Jul 2021". The sentinel NONE and
    a missing part become NULL. A string with more than two parts keeps the
    first as time and the rest, re-joined, as type, and sets ``extra``.
    """
    t = F.regexp_replace(_c(c), " • ", "  ")
    parts = F.split(t, "  ")
    n = F.size(parts)
    time = F.get(parts, 0)
    typ = F.when(n >= 2, F.array_join(F.slice(parts, 2, n - 1), "  "))
    return F.struct(
        F.when(time != NONE, time).alias("time"),
        F.when(typ != NONE, typ).alias("type"),
        (n > 2).alias("extra"),
    )


def visit_month(c) -> Column:
    """"Jul 2021" -> DATE 2021-07-01; anything else -> NULL."""
    return F.try_to_date(_c(c), "MMM yyyy")


def none_if_sentinel(c) -> Column:
    c = _c(c)
    return F.when(c != NONE, c)


def or_sentinel(c) -> Column:
    return F.coalesce(_c(c), F.lit(NONE))
