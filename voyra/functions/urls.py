"""URL building and parsing as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------
SCHEME_HOST = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]+)"
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
DOT_SEGMENT = r"/\.\.?(/|$)"
# Review-page URLs: the page slot follows this word, as "-or<offset>".
PAGE_SLOT = "Reviews"
OFFSET_MARK = "-or"
# --- end of fixed values -------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_host(u) -> Column:
    return F.regexp_extract(_c(u), HOST, 1)


def abs_url(href, base: str | Column) -> Column:
    """Root-relative link -> absolute by prefixing the site; others unchanged."""
    href = _c(href)
    base = F.lit(base) if isinstance(base, str) else base
    return F.when(href.startswith("/") & ~href.startswith("//"), F.concat(base, href)).otherwise(href)


def fold_dots(path: Column) -> Column:
    """``path`` (it starts with "/") without "." and ".." segments; ".." at the root stays there."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    kept = F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(DOT_SEGMENT), F.array_join(kept, "/")).otherwise(path)


def url_join(base, href) -> Column:
    """Resolve ``href`` against the page ``base`` the way a browser does for
    the common forms: absolute, scheme-relative, root-relative, query-only,
    fragment-only, empty and path-relative; "." and ".." segments are folded."""
    base, href = _c(base), _c(href)
    scheme_host = F.regexp_extract(base, SCHEME_HOST, 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    no_frag = F.regexp_replace(base, "#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    path = F.substring(no_query, F.length(scheme_host) + 1, 1 << 30)
    dir_ = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    href_path = F.regexp_extract(href, "^[^?#]*", 0)
    href_tail = F.substring(href, F.length(href_path) + 1, 1 << 30)
    return (F.when(href.rlike(ABSOLUTE), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(scheme_host, fold_dots(href_path), href_tail))
            .when(href.startswith("?"), F.concat(no_query, href))
            .when(href.startswith("#"), F.concat(no_frag, href))
            .when(href == "", base)   # an empty link is the page itself, fragment kept
            .otherwise(F.concat(scheme_host, fold_dots(F.concat(dir_, href_path)), href_tail)))


def url_template(u, offset) -> Column:
    """Insert the review offset after every ``Reviews`` in the URL."""
    off = F.lit(offset) if isinstance(offset, int) else _c(offset)
    return F.regexp_replace(_c(u), F.lit(PAGE_SLOT), F.concat(F.lit(PAGE_SLOT + OFFSET_MARK), off.cast("string")))


def url_page_no(u, size: int = 10) -> Column:
    """Third integer in the URL divided by the page size; NULL when absent."""
    third = F.get(F.regexp_extract_all(_c(u), F.lit(r"(\d+)"), 1), 2)
    return F.floor(third.try_cast("long") / F.lit(size)).cast("long")


def url_fingerprint(u) -> Column:
    return F.sha1(_c(u))
