"""URL functions as native Column expressions.

``resolve(base, href)`` follows ``urllib.parse.urljoin`` (RFC 3986 with the
standard library's quirks): absolute references pass through, ``//host``
takes the base scheme, ``#f`` / ``?q`` / ``''`` keep the base path, and
path references are merged and dot segments removed with an ``aggregate``
over the split path.  No Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitelens.functions.text import bind

SCHEME_RE = "^([A-Za-z][A-Za-z0-9+.-]*):"
AUTHORITY_RE = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
# scheme, authority, path, query (with '?'), fragment (with '#')
SPLIT_RE = "^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(\\?[^#]*)?(#.*)?$"


def authority(url: Column) -> Column:
    """``urlparse(url).netloc``: userinfo and port kept, case kept."""
    return F.regexp_extract(url, AUTHORITY_RE, 1)


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, SPLIT_RE, i)


def _resolve_path(segments: Column) -> Column:
    """Dot-segment removal over an array of path segments, as urljoin does."""
    init = F.array().cast("array<string>")
    merged = F.aggregate(
        segments, init,
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    last = F.element_at(segments, -1)
    merged = F.when(last.isin(".", ".."), F.array_append(merged, F.lit(""))).otherwise(merged)
    joined = F.array_join(merged, "/")
    return F.when(joined == "", F.lit("/")).otherwise(joined)


def base_parts(base: Column) -> Column:
    """Per-page pieces of the base URL, computed once per page and shared by
    all of its links."""
    has_auth = base.rlike("^[A-Za-z][A-Za-z0-9+.-]*://")
    b_scheme, b_auth, b_path = _part(base, 1), _part(base, 2), _part(base, 3)
    base_dir = F.split(b_path, "/")
    base_dir = F.when(F.element_at(base_dir, -1) != "", F.slice(base_dir, 1, F.size(base_dir) - 1)).otherwise(base_dir)
    return F.struct(
        base.alias("base"), has_auth.alias("has_auth"), b_scheme.alias("scheme"),
        F.when(has_auth, F.concat(b_scheme, F.lit("://"), b_auth)).otherwise(F.concat(b_scheme, F.lit(":"))).alias("prefix"),
        F.regexp_replace(base, "#.*$", "").alias("no_frag"),
        F.regexp_replace(base, "[?#].*$", "").alias("no_query"),
        base_dir.alias("dir"))


DOT_SEGMENT_RE = "^[^?#]*(^|/)\\.\\.?(/|[?#]|$)"


def resolve_with(bp: Column, href: Column) -> Column:
    """``urljoin`` given ``base_parts``.  Rooted references without dot
    segments (the common case) take a plain concatenation; only the rest go
    through segment merging."""
    # as the standard library splits URLs: leading control characters and blanks go, line breaks and tabs anywhere
    def clean(given: Column) -> Column:
        stripped = F.regexp_replace(F.regexp_replace(given, "^[\\x00-\\x20]+", ""), "[\\t\\n\\r]", "")
        return bind(stripped, lambda h: _resolved(bp, given, h))

    return bind(href, clean)


def _resolved(bp: Column, given: Column, href: Column) -> Column:
    base = bp["base"]
    h_path, h_query, h_frag = _part(href, 3), _part(href, 4), _part(href, 5)
    rooted = F.split(h_path, "/")
    rel = F.concat(bp["dir"], F.split(h_path, "/"))
    n = F.size(rel)
    inner = F.filter(F.slice(rel, 2, F.greatest(n - 2, F.lit(0))), lambda s: s != "")
    rel = F.when(n > 2, F.concat(F.slice(rel, 1, 1), inner, F.slice(rel, n, 1))).otherwise(rel)
    path = F.when(h_path.startswith("/"), _resolve_path(rooted)).otherwise(_resolve_path(rel))
    # urlunparse roots the path whenever there is an authority
    path = F.when(bp["has_auth"] & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    merged = F.concat(bp["prefix"], path, h_query, h_frag)

    return (
        F.when(href.isNull(), F.lit(None))
        .when(href.startswith("/") & ~href.startswith("//") & ~href.rlike(DOT_SEGMENT_RE),
              F.concat(bp["prefix"], href))
        .when(href.rlike(SCHEME_RE), F.when(F.lower(F.regexp_extract(href, SCHEME_RE, 1)) == F.lower(bp["scheme"]), href)
              .otherwise(given))
        .when(href.startswith("//"), F.concat(bp["scheme"], F.lit(":"), href))
        .when(given == "", base)
        .when(href == "", bp["no_frag"])
        .when(href.startswith("#"), F.concat(bp["no_frag"], href))
        .when(href.startswith("?"), F.concat(bp["no_query"], href))
        .when((h_path == "") & (h_query != ""), F.concat(bp["no_query"], href))
        .otherwise(merged)
    )


def resolve(base: Column, href: Column) -> Column:
    return resolve_with(base_parts(base), href)


def is_document(url: Column, extensions: list[str]) -> Column:
    """Lower-cased URL contains one of the extensions (substring test)."""
    from sitelens.functions.text import any_contains
    return any_contains(F.lower(url), extensions)

