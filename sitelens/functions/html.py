"""HTML field extraction as native Column expressions.

Title, headings, meta description, anchors and whole-page text come out
of regular expressions evaluated inside whole-stage codegen.  Selector
based main-content extraction lives in ``sitelens.operators.content``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitelens.functions.text import WS, bind, squash_ws, strip_ws, unescape

NOISE_RE = "(?is)<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>|<!--.*?-->"
TITLE_RE = "(?is)<title[^>]*>(.*?)</title>"
ANCHOR_RE = "(?is)<a(\\s[^>]*)>(.*?)</a>"
TAG_GLUE_RE = f"{WS}*<[^>]*>{WS}*"
HREF_PRESENT_RE = "(?is)(^|\\s)href\\s*="
META_RE = "(?is)<meta(\\s[^>]*)>"


def attr_re(name: str) -> str:
    """Attribute value, double-, single- or un-quoted (groups 1, 2, 3)."""
    return f"(?is)(?:^|\\s){name}\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s\"'>]+))"


def strip_noise(html: Column) -> Column:
    """Drop script, style and comments (they may hold '</p>' and the like)."""
    return F.regexp_replace(html, NOISE_RE, "")


def node_text(fragment: Column) -> Column:
    """``tag.get_text(strip=True)``: text pieces stripped and glued."""
    return strip_ws(unescape(F.regexp_replace(fragment, TAG_GLUE_RE, "")))


def title(html: Column) -> Column:
    """``<title>`` text, NULL when absent or empty (not stripped)."""
    return F.nullif(unescape(F.regexp_extract(strip_noise(html), TITLE_RE, 1)), F.lit(""))


def headings(html: Column, level: int, limit: int | None = None) -> Column:
    arr = F.regexp_extract_all(strip_noise(html), F.lit(f"(?is)<h{level}\\b[^>]*>(.*?)</h{level}>"), 1)
    arr = F.transform(arr, node_text)
    return F.slice(arr, 1, limit) if limit else arr


def meta_description(html: Column) -> Column:
    """``content`` of the first ``<meta name="description">`` that has one, in
    any order and quoting of the attributes; NULL when absent or empty."""
    tags = F.regexp_extract_all(strip_noise(html), F.lit(META_RE), 1)
    named = F.filter(tags, lambda t: F.lower(attr_value(t, "name")) == "description")
    return F.nullif(F.try_element_at(F.transform(named, lambda t: attr_value(t, "content")), F.lit(1)), F.lit(""))


def attr_value(attrs: Column, name: str) -> Column:
    pat = attr_re(name)
    return unescape(F.concat(F.regexp_extract(attrs, pat, 1), F.regexp_extract(attrs, pat, 2),
                             F.regexp_extract(attrs, pat, 3)))


def anchors(html: Column, page_url: Column | None = None, base: Column | None = None) -> Column:
    """array<struct<href, url, text, title>> of ``a[href]`` in document order.

    One regex pass over the page finds the anchors; every per-anchor field is
    computed once inside the array, so later filters read plain struct fields
    instead of re-evaluating the extraction chain.  ``base`` may carry
    pre-computed ``urls.base_parts`` of the page URL."""
    from sitelens.functions import urls
    found = F.regexp_extract_all(strip_noise(html), F.lit(ANCHOR_RE), 0)
    found = F.filter(found, lambda m: F.regexp_extract(m, ANCHOR_RE, 1).rlike(HREF_PRESENT_RE))
    if base is None and page_url is not None:
        base = urls.base_parts(page_url)

    def fields(m):
        def of(attrs):
            return bind(attr_value(attrs, "href"), lambda href: F.struct(
                href.alias("href"), (urls.resolve_with(base, href) if base is not None else href).alias("url"),
                F.lower(node_text(F.regexp_extract(m, ANCHOR_RE, 2))).alias("text"),
                attr_value(attrs, "title").alias("title")))
        return bind(F.regexp_extract(m, ANCHOR_RE, 1), of)

    return F.transform(found, fields)


def plain_text(html: Column) -> Column:
    """Whole-page text for matching: script/style/nav/header/footer dropped,
    tags removed without separator, whitespace squashed, every character that
    is not a letter, digit, underscore, whitespace or '-' blanked, squashed
    again.  Unicode-aware classes keep Java and RE2 in agreement."""
    h = F.regexp_replace(html, NOISE_RE, "")
    for tag in ("nav", "header", "footer"):
        h = F.regexp_replace(h, f"(?is)<{tag}\\b[^>]*>.*?</{tag}>", "")
    h = F.regexp_replace(h, "<[^>]*>", "")
    h = squash_ws(unescape(h))
    h = F.regexp_replace(h, "[^\\p{L}\\p{N}_ \\t\\n\\f\\r-]", " ")
    return squash_ws(h)


def region_text(html: Column) -> Column:
    """Text of the first ``<main>`` / ``<article>`` region (else ``<body>``),
    tags replaced by a blank, whitespace squashed: the native content profile
    used where a selector engine is not needed."""
    h = strip_noise(html)
    region = F.coalesce(
        F.nullif(F.regexp_extract(h, "(?is)<main\\b[^>]*>(.*?)</main>", 1), F.lit("")),
        F.nullif(F.regexp_extract(h, "(?is)<article\\b[^>]*>(.*?)</article>", 1), F.lit("")),
        F.nullif(F.regexp_extract(h, "(?is)<body\\b[^>]*>(.*?)(</body>|$)", 1), F.lit("")),
        h,
    )
    return squash_ws(unescape(F.regexp_replace(region, "<[^>]*>", " ")))
