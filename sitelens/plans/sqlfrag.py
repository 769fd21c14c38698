"""DuckDB twins of the Column builders in ``sitelens.functions``.

Each helper returns SQL text.  Character references, whitespace, authority and
scheme patterns are written here anew, in RE2's own terms; the remaining HTML
patterns are shared with the Spark side.
"""

from __future__ import annotations

from sitelens.functions import html as H

# what the corpus uses; '&amp;' last, so that '&amp;lt;' gives '&lt;'
REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", "\u00a0"),
              ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&mdash;", "\u2014"), ("&eacute;", "\u00e9"),
              ("&amp;", "&")]
SPACES = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
SCHEME = r"^([[:alpha:]][[:alnum:]+.-]*):"
AUTHORITY = r"^[[:alpha:]][[:alnum:]+.-]*://([^/?#]*)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx_replace(x: str, pat: str, rep: str = "") -> str:
    return f"regexp_replace({x}, {q(pat)}, {q(rep)}, 'g')"


def unescape(x: str) -> str:
    for k, v in REFERENCES:
        x = f"replace({x}, {q(k)}, {q(v)})"
    return x


def strip_ws(x: str) -> str:
    return rx_replace(x, f"^{SPACES}+|{SPACES}+$")


def squash_ws(x: str) -> str:
    return strip_ws(rx_replace(x, f"{SPACES}+", " "))


def any_contains(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")" if words else "FALSE"


def count_contains(x: str, words: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({x}, {q(w)}) AS INTEGER)" for w in words) + ")" if words else "0"


def authority(x: str) -> str:
    return f"regexp_extract({x}, {q(AUTHORITY)}, 1)"


def strip_noise(x: str) -> str:
    return rx_replace(x, H.NOISE_RE)


def node_text(x: str) -> str:
    return strip_ws(unescape(rx_replace(x, f"{SPACES}*<[^>]*>{SPACES}*")))


def attr_value(attrs: str, name: str) -> str:
    p = q(H.attr_re(name))
    return unescape(f"(regexp_extract({attrs}, {p}, 1) || regexp_extract({attrs}, {p}, 2) || "
                    f"regexp_extract({attrs}, {p}, 3))")


def title(x: str) -> str:
    return f"nullif({unescape(f'regexp_extract({strip_noise(x)}, {q(H.TITLE_RE)}, 1)')}, '')"


def resolve(base: str, href: str) -> str:
    """urljoin for references without dot segments (all the corpus has)."""
    scheme = f"regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"
    origin = f"regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
    no_frag = f"regexp_replace({base}, '#.*$', '')"
    no_query = f"regexp_replace({base}, '[?#].*$', '')"
    return (f"CASE WHEN {href} IS NULL THEN NULL "
            f"WHEN regexp_matches({href}, {q(SCHEME)}) THEN {href} "
            f"WHEN starts_with({href}, '//') THEN {scheme} || ':' || {href} "
            f"WHEN {href} = '' THEN {base} "
            f"WHEN starts_with({href}, '#') THEN {no_frag} || {href} "
            f"WHEN starts_with({href}, '?') THEN {no_query} || {href} "
            f"WHEN starts_with({href}, '/') THEN {origin} || {href} "
            f"ELSE regexp_replace({no_query}, '[^/]*$', '') || {href} END")


def plain_text(x: str) -> str:
    h = rx_replace(x, H.NOISE_RE)
    for tag in ("nav", "header", "footer"):
        h = rx_replace(h, f"(?is)<{tag}\\b[^>]*>.*?</{tag}>")
    h = rx_replace(h, "<[^>]*>")
    h = squash_ws(unescape(h))
    h = rx_replace(h, "[^\\p{L}\\p{N}_ \\t\\n\\f\\r-]", " ")
    return squash_ws(h)


def region_text(x: str) -> str:
    h = strip_noise(x)
    region = (f"coalesce(nullif(regexp_extract({h}, '(?is)<main\\b[^>]*>(.*?)</main>', 1), ''), "
              f"nullif(regexp_extract({h}, '(?is)<article\\b[^>]*>(.*?)</article>', 1), ''), "
              f"nullif(regexp_extract({h}, '(?is)<body\\b[^>]*>(.*?)(</body>|$)', 1), ''), {h})")
    return squash_ws(unescape(rx_replace(region, "<[^>]*>", " ")))


def pages_cte() -> str:
    return f"pg AS (SELECT page_id, url, html, {authority('url')} AS entity, page_id AS page_seq FROM pages)"


def links_cte() -> str:
    """pages -> links(entity, page_id, page_seq, link_seq, href, url, text, title)."""
    a = q(H.ANCHOR_RE)
    found = (f"list_filter(regexp_extract_all({strip_noise('html')}, {a}, 0), "
             f"lambda m: regexp_matches(regexp_extract(m, {a}, 1), {q(H.HREF_PRESENT_RE)}))")
    return f"""
lk0 AS (SELECT page_id, url AS page_url, {authority('url')} AS entity, page_id AS page_seq, {found} AS ms FROM pages),
lk1 AS (SELECT entity, page_id, page_seq, page_url, unnest(ms) AS m, generate_subscripts(ms, 1) - 1 AS link_seq FROM lk0),
lk2 AS (SELECT entity, page_id, page_seq, page_url, link_seq,
               regexp_extract(m, {a}, 1) AS attrs, regexp_extract(m, {a}, 2) AS inner_html FROM lk1),
lk3 AS (SELECT entity, page_id, page_seq, page_url, link_seq, {attr_value('attrs', 'href')} AS href,
               lower({node_text('inner_html')}) AS text, {attr_value('attrs', 'title')} AS title FROM lk2),
links AS (SELECT entity, page_id, page_seq, link_seq, href, {resolve('page_url', 'href')} AS url, text, title FROM lk3)"""
