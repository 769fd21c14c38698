"""String helpers as JVM-side Column expressions (codegen friendly).

Regular expressions here are written in the subset shared by Java regex and
RE2, so the same pattern text can drive a DuckDB twin in the oracle.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.split()/strip() sees it, Unicode included.
WS = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WS_NO_BLANK = WS.replace("\x1c-\x20", "\x1c-\x1f")

# Character references: decimal, hexadecimal, or a name of the HTML5 table.
REFERENCE_RE = "^(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]*);"


def _names() -> dict[str, str]:
    """The HTML5 names that end in a semicolon, and the code points of the
    Windows-1252 range that stand for other characters."""
    import html.entities
    table = {k[:-1]: v for k, v in html.entities.html5.items() if k.endswith(";")}
    for n in range(0x80, 0xA0):
        shown = bytes([n]).decode("cp1252", "ignore")
        if shown:
            table[f"#{n}"] = shown
    return table


def bind(value: Column, body) -> Column:
    """``body`` of a value that is written into the plan, and computed, once
    however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _character(name: Column) -> Column:
    """What a reference's name stands for, NULL if nothing."""
    import html.entities
    names = _names()
    # the names of HTML 4 are looked up in a short text first: a look-up reads the whole text
    usual, table = (F.lit("".join(f"&{k};{names[k]}\x01" for k in sorted(some)))
                    for some in (html.entities.name2codepoint, names))

    def named(key: Column) -> Column:
        def behind(text: Column) -> Column:
            return F.substring_index(F.call_function("substring_index", text, key, F.lit(-1)), "\x01", 1)
        return F.when(F.contains(usual, key), behind(usual)).when(F.contains(table, key), behind(table))

    def numbered(code: Column) -> Column:
        return (F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("\ufffd"))
                .when(code.between(0x80, 0x9F), named(F.concat(F.lit("&#"), code.cast("string"), F.lit(";"))))
                .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))

    digits = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 9))
    return F.when(name.startswith("#"), bind(digits.cast("bigint"), lambda code: F.coalesce(
        numbered(code), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))).otherwise(
        bind(F.concat(F.lit("&"), name, F.lit(";")), named))


def unescape(c: Column) -> Column:
    """Character references decoded in one pass from left to right, so that
    ``&amp;lt;`` gives ``&lt;``.  Texts without ``&`` are left alone."""
    def decoded(part: Column) -> Column:
        return bind(F.regexp_extract(part, REFERENCE_RE, 1), lambda name: F.when(
            name == "", F.concat(F.lit("&"), part)).otherwise(bind(_character(name), lambda char: F.when(
                char.isNull(), F.concat(F.lit("&"), part)).otherwise(
                F.concat(char, F.substring(part, F.length(name) + 2, F.length(part)))))))

    def all_parts(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), decoded)
        return F.concat(parts[0], F.array_join(rest, ""))

    return bind(c, lambda s: F.when(F.contains(s, F.lit("&")), bind(F.split(s, "&", -1), all_parts)).otherwise(s))


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def squash_ws(c: Column) -> Column:
    """``' '.join(s.split())``: runs of whitespace to one blank, trimmed.  Blanks that
    stand alone are left where they are; no other whitespace is left to trim."""
    return F.trim(F.regexp_replace(c, f" {WS}+|{WS_NO_BLANK}{WS}*", " "))


def any_contains(c: Column, words: list[str]) -> Column:
    """True when any word is a literal substring; a flat OR keeps codegen."""
    if not words:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def count_contains(c: Column, words: list[str]) -> Column:
    """Number of list entries contained (presence, not occurrences)."""
    if not words:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [F.when(c.contains(w), 1).otherwise(0) for w in words])


def left_chars(c: Column, n: int) -> Column:
    """First n code points (Python slicing ``s[:n]``)."""
    return F.substring(c, 1, n)
