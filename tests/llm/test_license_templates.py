"""Variants of the notices and paragraphs of the licenses, each found as what it is."""

from sitelens.llm import licenses as L

SAID = {
    "Licensed under the MIT License.": "mit-licensed",
    "This software is released under the MIT License.": "mit",
    "The code is licensed under the GNU GPL v3.": "gpl-3.0-short",
    "The code is licensed under the GNU GPL v2.": "gpl-2.0-short",
    "// SPDX-License-Identifier: Apache-2.0": "apache-2.0-spdx",
    "# SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3.0-spdx",
    "This library is free software under the GNU Lesser General\n * Public License, see below": "lgpl",
    "Permission was given; see the BSD 3-Clause License for it": "bsd-3-clause",
}


def found(spark, rows):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r.doc_id: [m.license for m in r.licenses] for r in L.licenses(docs, windowed=True).collect()}
    return [got[i] for i in range(len(rows))]


def test_usual_variants(spark):
    assert found(spark, [f"Some prose. {text} More prose of it." for text in SAID]) == [[name] for name in SAID.values()]


def test_license_bodies_without_a_notice(spark):
    for_each = {
        "mit": ("mit-disclaimer", 60), "apache": ("apache-2.0-grant", 45), "gpl": ("gpl-3.0-preamble", 40),
        "lgpl": ("lgpl-2.1-body", 35), "mpl": ("mpl-2.0-grant", 45), "bsd": ("bsd-disclaimer", 90)}
    rows = []
    for name, _ in for_each.values():
        words = L.TEMPLATES[name].split()
        rows.append("Section 2\n" + "\n".join("   " + " ".join(words[k:k + 8]) for k in range(0, len(words), 8))
                    + "\nand further terms " * 50)
    for got, (name, least) in zip(found(spark, rows), for_each.values(), strict=True):
        assert got == [name]
        assert len(L.TEMPLATES[name].split()) >= least


def test_templates_are_told_apart(spark):
    """The two exceptions hold the other template's words."""
    within = {"apache-2.0-header": ["apache-2.0", "apache-2.0-header"], "lgpl-3.0-body": ["lgpl", "lgpl-3.0-body"]}
    for name, got in zip(L.TEMPLATES, found(spark, list(L.TEMPLATES.values())), strict=True):
        assert got == within.get(name, [name])


def test_prose_and_words_of_notices_are_none(spark):
    assert found(spark, ["The public license of the software is a general one; see the terms under the GNU tree.",
                         "He was granted permission to use, copy and modify the source, without any warranty."]) == [[], []]
