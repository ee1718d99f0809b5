import re

from brute import base_licenses, plain_words
from rankfold.llm import license_rules

SF = "/root/testdata/sf0.01"

TEXTS = {
    "Released under the MIT License.": ("mit", "mit"),
    "Apache License, Version 2.0": ("apache-2", "apache-2"),
    "apache license": ("", "apache"),
    "Licensed under the terms of the GNU General Public License version 3 or any later version": ("", "gpl-3"),
    "CC BY-NC 4.0 and cc-by-nc": ("cc-by-nc", "cc-by-nc,cc-by-nc-4.0"),
    "SPDX-License-Identifier: MPL-2.0": ("", "mpl-2"),
    "Permission is hereby granted, free of charge, to any person obtaining a copy": ("", "mit"),
    "the omit license": ("", ""), "license " * 40: ("", ""), "BSD 3-Clause License": ("", "bsd-3"),
    "GPLv3": ("", "gpl-3"), "GPL-2.0-or-later": ("", "gpl-2"), "license: mit": ("", "mit"), "under the GNU GPL v2": ("", "gpl,gpl-2"),
    "licensed under the GPL, version 2": ("", "gpl,gpl-2"), "released under the Unlicense": ("", "unlicense"),
    "the GNU General Public License as published by the Free Software Foundation; either version 3 of the License": ("", "gpl-3"),
    "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1": ("", "lgpl-2.1"),
    "Redistributions of source code must retain the above copyright notice": ("", "bsd"), "BSD-3-Clause": ("", "bsd-3"),
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": ("", "mpl-2"),
    "This is free and unencumbered software released into the public domain.": ("", "unlicense"),
    "All rights reserved": ("", "all-rights-reserved"), "dedicated to the public domain": ("", "public-domain"),
}


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_there_are_hundreds_of_rules():
    assert len(license_rules.rules()) > 300


def test_labels(spark):
    texts = list(TEXTS)
    for r in license_rules.licenses(docs_of(spark, texts)).collect():
        assert (r.base_labels, r.labels) == TEXTS[texts[r.doc_id]], texts[r.doc_id]
        assert (r.score > 0) == bool(r.labels) and 0 <= r.score <= 1


def test_signatures_are_many():
    assert len(license_rules.SIGNATURES) >= 110


def brute(text):
    """Every rule at every keyword over the whole text, then every match against every other."""
    words, found = plain_words(text), set()
    rules = {}
    for keyword, pattern, label, form, priority, weight in license_rules.rules():
        rules.setdefault(keyword, []).append((re.compile(f"(?<= ){pattern}(?= )"), label, form, priority, weight))
    for i, w in enumerate(words):
        if w in rules:
            line = " " + "".join(x + " " for x in words[:i]) + "@" + " ".join(words[i:]) + " "
            for pattern, label, form, priority, weight in rules[w]:
                if m := pattern.search(line):
                    a, b = m[0].split("@")
                    found.add((i - a.count(" "), i + 1 + b.count(" "), label, form, priority, weight))
    kept = [x for x in found if x[3] == "base" or not any(
        o[0] <= x[0] and o[1] >= x[1] and (o[4] > x[4] or o[4] == x[4] and o[1] - o[0] > x[1] - x[0]) for o in found)]
    return ",".join(sorted({x[2] for x in kept})), max((x[5] for x in kept), default=0.0), len(kept)


def test_labels_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400).collect() + [(10_000 + i, t) for i, t in enumerate(TEXTS)]
    texts = {r[0]: r[1] for r in docs}
    texts[20_000] = " ".join(f"{t} filler{i}" for i, t in enumerate(list(TEXTS) * 40))
    rows = license_rules.licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    for r in rows:
        if r.doc_id != 20_000:
            assert (r.labels, r.score, r.n_matches) == brute(texts[r.doc_id]), texts[r.doc_id][:200]
    long = next(r for r in rows if r.doc_id == 20_000)
    once = [brute(f"filler {t} filler")[2] for t in TEXTS]
    assert long.n_words > license_rules.SPAN and long.n_matches >= 40 * sum(once) - len(TEXTS) * 40


def test_blocks_change_nothing(spark, monkeypatch):
    text = " ".join(list(TEXTS) * 30)
    docs = docs_of(spark, [text, text, "x " + text])
    want = [tuple(r) for r in license_rules.licenses(docs).orderBy("doc_id").collect()]
    monkeypatch.setattr(license_rules, "SPAN", 40)
    assert [tuple(r) for r in license_rules.licenses(docs).orderBy("doc_id").collect()] == want
    assert want[0][1:] == want[1][1:]


def test_copies_are_matched_once(spark):
    docs = docs_of(spark, ["Released under the MIT License. All rights reserved."] * 200)
    found = license_rules.detections(license_rules.mentions(docs))
    assert found.count() == found.distinct().count() < 12


def test_ties_both_stay(spark):
    rows = license_rules.detections(license_rules.mentions(docs_of(spark, ["lgpl v2 1"]))).collect()
    spans = {}
    for r in rows:
        spans.setdefault((r.start, r.end, r.priority), []).append(r.kept)
    assert all(len(set(v)) == 1 for v in spans.values())


def test_base_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = license_rules.licenses(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_licenses(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_containment_suppression_by_priority(spark):
    found = license_rules.mentions(docs_of(spark, ["available under the terms of the Mozilla Public License version 2.0 today"]))
    rows = license_rules.detections(found).collect()
    assert len(rows) > 3
    assert [(r.label, r.start, r.end) for r in rows if r.kept] == [("mpl-2", 0, 12)]


def test_places_are_counted_once_and_everywhere(spark):
    text = " ".join(["under the mit license"] * 50 + ["x"] * 3000 + ["apache license version 2", "cc by nc"])
    r = license_rules.licenses(docs_of(spark, [text])).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_licenses(text)
    assert r.n_base == 52


def test_odd_rows(odd_docs, no_docs):
    rows = license_rules.licenses(odd_docs).collect()
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows}
    assert (by[3].n_words, by[3].n_base, by[3].labels, by[3].score) == (0, 0, "", 0.0)
    assert by[8].base_labels == "cc-by-nc,mit"
    assert license_rules.licenses(no_docs).count() == 0
