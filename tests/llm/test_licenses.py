import re

import pytest

from assaylake.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _plain(text):
    """Words and base phrases, word by word."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_query_equals_plain_scan(spark, documents, sf):
    docs = {r.doc_id: r.text for r in documents.collect()}
    got = queries.op7_licenses(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _plain(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)


def test_odd_rows(odd, empty):
    scanned = licenses.scan_licenses(odd, into="score")
    assert scanned.columns == odd.columns
    for r in scanned.collect():
        assert (r.score.n_words, r.score.n_base, r.score.first_word, r.score.last_word, ",".join(r.score.base_labels)) == _plain(r.text)
    assert licenses.scan_licenses(empty).collect() == []


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
        ("licensed under the\n * Apache\n * License, version 2.0", {"apache-2.0"}),
        ("Released under the MIT License.", {"mit"}),
        ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0"}),
        ("GNU Lesser General Public License v2.1", {"lgpl-2.1"}),
        ("# SPDX-License-Identifier: MPL-2.0", {"mpl-2.0"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
        ("Creative Commons Attribution ShareAlike", {"cc-by-sa"}),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted", {"bsd"}),
        ("the committee submitted a permit", set()),
        ("mit Lizenz", set()),
    ],
)
def test_signatures(text, labels):
    assert {r.label for _, _, r in licenses.detect(text.lower().encode())} == labels


@pytest.mark.parametrize(
    "text, label",
    [
        ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa-4.0"),
        ("Creative Commons Attribution-Share Alike", "cc-by-sa"),
        ("Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported", "cc-by-nc-sa-3.0"),
        ("Creative Commons Attribution-Non-Commercial-NoDerivatives 4.0", "cc-by-nc-nd-4.0"),
        ("Creative Commons Attribution-NoDerivs 3.0", "cc-by-nd-3.0"),
        ("Creative Commons Attribution-NonCommercial 2.0", "cc-by-nc-2.0"),
        ("Creative Commons Attribution. No derivation", "cc-by"),
    ],
)
def test_creative_commons_names_in_full(text, label):
    assert {r.label for _, _, r in licenses.detect(text.lower().encode())} == {label}


@pytest.mark.parametrize(
    "text, label",
    [
        ("Permission is hereby granted, free of charge,\n" + 16 * " " + "to any person obtaining a copy", "mit"),
        ("Permission is hereby granted, free of charge, to any person          */\n/*          obtaining a copy", "mit"),
        ("Licensed under the" + 500 * " " + "Apache License,\n" + 30 * "*" + "\nVersion 2.0", "apache-2.0"),
        ("Neither the name of The Regents of the University of California nor the names of its contributors may be used", "bsd-3-clause"),
        ("Neither the name of the copyright holder, Foo Bar Inc. nor the names of its contributors may be used", "bsd-3-clause"),
    ],
)
def test_signatures_over_wide_gaps(text, label):
    assert {r.label for _, _, r in licenses.detect(text.lower().encode())} == {label}


def test_contained_detections_give_way():
    text = b"licensed under the gnu general public license, version 2.0 and the mit license"
    found = [(r.label, r.priority) for _, _, r in licenses.detect(text)]
    assert found == [("gpl-2.0", 90), ("mit", 40)]


def test_hundreds_of_rules_in_order():
    rules = licenses.rules()
    assert len(rules) > 300 and len({r.name for r in rules}) == len(rules)
    assert [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)
