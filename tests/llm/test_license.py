"""Operator 8 against a plain Python scan of the same rules, and its base part word by word."""

import random
import re

import pytest

from helpers import ODD_TEXTS, SF, clashing, docs_frame, texts_of
from matchlake.llm import license_scan as scan
from matchlake.llm.license_rules import CONFIDENCE, rules

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

NOTICES = {
    "Released under the MIT License.": "mit",
    "Licensed under the Apache License, Version 2.0 (the \"License\")": "apache-2",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
    "SPDX-License-Identifier: LGPL-2.1-or-later": "lgpl-2.1",
    "see https://creativecommons.org/licenses/by-sa/4.0/": "cc-by-sa",
    "See http://www.wtfpl.net/ for more": "wtfpl",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files": "mit",
    "Copyright (c) 2020 Example Corp. All rights reserved.": "proprietary",
    "Mozilla Public License, v. 2.0": "mpl-2.0",
    "dedicated to the Public Domain": "public-domain",
    "GNU Affero General Public License version 3": "agpl-3",
    "Common Development and Distribution License 1.1": "cddl-1.1",
    "Creative Commons Attribution 4.0": "cc-by",
}


def plain(text):
    words = WORD.findall((text or "").translate(AZ))
    places = []
    for phrase, label in scan.PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words) - len(parts) + 1)
                   if words[i:i + len(parts)] == parts]
    base = sorted({label for _, label in places})
    line, found = " ".join(words), []
    for r in rules():
        found += [(m.start(), m.end(), r.priority, r.label)
                  for m in re.finditer(scan.whole(r.pattern), line)]
    free = []
    for k, (a, b, p, label) in enumerate(found):
        if not any((c <= a and b <= d) and q >= p and ((c, d, q) != (a, b, p) or (m, n) < (label, k))
                   for n, (c, d, q, m) in enumerate(found) if n != k):
            free.append((p, label))
    score = max([CONFIDENCE[p] for p, _ in free] + [0.9 if places else 0.0])
    return (len(words), len(places), min((i for i, _ in places), default=None),
            max((i for i, _ in places), default=None), ",".join(base),
            ",".join(sorted({label for _, label in free} | set(base))), score)


def got(df):
    return {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels,
                       r.score) for r in scan.scan(df).collect()}


def test_hundreds_of_rules():
    table = rules()
    assert len(table) >= 300 and len({r.label for r in table}) >= 80
    assert [r.priority for r in table] == sorted((r.priority for r in table), reverse=True)


def test_keywords_and_roots_are_necessary():
    """Random matches of every rule hold its keyword and one of the root words."""
    rng = random.Random(4)
    for r in rules():
        for _ in range(12):
            example = random_match(re._parser.parse(r.pattern), rng)
            if not re.search(scan.whole(r.pattern), example):
                continue  # a look-ahead forbids it
            assert r.keyword in example, (r, example)
            assert any(root in example for root in scan.ROOTS), (r, example)


def random_match(tree, rng):
    """A text that the parsed pattern matches, its choices made at random."""
    out = ""
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "NOT_LITERAL":
            out += "x"
        elif name == "IN":
            kind, value = rng.choice(arg)
            out += {"LITERAL": lambda: chr(value), "NEGATE": lambda: "x",
                    "RANGE": lambda: chr(rng.randint(*value))}[str(kind)]()
        elif name == "SUBPATTERN":
            out += random_match(arg[3], rng)
        elif name == "BRANCH":
            out += random_match(rng.choice(arg[1]), rng)
        elif name == "MAX_REPEAT":
            for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 2))):
                out += random_match(arg[2], rng)
    return out


def test_query_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = {r.doc_id: r for r in scan.query(spark, SF).collect()}
    for d in docs:
        r = rows[d.doc_id]
        assert plain(d.text) == (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels,
                                 r.labels, r.score), d.doc_id


def test_notices(spark):
    texts = list(NOTICES)
    joined = " -- ".join(texts * 3)
    found = got(clashing(docs_frame(spark, [*texts, joined, *texts_of(spark)[:3]])))
    for i, t in enumerate(texts):
        assert NOTICES[t] in found[i][5].split(","), t
        assert found[i] == plain(t), t
    assert found[len(texts)] == plain(joined)


def test_containment_and_base(spark):
    texts = ["Licensed under the GNU Lesser General Public License version 2.1",
             "under the mit license under the MIT License", "CC-BY-NC cc by nc", "cc by ncs"]
    found = got(docs_frame(spark, texts))
    assert found[0][5] == "lgpl-2.1"
    assert found[1][:4] == (8, 2, 0, 4)
    assert found[2][:5] == (6, 2, 0, 3, "cc-by-nc")
    assert found[3][1:4] == (0, None, None)


@pytest.mark.parametrize("mark", ["\x85", "\u2028", "\u2029"])
def test_last_word_behind_a_line_mark(spark, mark):
    """Characters that end a line for '.' but belong to the words of a word line."""
    phrase = "under the mit license"
    texts = [f"{phrase} a {mark} b {phrase}", f"a{mark}b {phrase}", f"{phrase} {mark}",
             f"{phrase} {mark}{phrase} x {phrase}{mark} {mark} cc by nc {mark} cc by nc"]
    found = got(docs_frame(spark, texts))
    assert found == {i: plain(t) for i, t in enumerate(texts)}
    assert found[0][1:4] == (2, 0, 7)


def test_odd_rows(spark):
    df = clashing(docs_frame(spark, ODD_TEXTS))
    found = got(df.unionAll(df))
    assert found == {i: plain(t) for i, t in enumerate(ODD_TEXTS)}
    assert scan.scan(docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("native", ["Python", "Arrow", "Pandas"])
def test_native_plan(spark, native):
    plan = scan.query(spark, SF)._jdf.queryExecution().toString()
    assert native not in plan and "Exchange" not in plan


def test_many_places_take_time_in_proportion(spark):
    """100,000 places of one text, and the same labels and words as for few."""
    import time
    unit = "released under the mit license and see the license for details "
    begun = time.time()
    rows = scan.scan(docs_frame(spark, [unit * n for n in (1, 300, 25_000)])).collect()
    assert time.time() - begun < 120
    for r, n in zip(sorted(rows, key=lambda r: r.doc_id), (1, 300, 25_000)):
        assert (r.n_base, r.first_word, r.last_word) == (n, 1, 11 * (n - 1) + 1)
        assert r.labels == rows[0].labels and r.score == rows[0].score
