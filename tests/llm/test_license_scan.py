import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import AWKWARD, awkward, empty
from tickloom.llm.license_scan import (
    Any,
    Automaton,
    Choice,
    Template,
    Word,
    all_templates,
    automaton,
    mandatory_words,
    parse,
    scan,
    summary,
    words_of,
)

MARKUPS = [
    "a b <<beginOptional>>c <<beginOptional>>d<<endOptional>> a<<endOptional>> b",
    'a <<var;name="x";original="";match=".{0,2}">> c',
    'b <<var;name="x";original="";match="a a|c|">> <<beginOptional>>d<<endOptional>>',
    '<<beginOptional>>c<<endOptional>> d <<var;name="x";original="";match=".{2,3}">> a',
    "a a",
]


def readings(regions, words, at):
    """Every end that the regions can reach from `at`, by trying all ways."""
    if not regions:
        return {at}
    head, rest = regions[0], regions[1:]
    if isinstance(head, Word):
        ends = {at + 1} if at < len(words) and words[at] == head.text else set()
    elif isinstance(head, Any):
        ends = {at + n for n in range(head.least, head.most + 1) if at + n <= len(words)}
    else:
        assert isinstance(head, Choice)
        ends = {end for way in head.ways for end in readings(way, words, at)}
    return {end for middle in ends for end in readings(rest, words, middle)}


def brute(templates, words):
    out = []
    for start in range(len(words)):
        for number, template in enumerate(templates):
            if ends := readings(parse(template.markup), words, start):
                out.append((start, number, max(ends) - start))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c", b"d", b"e"]), max_size=14))
def test_automaton_finds_what_trying_all_ways_finds(words):
    templates = [Template(str(i), markup) for i, markup in enumerate(MARKUPS)]
    assert list(Automaton(templates).matches(words)) == brute(templates, words)


def test_all_templates_compile_and_hold_their_own_wording():
    templates = all_templates()
    machine = automaton(templates)
    for number, template in enumerate(templates):
        original = re.sub(r'<<var;name="[^"]*";original="([^"]*)";[^>]*>>', r" \1 ", template.markup)
        words = words_of(re.sub(r"<<.*?>>", " ", original).encode())
        assert (0, number, len(words)) in list(machine.matches(words)), template.markup
        assert mandatory_words(parse(template.markup)) > 1


@pytest.mark.parametrize(
    "markup",
    ["<<endOptional>> a", "<<beginOptional>> a", "a <<var;name=x>>", "<<other>> a", "<<beginOptional>>a<<endOptional>>",
     '<<var;name="x";original="";match=".{0,2}">> a', ""],
)
def test_bad_markup_is_refused(markup):
    with pytest.raises(ValueError):
        Automaton([Template("x", markup)])


GRANT = """Copyright (c) 2020 Jane Q. Public <jane@example.org>

 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software, and to permit persons to whom the Software is
 * furnished to do so, subject to the following conditions:

 * The above copyright notice and this permission notice shall be included in
 * all copies or substantial portions of the Software."""
GNU = "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"


def labels(spark, text):
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = summary(rows).collect()
    return row.labels, row.base_labels, row.n_base


def test_wording_decides(spark):
    assert labels(spark, f"x {GRANT} y") == ("mit", "", 0)
    assert labels(spark, GRANT.upper().replace("*", "#"))[0] == "mit"
    assert labels(spark, GRANT.replace("without limitation", "with limitation"))[0] == ""
    assert labels(spark, GRANT.replace("Software.", "Program."))[0] == ""
    assert labels(spark, GRANT.removesuffix("Software."))[0] == ""
    assert labels(spark, "Licensed under the Apache License, Version 2.0.") == ("apache,apache-2.0", "apache", 1)
    assert labels(spark, "Licensed under the Apache License, Version 1.1.") == ("apache", "apache", 1)
    assert labels(spark, GNU) == ("gpl,gpl-3.0", "gpl", 1)
    later = f"{GNU}, or (at your option) any later version."
    assert labels(spark, later) == ("gpl,gpl-3.0,gpl-3.0-or-later", "gpl", 1)
    assert labels(spark, "GNU Lesser General Public License, v2.1") == ("gpl", "gpl", 1)
    assert labels(spark, "GNU Lesser General Public License v 2.1") == ("gpl,lgpl-2.1", "gpl", 1)
    assert labels(spark, "Released under the terms of the MIT License; MIT/license, mit licenses") == ("mit", "mit", 2)


def test_awkward_rows(spark):
    rows = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.labels, r.score) for r in summary(awkward(spark)).collect()}
    words = [(i, len(words_of((t or "").encode()))) for i, t, *_ in AWKWARD]
    assert rows == {(i, n, 0, None, "", 0.0) for i, n in words}
    assert summary(empty(spark)).count() == 0


def test_scan_keeps_columns_and_gives_spans(spark):
    docs = awkward(spark).selectExpr("*", "'mit license mit license' as Spans", "1 as n_words")
    out, n_words, found = scan(docs, "Spans")
    assert out.columns == [*docs.columns, n_words, found] and len({c.lower() for c in out.columns}) == len(out.columns)
    assert {tuple((s.label, s.start, s.words) for s in r[found]) for r in out.collect()} == {
        (("mit", 0, 2), ("mit", 2, 2))
    }


def test_long_texts_of_first_words_take_time_in_proportion():
    machine = automaton(all_templates())
    start = time.perf_counter()
    for word in (b"copyright", b"permission", b"gnu", b"general"):
        assert not list(machine.matches([word] * 50_000))
    assert time.perf_counter() - start < 20
