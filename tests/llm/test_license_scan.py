"""License scans against every block compared with every template."""

import random
import re
from collections import Counter
from math import ceil

import compare
from conftest import AWKWARD, SCHEMA
from tidemark.llm import licenses, oracle, queries

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"\n[\x00-\x2F\x3A-\x60\x7B-\x7F]*\n")
NOTICE = dict((label, text) for label, text in licenses.TEMPLATES)


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def pairs(text):
    found = words(text)
    return set(zip(found, found[1:]))  # noqa: B905


def expected(text, templates=licenses.TEMPLATES, phrases=licenses.PHRASES, num=4, den=5):
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found, at, base = words(text), [], set()
    for phrase, label in phrases:
        parts = phrase.split(" ")
        here = [i for i in range(len(found)) if found[i : i + len(parts)] == parts]
        at += here
        base |= {label} if here else set()
    best, more = 0.0, set()
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    for block in BLANK.split(lower):
        held = pairs(block)
        for label, template in templates:
            own = pairs(template)
            shared = len(own & held)
            if own and den * shared >= num * len(own):
                best, more = max(best, shared / len(own)), more | {label}
    return (
        len(found), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | more)), 1.0 if at else best,
    )


def got(df):
    return Counter(tuple(r) for r in df.collect())


def test_query_gives_what_its_sql_gives(spark):
    df = queries.registered()["op11_license_scan"](spark, SMALL)
    assert compare.differences(df, compare.duck(SMALL), oracle.statements()["op11_license_scan"]) == []


def test_random_blocks_against_all_pairs(spark):
    random.seed(11)
    letters = "a b c d e f".split()
    text = lambda n: " ".join(random.choice(letters) for _ in range(n))
    templates = [(f"t{i}", text(random.choice([1, 2, 4, 6, 9, 14]))) for i in range(25)]
    docs = [
        (i, "".join(text(random.randint(0, 25)) + random.choice(["\n", "\n\n", "\n -- \n", ". "]) for _ in range(4)))
        for i in range(200)
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    for threshold, num, den in ((0.8, 4, 5), (0.35, 7, 20), (1.0, 1, 1)):
        found = licenses.scan(frame, templates, (("a b", "x"), ("c", "y")), threshold)
        want = Counter((i, *expected(t, templates, (("a b", "x"), ("c", "y")), num, den)) for i, t in docs)
        assert got(found) == want


def test_awkward_rows(spark, awkward):
    assert got(licenses.scan(awkward)) == Counter((i, *expected(t)) for i, t, *_ in AWKWARD)


def test_notices_in_comments_and_with_changes(spark):
    wrap = lambda t, mark: "\n".join(f"{mark} {x}" for x in re.findall(r".{1,50}(?:\s|$)", t))
    mit = [t for label, t in licenses.TEMPLATES if label == "mit"][2]
    rows = [
        (1, f"#!/bin/sh\n\n{wrap(mit, '#')}\n\nset -e"),
        (2, f"code\n *\n{wrap(NOTICE['isc'].upper(), ' *')}\n *\nmore"),
        (3, NOTICE["bsd"].replace("binary forms", "any forms")),
        (4, NOTICE["bsd"].replace(" ", "\n\n")),
        (5, "All rights reserved. ALL RIGHTS RESERVED under CC-BY and cc by cc by"),
        (6, "Licensed under the Apache License, Version 1.1 Kind"),
        (7, "GENERAL PUBLİC LICENSE"),
    ]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {i: tuple(found[i])[1:] for i in found} == {i: expected(t) for i, t in rows}
    assert [found[i].labels for i in range(1, 8)] == ["mit", "isc", "bsd", "", "cc-by,reserved", "", ""]
    assert found[5].n_base == 5 and 0.8 <= found[3].score < 1


def test_a_third_of_the_rows_hold_one_notice(spark):
    rows = [(i, f"text {i}\n\n{NOTICE['mit']}" if i % 3 else f"text {i}") for i in range(300)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7))
    assert got(found) == Counter((i, *expected(t)) for i, t in rows)


def test_without_templates_or_phrases(spark, awkward):
    assert got(licenses.scan(awkward, templates=(), phrases=())) == Counter(
        (i, *expected(t, (), ())) for i, t, *_ in AWKWARD
    )


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_on_the_main_path(spark, awkward):
    text = licenses.scan(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Arrow", "ExistingRDD", "CartesianProduct", "NestedLoop"))


def test_least_tokens_are_exact():
    assert [licenses.needed(n, 0.8) for n in (1, 5, 35)] == [1, 4, 28]
    assert all(licenses.needed(n, 0.35) == ceil(n * 35 / 100 - 1e-9) for n in range(1, 300))
