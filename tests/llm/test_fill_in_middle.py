"""Fill-in-middle outputs against plain Python, and the way back."""

import random
import re
from collections import Counter
from hashlib import sha256

import pytest

import compare
from conftest import AWKWARD, SCHEMA
from tidemark.llm import fim, oracle, queries

SMALL = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text, share=50):
    """n, form, prefix_chars, middle_chars, output of one document."""
    text = text or ""
    units, h = UNIT.findall(text), sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= share:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def digest(text):
    return sha256(text.encode()).hexdigest()


def check(spark, rows, share=50):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    rules = fim.Rules(share=share)
    got = Counter(tuple(r) for r in fim.digests(docs, rules).collect())
    want = Counter()
    for doc_id, text in rows:
        *figures, output = expected(doc_id, text, share)
        want[(doc_id, *figures, digest(output), digest(text or ""))] += 1
    assert got == want


def test_query_gives_what_its_sql_gives(spark):
    df = queries.registered()["op13_fill_in_middle"](spark, SMALL)
    assert compare.differences(df, compare.duck(SMALL), oracle.statements()["op13_fill_in_middle"]) == []


def test_against_plain_python(spark):
    random.seed(13)
    text = lambda n: "".join(random.choice("ab<>PSM é漢🙂 \n\t\x0b ") for _ in range(n))
    check(spark, [(i, text(random.randint(0, 60))) for i in range(300)])


def test_awkward_rows_keep_a_result_each(spark, awkward):
    want = Counter()
    for doc_id, text, *_ in AWKWARD:
        *figures, output = expected(doc_id, text)
        want[(doc_id, *figures, digest(output), digest(text or ""))] += 1
    assert Counter(tuple(r) for r in fim.digests(awkward).collect()) == want


def test_equal_rows_in_one_partition_and_in_many(spark):
    rows = [(1, "a b c d e")] * 40 + [(None, None)] * 30 + [(1, "a b c d f"), (2, "")]
    check(spark, rows, share=100)
    one = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert fim.digests(one, fim.Rules(share=100)).count() == len(rows)


def test_texts_of_many_pieces(spark, monkeypatch):
    random.seed(31)
    words = lambda n: " ".join(random.choice(["word", "ünïcödé", "x" * 70_000]) for _ in range(n))
    check(spark, [(i, words(60) + "  ") for i in range(6)], share=100)


def test_pieces_are_whole_units_and_bounded(spark):
    raw = ("word " * 50_000).strip().encode() + b" " + b"y" * 100_000
    (_, doc), = fim.documents(fim.pa.array([raw.decode()]), [7], fim.Rules(share=100))
    found = [piece for _, piece in doc.pieces()]
    assert max(map(len, found)) <= fim.PIECE_BYTES + 3
    assert sum(map(len, found)) == len(raw) + 9
    assert sum(not p.endswith((b"word", b"y")) for p in found) == 0


def test_outputs_and_the_way_back(spark, awkward):
    docs = awkward.select("doc_id", "text")
    made = fim.outputs(docs, fim.Rules(share=100))
    want = Counter((i, *expected(i, t, 100)) for i, t, *_ in AWKWARD)
    assert Counter(tuple(r) for r in made.collect()) == want
    back = fim.restored(made).select("doc_id", "text").collect()
    assert Counter(map(tuple, back)) == Counter((i, t or "") for i, t, *_ in AWKWARD)


@pytest.mark.parametrize("cut", range(1, 12))
def test_marks_are_found_across_pieces(cut):
    output = b"<S><<S<P>a<P<M>>M<"
    splitter, found = fim.Splitter("spm"), {}
    for at in range(0, len(output), cut):
        for place, data in splitter.feed(output[at : at + cut]):
            found[place] = found.get(place, b"") + data
    for place, data in splitter.close():
        found[place] = found.get(place, b"") + data
    assert found == {0: b"a<P", 1: b">M<", 2: b"<<S"}


def test_broken_outputs_are_refused():
    with pytest.raises(ValueError):
        fim.restored_text("no mark", "psm")
    with pytest.raises(ValueError):
        fim.restored_text("<P>a<S>b", "psm")
    assert fim.restored_text("<P>", "plain") == "<P>"


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert fim.digests(nothing).collect() == []
    assert fim.outputs(nothing).collect() == []


def test_one_shuffle_for_both_orders(spark, awkward):
    text = fim.digests(awkward)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("Sort ") == 2
