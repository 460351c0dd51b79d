"""Decontamination, language identification, fertility rules and byte-level BPE against brute force."""

import base64
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, fertility, language_id, ngram_join, queries, words
from tidemark.llm.cluster import written
from tidemark.llm.words import Texts

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# Decontamination


def hits(docs, items, window=13):
    """doc_id to (words, words hit, sorted items), by looking at every place."""
    windows = defaultdict(set)
    for item, text in items:
        words = WORDS.findall(lowered(text))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(item)
    out = []
    for doc, text in docs:
        words, hit, found = WORDS.findall(lowered(text)), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if items_here := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= items_here
        out.append((doc, len(words), len(hit), tuple(sorted(found))))
    return out


def test_decontamination_finds_what_brute_force_finds(spark, documents):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    got = queries.registered()["op6_decontaminate"](spark, SMALL).collect()
    expected = hits([(d[0], d[1]) for d in documents], items)
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in got) == sorted(
        (d, w, h, len(i)) for d, w, h, i in expected
    )
    by_id = {r.doc_id: r for r in got}
    for doc, words, hit, found in expected:
        digest = sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert by_id[doc].items_sha256 == digest
        assert by_id[doc].contaminated == (hit > 0 and 20 * hit >= words)


def test_decontamination_of_random_words(spark):
    random.seed(5)
    words = "a b c d ab ba Cd é".split()
    text = lambda n: " ".join(random.choice(words) for _ in range(n))
    items = [(i, text(random.choice([0, 1, 2, 3, 4, 5, 8, 13, 14, 20]))) for i in range(40)]
    items += [(i, None) for i in (100, 101)] + [(7, "a b c")]
    docs = [(i, text(random.randint(0, 120)) + random.choice(["", ".", " -"])) for i in range(60)]
    docs += [(900 + i, f"{text(9)}, {t}!") for i, t in items if t]
    got = decontaminate.scan(
        spark.createDataFrame(docs, "doc_id int, text string"),
        spark.createDataFrame(items, "item_id int, text string"),
        window=5,
    ).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == sorted(
        hits(docs, [x for x in items if x[1]], window=5)
    )


def test_items_in_several_sets(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SET_BYTES", 200)
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert len(list(decontaminate.item_sets(items, "item_id", "text"))) > 5
    columns = ["doc_id", "n_hit", "items_sha256"]
    many = decontaminate.scan(docs, items).select(columns).collect()
    monkeypatch.undo()
    assert sorted(many) == sorted(decontaminate.scan(docs, items).select(columns).collect())


def test_cleaning_with_several_sets(spark, awkward, monkeypatch):
    items = spark.createDataFrame(
        [(1, "word " * 14), (None, "ok"), (3, "Equal text on two rows of"), (4, "nothing of it")], "item_id int, text string"
    )
    once = sorted(map(repr, decontaminate.clean(awkward, items).collect()))
    found = sorted(map(repr, decontaminate.scan(awkward, items).collect()))
    monkeypatch.setattr(decontaminate, "SET_BYTES", 10)
    assert sorted(map(repr, decontaminate.clean(awkward, items).collect())) == once
    assert sorted(map(repr, decontaminate.scan(awkward, items).collect())) == found
    assert len(once) == awkward.count() - 4


def test_items_without_id_count_for_hits(spark, monkeypatch):
    items = spark.createDataFrame([(None, "a b c d"), (5, "x y z"), (None, "x y z"), (6, None)], "item_id int, text string")
    docs = spark.createDataFrame(
        [(1, "a b c d e"), (2, "x y z"), (3, "q r s"), (4, "a b c d x y z")], "doc_id int, text string"
    )
    for size in (1 << 20, 3):
        monkeypatch.setattr(decontaminate, "SET_BYTES", size)
        got = {r.doc_id: (r.n_hit, list(r["items"]), r.n_items, r.contaminated) for r in decontaminate.scan(docs, items).collect()}
        assert got == {1: (4, [], 0, True), 2: (3, [5], 1, True), 3: (0, [], 0, False), 4: (7, [5], 1, True)}
        assert [r.doc_id for r in decontaminate.clean(docs, items).collect()] == [3]
        assert {r.items_sha256 for r in decontaminate.scan(docs, items).collect() if r.doc_id in (1, 3)} == {sha256(b"").hexdigest()}


def test_a_worker_holds_the_tables_of_one_set(spark):
    sets = [decontaminate.Search(spark, [(i, f"one two {i}")], 13) for i in range(3)]
    for search in sets:
        list(search(decontaminate.pa.array(["one two 1", None])))
        assert list(decontaminate.Search._built) == [search.key]


def test_decontamination_of_awkward_rows(spark, awkward, empty):
    items = spark.createDataFrame([(1, "word " * 14), (2, None), (3, ""), (4, "ok")], "item_id int, text string")
    got = decontaminate.scan(awkward, items).collect()
    assert sorted((repr(r.doc_id), r.n_words, r.n_hit) for r in got) == sorted(
        (repr(d), w, h)
        for d, w, h, _ in hits(
            [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()],
            [(1, "word " * 14), (4, "ok")],
        )
    )
    assert {r.doc_id for r in got if r.contaminated} == {6, 7}
    kept = decontaminate.clean(awkward, items)
    assert kept.dtypes == awkward.dtypes and kept.count() == awkward.count() - 2
    assert decontaminate.scan(empty, items).count() == decontaminate.clean(empty, items).count() == 0
    assert decontaminate.clean(awkward, items.limit(0)).count() == awkward.count()


# Fertility rules


def shape(text):
    words = SPACED.findall(text or "")
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if SPACED.search(line):
            lines += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {
        i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)
    }
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(covered))


MEASURED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_shapes_are_those_of_brute_force(spark, documents):
    got = {r.doc_id: r for r in queries.registered()["op9_fertility"](spark, SMALL).collect()}
    assert len(got) == len(documents)
    for doc, text, *_ in documents:
        assert tuple(got[doc][c] for c in MEASURED) == shape(text), doc
        n, repeats = got[doc].n_words, got[doc].n_repeat_words
        assert got[doc].base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert not (got[doc].base_failed and got[doc].kept)


def test_shapes_of_random_texts():
    random.seed(3)
    alphabet = ["a", "b", " ", "  ", "\n", "\n\n", "a b", "é#", "\t", " ", "\x1c", "<|>"]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 80))) for _ in range(400)]
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    got = fertility.shape(Texts(data, ends - [len(r) for r in raw], ends), 8)
    for i, text in enumerate(texts):
        assert tuple(int(got[c][i]) for c in MEASURED) == shape(text), repr(text)


def test_fertility_rejects_what_no_vocabulary_knows(spark):
    plain = "The people of the small town were walking to the market when it began to rain. " * 1
    plain += "Nobody had thought of taking an umbrella, since the morning had been bright and warm."
    noise = " ".join(base64.b64encode(sha256(str(i).encode()).digest()).decode() for i in range(40))
    same = " ".join(f"{w} " * 30 for w in "aa bb cc dd".split())
    rows = [(1, plain), (2, noise), (3, same)]
    got = fertility.measure(spark.createDataFrame(rows, "doc_id int, text string"), queries.RULES)
    assert {r.doc_id: r.kept for r in got.collect()} == {1: True, 2: False, 3: False}
    strict = fertility.Rules(queries.RULES.vocabulary, least_tokens=10, language_bands={"xx": fertility.Band(50, 60, 0)})
    rows = spark.createDataFrame([(1, plain, "xx"), (2, plain, "en")], "doc_id int, text string, lang string")
    kept = fertility.keep(rows, strict, lang_col="lang").collect()
    assert [r.doc_id for r in kept] == [2]


def test_clean_documents_are_kept(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1")
    got = queries.registered()["op9_fertility"](spark, SMALL).join(labels, "doc_id")
    assert got.where("not base_failed and not kept").count() == 0


def test_fertility_of_awkward_rows(awkward, empty):
    got = fertility.measure(awkward, queries.RULES).collect()
    assert len(got) == awkward.count()
    for row, given in zip(sorted(got, key=repr), sorted(awkward.collect(), key=repr), strict=True):
        del row, given
    texts = Counter((r.doc_id, *shape(r.text)) for r in awkward.collect())
    assert Counter((r.doc_id, *(r[c] for c in MEASURED)) for r in got) == texts
    kept = fertility.keep(awkward, queries.RULES, lang_col="lang")
    assert kept.dtypes == awkward.dtypes
    assert fertility.measure(empty, queries.RULES).count() == fertility.keep(empty, queries.RULES).count() == 0


PROSE = {
    "han": "人民共和国的首都是北京,这座城市有三千多年的历史。今天天气很好,我们一起去公园散步,看见许多孩子在湖边放风筝。",
    "kana": "これはとてもおもしろい本です。昨日、友達と一緒に図書館へ行って、いろいろな本を借りました。カタカナの言葉もあります。",
    "hangul": "오늘은 날씨가 매우 좋아서 친구들과 함께 공원에 갔습니다. 대한민국의 수도는 서울이며 많은 사람들이 살고 있습니다.",
    "arabic": "اللغة العربية من أكثر اللغات انتشارا في العالم، ذهبنا اليوم إلى الحديقة وشاهدنا الأطفال يلعبون بالقرب من البحيرة.",
    "hebrew": "העברית היא שפה שמית ממשפחת השפות הידועה כשפתם של היהודים. היום הלכנו לפארק וראינו ילדים משחקים ליד האגם.",
    "indic": "हिन्दी विश्व की एक प्रमुख भाषा है और भारत की एक राजभाषा है। आज मौसम बहुत अच्छा है इसलिए हम सब बगीचे में घूमने गए।",
    "thai": "ภาษาไทยเป็นภาษาที่มีระดับเสียงของคำแน่นอน วันนี้อากาศดีมากเราจึงไปเดินเล่นที่สวนสาธารณะและเห็นเด็กๆ เล่นอยู่",
}


@pytest.mark.parametrize("name", PROSE)
def test_bands_of_scripts(name):
    """Prose of each script is accepted; a few of its letters over and over are not, and neither are
    letters that the vocabulary knows as bytes only, where prose is not made of such."""
    rules, band = queries.RULES, queries.RULES.bands[name]
    encode, raw = fertility.vocabulary(rules.vocabulary)

    def verdict(text):
        assert fertility.script(text) == name
        n, *figures = fertility.fertility(text, encode, raw)
        return fertility.accepted(band, n, rules.least_tokens, *figures)

    assert verdict(PROSE[name]) and verdict(PROSE[name] * 5)
    assert not verdict((PROSE[name][:2] + " ") * 200)
    if name == "han":
        assert not verdict("龘靐齉齾爩鱻麤龗灪籱龖厵滟爨癵饢驫鲡鹂鸾麣纞虋讟钃骊郁吁齹齺齻齼麷麶麵麴鼟鼞鼝鼜黸黷黶黵")


def test_scripts():
    assert fertility.script("привет, world") == "cyrillic" and fertility.script("漢字 ok") == "han"
    assert fertility.script("12 .,!") == fertility.script("") == "other"


# Byte-level BPE


@pytest.fixture(scope="module")
def coder():
    ranks = bpe.read_ranks(queries.BYTE_BPE)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return bpe.Encoder(ranks), bpe.Decoder(ranks), library


def agrees(coder, texts):
    encoder, decoder, library = coder
    for text, (ids, pieces, at) in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)
        assert b"".join(pieces) == ids and decoder.decode(ids) == text.encode()
        assert at.tolist() == np.cumsum([0, *(len(decoder.decode(p)) for p in pieces)]).tolist()[:-1]


def offsets(text):
    """Where each match of the pattern begins, in bytes."""
    widths = np.cumsum([0, *(len(c.encode()) for c in text)])
    return [int(widths[m.start()]) for m in PIECE.finditer(text)]


PIECE = regex.compile(public_tokenizers.PATTERN)


def test_ids_are_those_of_the_library(spark, documents, coder):
    got = {r.doc_id: r for r in queries.registered()["op10_bpe"](spark, SMALL).collect()}
    for doc, text, *_ in documents:
        ids = coder[2].encode_ordinary(text)
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc].decoded_sha256 == sha256(text.encode()).hexdigest()
        at = offsets(text)
        assert got[doc].n_pieces == len(at)
        assert got[doc].offsets_sha256 == sha256(np.array(at, "<u8").tobytes()).hexdigest()


def test_ids_of_random_texts(coder):
    random.seed(1)
    bits = ["'", "s", "t", "re", "ll", "d", "ve", "m", " ", "  ", "\n", "\t", " ", "a", "B", "é", "1",
            "½", "²", "漢", "!", "?", "#", "　", "\x1c", "🙂", "́", "'S", "l", "r", " '", "ǅ", "٣"]
    for _ in range(60):
        agrees(coder, ["".join(random.choice(bits) for _ in range(random.randint(0, 70))) for _ in range(20)])


def test_ids_of_every_code_point(coder):
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    agrees(coder, [" a".join(points[i : i + 4000]) for i in range(0, len(points), 4000)])


def test_ids_of_long_pieces(coder):
    agrees(coder, ["x" * 5000 + "ab" * 3000 + "!" * 777, " " * 4000, "\n" * 3000 + "a", "ß" * 2000])


def test_encode_and_decode(spark, awkward, empty):
    coded = bpe.encode(awkward, queries.BYTE_BPE)
    rows = coded.collect()
    assert all(sum(r.piece_tokens) == r.n_tokens == len(r.ids) // 4 for r in rows)
    back = bpe.decode(written(coded, "coded"), queries.BYTE_BPE).collect()
    assert Counter(bytes(r.decoded) for r in back) == Counter((r.text or "").encode() for r in awkward.collect())
    assert bpe.digests(empty, queries.BYTE_BPE).count() == bpe.encode(empty, queries.BYTE_BPE).count() == 0
    assert bpe.digests(awkward, queries.BYTE_BPE).count() == awkward.count()


def test_ranges_are_decoded_from_their_pieces(spark, awkward, coder):
    random.seed(10)
    coded = written(bpe.encode(awkward, queries.BYTE_BPE), "ranges")
    texts = {r.doc_id: (r.text or "").encode() for r in awkward.collect()}
    cuts = [(0, 10), (3, 9), (7, 7), (9, 3), (0, 10**6), (-5, 4), (149_990, 150_010), (10**7, 10**8)]
    cuts += [(a := random.randint(0, 200), a + random.randint(0, 90)) for _ in range(30)]
    ranges = spark.createDataFrame([*cuts, (None, 3), (3, None)], "a int, b int")
    got = bpe.decode_ranges(coded.crossJoin(ranges).withColumn("key", F.struct("doc_id", "a", "b")), queries.BYTE_BPE,
                            "a", "b", id_col="key").collect()
    assert len(got) == coded.count() * (len(cuts) + 2)
    for r in got:
        doc, a, b = r.key
        want = None if a is None or b is None else texts[doc][max(a, 0) : max(b, 0)]
        assert (None if r.decoded is None else bytes(r.decoded)) == want, r.key
    # No other token is looked at.
    encoder, decoder, _ = coder
    (ids, pieces, at), = encoder.encode(["some words and more"])
    n = np.array([len(x) // 4 for x in pieces])
    broken = ids[: 4 * n[0]] + b"\xff" * (len(ids) - 4 * n[0])
    assert decoder.decode_range(broken, n, at, 1, 4) == b"ome"


def test_pieces_side_by_side(coder):
    """Merging many pieces at once gives what merging each alone does."""
    draw = random.Random(5)
    signs = "abcdetnaeiosßé漢 🙂xQ"
    pieces = ["".join(draw.choices(signs, k=draw.randint(1, 30))).encode() for _ in range(3000)]
    encoder = coder[0]
    found, bounds = encoder.merged_together(pieces)
    own = [found[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    whole = [encoder.ranks.get(p) is not None for p in pieces]
    assert [o for o, w in zip(own, whole) if not w] == [
        encoder.merged(p) for p, w in zip(pieces, whole) if not w
    ]
    assert bounds[-1] == len(found)


def test_a_full_cache_changes_nothing(coder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    agrees((bpe.Encoder(coder[0].ranks), *coder[1:]), ["some words and more words of some kind", "and more"])


# Language identification


def test_languages_of_held_out_documents(spark, documents):
    got = {r.doc_id: r for r in queries.registered()["op7_language_id"](spark, SMALL).collect()}
    out = {d[0] for d in documents if zlib.crc32(str(d[0]).encode()) % 3 == 1}
    assert {d for d, r in got.items() if r.held_out} == out
    right = [got[d[0]].lang_pred == d[2] for d in documents if d[0] in out]
    assert sum(right) >= 0.98 * len(right)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_counts_are_those_of_brute_force(spark):
    texts = ["Ab, c!", "b", "éa  b", ""]
    rows = spark.createDataFrame([(t, "x" if i % 2 else "y") for i, t in enumerate(texts)], "text string, lang string")
    features = language_id.Features()
    got = {r.label: r.n for r in language_id.counts(rows, features).where("bucket >= 0").groupBy("label").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    expected = Counter()
    for i, text in enumerate(texts):
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            padded = f" {word} "
            grams = list(word) + [padded[k : k + n] for n in (2, 3) for k in range(len(padded) - n + 1)]
            expected["x" if i % 2 else "y"] += len(grams)
    assert got == dict(expected)


def test_languages_of_awkward_rows(spark, awkward, empty):
    model = language_id.fit(awkward)
    got = language_id.predict(awkward, model, keep={"held_out": queries.held_out(awkward.doc_id)}).collect()
    unknown = {r.doc_id for r in got if r.lang_pred == "und"}
    assert unknown == {1, 2, 3, 9} and all(r.score == 0 for r in got if r.doc_id in unknown)
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    nothing = language_id.fit(empty)
    assert {r.lang_pred for r in language_id.predict(awkward, nothing).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MATRIX_BYTES", 8 << 16)
    rows = spark.createDataFrame([("abc", "x"), ("abd", "y")], "text string, lang string")
    with pytest.raises(ValueError, match="fewer bits"):
        language_id.fit(rows)


def test_a_part_takes_little_memory():
    """A worker keeps tables as long as a part, and arrays of several times its size while at work."""
    texts = pa.array([" ".join(f"w{i * j % 977}" for j in range(400)) for i in range(3000)])
    words._POWERS.clear()
    tracemalloc.start()
    for _, part in words.parts(texts):
        ngram_join.signatures(part, ngram_join.Join())
    kept, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 24e6 and most < 64e6
