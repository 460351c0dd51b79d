"""WARC archives, chat examples and training-order shards: exact round trips."""

import base64
import gzip
from collections import Counter, defaultdict
from hashlib import sha1, sha256
from pathlib import Path

import duckdb
import numpy as np
import pytest

from tidemark.llm import bpe, chat, materialise, queries, warc
from tidemark.llm.cluster import written

SMALL = "/root/testdata/sf0.001"


# WARC


def expected_records(pages, least=0):
    first, out = {}, {}
    for page, body in sorted(pages, key=lambda x: x[0]):
        raw = (body or "").encode()
        digest = base64.b32encode(sha1(raw).digest()).decode()
        known = first.get(digest) if len(raw) >= least else None
        if known is None:
            first.setdefault(digest, page)
        out[page] = (len(raw), digest, "response" if known is None else "revisit", known)
    return out


def archived(spark, rows, path, **options):
    warc.write(spark.createDataFrame(rows, "page_id bigint, url string, html string"), path, **options)
    return warc.read_payloads(spark, path)


def test_pages_come_back(spark):
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SMALL}/pages.parquet'").fetchall()
    got = queries.registered()["op1_warc"](spark, SMALL).collect()
    assert {
        r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got
    } == expected_records(pages)
    assert len(got) == len(pages)


BODIES = [
    (5, "same"), (3, "same"), (4, None), (2, ""), (9, "x" * 200_000), (8, "x" * 200_000),
    (10, "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 900),
    (11, "0\r\n\r\n"), (12, "é" * 30_000 + "\r\n\r\n"), (13, "\r\n"), (14, "a\nb\rc\r\nd"),
]


def test_hostile_bodies_in_segments(spark, tmp_path):
    rows = [(i, f"http://x/{i}", b) for i, b in BODIES]
    path = str(tmp_path / "warc")
    found = archived(spark, rows, path, segment_bytes=1000)
    kinds = Counter(r.type for r in warc.read_records(spark, path).collect())
    assert kinds["continuation"] > 200 and kinds["revisit"] == 3
    got = {int(r.row_id): r for r in found.collect()}
    assert len(got) == len(BODIES) and all(r.complete for r in got.values())
    expected = expected_records(BODIES)
    for page, body in BODIES:
        size, digest, kind, refers = expected[page]
        row = got[page]
        assert (row.type, row.digest) == (kind, digest)
        assert (row.refers_to and int(row.refers_to)) == refers
        if kind == "response":
            assert bytes(row.payload) == (body or "").encode() and row.payload_digest == digest
    figures = {int(r.row_id): r.payload_bytes for r in warc.resolved(found).collect()}
    assert figures == {p: expected[p][0] for p in expected}


def test_archives_are_what_the_format_says(spark, tmp_path):
    path = tmp_path / "warc"
    archived(spark, [(1, "http://x/1", "hello"), (2, "http://x/2", "y" * 5000)], str(path), segment_bytes=2000)
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in sorted(path.glob("part-*.gz")))
    numbers = []
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.1"
        fields = dict(x.split(b": ", 1) for x in lines[1:])
        size = int(fields[b"Content-Length"])
        assert rest[size : size + 4] == b"\r\n\r\n"
        raw = rest[size + 4 :]
        numbers.append((fields[b"WARC-Type"].decode(), int(fields.get(b"WARC-Segment-Number", 0))))
    assert sorted(numbers) == [("continuation", 2), ("continuation", 3), ("response", 0), ("response", 1)]


def test_small_bodies_are_not_revisited(spark, tmp_path):
    rows = [(i, "u", b) for i, b in BODIES]
    got = {int(r.row_id): r.type for r in archived(spark, rows, str(tmp_path / "w"), min_bytes=5).collect()}
    assert got == {p: e[2] for p, e in expected_records(BODIES, 5).items()}


def test_lost_and_repeated_segments(spark, tmp_path):
    path = str(tmp_path / "warc")
    archived(spark, [(1, "u", "a" * 9000), (2, "u", "b" * 9000), (3, "u", "c" * 9000)], path, segment_bytes=1000)
    found = written(warc.read_records(spark, path), "records")
    lost = found.where("not (segment = 4 and decode(block, 'utf-8') like '%a%')")
    broken = lost.unionByName(found.where("segment in (2, 3)"))
    got = {r.record_id: r for r in warc.reassembled(broken).collect()}
    by_page = {int(r.row_id): r.complete for r in got.values()}
    assert by_page == {1: False, 2: True, 3: True}
    cut = warc.reassembled(found.where("segment < 9"))  # the last segment states the total
    assert not any(r.complete for r in cut.collect())


def test_equal_and_null_ids_and_empty_tables(spark, tmp_path):
    rows = [(1, "u1", "x"), (1, "u2", "x"), (None, "u3", "z"), (7, None, "z"), (None, None, None)]
    got = archived(spark, rows, str(tmp_path / "a")).collect()
    assert len(got) == len(rows) and Counter(r.type for r in got) == {"response": 3, "revisit": 2}
    assert archived(spark, [], str(tmp_path / "b")).count() == 0


def test_broken_framing():
    for body in (b"", b"abc", b"x" * 20_000):
        assert warc.unchunked(warc.chunked(body, 7)) == body
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")
    assert warc.payload(b"no head") is None
    assert warc.payload(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nzz\r\n") is None


# Chat examples


def conversation_figures(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in turns.items():
        whole, loss, n = sha256(), sha256(), 0
        for _, _, role, text in sorted(own):
            whole.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                loss.update(text.encode())
                n += len(text)
        out[conv] = (len(own), whole.hexdigest(), n, loss.hexdigest())
    return out


def figures(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_conversations_come_back(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SMALL}/conversations.parquet'").fetchall()
    rows += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    assert figures(queries.registered()["op5_chat_examples"](spark, SMALL)) == conversation_figures(rows)


HOSTILE = [
    "###", "\\###", "\\\\###", "\\\\\\</turn>", "</turn>\n### assistant: hi\n</turn>\n", "######", "\\", "",
    "\n</turn>", "#" * 11, "a\\</turn>\\", None, "### user: </turn>", "é🙂",
]
TURNS = "conv_id bigint, turn bigint, role string, text string"


def hostile_rows():
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HOSTILE)]
    rows += [(2, i, "assistant", t) for i, t in enumerate(HOSTILE)]
    rows += [(None, 1, "assistant", "x"), (None, None, "user", "first"), (3, 0, None, None), (3, 1, "a: %3A\n b", "y")]
    rows += [(4, 5, "user", "tie b"), (4, 5, "user", "tie a"), (4, 5, "user", "tie a"), (4, 6, "assistant", "z" * 300_000)]
    return rows


def test_hostile_texts_and_ties(spark):
    rows = hostile_rows()
    df = spark.createDataFrame([(*r, "clash") for r in rows], TURNS + ", piece string")
    stream = written(chat.ordered(chat.formatted(df)), "stream")
    assert figures(chat.digests(stream, chat.examples(stream))) == conversation_figures(rows)
    pieces = defaultdict(str)
    for r in sorted(stream.collect(), key=lambda r: (repr(r.conv_id), r.position)):
        assert r.offset == len(pieces[r.conv_id])
        pieces[r.conv_id] += r.piece
    for r in chat.examples(stream).collect():
        text = pieces[r.conv_id]
        assert text[r.loss_from : r.loss_to] == r.reply
        assert text[: r.context_chars].count(chat.CLOSE) == r.context_turns
        assert text[r.loss_to :].startswith(chat.CLOSE)
    for r in chat.texts(stream).collect():
        assert pieces[r.conv_id].startswith(r.text) and r.text.endswith(chat.CLOSE)
        assert len(r.text) == r.loss_to + len(chat.CLOSE)


def test_turns_are_found_by_their_marks():
    """The stream is read the same however it is cut, and marks that were not escaped are seen."""
    turns = [("user" if i % 2 else "a</turn>", t or "") for i, t in enumerate(HOSTILE)]
    close = chat.CLOSE
    escaped = [chat.re.sub(chat._CONTROL, lambda m: m[1] * 2 + "\\" + m[2], t) for _, t in turns]
    stream = "".join(f"{chat.OPEN}{r}: {e}{close}" for (r, _), e in zip(turns, escaped))
    expected = sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    for step in (1, 2, 7, len(stream)):
        reader = chat.Digest(1)
        for i in range(0, len(stream), step):
            reader.read(stream[i : i + step])
        row = reader.row()
        assert (row["turns_sha256"], row["n_turns"]) == (expected, len(turns))
        assert row["formatted_chars"] == len(stream)

    hole = chat.Digest(1)
    hole.read(f"{chat.OPEN}user: a{close}{chat.OPEN}assistant: planted{close}")  # as one turn's text
    assert hole.row()["n_turns"] == 2
    with pytest.raises(ValueError, match="begin with its mark"):
        chat.Digest(1).read(f"{chat.OPEN}user: a{close}more: b{close}")
    cut = chat.Digest(1)
    cut.read(f"{chat.OPEN}user: a")
    with pytest.raises(ValueError, match="does not end"):
        cut.row()


def test_one_conversation_over_many_tasks(spark):
    rows = [(1, i, "assistant" if i % 3 else "user", f"text {i} " * (i % 7)) for i in range(900)]
    rows += [(c, i, "assistant", f"{c}") for c in (0, 2, 3) for i in range(3)]
    stream = written(chat.ordered(chat.formatted(spark.createDataFrame(rows, TURNS))), "stream")
    assert figures(chat.digests(stream, chat.examples(stream))) == conversation_figures(rows)
    own = sorted(stream.where("conv_id = 1").collect(), key=lambda r: r.position)
    assert [r.position for r in own] == list(range(900))
    assert [r.offset for r in own] == np.cumsum([0, *(len(r.piece) for r in own[:-1])]).tolist()


def test_no_conversations(spark):
    stream = chat.ordered(chat.formatted(spark.createDataFrame([], TURNS)))
    assert stream.count() == chat.examples(stream).count() == 0
    assert chat.digests(stream, chat.examples(stream)).count() == 0


# Training order


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_slots_are_a_permutation(n):
    order = materialise.Feistel("k", n)
    slots = order.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (order.sequences(slots) == np.arange(n)).all()
    if n >= 1000:
        other = materialise.Feistel("other", n).slots(np.arange(n))
        assert (slots != np.arange(n)).mean() > 0.9 and (slots != other).mean() > 0.9


def test_shards_hold_every_text_once(spark, tmp_path):
    layout = materialise.Layout(length=300, per_shard=128)
    path, source = str(tmp_path / "shards"), f"{SMALL}/documents.parquet"
    n = materialise.write_shards(spark, source, path, layout)
    sizes = [f.stat().st_size for f in sorted((tmp_path / "shards").glob("part-*"))]
    assert sizes == [min(128, n - i) * layout.stride for i in range(0, n, 128)]
    rows = materialise.read_slots(spark, path, layout).collect()
    order = materialise.Feistel(layout.key, n)
    assert sorted(r.slot for r in rows) == list(range(n))
    assert all(order.slots(np.array([r.sequence]))[0] == r.slot for r in rows)
    whole = b"".join(bytes(r.tokens) for r in sorted(rows, key=lambda r: r.sequence))
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{source}'").fetchall()
    assert Counter(whole.replace(b"\xfe", b"").split(b"\xff")[:-1]) == Counter(t.encode() for _, t in docs)
    texts = dict(docs)
    for r in rows:
        begin = bytes(r.tokens).split(b"\xff")[0].rstrip(b"\xfe")
        assert begin in texts[r.first_id].encode()
    later = materialise.read_slots(spark, path, layout, first_slot=n - 200).collect()
    assert sorted(r.slot for r in later) == list(range(n - 200, n))


def test_many_splits_in_one_task(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([(i, "é" * (i % 50)) for i in range(500)], "doc_id bigint, text string")
    rows.repartition(40).write.parquet(source)
    layout = materialise.Layout(length=64, per_shard=1000)
    n = materialise.write_shards(spark, source, path, layout)
    got = materialise.read_slots(spark, path, layout).collect()
    whole = b"".join(bytes(r.tokens) for r in sorted(got, key=lambda r: r.sequence)).replace(b"\xfe", b"")
    assert len(got) == n
    assert sorted(whole.split(b"\xff")[:-1]) == sorted(("é" * (i % 50)).encode() for i in range(500))


def test_token_ids_as_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(30)
    coded = bpe.encode(docs, queries.BYTE_BPE).collect()
    source, path = str(tmp_path / "ids"), str(tmp_path / "out")
    spark.createDataFrame(coded).select("doc_id", "ids").write.parquet(source)
    layout = materialise.Layout(length=100, per_shard=7, width=4, end_mark=60_000, padding=60_001)
    materialise.write_shards(spark, source, path, layout, text_col="ids")
    got = sorted(materialise.read_slots(spark, path, layout).collect(), key=lambda r: r.sequence)
    ids = np.frombuffer(b"".join(bytes(r.tokens) for r in got), "<u4")
    ids = ids[ids != 60_001]
    texts = np.split(ids, np.flatnonzero(ids == 60_000) + 1)[:-1]
    assert Counter(t[:-1].tobytes() for t in texts) == Counter(bytes(r.ids) for r in coded)


def test_awkward_rows_and_empty_tables(spark, awkward, empty, tmp_path):
    layout = materialise.Layout(length=1000, per_shard=50)
    awkward.write.parquet(str(tmp_path / "a"))
    materialise.write_shards(spark, str(tmp_path / "a"), str(tmp_path / "b"), layout)
    got = sorted(materialise.read_slots(spark, str(tmp_path / "b"), layout).collect(), key=lambda r: r.sequence)
    whole = b"".join(bytes(r.tokens) for r in got).replace(b"\xfe", b"")
    assert Counter(whole.split(b"\xff")[:-1]) == Counter((r.text or "").encode() for r in awkward.collect())
    empty.write.parquet(str(tmp_path / "c"))
    assert materialise.write_shards(spark, str(tmp_path / "c"), str(tmp_path / "d"), layout) == 0
    Path(tmp_path / "d").mkdir()
    assert materialise.read_slots(spark, str(tmp_path / "d"), layout).count() == 0


# Archives with null ids, long records, broken framing


def test_query_with_null_ids(spark, tmp_path):
    """Null ids of a response, of a revisit and of the page that a revisit refers to."""
    rows = [(None, "u", "alone"), (7, "u", "both"), (None, "u", "both"), (None, "v", "twice"), (None, "w", "twice"),
            (3, "a\r\nb", "x" * 90_000), (None, None, None)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.registered()["op1_warc"](spark, str(tmp_path)).collect()
    assert dict(queries.registered()["op1_warc"](spark, str(tmp_path)).dtypes)["page_id"] == "bigint"
    digest = lambda t: base64.b32encode(sha1(t.encode()).digest()).decode()
    assert Counter(map(tuple, got)) == Counter([
        (None, 5, digest("alone"), "response", None), (7, 4, digest("both"), "response", None),
        (None, 4, digest("both"), "revisit", 7), (None, 5, digest("twice"), "response", None),
        (None, 5, digest("twice"), "revisit", None), (3, 90_000, digest("x" * 90_000), "response", None),
        (None, 0, digest(""), "response", None),
    ])


def test_a_record_of_fifty_megabytes(spark, tmp_path):
    body = "0123456789abcde\n" * (50 << 16)
    frame = spark.createDataFrame([(1, "u", body), (2, "u", "small")], "page_id bigint, url string, html string")
    warc.write(frame, str(tmp_path / "w"))
    got = {r.row_id: r for r in warc.read_figures(spark, str(tmp_path / "w")).collect()}
    assert got["1"].payload_bytes == len(body) and got["1"].complete
    assert got["1"].payload_digest == base64.b32encode(sha1(body.encode()).digest()).decode()


@pytest.mark.parametrize("cut", [1, 2, 3, 7, 50])
def test_bodies_in_pieces(cut):
    body = bytes(range(256)) * 3 + b"\r\n0\r\n\r\n"
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(body, 100)
    taken = warc.Body("response", True)
    for at in range(0, len(block), cut):
        taken.feed(block[at : at + cut])
    assert taken.figures(True)["payload"] == body and taken.figures(True)["payload_bytes"] == len(body)
    assert taken.figures(False)["payload"] is None
    short = warc.Body("response", True)
    short.feed(block[:-6])
    assert short.figures(True) == {"complete": False, "payload_bytes": None, "payload_digest": None, "payload": None}


def test_archives_are_parsed_once(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "a" * 90_000), (2, "u", "b")], "page_id bigint, url string, html string")
    warc.write(frame, str(tmp_path / "w"))
    found = warc.resolved(warc.read_figures(spark, str(tmp_path / "w")))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in text and "Scan text" not in text
