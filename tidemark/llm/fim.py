"""Fill-in-middle: a document's prefix, middle and suffix put into the order that a model reads.

A text is cut into units: a run of white space (ASCII) with the run of other characters behind it,
or white space at the end. Two places between units, drawn from a digest of the document's id, bound
the middle. The output is the text as it is (``plain``), ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
(``psm``), or ``<S>`` suffix ``<P>`` prefix ``<M>`` middle (``spm``).

Assembly is a secondary sort. Each text is read once, in its own order, and gives pieces of whole
units (a unit longer than a piece is cut) keyed by document and place in the output. One shuffle by
document and a sort by place within partitions, which Spark spills where it must, put the pieces in
the order of the output; they go through an incremental digest one at a time, so no task holds a
whole output. The same stream is searched for the marks, which gives each piece its place in the
text again; a second sort within the same partitions (no shuffle) puts them back, and a second
digest is that of the restored text. ``repartition`` by key with ``sortWithinPartitions`` is the
DataFrame form of repartitionAndSortWithinPartitions.

A text that contains a mark stays plain, so marks in an output are always those set here. They
cannot arise at a seam either: a mark has its ``<`` in front and nowhere else.

Defined cases: null and empty texts are plain, with no units. A null id draws as an empty string
does. Rows of equal id draw equal places; each row keeps its own result, also where id and text are
equal. A text of any length is read whole. An empty table gives no rows. Only the id and text
columns are read, whatever other columns are called."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.cluster import prepare
from tidemark.llm.words import parts

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# What a form's output consists of, in order; and where each belongs in the text.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE), "plain": ()}
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

# A piece has at most this many bytes; a batch of pieces some megabytes.
PIECE_BYTES = 32 << 10
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2048
# Room for the pieces of one segment in the number that orders the pieces of an output.
SEGMENT = 1 << 40

DARK = np.ones(256, dtype=bool)
DARK[0x20] = DARK[0x09:0x0E] = False


@dataclass(frozen=True)
class Rules:
    """How places and forms are drawn: ``share`` of 100 documents are cut, ``spm`` of 100 of those
    have the suffix first."""

    seed: int = 42
    share: int = 50
    spm: int = 80

    def draws(self, doc_id) -> tuple[int, ...]:
        found = sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return tuple(int(found[i : i + 8], 16) for i in range(0, 32, 8))

    def cuts(self, draws: tuple[int, ...], n: int) -> tuple[int, int]:
        """Units before the middle, and up to its end."""
        a, b = draws[0] % (n + 1), draws[1] % (n + 1)
        return min(a, b), max(a, b)

    def form(self, draws: tuple[int, ...], raw: bytes) -> str:
        if not raw or any(mark in raw for mark in PLACE) or draws[2] % 100 >= self.share:
            return "plain"
        return "spm" if draws[3] % 100 < self.spm else "psm"


@dataclass
class Document:
    """One text: its figures, and its segments as pieces."""

    raw: bytes
    ends: np.ndarray  # of its units, in bytes
    form: str
    cut: tuple[int, int]

    def at(self, unit: int) -> int:
        return int(self.ends[unit - 1]) if unit else 0

    def figures(self) -> tuple:
        """Units, form, characters of prefix and middle."""
        if self.form == "plain":
            return len(self.ends), self.form, None, None
        a, b = map(self.at, self.cut)
        prefix, middle = self.raw[:a].decode(), self.raw[a:b].decode()
        return len(self.ends), self.form, len(prefix), len(middle)

    def pieces(self) -> Iterator[tuple[int, bytes]]:
        """Places in the output and bytes of the pieces, in the order of the text. A segment's mark
        goes in front of its first piece."""
        if self.form == "plain":
            yield from self.cut_up(0, len(self.raw), 0, b"")
            return
        a, b = map(self.at, self.cut)
        order = FORMS[self.form]
        for mark, low, high in ((PREFIX, 0, a), (MIDDLE, a, b), (SUFFIX, b, len(self.raw))):
            yield from self.cut_up(low, high, order.index(mark) * SEGMENT, mark)

    def cut_up(self, low: int, high: int, place: int, mark: bytes) -> Iterator[tuple[int, bytes]]:
        while True:
            to = min(low + PIECE_BYTES, high)
            if to < high:
                unit = int(np.searchsorted(self.ends, to, side="right"))
                to = self.at(unit) if self.at(unit) > low else to
            yield place, mark + self.raw[low:to]
            if to >= high:
                return
            low, place, mark = to, place + 1, b""


def documents(texts: pa.Array, ids: list, rules: Rules) -> Iterator[tuple[int, Document]]:
    """Row numbers and cut texts."""
    for rows, part in parts(texts):
        start, end = part.runs(DARK)
        bounds = np.searchsorted(end, part.starts, side="right")
        stops = np.searchsorted(end, part.ends, side="right")
        data = part.data.tobytes()
        for i in range(len(part)):
            low, high = int(part.starts[i]), int(part.ends[i])
            units = end[bounds[i] : stops[i]] - low
            if high > low and (not len(units) or units[-1] != high - low):
                units = np.append(units, high - low)
            raw, draws = data[low:high], rules.draws(ids[rows.start + i])
            yield rows.start + i, Document(
                raw, units, rules.form(draws, raw), rules.cuts(draws, len(units))
            )


class Splitter:
    """The segments of an output that comes in pieces, told apart by the marks of its form."""

    def __init__(self, form: str):
        self.marks, self.place, self.held = list(FORMS[form]), 0, b""
        self.begun = not self.marks

    def feed(self, piece: bytes) -> Iterator[tuple[int, bytes]]:
        """Segments' places in the text, and their next bytes."""
        data, self.held = self.held + piece, b""
        while self.marks:
            mark = self.marks[0]
            at = data.find(mark)
            if at < 0:
                # The mark may begin at the end of this piece.
                keep = next((k for k in (2, 1) if data.endswith(mark[:k])), 0)
                data, self.held = data[: len(data) - keep], data[len(data) - keep :]
                break
            yield from self.given(data[:at])
            data, self.place, self.begun = data[at + len(mark) :], PLACE[mark], True
            self.marks.pop(0)
        yield from self.given(data)

    def given(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        if data and not self.begun:
            raise ValueError("an output does not begin with the mark of its form")
        if data:
            yield self.place, data

    def close(self) -> Iterator[tuple[int, bytes]]:
        if self.marks:
            raise ValueError(f"an output lacks {self.marks[0].decode()}")
        if self.held:
            yield self.place, self.held


def restored_text(output: str, form: str) -> str:
    """The text that ``output`` was made of."""
    splitter, found = Splitter(form), {0: [], 1: [], 2: []}
    for pieces in (splitter.feed(output.encode()), splitter.close()):
        for place, data in pieces:
            found[place].append(data)
    return b"".join(b"".join(found[place]) for place in range(3)).decode()


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size; the last column holds the bytes that count."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += len(row[-1] or b"")
        if size > BATCH_BYTES or len(out) >= BATCH_ROWS:
            yield _batch(out, schema)
            out, size = [], 0
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        # Some rows at a time: a batch of pieces is large.
        for first in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(first, 256).columns), strict=True)


_FIGURES = "n bigint, form string, prefix_chars bigint, middle_chars bigint"


def _schema(docs: DataFrame, id_col: str, digested: bool = False) -> tuple[str, pa.Schema]:
    """DDL and Arrow schema of rows with a key, a place, figures of a document, and bytes."""
    kind = docs.schema[id_col].dataType
    numbers = [(c, pa.int64()) for c in ("n", "prefix_chars", "middle_chars")]
    fields = [("key", pa.binary()), ("place", pa.int64()), ("id", to_arrow_type(kind)), numbers[0],
              ("form", pa.string()), *numbers[1:]]
    ddl = f"key binary, place bigint, id {kind.simpleString()}, {_FIGURES}"
    if digested:
        fields += [("output_sha256", pa.string()), ("copies", pa.int64())]
        ddl += ", output_sha256 string, copies bigint"
    return f"{ddl}, piece binary", pa.schema([*fields, ("piece", pa.binary())])


def pieces(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key`` of the document, ``place`` in its output, ``piece``; the piece at place 0 has the
    document's ``id`` and figures.

    The key is a digest of id, text and input partition, so it is the same in a repeated task;
    equal rows that are dealt over many partitions stay apart, and those of one partition give each
    piece once per row."""
    prepare(docs.sparkSession)
    ddl, schema = _schema(docs, id_col)

    def work(batches):
        yield from _batches(emitted(batches), schema)

    def emitted(batches):
        here = TaskContext.get().partitionId()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, doc in documents(batch.column(1), ids, rules):
                key = blake2b(f"{here}|{ids[i]!r}|".encode(), digest_size=16)
                key.update(doc.raw)
                for place, piece in doc.pieces():
                    figures = (ids[i], *doc.figures()) if place == 0 else (None,) * 5
                    yield key.digest(), place, *figures, piece

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(work, ddl)


def sorted_pieces(found: DataFrame) -> DataFrame:
    """Each document's pieces in one partition, in the order of its output."""
    return found.repartition("key").sortWithinPartitions("key", "place")


def _outputs(rows: Iterator[tuple]) -> Iterator[tuple[str, list, bytes | None]]:
    """What happens to each document in turn ("begin" and "piece" with a piece, "end"), with its
    key, figures, number of equal rows and last place."""
    held = None
    for key, place, *figures, piece in rows:
        if held is None or key != held[0]:
            if held is not None:
                yield "end", held, None
            held = [key, figures, 1, place]
            yield "begin", held, piece
        elif place == held[3]:
            held[2] += place == 0
        else:
            held[3] = place
            yield "piece", held, piece
    if held is not None:
        yield "end", held, None


def split_outputs(assembled: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """Outputs read as streams: pieces with their ``place`` in the text, and a row at place -1 with
    the document's figures, the digest of its output and the number of equal rows."""
    ddl, schema = _schema(docs, id_col, digested=True)

    def work(batches):
        yield from _batches(parted(batches), schema)

    def parted(batches):
        for event, doc, piece in _outputs(_rows(batches)):
            if event == "begin":
                digest, splitter, numbers = sha256(), Splitter(doc[1][2]), [0, 0, 0]
            found = splitter.close() if event == "end" else splitter.feed(piece)
            for segment, data in found:
                yield doc[0], segment * SEGMENT + numbers[segment], *(None,) * 7, data
                numbers[segment] += 1
            if event == "end":
                yield doc[0], -1, *doc[1], digest.hexdigest(), doc[2], None
            else:
                digest.update(piece)

    return assembled.mapInArrow(work, ddl)


def digests(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n (units), form, prefix_chars, middle_chars, output_sha256, and
    restored_sha256 of the text put together again from the output."""
    assembled = sorted_pieces(pieces(docs, rules, id_col, text_col))
    back = split_outputs(assembled, docs, id_col).sortWithinPartitions("key", "place")
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"`{id_col}` {kind}, {_FIGURES}, output_sha256 string, restored_sha256 string"
    _, schema = _schema(docs, id_col)
    fields = [(id_col, schema.field("id").type), *((f.name, f.type) for f in list(schema)[3:7])]
    schema = pa.schema([*fields, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])

    def work(batches):
        yield from _batches(finished(batches), schema)

    def finished(batches):
        doc = digest = None
        for _, place, *figures, piece in _rows(batches):
            if place >= 0:
                digest.update(piece)
                continue
            if doc:
                yield from [(*doc[:-1], digest.hexdigest())] * doc[-1]
            doc, digest = figures, sha256()
        if doc:
            yield from [(*doc[:-1], digest.hexdigest())] * doc[-1]

    return back.mapInArrow(work, ddl)


def outputs(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n, form, prefix_chars, middle_chars and the ``output`` itself. A task holds
    one output at a time."""
    kind = docs.schema[id_col].dataType.simpleString()
    _, schema = _schema(docs, id_col)
    fields = [(id_col, schema.field("id").type), *((f.name, f.type) for f in list(schema)[3:7])]
    schema = pa.schema([*fields, ("output", pa.string())])

    def work(batches):
        yield from _batches(joined(batches), schema)

    def joined(batches):
        for event, doc, piece in _outputs(_rows(batches)):
            if event == "begin":
                held = []
            if event == "end":
                yield from [(*doc[1], b"".join(held).decode())] * doc[2]
            else:
                held.append(piece)

    ddl = f"`{id_col}` {kind}, {_FIGURES}, output string"
    return sorted_pieces(pieces(docs, rules, id_col, text_col)).mapInArrow(work, ddl)


def restored(rows: DataFrame, output_col: str = "output", form_col: str = "form", text_col: str = "text") -> DataFrame:
    """``rows`` with the text that each output was made of."""
    prepare(rows.sparkSession)
    out_at, form_at = rows.columns.index(output_col), rows.columns.index(form_col)
    schema = T.StructType([*rows.schema.fields, T.StructField(text_col, T.StringType())])

    def work(batches):
        for batch in batches:
            texts = [
                restored_text(o or "", f)
                for o, f in zip(batch.column(out_at).to_pylist(), batch.column(form_at).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text_col]
            )

    return rows.mapInArrow(work, schema)
