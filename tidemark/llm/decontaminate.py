"""Benchmark decontamination: which words of a document lie inside a passage of a benchmark item.

Words are runs of ASCII letters, digits and all characters beyond ASCII, with A-Z in lower case. A
window is 13 consecutive words of an item; an item of fewer words, but not none, is one window.

The search is Wu and Manber's for many patterns, with words as symbols. Windows of one length m
share a table: the last B words before a position, hashed, give a shift by which the search may
jump, because no window has them nearer to its m-th word. Where the shift is 0, the hash of the
last words selects the windows to test, that of the first words narrows them down, and the bytes
are compared. Stretches of the texts are searched side by side, one numpy lane each.

Items travel in sets of bounded size. One set, as most benchmarks are, is searched in one pass. Of
several, each is searched in a pass of its own, and its tables are let go before the next: the pass
writes the places hit, for documents with any, and the places of all sets are put together in the
end. So neither driver nor workers ever hold more than one set.

Defined cases: a null text has no words, and a document without words is clean. Items whose text is
null or has no words have no window. An item without an id counts for ``n_hit`` like any other, but
has no id to be listed or counted. Repeated items and repeated documents each count for themselves;
items with equal ids count once. A text of any length is searched whole. An empty table of documents
gives no rows; without items nothing is hit. Only the id and text columns are read, whatever other
columns are called."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from hashlib import sha256
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.cluster import prepare, written
from tidemark.llm.words import Texts, counted, mixed, parts, stretch, sums

WINDOW = 13
BLOCK = 3
TABLE_BITS = 20
LANE_WORDS = 256
# Items travel to the tasks in sets of at most this many bytes, one after the other.
SET_BYTES = 16 << 20

WORD = np.zeros(256, dtype=bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass(frozen=True)
class Tokens:
    """The words of many texts: bounds in the lower-cased buffer, hashes and owners."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word: np.ndarray
    owner: np.ndarray

    def text(self, first: int, last: int) -> bytes:
        """Words first..last with single spaces."""
        return b" ".join(
            self.data[s:e].tobytes()
            for s, e in zip(self.start[first : last + 1], self.end[first : last + 1], strict=True)
        )


def tokens(texts: Texts) -> Tokens:
    data = LOWER[texts.data]
    start, end = texts.runs(WORD)
    return Tokens(data, start, end, stretch(sums(data), start, end), texts.owner(start))


def block_hash(word: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that end at each position of ``last``."""
    value = np.zeros(len(last), dtype=np.uint64)
    for back in range(size - 1, -1, -1):
        value = value * np.uint64(0x9FB21C651E98DF25) + word[last - back]
    return mixed(value)


@dataclass
class Windows:
    """The tables for all windows of one length."""

    length: int
    block: int
    shift: np.ndarray
    keys: np.ndarray  # of last and first words, sorted
    buckets: dict[bytes, tuple[int, ...]] = field(default_factory=dict)

    @classmethod
    def build(cls, length: int, patterns: dict[bytes, set[int]]) -> Windows:
        joined = list(patterns)
        ends = np.cumsum([len(p) for p in joined])
        starts = ends - [len(p) for p in joined]
        found = tokens(Texts(np.frombuffer(b"".join(joined), np.uint8), starts, ends))
        first = np.arange(len(joined)) * length
        block = min(BLOCK, length)
        shift = np.full(1 << TABLE_BITS, length - block + 1, dtype=np.int64)
        mask = np.uint64((1 << TABLE_BITS) - 1)
        for at in range(block - 1, length):
            slot = (block_hash(found.word, first + at, block) & mask).astype(np.int64)
            np.minimum.at(shift, slot, length - 1 - at)
        table = cls(length, block, shift, np.zeros(0, np.uint64))
        table.keys = np.unique(table.key(found.word, first + length - 1))
        table.buckets = {p: tuple(sorted(items)) for p, items in patterns.items()}
        return table

    def key(self, word: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the window's last words with that of its first words."""
        head = block_hash(word, last - self.length + self.block, self.block)
        return block_hash(word, last, self.block) ^ (head * np.uint64(3))

    def candidates(self, found: Tokens, bounds: np.ndarray) -> np.ndarray:
        """Positions of last words where a window may end; ``bounds`` are the texts' first words
        and, at the end, the number of words."""
        low = bounds[:-1] + self.length - 1
        lanes = np.maximum(0, -(-(bounds[1:] - low) // LANE_WORDS))
        text = np.repeat(np.arange(len(low)), lanes)
        rank = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = low[text] + rank * LANE_WORDS
        stop = np.minimum(at + LANE_WORDS, bounds[1:][text])
        mask = np.uint64((1 << TABLE_BITS) - 1)
        out = []
        while len(at):
            jump = self.shift[(block_hash(found.word, at, self.block) & mask).astype(np.int64)]
            out.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            ahead = at < stop
            at, stop = at[ahead], stop[ahead]
        last = np.concatenate(out) if out else np.zeros(0, np.int64)
        if not len(last) or not len(self.keys):
            return last[:0]
        key = self.key(found.word, last)
        near = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return last[self.keys[near] == key]

    def occurrences(self, found: Tokens, bounds: np.ndarray) -> Iterator[tuple[int, tuple]]:
        """Last words and items of windows that occur, by comparing bytes."""
        for last in self.candidates(found, bounds).tolist():
            items = self.buckets.get(found.text(last - self.length + 1, last))
            if items:
                yield last, items


def item_windows(items: list[tuple[int, str]], window: int) -> list[Windows]:
    """Tables for numbered items; one per length of windows."""
    by_length: dict[int, dict[bytes, set[int]]] = {}
    for number, text in items:
        raw = np.frombuffer(text.encode(), np.uint8)
        found = tokens(Texts(raw, np.array([0]), np.array([len(raw)])))
        length = min(window, len(found.start))
        for first in range(len(found.start) - length + 1 if length else 0):
            pattern = found.text(first, first + length - 1)
            by_length.setdefault(length, {}).setdefault(pattern, set()).add(number)
    return [Windows.build(length, patterns) for length, patterns in sorted(by_length.items())]


def places(texts: pa.Array, tables: list[Windows]) -> Iterator[tuple[int, np.ndarray, set[int]]]:
    """Per text: words, numbers of the words hit, numbers of the items found."""
    for _, part in parts(texts):
        found = tokens(part)
        words = counted(found.owner, len(part))
        bounds = np.concatenate([[0], np.cumsum(words)])
        cover = np.zeros(len(found.start) + 1, dtype=np.int64)
        items: dict[int, set[int]] = {}
        for table in tables:
            for last, numbers in table.occurrences(found, bounds):
                cover[last - table.length + 1] += 1
                cover[last + 1] -= 1
                items.setdefault(int(found.owner[last]), set()).update(numbers)
        hit = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
        cuts = np.searchsorted(hit, bounds)
        for i, n in enumerate(words.tolist()):
            yield n, hit[cuts[i] : cuts[i + 1]] - bounds[i], items.get(i, set())


def contaminated(n_words: int, n_hit: int) -> bool:
    """At least a twentieth of the words are hit."""
    return n_hit > 0 and 20 * n_hit >= n_words


def item_sets(items: DataFrame, item_id: str, text_col: str) -> Iterator[list[tuple]]:
    """The items in sets of at most SET_BYTES; they come to the driver a partition at a time."""
    rows, size = [], 0
    picked = items.select(F.col(item_id).alias("i"), F.col(text_col).alias("t"))
    for row in picked.where("t is not null").distinct().toLocalIterator():
        length = len(row.t.encode())
        if rows and size + length > SET_BYTES:
            yield rows
            rows, size = [], 0
        rows.append((row.i, row.t))
        size += length
    if rows:
        yield rows


class Search:
    """One set of items, broadcast, and the search over a column of texts. A worker process builds
    the tables of a set once, and holds those of one set at a time."""

    _built: dict[str, list[Windows]] = {}

    def __init__(self, spark: SparkSession, items: list[tuple], window: int):
        self.key, self.window = uuid4().hex, window
        self.held = spark.sparkContext.broadcast(items)

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, list]]:
        """Words, numbers of the words hit, and ids of the items found, per text."""
        if self.key not in Search._built:
            Search._built.clear()
            Search._built[self.key] = item_windows([(i, t) for i, (_, t) in enumerate(self.held.value)], self.window)
        ids = [i for i, _ in self.held.value]
        for n_words, hit, numbers in places(texts, Search._built[self.key]):
            yield n_words, hit, sorted({ids[n] for n in numbers if ids[n] is not None})


def scan(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Per document: id, n_words, n_hit, ``items`` (ids found, in order), n_items, items_sha256 (of
    the ids as sorted strings, with commas) and ``contaminated``."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return _found(rows, items, item_id, item_text, window).select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"), "contaminated", "items",
    )


def clean(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns as they are."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    prepare(spark)
    first, more = _split(item_sets(items, item_id, item_text))
    if more:
        rows = docs.select(F.lit(0).alias("id"), docs[text_col].alias("text"))
        found = _in_turn(rows, chain([first], more), window, items.schema[item_id].dataType)
        bad = _judged(found).where("contaminated").select(F.col("text_key").alias("_bad_text")).distinct()
        return docs.join(bad, F.unhex(F.sha2(docs[text_col].cast("binary"), 256)) == F.col("_bad_text"), "left_anti")
    search = Search(spark, first, window)

    def work(batches):
        for batch in batches:
            keep = [not contaminated(n, len(hit)) for n, hit, _ in search(batch.column(at))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def _split(sets: Iterator[list[tuple]]) -> tuple[list[tuple], Iterator[list[tuple]] | None]:
    """The first set, and the others if there are any."""
    first, second = next(sets, []), next(sets, None)
    return first, None if second is None else chain([second], sets)


def _found(rows: DataFrame, items: DataFrame, item_id: str, item_text: str, window: int) -> DataFrame:
    prepare(rows.sparkSession)
    kind = items.schema[item_id].dataType
    first, more = _split(item_sets(items, item_id, item_text))
    if more:
        return _judged(_in_turn(rows, chain([first], more), window, kind))
    return _judged(_hits(rows, Search(rows.sparkSession, first, window), kind, "figures"))


def _judged(found: DataFrame) -> DataFrame:
    hit = F.col("n_hit")
    return found.withColumn("contaminated", (hit > 0) & (20 * hit >= F.col("n_words")))


def _hits(rows: DataFrame, search: Search, kind: T.DataType, give: str) -> DataFrame:
    """Per row of (id, text): id, text_key (digest of the text), n_words, n_hit and ``items``. To
    ``give`` "figures" leaves the digest out; "places" gives rows with hits only, and the numbers of the
    words hit for n_hit."""
    id_type, item_type = to_arrow_type(rows.schema["id"].dataType), pa.list_(to_arrow_type(kind))
    hit_type = pa.list_(pa.int64()) if give == "places" else pa.int64()

    def work(batches):
        for batch in batches:
            found = list(search(batch.column(1)))
            keep = pa.array([i for i, x in enumerate(found) if give != "places" or len(x[1])], pa.int64())
            found = [found[i] for i in keep.to_pylist()]
            hits = [hit.tolist() if give == "places" else len(hit) for _, hit, _ in found]
            keys = [None] * len(found)
            if give != "figures":
                texts = batch.column(1).take(keep).to_pylist()
                keys = [t if t is None else sha256(t.encode()).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(keep).cast(id_type), pa.array(keys, pa.binary()),
                    pa.array([x[0] for x in found], pa.int64()), pa.array(hits, hit_type),
                    pa.array([x[2] for x in found], item_type),
                ],
                ["id", "text_key", "n_words", "n_hit", "items"],
            )

    ddl = (
        f"id {rows.schema['id'].dataType.simpleString()}, text_key binary, n_words bigint,"
        f" n_hit {'array<bigint>' if give == 'places' else 'bigint'}, items array<{kind.simpleString()}>"
    )
    return rows.mapInArrow(work, ddl)


def _in_turn(rows: DataFrame, sets: Iterable[list[tuple]], window: int, kind: T.DataType) -> DataFrame:
    """As ``_hits``, a pass per set. Equal texts have equal hits, so what is found goes by the text,
    once for all its rows."""
    spark, found = rows.sparkSession, []
    for own in sets:
        search = Search(spark, own, window)
        found.append(written(_hits(rows, search, kind, "places"), "hits"))
        search.held.destroy()
    together = reduce(DataFrame.unionByName, found).groupBy(F.col("text_key").alias("k")).agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("n_hit")))).cast("bigint").alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("own"),
    )
    plain = _hits(rows, Search(spark, [], window), kind, "keys").drop("n_hit", "items")
    return plain.join(together, F.col("text_key") == F.col("k"), "left").select(
        "id", "text_key", "n_words", F.coalesce("hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("own", F.array().cast(T.ArrayType(kind))).alias("items"),
    )
