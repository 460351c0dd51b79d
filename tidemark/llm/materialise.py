"""Training-order materialisation: every sequence gets a place in one global random order, and the
sequences are written in that order as shards of fixed-size records.

The texts of a table are packed, document after document with an end mark, into sequences of
``length`` tokens. Sequence i goes to slot p(i), where p is a keyed permutation of 0..n-1: a Feistel
network over the next power of four, walked on until it falls below n. So nothing is sorted by a
random number, any slot can be worked out from the key alone, and no two sequences meet. Shard s
holds slots [s * per_shard, (s + 1) * per_shard) and is one file of one task.

A record is the sequence's number and the id of the document its first token belongs to (8 bytes
each, little-endian), the tokens, and a line feed; slot k is at byte (k % per_shard) * stride of
its shard, so that a reader can stop and go on anywhere.

Numbers must be the same when a task is run again. The input is a table that is written, read in
splits that depend on its files and one setting only: a first pass counts the tokens of each split
(a number per split comes to the driver), a second numbers them from there and fails if a split
has changed.

Tokens are unsigned numbers of 1, 2 or 4 bytes. Texts are taken as their UTF-8 bytes, in which 254
and 255 never occur and serve as padding and end mark. Columns of token ids, as ``bpe.encode``
gives them, are taken as they are, with marks to be named.

Defined cases: a null text is empty and leaves only its end mark. A null id is written as the
smallest 64-bit number. Long texts run over as many sequences as they need. Repeated rows are
written each time. An empty table writes no shard. Only the columns named are read."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.cluster import prepare
from tidemark.llm.words import buffers, mixed

ROUNDS = 8
NO_ID = -(2**63)
HEADER = 16


@dataclass(frozen=True)
class Feistel:
    """A keyed permutation of 0..n-1."""

    key: str
    n: int

    @property
    def half_bits(self) -> int:
        return max(1, (max(self.n - 1, 1).bit_length() + 1) // 2)

    def _round_keys(self) -> list[np.uint64]:
        return [
            np.uint64(int.from_bytes(sha256(f"{self.key}|{i}".encode()).digest()[:8], "little"))
            for i in range(ROUNDS)
        ]

    def _once(self, x: np.ndarray, keys: list[np.uint64], back: bool) -> np.ndarray:
        half = np.uint64(self.half_bits)
        mask = (np.uint64(1) << half) - np.uint64(1)
        left, right = x >> half, x & mask
        for key in reversed(keys) if back else keys:
            if back:
                left, right = right ^ (mixed(left ^ key) & mask), left
            else:
                left, right = right, left ^ (mixed(right ^ key) & mask)
        return (left << half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        keys = self._round_keys()
        out = self._once(x.astype(np.uint64), keys, back)
        out_of = np.flatnonzero(out >= self.n)
        while len(out_of):  # a cycle through a number below n comes back below n
            out[out_of] = self._once(out[out_of], keys, back)
            out_of = out_of[out[out_of] >= self.n]
        return out.astype(np.int64)

    def slots(self, sequences: np.ndarray) -> np.ndarray:
        return self._walk(np.asarray(sequences), False)

    def sequences(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(np.asarray(slots), True)


@dataclass(frozen=True)
class Layout:
    """``width`` is bytes per token; a shard has ``per_shard`` records."""

    length: int = 2048
    per_shard: int = 8192
    width: int = 1
    end_mark: int = 255
    padding: int = 254
    key: str = "training-order"

    @property
    def size(self) -> int:
        return self.length * self.width

    @property
    def stride(self) -> int:
        return HEADER + self.size + 1

    def mark(self, token: int) -> bytes:
        return token.to_bytes(self.width, "little")


@contextmanager
def fixed_splits(spark: SparkSession) -> Iterator[None]:
    """Within, splits of files do not depend on how many cores the cluster has just then."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _rows(spark: SparkSession, path: str, id_col: str, text_col: str) -> DataFrame:
    table = spark.read.parquet(path)
    split = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
    return table.select(
        split.alias("split"), table[id_col].cast("bigint").alias("id"),
        table[text_col].cast("binary").alias("data"),
    )


class Packer:
    """Packs the documents of one split into sequences, a batch at a time."""

    def __init__(self, layout: Layout, first: int):
        self.layout, self.next = layout, first
        self.held, self.held_ids, self.held_at = b"", [], []

    def add(self, docs: list[bytes], ids: list[int]) -> tuple[int, list[bytes], list[int]]:
        """Number of the first sequence that is now whole, the sequences, their first ids."""
        mark = self.layout.mark(self.layout.end_mark)
        lengths = [len(d) + len(mark) for d in docs]
        at = np.cumsum([len(self.held), *lengths])
        data = self.held + b"".join(x for d in docs for x in (d, mark))
        starts = np.array([*self.held_at, *at[:-1].tolist()], dtype=np.int64)
        names = [*self.held_ids, *ids]
        return self._cut(data, starts, names, len(data) // self.layout.size)

    def _cut(self, data: bytes, starts: np.ndarray, names: list, n: int):
        size, first = self.layout.size, self.next
        cuts = np.arange(n) * size
        own = np.searchsorted(starts, cuts, side="right") - 1
        out = [data[a : a + size] for a in cuts.tolist()]
        self.held, self.next = data[n * size :], first + n
        # Of what was before the rest, only the document that the rest begins in still matters.
        keep = max(0, int(np.searchsorted(starts, n * size, side="right")) - 1) if names else 0
        self.held_ids = names[keep:] if self.held else []
        self.held_at = (starts[keep:] - n * size).tolist() if self.held else []
        return first, out, [names[i] for i in own.tolist()]

    def end(self) -> tuple[int, list[bytes], list[int]]:
        """The last sequence, padded, if anything is left."""
        rest = len(self.held) % self.layout.size
        if not rest:
            return self.next, [], []
        fill = self.layout.mark(self.layout.padding) * ((self.layout.size - rest) // self.layout.width)
        return self._cut(self.held + fill, np.array(self.held_at, dtype=np.int64), self.held_ids, 1)


def write_shards(
    spark: SparkSession, source: str, path: str, layout: Layout | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> int:
    """Write the Parquet table ``source`` as shards below ``path``; the number of sequences."""
    prepare(spark)
    layout = layout or Layout()
    with fixed_splits(spark):
        counted = _rows(spark, source, id_col, text_col).groupBy("split").agg(
            F.sum(F.coalesce(F.octet_length("data"), F.lit(0)) + layout.width).alias("size")
        )
        sizes = sorted((r.split, -(-r["size"] // layout.size)) for r in counted.toLocalIterator())
        n = sum(count for _, count in sizes)
        if n == 0:
            return 0
        # A pair of numbers per split of the input files: a ten-millionth of the input.
        bases = dict(zip((s for s, _ in sizes), np.cumsum([0, *(c for _, c in sizes)]).tolist(), strict=False))
        expected = spark.sparkContext.broadcast((bases, dict(sizes)))
        order = Feistel(layout.key, n)

        def work(batches):
            split, packer = None, None

            def rows(found) -> Iterator[pa.RecordBatch]:
                first, sequences, ids = found
                if sequences:
                    numbers = np.arange(first, first + len(sequences))
                    head = np.empty((len(sequences), 2), dtype="<i8")
                    head[:, 0], head[:, 1] = numbers, ids
                    raw = [h.tobytes() + s for h, s in zip(head, sequences, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(order.slots(numbers)), pa.array(raw, pa.binary())], ["slot", "record"]
                    )

            def ended() -> Iterator[pa.RecordBatch]:
                if packer is not None:
                    yield from rows(packer.end())
                    if packer.next != expected.value[0][split] + expected.value[1][split]:
                        raise RuntimeError("a split of the source has changed between two passes")

            for batch in batches:
                splits = np.array(batch.column(0).to_pylist())
                data, at = buffers(batch.column(2))
                ids = [NO_ID if i is None else i for i in batch.column(1).to_pylist()]
                raw, low = data.tobytes(), 0
                for high in [*(np.flatnonzero(splits[1:] != splits[:-1]) + 1).tolist(), len(splits)]:
                    if high == low:
                        continue
                    if splits[low] != split:
                        yield from ended()
                        split = int(splits[low])
                        packer = Packer(layout, expected.value[0][split])
                    docs = [raw[a:b] for a, b in zip(at[low:high], at[low + 1 : high + 1], strict=True)]
                    yield from rows(packer.add(docs, ids[low:high]))
                    low = high
            yield from ended()

        made = _rows(spark, source, id_col, text_col).mapInArrow(work, "slot bigint, record binary")
        shards = -(-n // layout.per_shard)
        dealt = made.repartitionById(shards, F.expr(f"int(slot div {layout.per_shard})"))
        dealt.sortWithinPartitions("slot").select(F.col("record").cast("string").alias("value")).write.text(
            path, lineSep="\n"
        )
    return n


def read_slots(
    spark: SparkSession, path: str, layout: Layout | None = None, first_slot: int = 0
) -> DataFrame:
    """Records from ``first_slot`` on: slot, sequence, first_id, ``tokens`` (padding included).

    Only shards that hold such slots are opened. A task reads a shard, whose size is fixed."""
    prepare(spark)
    layout = layout or Layout()
    schema = "slot bigint, sequence bigint, first_id bigint, tokens binary"
    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int")
    files = spark.read.format("binaryFile").load(path).select("path", number.alias("shard"))
    low = first_slot // layout.per_shard
    wanted = [r.path for r in files.where(F.col("shard") >= low).toLocalIterator()]
    if not wanted:
        return spark.createDataFrame([], schema)

    def work(batches):
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = int(re.search(r"part-(\d+)[^/]*$", name)[1])
                n = len(content) // layout.stride
                table = np.frombuffer(content, np.uint8)[: n * layout.stride].reshape(n, layout.stride)
                head = np.ascontiguousarray(table[:, :HEADER]).view("<i8")
                slots = shard * layout.per_shard + np.arange(n)
                keep = np.flatnonzero(slots >= first_slot)
                for some in np.array_split(keep, max(1, len(keep) * layout.stride >> 23)):
                    tokens = [table[i, HEADER:-1].tobytes() for i in some.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slots[some]), pa.array(head[some, 0]), pa.array(head[some, 1]),
                         pa.array(tokens, pa.binary())],
                        ["slot", "sequence", "first_id", "tokens"],
                    )

    found = spark.read.format("binaryFile").load(wanted).select("path", "content")
    return found.mapInArrow(work, schema)
