"""Similarity self-join of texts on their word n-grams, by MinHash banding.

Two texts are linked if the Jaccard similarity of their sets of n-grams (five words) is at least
the threshold. Bands and rows are chosen so that a pair at the threshold shares a band with the
target recall. Copies (equal sequences of words) are one class and go through everything once.

Buckets are shuffled by band hash as pairs of numbers. No pairs are listed within a bucket:

1. Each member is verified against the smallest member of its buckets, on full n-gram sets; a
   bucket with many members is salted. Links give first components.
2. Buckets that still hold more than one component are compared in full, block by block, inside
   tasks that send back a spanning forest of the links they find: no link between components is
   lost, and what comes out grows with the members.
3. Final components are compared block by block to count each member's links. A task gets two
   blocks of bounded size and returns one count per member.

Words are as in ``decontaminate``. Defined cases: a text with words but fewer than five has one
n-gram, all its words; a null text or one without words has none and is linked to nothing. Rows of
equal id are rows of their own. A text of any length counts whole. An empty table gives no rows.
Other columns are not looked at."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.cluster import files_for, prepare, written
from tidemark.llm.components import components
from tidemark.llm.decontaminate import LOWER, WORD, Tokens, tokens
from tidemark.llm.words import Texts, counted, mixed, parts, powers

BLOCK_ROWS = 512
BLOCK_BYTES = 8 << 20
SALT_ROWS = 1024


def choose_bands(threshold: float, recall: float) -> tuple[int, int]:
    """(bands, rows): of the choices that reach ``recall`` at ``threshold`` with at most 128
    hashes, the one with most rows, which lets fewest dissimilar pairs through."""
    best = None
    for rows in range(1, 17):
        share = threshold**rows
        bands = 1 if share >= 1 else max(1, ceil(log(1 - recall) / log1p(-share)))
        if bands * rows <= 128:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"128 hashes do not reach {recall} at {threshold}")
    return best


@dataclass(frozen=True)
class Join:
    n: int = 5
    threshold: float = 0.8
    recall: float = 0.9999
    seed: int = 7

    @property
    def bands(self) -> tuple[int, int]:
        return choose_bands(self.threshold, self.recall)


def shingles(found: Tokens, n_texts: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of all texts, in order, and the text each is in."""
    words = counted(found.owner, n_texts)
    first = np.concatenate([[0], np.cumsum(words)])
    base = 0xA0761D6478BD642F
    running = np.zeros(len(found.word) + 1, dtype=np.uint64)
    np.cumsum(found.word * powers(base, len(found.word))[: len(found.word)], out=running[1:])
    length = np.minimum(words, n)
    many = np.where(words > 0, words - length + 1, 0)
    owner = np.repeat(np.arange(n_texts), many)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + first[owner]
    inverse = powers(pow(base, -1, 1 << 64), len(running))
    return mixed((running[at + length[owner]] - running[at]) * inverse[at] + length[owner].astype(np.uint64)), owner


def ngram_set(text: str, n: int) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    found = tokens(Texts(raw, np.array([0]), np.array([len(raw)])))
    return np.unique(shingles(found, 1, n)[0])


def signatures(texts: Texts, join: Join) -> tuple[list, list, np.ndarray]:
    """Per text: key of its words, band hashes (None without words), bytes."""
    bands, rows = join.bands
    found = tokens(texts)
    n = len(texts)
    hashes, owner = shingles(found, n, join.n)
    have, first = np.unique(owner, return_index=True)
    random = np.random.Generator(np.random.PCG64(join.seed))
    flips = random.integers(0, 2**64, size=bands * rows, dtype=np.uint64)
    factors = random.integers(0, 2**63, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(have), bands), dtype=np.uint64)
    if len(have):
        for i in range(bands * rows):
            least = np.minimum.reduceat((hashes ^ flips[i]) * factors[i], first)
            band = i // rows
            out[:, band] = mixed(out[:, band] * np.uint64(0x9FB21C651E98DF25) + least + np.uint64(band + 1))
    sets: list = [None] * n
    for row, i in zip(out.view(np.int64).tolist(), have.tolist(), strict=True):
        sets[i] = row
    return word_keys(texts, found.data), sets, texts.ends - texts.starts


def word_keys(texts: Texts, lowered: np.ndarray) -> list:
    """Per text: digest of its words with one byte between them; None without words."""
    inside = WORD[lowered]
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    begins = texts.starts[texts.starts < len(kept)]
    kept[begins] = inside[begins]
    flat = np.where(inside, lowered, 32)[kept].astype(np.uint8).tobytes()
    upto = np.concatenate([[0], np.cumsum(kept)])
    bounds = zip(upto[texts.starts].tolist(), upto[texts.ends].tolist(), strict=True)
    words = [flat[a:b].rstrip(b" ") for a, b in bounds]
    return [sha256(w).digest()[:16] if w else None for w in words]


def sketches(docs: DataFrame, join: Join, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, key (of its words), bands and size."""
    prepare(docs.sparkSession)

    def work(batches):
        for batch in batches:
            for piece, part in parts(batch.column(1)):
                keys, bands, sizes = signatures(part, join)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[piece], pa.array(keys, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sizes, pa.int64())],
                    ["id", "key", "bands", "size"],
                )

    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, key binary, bands array<bigint>, size bigint"
    return docs.select(docs[id_col], docs[text_col]).mapInArrow(work, schema)


def keyed(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` with the key of each row's words in a column ``name``."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text_col)

    def work(batches):
        for batch in batches:
            keys = []
            for _, part in parts(batch.column(at)):
                keys += word_keys(part, LOWER[part.data])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, name]
            )

    schema = docs.select("*", F.lit(b"").alias(name)).schema
    schema[name].nullable = True
    return docs.mapInArrow(work, schema)


def similar(inter: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, given sizes of intersections and sets."""
    return inter >= threshold * (a + b - inter) - 1e-9


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    flat = [np.concatenate(s) if s else np.zeros(0, np.uint64) for s in (left, right)]
    shared = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    place = []
    for values, sets in zip(flat, (left, right), strict=True):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(shared, values)
        at[at == len(shared)] = 0
        ok = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        place.append((row[ok], at[ok]))
    width = 4096
    for low in range(0, len(shared), width):
        tables = []
        for (row, at), sets in zip(place, (left, right), strict=True):
            near = (at >= low) & (at < low + width)
            table = np.zeros((len(sets), min(width, len(shared) - low)), dtype=np.float32)
            table[row[near], at[near] - low] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out.astype(np.int64)


def forest(a: list[int], b: list[int], n: int) -> list[tuple[int, int]]:
    """Links that connect what the links (a[i], b[i]) connect, fewer than n."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for x, y in zip(a, b, strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def grouped_rows(batches, n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that arrive sorted by their first ``n_keys`` columns, a group at a time."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield key, rows


def verified_stars(edges: DataFrame, texts: DataFrame, join: Join) -> DataFrame:
    """Those of the links (``node``, ``pivot``) whose texts are similar.

    A pivot's text is repeated once per salt, as many as its members need; a task holds one
    pivot's n-grams and reads the members past them."""
    salts = edges.groupBy("pivot").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts"))
    members = edges.join(salts, "pivot").join(texts, "node").select(
        "pivot", F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt"), F.lit(1).alias("rank"),
        "node", "text",
    )
    pivots = salts.join(texts, salts.pivot == texts.node).select(
        "pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.lit(0).alias("rank"), "node", "text",
    )

    def work(batches):
        held, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            found = []
            for pivot, _, rank, node, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams = ngram_set(text, join.n)
                if rank == 0:
                    held, own = pivot, grams
                elif held == pivot:
                    inter = len(np.intersect1d(own, grams, assume_unique=True))
                    if similar(np.array(inter), len(own), len(grams), join.threshold):
                        found.append({"a": node, "b": pivot})
            if found:
                yield pa.RecordBatch.from_pylist(found, LINKS)

    rows = members.unionByName(pivots).repartition("pivot", "salt")
    return rows.sortWithinPartitions("pivot", "salt", "rank").mapInArrow(work, "a bigint, b bigint")


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
COUNTS = pa.schema([("node", pa.int64()), ("n", pa.int64())])


def compared(groups: DataFrame, texts: DataFrame, join: Join, counting: bool) -> DataFrame:
    """All members of each group (``group``, ``node``) compared, in blocks.

    Gives links that connect what is similar, or (``counting``) per node and pair of blocks the
    documents it is linked to. A group is cut into blocks by hash so that a block has about
    BLOCK_ROWS members and BLOCK_BYTES of text; each pair of blocks is a task's work."""
    # Only numbers are dealt by group; texts are joined by node, when the pairs of blocks are known.
    sized = groups.join(texts.select("node", "size"), "node")
    blocks = sized.groupBy("group").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("size") / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    dealt = sized.join(blocks, "group").select(
        "group", "node", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    rows = dealt.select(
        "group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node"
    ).join(texts, "node").select("group", "i", "j", "own", "node", "n_docs", "text")

    def work(batches):
        for (_, i, j), members in grouped_rows(batches, 3):
            sides = [[m for m in members if m[0] == own] for own in sorted({i, j})]
            sets = [[ngram_set(m[3], join.n) for m in side] for side in sides]
            left, right = sides[0], sides[-1]
            sizes = [np.array([len(s) for s in x], dtype=np.int64) for x in (sets[0], sets[-1])]
            inter = intersections(sets[0], sets[-1])
            linked = similar(inter, sizes[0][:, None], sizes[1][None, :], join.threshold)
            linked &= inter > 0
            if i == j:
                np.fill_diagonal(linked, False)
            if counting:
                weight = [np.array([m[2] for m in side], dtype=np.int64) for side in (left, right)]
                found = list(zip([m[1] for m in left], (linked @ weight[1]).tolist(), strict=True))
                if i != j:
                    found += zip([m[1] for m in right], (linked.T @ weight[0]).tolist(), strict=True)
                rows = [{"node": a, "n": n} for a, n in found if n]
                yield pa.RecordBatch.from_pylist(rows, COUNTS)
            else:
                shift = 0 if i == j else len(left)
                names = [m[1] for m in left] + ([] if i == j else [m[1] for m in right])
                a, b = np.nonzero(linked)
                kept = forest(a.tolist(), (b + shift).tolist(), len(names))
                yield pa.RecordBatch.from_pylist([{"a": names[x], "b": names[y]} for x, y in kept], LINKS)

    order = ["group", "i", "j"]
    schema = "node bigint, n bigint" if counting else "a bigint, b bigint"
    return rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(work, schema)


@dataclass(frozen=True)
class Classes:
    """``rows``: id and key of every document. ``classes``: key, node, n_docs, least id.
    ``members``: node and component of linked classes. ``texts``: of classes that may be linked."""

    rows: DataFrame
    classes: DataFrame
    members: DataFrame
    texts: DataFrame


def linked_classes(
    docs: DataFrame, join: Join | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> Classes:
    """Classes of copies, and the components that links between classes form."""
    join = join or Join()
    spark = docs.sparkSession
    rows = written(sketches(docs, join, id_col, text_col), "sketches")
    n_rows, n_bytes = rows.select(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    classes = written(
        rows.where("key is not null").groupBy("key", "bands")
        .agg(F.count("*").alias("n_docs"), F.min("id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes", files_for(spark, n_rows),
    )
    # A band's place is part of its hash, so hashes of different bands do not meet.
    placed = classes.select("node", F.explode("bands").alias("h"))
    shared = placed.groupBy("h").agg(F.count("*").alias("c"), F.min("node").alias("pivot"))
    in_buckets = files_for(spark, n_rows * join.bands[0])
    buckets = written(placed.join(shared.where("c > 1").drop("c"), "h"), "buckets", in_buckets)
    wanted = classes.join(buckets.select("node").distinct(), "node", "left_semi").select(
        F.col("key").alias("k"), F.col("least"), "node", "n_docs"
    )
    sources = keyed(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), "text", "key")
    texts = written(
        sources.join(wanted, (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("least")))
        .groupBy("node", "n_docs").agg(F.first("text").alias("text"))
        .withColumn("size", F.octet_length("text")),
        "texts", max(files_for(spark, n_rows, waves=4), -(-n_bytes // BLOCK_BYTES)),
    )
    edges = buckets.where("node <> pivot").select("node", "pivot").distinct()
    # Links that are found are at most the members of buckets.
    n_links = files_for(spark, buckets.count())
    stars = written(verified_stars(edges, texts.select("node", "text"), join), "stars", n_links, dealt=True)
    first = written(components(stars), "components", n_links)
    labelled = buckets.join(first, "node", "left").select(
        "h", "node", F.coalesce("component", "node").alias("component")
    )
    # Buckets with the same members are compared once.
    mixed_up = labelled.groupBy("h").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("c"),
        F.min("node").alias("least"), F.max("node").alias("most"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"),
    ).where("low <> high").groupBy("c", "least", "most", "s").agg(F.min("h").alias("h"))
    open_groups = buckets.join(mixed_up.select("h"), "h", "left_semi").select(
        F.col("h").alias("group"), "node"
    )
    more = written(compared(open_groups, texts, join, counting=False), "more-links", n_links, dealt=True)
    members = written(components(stars.unionByName(more)), "components", n_links)
    return Classes(rows, classes, members, texts)


def neighbours(
    docs: DataFrame, join: Join | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``class_id`` (the least id that links lead to), ``copy_id`` (the
    least id with the same words) and ``n_links`` (documents it is linked to)."""
    join = join or Join()
    found = linked_classes(docs, join, id_col, text_col)
    groups = found.members.select(F.col("component").alias("group"), "node")
    counts = compared(groups, found.texts, join, counting=True).groupBy("node").agg(F.sum("n").alias("n"))
    least = (
        found.classes.join(found.members, "node").groupBy("component").agg(F.min("least").alias("class_id"))
    )
    placed = (
        found.classes.select("key", "node", "n_docs", "least")
        .join(found.members, "node", "left")
        # Classes without links have keys of their own, so that they are not dealt to one task.
        .withColumn("component", F.coalesce("component", "node"))
        .join(least, "component", "left").join(counts, "node", "left")
        .select(
            F.col("key").alias("k"), F.coalesce("class_id", "least").alias("class_id"),
            F.col("least").alias("copy_id"),
            (F.col("n_docs") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        )
    )
    rows = found.rows.select("id", "key")
    out = rows.join(placed, F.col("key") == F.col("k"), "left").select(
        F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("copy_id", "id").alias("copy_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    return out.coalesce(files_for(docs.sparkSession, rows.count()))


def free_name(columns: list[str], name: str) -> str:
    while name in columns:
        name += "_"
    return name


def one_of_each(
    docs: DataFrame, join: Join | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without all but one of each group of linked documents: the one of least id stays.
    Rows without words all stay."""
    join = join or Join()
    found = linked_classes(docs, join, id_col, text_col)
    placed = found.classes.join(found.members, "node", "left").select(
        "key", "least", F.coalesce("component", "node").alias("component")
    )
    # The least id, and among classes that share it the least key.
    chosen = placed.groupBy("component").agg(F.min(F.struct("least", "key")).alias("x"))
    key = free_name(docs.columns, "word_key")
    names = free_name([*docs.columns, key], "kept_key"), free_name([*docs.columns, key], "kept_id")
    kept = chosen.select(F.col("x.key").alias(names[0]), F.col("x.least").alias(names[1]))
    rows = keyed(docs, text_col, key)
    same: Column = (rows[key] == kept[names[0]]) & rows[id_col].eqNullSafe(kept[names[1]])
    worded = rows.join(kept, same, "left_semi").dropDuplicates([key, id_col])
    return worded.unionByName(rows.where(rows[key].isNull())).drop(key)
