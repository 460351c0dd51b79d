"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and read as words of letters; the n-grams of a word padded with one space on
each side are hashed into 2**bits buckets. Counting is distributed: a task adds up its own texts
and sends one row per language and bucket that it has seen, so one hot language or source costs no
more than any other. The matrix of log-probabilities (languages by buckets, of a size that is
checked) is broadcast, and batches of texts are scored in numpy by gathering from it.

Defined cases: a text that is null or has no letter gets ``und`` with score 0. A text of any length
is scored whole. Between languages of equal score the first by name wins. Rows with a null language
are not learned from; if nothing can be learned, every text is ``und``. Repeated rows count each
time. Only the columns named are read."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import groups
from tidemark.llm.cluster import prepare, written
from tidemark.llm.words import mixed

UNKNOWN = "und"
MATRIX_BYTES = 64 << 20


@dataclass(frozen=True)
class Features:
    orders: tuple[int, ...] = (1, 2, 3)
    bits: int = 16
    smoothing: float = 0.5


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)])


def ngrams(texts: list[str], features: Features) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the bucket of every n-gram of all texts and the text it is in, in order."""
    lowered = [t.lower() for t in texts]
    joined = "\n" + "\n".join(lowered) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[points]
    kept = letter.copy()
    kept[0] = True
    kept[1:] |= letter[:-1]  # of what lies between words, the first code point
    at = np.flatnonzero(kept)
    letter = letter[at]
    value = np.where(letter, points[at], 32).astype(np.uint64)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    owner = np.searchsorted(ends, at - 1, side="right").astype(np.int64)
    for n in features.orders:
        count = len(value) - n + 1
        if count <= 0:
            continue
        ok = np.ones(count, dtype=bool) if n > 1 else letter[:count].copy()
        for i in range(1, n - 1):  # spaces stand at the ends only
            ok &= letter[i : i + count]
        first = np.flatnonzero(ok)
        code = np.full(len(first), n, dtype=np.uint64)
        for i in range(n):
            code = code * np.uint64(0x100000001B3) + value[first + i]
        # An n-gram that begins with a space belongs to the text of its first letter.
        inside = first if n == 1 else np.where(letter[first], first, first + 1)
        yield (mixed(code) >> np.uint64(64 - features.bits)).astype(np.int64), owner[inside]


def counts(
    df: DataFrame, features: Features, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``label``, ``bucket`` and ``n``: n-grams per language and bucket over all rows of ``df``;
    bucket -1 has the number of texts."""
    prepare(df.sparkSession)
    size = 1 << features.bits

    def work(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            first = 0
            for texts in groups(batch.column(0).to_pylist()):
                own = langs[first : first + len(texts)]
                first += len(texts)
                names = sorted(set(own))
                label = np.array([names.index(x) for x in own])
                table = np.zeros((len(names), size + 1), dtype=np.int64)
                table[:, size] = np.bincount(label, minlength=len(names))
                for bucket, owner in ngrams(texts, features):
                    flat = np.bincount(label[owner] * size + bucket, minlength=len(names) * size)
                    table[:, :size] += flat.reshape(len(names), size)
                for name, row in zip(names, table, strict=True):
                    totals[name] = totals[name] + row if name in totals else row
        for name, row in totals.items():
            seen = np.flatnonzero(row)
            bucket = np.where(seen == size, -1, seen).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen), pa.string()), pa.array(bucket), pa.array(row[seen])],
                ["label", "bucket", "n"],
            )

    labelled = df.select(df[text_col], df[lang_col].cast("string")).where(
        df[lang_col].isNotNull() & df[text_col].isNotNull()
    )
    parts = labelled.mapInArrow(work, "label string, bucket int, n bigint")
    return parts.groupBy("label", "bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    prior: np.ndarray
    log_prob: np.ndarray  # languages by buckets
    features: Features

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Languages and their posterior probabilities."""
        n, k = len(texts), len(self.labels)
        total, seen = np.zeros((n, k)), np.zeros(n, dtype=np.int64)
        for bucket, owner in ngrams(texts, self.features):
            seen += np.bincount(owner, minlength=n)
            for j in range(k):
                total[:, j] += np.bincount(owner, weights=self.log_prob[j][bucket], minlength=n)
        if not k:
            return [UNKNOWN] * n, [0.0] * n
        total += self.prior
        best = total.argmax(axis=1)
        odds = np.exp(total - total.max(axis=1, keepdims=True))
        score = odds[np.arange(n), best] / odds.sum(axis=1)
        known = (seen > 0).tolist()
        return (
            [self.labels[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), known, strict=True)],
            [s if ok else 0.0 for s, ok in zip(score.tolist(), known, strict=True)],
        )


def fit(
    df: DataFrame, features: Features | None = None, text_col: str = "text", lang_col: str = "lang"
) -> Model:
    """A model of all labelled rows of ``df``. The driver gets one number per language and bucket."""
    features = features or Features()
    size = 1 << features.bits
    most = MATRIX_BYTES // (8 * size)
    # Written, so that the texts are counted once for the totals and the buckets.
    table = written(counts(df, features, text_col, lang_col), "language-counts")
    totals = table.where("bucket = -1").orderBy("label").limit(most + 1).collect()
    if len(totals) > most:
        raise ValueError(f"more than {most} languages: take fewer bits, so that the matrix fits")
    labels = tuple(r.label for r in totals)
    n = np.zeros((len(labels), size))
    place = {x: i for i, x in enumerate(labels)}
    rows = table.where("bucket >= 0").toArrow()
    row = np.array([place[x] for x in rows.column("label").to_pylist()], dtype=np.int64)
    n[row, rows.column("bucket").to_numpy().astype(np.int64)] = rows.column("n").to_numpy()
    n += features.smoothing
    prior = np.array([r.n for r in totals], dtype=float)
    return Model(
        labels,
        np.log(prior / prior.sum()) if len(labels) else prior,
        np.log(n / n.sum(axis=1, keepdims=True)),
        features,
    )


def predict(
    df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: id, the columns of ``keep`` (name to expression), lang_pred and score."""
    spark = df.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    own = [df[id_col], *[c.alias(n) for n, c in (keep or {}).items()]]
    extra = df.select(*own).dtypes
    names = [n for n, _ in extra]

    def work(batches):
        for batch in batches:
            langs, scores = [], []
            for texts in groups(batch.column(0).to_pylist()):
                a, b = shared.value.predict(texts)
                langs += a
                scores += b
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*names, "lang_pred", "score"],
            )

    results = [("lang_pred", "string"), ("score", "double")]
    schema = ", ".join(f"`{n}` {k}" for n, k in [*extra, *results])
    return df.select(df[text_col], *own).mapInArrow(work, schema)
