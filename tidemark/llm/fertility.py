"""Quality rules on text shape, and tokeniser fertility: how a public vocabulary copes with a text.

The base rules reject short and repetitive texts. The fertility rules encode the whole text with a
public vocabulary and measure characters per token, the share of tokens that are single raw bytes
(byte fallback), and the entropy of the tokens; a text outside the bands of its script is rejected.

Defined cases: a null or empty text has no words, all counts are 0 and it fails the base rules. A
text of any length is measured whole. Rows are judged one by one, so repeated rows and ties change
nothing. Other columns, whatever their names, are not looked at. An empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.cluster import prepare
from tidemark.llm.words import Texts, counted, mixed, parts, powers, stretch, sums, twice

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SYMBOLS = b"#*$%&|<>"
WORD = np.ones(256, dtype=bool)
WORD[list(SPACES)] = False
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_FIRST = np.array([b & 0xC0 != 0x80 for b in range(256)])  # bytes that begin a code point

# First code point of each stretch of letters and its script; up to the next entry.
SCRIPT_STARTS = (
    (0x0000, "other"), (0x0041, "latin"), (0x005B, "other"), (0x0061, "latin"), (0x007B, "other"),
    (0x00C0, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"),
    (0x0530, "other"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"),
    (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
)


@dataclass(frozen=True)
class Band:
    """What is accepted. ``entropy`` is in bits, for texts of ``entropy_from`` tokens or more."""

    least_chars_per_token: float
    most_chars_per_token: float
    most_byte_share: float
    least_entropy: float = 3.0


@dataclass(frozen=True)
class Rules:
    """``bands`` by script; ``language_bands`` by value of the language column come first."""

    vocabulary: str
    least_words: int = 20
    most_repeat_percent: int = 30
    window: int = 8
    least_tokens: int = 50
    default: Band = Band(0.25, 12.0, 0.95)
    bands: dict[str, Band] = field(
        default_factory=lambda: {
            "latin": Band(1.50, 12.0, 0.25, 4.3),
            "greek": Band(0.40, 8.0, 0.60),
            "cyrillic": Band(0.80, 10.0, 0.40),
            "han": Band(0.45, 4.0, 0.70, 4.0),
            "kana": Band(0.45, 4.0, 0.70, 3.8),
            "hangul": Band(0.40, 4.0, 0.70, 3.8),
            "arabic": Band(0.60, 8.0, 0.40, 3.3),
            "hebrew": Band(0.50, 8.0, 0.40),
            # Letters of some of these scripts are in no vocabulary here: bytes alone are no fault.
            "indic": Band(0.25, 8.0, 0.97, 3.3),
            "thai": Band(0.45, 8.0, 0.60, 3.5),
        }
    )
    language_bands: dict[str, Band] = field(default_factory=dict)


@lru_cache(maxsize=2)
def vocabulary(path: str):
    """The encoder of a vocabulary file, and which of its ids are single raw bytes."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    raw = np.array([pieces.is_byte(i) or pieces.is_unknown(i) for i in range(len(pieces))])
    return (lambda text: pieces.encode(text, num_threads=1)), raw


def shape(texts: Texts, window: int) -> dict[str, np.ndarray]:
    """Counts of words, their characters, symbols, repeated lines and words in repeated windows."""
    data, n = texts.data, len(texts)
    start, end = texts.runs(WORD)
    owner = texts.owner(start)
    running = sums(data)
    # Distance in bytes does not matter to a window, so windows are stretches of word hashes.
    word = stretch(running, start, end)
    across = np.zeros(len(word) + 1, dtype=np.uint64)
    base = 0xC2B2AE3D27D4EB4F
    np.cumsum(word * powers(base, len(word))[: len(word)], out=across[1:])
    at = np.arange(max(0, len(word) - window + 1))
    at = at[owner[at] == owner[at + window - 1]] if len(at) else at
    key = (across[at + window] - across[at]) * powers(pow(base, -1, 1 << 64), len(across))[at]
    again = at[twice(mixed(key) ^ mixed(owner[at].astype(np.uint64) + np.uint64(1)))]
    cover = np.zeros(len(word) + 1, dtype=np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + window, -1)
    repeated = np.cumsum(cover)[:-1] > 0

    line, stop = texts.lines()
    held = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(WORD[data], out=held[1:])
    line, stop = (x[held[stop] > held[line]] for x in (line, stop))
    of = texts.owner(line)
    key = stretch(running, line, stop) ^ mixed(of.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(key, return_index=True)
    code_points = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_FIRST[data] & WORD[data], out=code_points[1:])
    symbols = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_SYMBOL[data], out=symbols[1:])
    return {
        "n_words": counted(owner, n),
        "word_chars": code_points[texts.ends] - code_points[texts.starts],
        "n_symbols": symbols[texts.ends] - symbols[texts.starts],
        "n_dup_lines": counted(of, n) - counted(of[first], n),
        "n_repeat_words": counted(owner[repeated], n),
    }


def script(text: str) -> str:
    """The script of most letters; ``other`` if there are none or they are of no listed script."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.array([s for s, _ in SCRIPT_STARTS])
    counts = np.bincount(np.searchsorted(starts, points, side="right") - 1, minlength=len(starts))
    totals: dict[str, int] = {}
    for (_, name), count in zip(SCRIPT_STARTS, counts.tolist(), strict=True):
        if name != "other" and count:
            totals[name] = totals.get(name, 0) + count
    return max(sorted(totals), key=totals.get) if totals else "other"


def fertility(text: str, encode, raw: np.ndarray) -> tuple[int, float, float, float]:
    """Tokens, characters per token, share of raw bytes, and entropy of the tokens in bits."""
    ids = np.array(encode(text), dtype=np.int64)
    if not len(ids):
        return 0, 0.0, 0.0, 0.0
    _, times = np.unique(ids, return_counts=True)
    share = times / len(ids)
    entropy = float(-(share * np.log2(share)).sum())
    return len(ids), len(text) / len(ids), float(raw[ids].mean()), entropy


def accepted(band: Band, tokens: int, least_tokens: int, chars, raw_share, entropy) -> bool:
    """Short texts are not judged: their figures say little."""
    return tokens < least_tokens or (
        band.least_chars_per_token <= chars <= band.most_chars_per_token
        and raw_share <= band.most_byte_share
        and entropy >= band.least_entropy
    )


MEASURES = pa.schema(
    [(c, pa.int64()) for c in
     ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("script", pa.string()), ("n_tokens", pa.int64()),
       ("chars_per_token", pa.float64()), ("byte_share", pa.float64()),
       ("token_entropy", pa.float64()), ("kept", pa.bool_())]
)


def judged(texts: pa.Array, langs: list, rules: Rules) -> Iterator[pa.RecordBatch]:
    """Measures and verdicts of a column of texts, in batches one after the other.

    The vocabulary is asked only about texts that pass the base rules; others have null figures."""
    encode, raw = vocabulary(rules.vocabulary)
    for piece, part in parts(texts):
        out = {k: v.tolist() for k, v in shape(part, rules.window).items()}
        out["base_failed"] = [
            words < rules.least_words or 100 * repeats > rules.most_repeat_percent * words
            for words, repeats in zip(out["n_words"], out["n_repeat_words"], strict=True)
        ]
        verdicts = []
        for text, lang, failed in zip(
            texts[piece].to_pylist(), langs[piece], out["base_failed"], strict=True
        ):
            if failed:
                verdicts.append((None, None, None, None, None, False))
                continue
            kind, figures = script(text), fertility(text, encode, raw)
            band = rules.language_bands.get(lang) or rules.bands.get(kind, rules.default)
            verdict = accepted(band, figures[0], rules.least_tokens, *figures[1:])
            verdicts.append((kind, *figures, verdict))
        columns = zip(*verdicts, strict=True)
        out |= dict(zip(MEASURES.names[6:], map(list, columns), strict=True))
        yield pa.RecordBatch.from_pydict(out, schema=MEASURES)


def measure(
    df: DataFrame, rules: Rules, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str | None = None,
) -> DataFrame:
    """The id, all measures and the verdict ``kept`` of each row."""
    prepare(df.sparkSession)
    kind = dict(df.dtypes)[id_col]
    columns = [df[id_col], df[text_col], *([df[lang_col]] if lang_col else [])]

    def work(batches):
        for batch in batches:
            langs = batch.column(2).to_pylist() if lang_col else [None] * batch.num_rows
            first = 0
            for out in judged(batch.column(1), langs, rules):
                ids = batch.column(0).slice(first, out.num_rows)
                first += out.num_rows
                yield pa.RecordBatch.from_arrays([ids, *out.columns], [id_col, *MEASURES.names])

    types = {"int64": "bigint", "double": "double", "string": "string", "bool": "boolean"}
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{f.name} {types[str(f.type)]}" for f in MEASURES)
    return df.select(*columns).mapInArrow(work, schema)


def keep(
    df: DataFrame, rules: Rules, text_col: str = "text", lang_col: str | None = None
) -> DataFrame:
    """The rows of ``df`` that pass, with all their columns as they are."""
    prepare(df.sparkSession)
    at, lang_at = df.columns.index(text_col), df.columns.index(lang_col) if lang_col else None

    def work(batches):
        for batch in batches:
            langs = [None] * batch.num_rows
            if lang_at is not None:
                langs = batch.column(lang_at).to_pylist()
            verdicts = [out.column("kept") for out in judged(batch.column(at), langs, rules)]
            if verdicts:
                yield batch.filter(pa.chunked_array(verdicts).combine_chunks())

    return df.mapInArrow(work, df.schema)
