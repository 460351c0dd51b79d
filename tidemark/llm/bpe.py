"""Byte-level BPE: texts to token ids by a public vocabulary's ranks, and back.

Pre-tokenisation runs without a regular expression. Every code point has a class (letter, number,
space, other white space, apostrophe, other), widened by what follows it where the pattern looks
ahead. A small automaton over classes tells at which code points a piece begins. Its transition
functions are closed under composition, a finite set with a table of products; products are
associative, so the function of a row of code points is worked out for all rows side by side, a
scan over the rows gives each row's first state, and a second sweep finds the boundaries.

Pieces then go through pair merging by rank, with a cache from piece to ids. Each piece's offset in
the text's bytes is kept with its number of tokens, so that any range of bytes can be decoded from
the tokens of the pieces it touches.

Defined cases: null is empty and has no tokens. A text of any length is one stretch, never cut
where a piece might cross. Rows are independent; an empty table gives no rows; only the columns
named are read."""

from __future__ import annotations

import base64
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.cluster import prepare

PART_CHARS = 1 << 20
CACHE_PIECES = 300_000
ROW = 128
NO_PAIR = 1 << 40  # above any rank
SHORT_BYTES = 64  # longer pieces are merged one by one

LETTER, NUMBER, SPACE, BLANK, QUOTE, OTHER = range(6)
# White space other than U+0020, as Unicode defines it (fixed values).
WHITE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
         0x202F, 0x205F, 0x3000)
# What may follow an apostrophe to make a piece of its own (fixed values).
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = kinds.get(unicodedata.category(chr(point))[0])
        if kind is not None:
            out[point] = kind
    out[list(WHITE)] = BLANK
    out[0x20], out[0x27] = SPACE, QUOTE
    return out


# The automaton. A symbol says all that a step needs to know of a code point: its class; for white
# space, whether more follows; for an apostrophe, how long a contraction it can begin. The first
# symbol of a text has the same meaning but starts from state START whatever came before.
# States: START nothing open; a run of letters, numbers or others is open; LONE a single space that
# the next run takes in; WHITES a run of white space that goes on; CUT1/CUT2 that many letters of a
# contraction are left; a boundary follows when they are used up.
START, LETTERS, NUMBERS, OTHERS, LONE, WHITES, CUT2, CUT1 = range(8)
STATES = 8
(S_LETTER, S_NUMBER, S_OTHER, S_LAST_SPACE, S_LAST_BLANK, S_MORE_WHITE, S_END_WHITE, S_QUOTE,
 S_QUOTE1, S_QUOTE2) = range(10)
SYMBOLS = 20  # ten, and the same at the beginning of a text


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a piece begins at this code point."""
    if state in (CUT2, CUT1):
        return (CUT1, False) if state == CUT2 else (START, False)
    run = {S_LETTER: LETTERS, S_NUMBER: NUMBERS, S_OTHER: OTHERS, S_QUOTE: OTHERS}.get(symbol)
    if symbol in (S_QUOTE1, S_QUOTE2):
        if state in (OTHERS, LONE):  # part of a run of others, or taken in by the space
            return OTHERS, False
        return (CUT1 if symbol == S_QUOTE1 else CUT2), True
    if run is not None:
        return run, state not in (run, LONE)
    if symbol == S_LAST_SPACE:  # the last of its run, before something: goes with what follows
        return LONE, True
    if symbol == S_LAST_BLANK:  # the last of its run, before something: a piece of its own
        return START, True
    return WHITES, state != WHITES  # more white space follows, or the text ends


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Next states and boundaries by [symbol, state]; the number of each symbol's transition
    function; the products [f, g] (f first, then g); and the functions themselves."""
    step = np.zeros((SYMBOLS, STATES), dtype=np.uint8)
    begins = np.zeros((SYMBOLS, STATES), dtype=bool)
    for symbol in range(SYMBOLS):
        for state in range(STATES):
            fresh = symbol >= SYMBOLS // 2
            step[symbol, state], begins[symbol, state] = _step(
                START if fresh else state, symbol % (SYMBOLS // 2)
            )
    identity = tuple(range(STATES))
    numbers, todo = {identity: 0}, [identity]
    generators = [tuple(row) for row in step.tolist()]
    while todo:
        f = todo.pop()
        for g in generators:
            product = tuple(g[s] for s in f)
            if product not in numbers:
                numbers[product] = len(numbers)
                todo.append(product)
    functions = np.array(list(numbers), dtype=np.uint8)
    lookup = {f: n for f, n in numbers.items()}
    products = np.array(
        [[lookup[tuple(g[s] for s in f)] for g in numbers] for f in numbers], dtype=np.uint16
    )
    return step, begins, np.array([lookup[g] for g in generators], np.uint16), products, functions


def symbols(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The symbol of each code point of texts that begin at ``starts`` (each has code points)."""
    n = len(points)
    kind = classes()[points]
    is_last = np.zeros(n, dtype=bool)  # last code point of a text
    is_last[np.append(starts[1:], n) - 1] = True
    white = (kind == SPACE) | (kind == BLANK)
    more = np.zeros(n, dtype=bool)
    more[:-1] = white[1:]
    more &= ~is_last
    out = np.array([S_LETTER, S_NUMBER, S_LAST_SPACE, S_LAST_BLANK, S_QUOTE, S_OTHER], np.uint8)[kind]
    out[white & more] = S_MORE_WHITE
    out[white & is_last] = S_END_WHITE
    quote = np.flatnonzero(kind == QUOTE)
    if len(quote):
        end = np.append(starts[1:], n)[np.searchsorted(starts, quote, side="right") - 1]
        one = np.where(quote + 1 < end, points[np.minimum(quote + 1, n - 1)], 0)
        two = np.where(quote + 2 < end, points[np.minimum(quote + 2, n - 1)], 0)
        for word in CONTRACTIONS:
            match = one == ord(word[0])
            if len(word) == 2:
                match &= two == ord(word[1])
            out[quote[match]] = S_QUOTE1 if len(word) == 1 else S_QUOTE2
    out[starts] += SYMBOLS // 2
    return out


def boundaries(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions at which pieces begin."""
    step, begins, function, products, functions = automaton()
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    sign = symbols(points, starts)
    rows = -(-n // ROW)
    table = np.zeros(rows * ROW, dtype=np.uint8)
    table[:n] = sign
    columns = np.ascontiguousarray(table.reshape(rows, ROW).T)
    whole = function[columns[0]]
    for column in columns[1:]:
        whole = products[whole, function[column]]
    # Inclusive scan over the rows by doubling, then the state in which each row begins.
    gap = 1
    while gap < rows:
        whole = np.concatenate([whole[:gap], products[whole[:-gap], whole[gap:]]])
        gap *= 2
    state = np.empty(rows, dtype=np.uint8)
    state[0], state[1:] = START, functions[whole[:-1], START]
    flags = np.empty((ROW, rows), dtype=bool)
    for i, column in enumerate(columns):
        flags[i] = begins[column, state]
        state = step[column, state]
    return np.flatnonzero(flags.T.reshape(-1)[:n])


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a vocabulary file: a line has a token in base64 and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in file if x.strip())}


class Encoder:
    """Pair merging by rank, with a cache of pieces in two halves. When the newer half has
    CACHE_PIECES / 2 it becomes the older one, and pieces asked for again move to the newer."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # Every split of a token into two tokens, by key; and the token of each byte.
        splits = sorted(
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        )
        table = np.array([*splits, (NO_PAIR << 22, NO_PAIR)], dtype=np.int64)
        self.pairs = np.ascontiguousarray(table[:, 0]), np.ascontiguousarray(table[:, 1])
        alone = [ranks.get(bytes([b])) for b in range(256)]
        self.of_byte = None if None in alone else np.array(alone, dtype=np.int64)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece: again and again, the adjacent pair of lowest rank becomes one."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > 256:
            return self.merged_long(piece)
        cut = list(range(len(piece) + 1))  # where parts begin, and the end
        pairs = [ranks.get(piece[i : i + 2], NO_PAIR) for i in range(len(piece) - 1)]
        while pairs and (best := min(pairs)) != NO_PAIR:
            at = pairs.index(best)
            del cut[at + 1], pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(piece[cut[at] : cut[at + 2]], NO_PAIR)
            if at:
                pairs[at - 1] = ranks.get(piece[cut[at - 1] : cut[at + 1]], NO_PAIR)
        return [ranks[piece[i:j]] for i, j in zip(cut, cut[1:], strict=False)]

    def merged_long(self, piece: bytes) -> list[int]:
        """The same with a heap and links, for long pieces."""
        import heapq

        ranks, n = self.ranks, len(piece)
        token = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                rank = ranks.get(token[i] + token[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, len(token[i]), len(token[j])))

        for i in range(n):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if token[i] is None or j >= n or (len(token[i]), len(token[j])) != (left, right):
                continue
            token[i] += token[j]
            token[j] = None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ranks[x] for x in token if x is not None]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that two adjacent tokens make, NO_PAIR if they make none."""
        keys, made = self.pairs
        wanted = left << 32 | right
        at = np.searchsorted(keys, wanted)
        return np.where(keys[at] == wanted, made[at], NO_PAIR)

    def merged_together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for many pieces side by side: each round merges the first pair of lowest rank of
        every piece that has one. All ids in the order of the pieces, and the bounds of each."""
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        owner = np.repeat(np.arange(len(pieces)), sizes)
        ids = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full(len(ids), NO_PAIR)  # of each part with the next one of its piece
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.rank_of(ids[inner], ids[inner + 1])
        done = []
        while len(ids):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(ids)))
            lowest = np.repeat(least, counts)
            live = lowest != NO_PAIR
            if not live.all():
                done.append((ids[~live], owner[~live]))
                ids, owner, rank, lowest = ids[live], owner[live], rank[live], lowest[live]
            at = np.flatnonzero(rank == lowest)
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])] if len(at) else at
            ids[at] = lowest[at]
            stay = np.ones(len(ids), dtype=bool)
            stay[at + 1] = False
            ids, owner, rank = ids[stay], owner[stay], rank[stay]
            at -= np.arange(len(at))
            rank[at] = NO_PAIR
            after = at[at + 1 < len(ids)]
            after = after[owner[after + 1] == owner[after]]
            rank[after] = self.rank_of(ids[after], ids[after + 1])
            before = at[at > 0]
            before = before[owner[before - 1] == owner[before]]
            rank[before - 1] = self.rank_of(ids[before - 1], ids[before])
        found, of = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(of, kind="stable")
        ends = np.cumsum(np.bincount(of, minlength=len(pieces)))
        return found[order], np.append(0, ends)

    def known(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of each piece as little-endian 32-bit numbers, from the cache where they are there."""
        cache, older, ranks = self.cache, self.older, self.ranks
        out, alone, together = {}, [], []
        for piece in pieces:
            ids = cache.get(piece)
            if ids is not None:
                out[piece] = ids
                continue
            ids = older.get(piece)
            if ids is not None:
                out[piece] = ids
            else:
                raw = piece.encode()
                if raw in ranks or len(raw) > SHORT_BYTES or self.of_byte is None:
                    out[piece] = np.array(self.merged(raw), "<u4").tobytes()
                else:
                    alone.append(piece)
                    together.append(raw)
                    continue
            cache[piece] = ids or out[piece]
        if together:
            found, bounds = self.merged_together(together)
            raw, ends = found.astype("<u4").tobytes(), (4 * bounds).tolist()
            for piece, a, b in zip(alone, ends, ends[1:], strict=False):
                out[piece] = cache[piece] = raw[a:b]
        if len(cache) >= CACHE_PIECES // 2:
            self.cache, self.older = {}, cache
        return out

    def pieces(self, texts: list[str]) -> tuple[str, list[int], np.ndarray, np.ndarray]:
        """The texts as one, the bounds of all pieces in it, each text's first piece, and the bounds
        in bytes."""
        joined = "".join(texts)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = boundaries(points, starts[lengths > 0])
        first = np.searchsorted(at, np.append(starts, len(joined)))
        in_bytes = np.append(at, len(joined))
        if not joined.isascii():
            # Bytes that continue a code point begin none; the others stand in the order of the text.
            raw = np.frombuffer(joined.encode(), np.int8)
            in_bytes = np.append(np.flatnonzero(raw >= -64), len(raw))[in_bytes]
        return joined, [*at.tolist(), len(joined)], first, in_bytes

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, list[bytes], np.ndarray]]:
        """Per text: its ids as little-endian 32-bit numbers, the same by piece, and the offset of
        each piece in the text's bytes."""
        joined, at, first, in_bytes = self.pieces(texts)
        pieces = [joined[a:b] for a, b in zip(at, at[1:], strict=False)]
        coded = list(map(self.known(set(pieces)).__getitem__, pieces))
        for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
            own = coded[a:b]
            yield b"".join(own), own, in_bytes[a:b] - in_bytes[a]


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_range(
        self, ids: bytes, piece_tokens: np.ndarray, piece_offsets: np.ndarray, start: int, end: int
    ) -> bytes:
        """Bytes [start, end) of the text, from the tokens of the pieces that are in it."""
        low = max(int(np.searchsorted(piece_offsets, start, side="right")) - 1, 0)
        high = int(np.searchsorted(piece_offsets, end, side="left"))
        if start >= end or low >= high:
            return b""
        tokens = np.concatenate([[0], np.cumsum(piece_tokens)])
        found = self.decode(ids[4 * tokens[low] : 4 * tokens[high]])
        begin = int(piece_offsets[low])
        return found[max(start - begin, 0) : end - begin]


_CODERS: dict[str, tuple[Encoder, Decoder]] = {}


def coders(path: str) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of a vocabulary, made once per worker process."""
    if path not in _CODERS:
        ranks = read_ranks(path)
        _CODERS[path] = Encoder(ranks), Decoder(ranks)
    return _CODERS[path]


def groups(texts: list[str | None]) -> Iterator[list[str]]:
    """The texts in groups of about PART_CHARS; null is empty."""
    out, size = [], 0
    for text in texts:
        out.append(text or "")
        size += len(out[-1])
        if size >= PART_CHARS:
            yield out
            out, size = [], 0
    if out:
        yield out


def encode(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_tokens, ``ids`` (little-endian unsigned 32-bit), ``piece_tokens`` (tokens per
    piece) and ``piece_offsets`` (where each piece begins in the text's bytes)."""
    prepare(df.sparkSession)

    def work(batches):
        encoder, _ = coders(vocabulary)
        for batch in batches:
            first = 0
            for texts in groups(batch.column(1).to_pylist()):
                out = list(encoder.encode(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(out)),
                        pa.array([len(ids) // 4 for ids, _, _ in out], pa.int64()),
                        pa.array([ids for ids, _, _ in out], pa.binary()),
                        pa.array([[len(x) // 4 for x in own] for _, own, _ in out], pa.list_(pa.int32())),
                        pa.array([at for _, _, at in out], pa.list_(pa.int64())),
                    ],
                    ["id", "n_tokens", "ids", "piece_tokens", "piece_offsets"],
                )
                first += len(out)

    kind = dict(df.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids binary, piece_tokens array<int>, piece_offsets array<bigint>"
    return df.select(df[id_col], df[text_col]).mapInArrow(work, schema)


def decode(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """Per row: id and ``decoded``, the bytes of the ids; null ids decode to no bytes."""
    prepare(df.sparkSession)

    def work(batches):
        _, decoder = coders(vocabulary)
        for batch in batches:
            decoded = [decoder.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(decoded, pa.binary())], ["id", "decoded"]
            )

    kind = dict(df.dtypes)[id_col]
    return df.select(df[id_col], df[ids_col]).mapInArrow(work, f"`{id_col}` {kind}, decoded binary")


def decode_ranges(df: DataFrame, vocabulary: str, start: str, end: str, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``encode``'s with columns ``start`` and ``end``: id and ``decoded``, the bytes from
    start up to end of its text. Only the tokens of the pieces in that range are decoded; a range
    beyond the text gives what there is of it, one without start or end gives null."""
    prepare(df.sparkSession)

    def work(batches):
        _, decoder = coders(vocabulary)
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)
            decoded = [
                None if a is None or b is None
                else decoder.decode_range(ids or b"", np.array(n or [], np.int64), np.array(at or [], np.int64), max(a, 0), b)
                for ids, n, at, a, b in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(decoded, pa.binary())], ["id", "decoded"]
            )

    kind = dict(df.dtypes)[id_col]
    picked = df.select(df[id_col], "ids", "piece_tokens", "piece_offsets", df[start].cast("bigint"), df[end].cast("bigint"))
    return picked.mapInArrow(work, f"`{id_col}` {kind}, decoded binary")


def digests(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_tokens, SHA-256 of the ids and of what they decode to, n_pieces, and SHA-256 of
    the pieces' byte offsets (unsigned 64-bit, little-endian). The ids of a batch are decoded where
    they were made, instead of being sent between processes."""
    prepare(df.sparkSession)

    def work(batches):
        encoder, decoder = coders(vocabulary)
        for batch in batches:
            first = 0
            for texts in groups(batch.column(1).to_pylist()):
                out = list(encoder.encode(texts))
                ids = [x for x, _, _ in out]
                back = [sha256(decoder.decode(x)).hexdigest() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(ids)),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([sha256(x).hexdigest() for x in ids], pa.string()),
                        pa.array(back, pa.string()),
                        pa.array([len(at) for _, _, at in out], pa.int64()),
                        pa.array([sha256(at.astype("<u8").tobytes()).hexdigest() for _, _, at in out], pa.string()),
                    ],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256", "n_pieces", "offsets_sha256"],
                )
                first += len(ids)

    kind = dict(df.dtypes)[id_col]
    schema = (
        f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string,"
        " n_pieces bigint, offsets_sha256 string"
    )
    return df.select(df[id_col], df[text_col]).mapInArrow(work, schema)
