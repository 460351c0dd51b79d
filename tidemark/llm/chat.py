"""Chat formatting: a conversation as one text with marked turns, and one example per reply.

Turns begin with ``### role: `` and end with ``</turn>`` on a line of its own. Control strings in
a text are escaped by a backslash, and backslashes before them too; a role has ``%``, ``:`` and line
feeds as in URLs. So reading a turn back gives exactly what was written.

Prefix-target expansion makes an example of every assistant turn: all turns before it are context
and only the reply is trainable. Contexts of one conversation are prefixes of one text, so an
example does not copy them: it is the conversation's stream of formatted turns up to the reply
(``context_chars`` of it) and the span of the reply. That keeps the output as long as the input,
where copies would grow with the square of a conversation; ``texts`` writes copies where a trainer
wants them.

Defined cases: a null text is empty; a null role is written as an empty one; a null conversation
id is a conversation of its own; null turns come first. Rows of equal conversation and turn are
ordered by role and text, and repeated rows are turns of their own. A conversation without an
assistant turn has no example. An empty table gives no rows. Only the columns named are read."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.cluster import prepare, written

OPEN, CLOSE = "### ", "\n</turn>\n"
# A backslash goes before these; the run of backslashes before them is doubled as well, so that a
# text may hold what looks like an escape.
_CONTROL = r"(\\*)(###|</turn>)"
_ESCAPED = r"(\\+)(###|</turn>)"
TARGET_ROLE = "assistant"
ROLE_CODES = (("%", "%25"), (":", "%3A"), ("\n", "%0A"))


def escape(text: Column) -> Column:
    """``\\`` n times before a control string becomes 2n + 1 times; other text stays."""
    return F.regexp_replace(text, _CONTROL, r"$1$1\\$2")


def unescaped(text: str) -> str:
    return re.sub(_ESCAPED, lambda m: "\\" * (len(m[1]) // 2) + m[2], text)


def formatted(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per turn: conv_id, turn, role, tie (order among equal turns) and its ``piece`` of the stream
    with the span [``body_from``, ``body_to``) of the escaped text in it. No shuffle."""
    role = F.coalesce(df[role_col].cast("string"), F.lit(""))
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    safe = role
    for plain, coded in ROLE_CODES:
        safe = F.replace(safe, F.lit(plain), F.lit(coded))
    head = F.concat(F.lit(OPEN), safe, F.lit(": "))
    body = escape(text)
    return df.select(
        df[conv_col].alias("conv_id"), df[turn_col].alias("turn"), role.alias("role"),
        F.concat(head, body, F.lit(CLOSE)).alias("piece"),
        F.length(head).alias("body_from"), (F.length(head) + F.length(body)).alias("body_to"),
    )


def ordered(turns: DataFrame) -> DataFrame:
    """Turns with ``position`` (0, 1, ...) in their conversation, ``offset`` of their piece in the
    stream, and the trainable span [``loss_from``, ``loss_to``) in the stream, null for context.

    Turns are dealt by range of conversation and turn, so a conversation may lie in several tasks.
    Each task adds up its own stretch of a conversation; the sums of stretches (as many as there
    are tasks, plus the conversations cut) say where the next one begins."""
    order = ["conv_id", "turn", "role", "piece"]
    spark = turns.sparkSession
    prepare(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = dict(turns.dtypes)
    names = [*order, "body_from", "body_to"]

    def running(batches) -> Iterator[pa.RecordBatch]:
        conv, seen, chars = object(), 0, 0
        for batch in batches:
            at, start = [], []
            for own, length in zip(
                batch.column(0).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True
            ):
                if own != conv:
                    conv, seen, chars = own, 0, 0
                at.append(seen)
                start.append(chars)
                seen, chars = seen + 1, chars + length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(at, pa.int64()), pa.array(start, pa.int64())],
                [*names, "part", "at", "start"],
            )

    dealt = turns.select(*names).repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = ", ".join(f"{c} {kinds[c]}" for c in names)
    placed = written(
        dealt.select("*", F.spark_partition_id(), F.length("piece").cast("bigint")).mapInArrow(
            running, f"{schema}, part int, at bigint, start bigint"
        ),
        "chat-turns",
    )
    sums = placed.groupBy("conv_id", "part").agg(
        F.count("*").alias("turns"), F.sum(F.length("piece")).alias("chars")
    )
    cut = sums.groupBy("conv_id").agg(F.collect_list(F.struct("part", "turns", "chars")).alias("s"))
    before = F.transform(
        "s",
        lambda x: F.struct(
            x.part.alias("p"),
            _total("s", x, "turns").alias("turns_before"),
            _total("s", x, "chars").alias("chars_before"),
        ),
    )
    # A conversation within one task begins at 0 and has no row here.
    starts = cut.where(F.size("s") > 1).select(F.col("conv_id").alias("c"), F.inline(before))
    joined = placed.join(
        starts, placed.conv_id.eqNullSafe(F.col("c")) & (placed.part == F.col("p")), "left"
    )
    offset = F.col("start") + F.coalesce("chars_before", F.lit(0))
    target = F.col("role") == TARGET_ROLE
    return joined.select(
        "conv_id", "turn", "role", "piece",
        (F.col("at") + F.coalesce("turns_before", F.lit(0))).alias("position"),
        offset.alias("offset"),
        F.when(target, offset + F.col("body_from")).alias("loss_from"),
        F.when(target, offset + F.col("body_to")).alias("loss_to"),
    )


def _total(parts: str, here: Column, field: str) -> Column:
    earlier = F.filter(parts, lambda y: y.part < here.part)
    return F.aggregate(earlier, F.lit(0).cast("bigint"), lambda a, y: a + y[field])


def examples(stream: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, ``example`` (the reply's position), ``context_turns``,
    ``context_chars`` (the prefix of the stream), the reply's span and its escaped text."""
    return stream.where("loss_from is not null").select(
        "conv_id",
        F.col("position").alias("example"),
        F.col("position").alias("context_turns"),
        F.col("offset").alias("context_chars"),
        "loss_from",
        "loss_to",
        F.expr("substring(piece, int(loss_from - offset) + 1, int(loss_to - loss_from))").alias("reply"),
    )


def texts(stream: DataFrame) -> DataFrame:
    """Examples with their whole text (``text``; the reply at [``from``, ``to``)), for trainers that
    need copies. The output holds every context again: it grows with the square of the turns."""
    context = stream.select(F.col("conv_id").alias("c"), F.col("position").alias("p"), "piece")
    targets = stream.where("loss_from is not null").select(
        "conv_id", F.col("position").alias("example"), "loss_from", "loss_to"
    )
    pairs = targets.join(
        context, targets.conv_id.eqNullSafe(F.col("c")) & (F.col("p") <= F.col("example"))
    )
    pieces = F.sort_array(F.collect_list(F.struct("p", "piece")))
    return pairs.groupBy("conv_id", "example", "loss_from", "loss_to").agg(
        F.array_join(F.transform(pieces, lambda x: x.piece), "").alias("text")
    )


class Digest:
    """The figures of one conversation, read from its stream; hashes, counts and the text of a turn
    that has not ended yet are kept."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss, self.rest = sha256(), sha256(), ""

    def read(self, text: str) -> None:
        """Go on reading the stream. Turns are found by their marks alone, wherever ``text`` ends."""
        self.chars += len(text)
        self.rest += text
        at = 0
        while (colon := self.rest.find(": ", at)) >= 0:
            end = self.rest.find(CLOSE, colon + 2)
            if end < 0:
                break
            self.turn(self.rest[at:colon], self.rest[colon + 2 : end])
            at = end + len(CLOSE)
        self.rest = self.rest[at:]

    def turn(self, head: str, body: str) -> None:
        if not head.startswith(OPEN):
            raise ValueError("a turn does not begin with its mark")
        head = head.removeprefix(OPEN)
        for plain, coded in reversed(ROLE_CODES):
            head = head.replace(coded, plain)
        self.turns += 1
        self.all.update(f"{head}\n{unescaped(body)}\n".encode())

    def example(self, reply: str, context_chars: int) -> None:
        """Read the trainable text of an example; its turn, the last of the stream, comes next."""
        if context_chars != self.chars or self.rest:
            raise ValueError("the context of an example is not what precedes its reply")
        own = unescaped(reply)
        self.loss_chars += len(own)
        self.loss.update(own.encode())

    def row(self) -> dict:
        if self.rest:
            raise ValueError("the last turn does not end with its mark")
        return {
            "conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


def digests(stream: DataFrame, found: DataFrame) -> DataFrame:
    """Per conversation, read back from the stream and its examples ``found``: n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars. Rows pass through in order; a hash has
    no halves, so one conversation's rows go through one task, but no more than one row is held."""
    prepare(stream.sparkSession)
    kind = dict(stream.dtypes)["conv_id"]
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([
        ("conv_id", to_arrow_type(stream.schema["conv_id"].dataType)), ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ])

    def work(batches) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in batches:
            for conv, _, is_turn, text, context in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if current is None or current.conv_id != conv:
                    if current is not None:
                        done.append(current.row())
                    current = Digest(conv)
                if is_turn:
                    current.read(text)
                else:
                    current.example(text, context)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
        if current is not None:
            yield pa.RecordBatch.from_pylist([current.row()], schema=schema)

    turns = stream.select(
        "conv_id", "position", F.lit(True).alias("is_turn"), F.col("piece").alias("part"),
        F.lit(None).cast("bigint").alias("context"),
    )
    replies = found.select(
        "conv_id", F.col("example").alias("position"), F.lit(False).alias("is_turn"),
        F.col("reply").alias("part"), F.col("context_chars").alias("context"),
    )
    rows = turns.unionByName(replies).repartition("conv_id")
    return rows.sortWithinPartitions("conv_id", "position", "is_turn").mapInArrow(
        work, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint,"
        " loss_sha256 string, formatted_chars bigint",
    )
