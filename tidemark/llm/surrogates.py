"""Personal data replaced by keyed surrogates of the same type and format.

Found are e-mail addresses, IP addresses (4 and 6), IBANs, payment cards (with a valid check
digit), US social security numbers, telephone numbers, given names (of a list, before a surname)
and surnames (after a title or a given name). All work is in column expressions.

A surname that was found is replaced wherever it stands alone in the same text with a capital
letter, given names too with ``bare_given``. Telephone numbers are those with a country code (8 to 15
digits), those of North America, and those with a zero before the area. IPv6 addresses may be
shortened; with fewer than four digits (``::1``) they name no host and stay.

Numbers side by side, joined by single spaces or hyphens, are searched number by number: at each, a
social security number, a telephone number or a card in the groupings that cards have is looked for
and what follows it is searched further. Where there is none of these, 13 to 19 digits in any
grouping are a card if the check digit is right.

A surrogate is a keyed permutation of the values of its format: a Feistel network over the two
halves of the value, whose steps shift each character within its own alphabet (digits, lower case,
upper case, Cyrillic, Greek and accented Latin letters). So length, separators, script and case stay,
the same value has the same surrogate everywhere (coreference), and different values of a format
have different ones. Given names move within the list of their gender and script. Check digits are
worked out anew, octets stay below 256, country codes and top-level domains stay.

Collision checks: the distinct values of the corpus are compared with all surrogates. A value whose
surrogate equals a value that occurs in the corpus, or the surrogate of another value, is given the
permutation of the next attempt until none is left. Few values need that; they reach the texts by
a join on the text's digest, and without any there is no join.

Defined cases: a null text stays null and has no entities; an empty one stays empty. Texts of any
length are replaced whole. Equal texts, on whatever rows, get equal results. An empty table gives
no rows. Columns of other names are kept as they are and never looked at."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.cluster import files_for, written
from tidemark.llm.ngram_join import free_name

ROUNDS = 4

# Given names by gender and script, each list a cycle.
GIVEN = {
    "female latin": ("Anna", "Maria", "Laura", "Julia", "Emma", "Sophie", "Clara", "Elena", "Marta",
                     "Alice", "Helen", "Susan", "Linda", "Karen", "Emily", "Camille", "Isabel"),
    "male latin": ("John", "Peter", "Thomas", "Michael", "David", "Paul", "Robert", "James", "Daniel",
                   "Lukas", "Hans", "Klaus", "Pierre", "Jean", "Carlos", "Pablo", "William"),
    "female cyrillic": ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина", "Светлана"),
    "male cyrillic": ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Андрей", "Николай"),
    "female greek": ("Μαρία", "Ελένη", "Κατερίνα", "Σοφία"),
    "male greek": ("Γιώργος", "Νίκος", "Δημήτρης", "Κώστας"),
}
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Mme", "Mlle", "Monsieur", "Madame",
          "Sr", "Sra", "Señor", "Señora", "Don", "Doña", "Господин", "Госпожа", "Κύριος", "Κυρία")
ALPHABETS = (
    "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŸŒ",
)
# Hexadecimal digits of addresses, while they are permuted, so that 9 may become a.
HEX, HIDDEN = "0123456789abcdef", "ⓐⓑⓒⓓⓔⓕⓖⓗⓘⓙⓚⓛⓜⓝⓞⓟ"
_letters = "".join((*ALPHABETS, HIDDEN))
_sizes = [len(a) for a in (*ALPHABETS, HIDDEN)]
_starts = [sum(_sizes[:i]) for i in range(len(_sizes))]
_group = "".join(str(i) * n for i, n in enumerate(_sizes))

_names = "|".join(n for names in GIVEN.values() for n in names)
_titles = "|".join(TITLES)
_octet = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_begin, _end = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_surname = r"\p{Lu}[\p{L}'’-]{1,40}"
_hex = "[0-9A-Fa-f]{1,4}"
# With "::" for at least one group, four digits or more and a decimal digit or three colons.
_compressed = (
    rf"(?=(?::*[0-9A-Fa-f]){{4}})(?=[A-Fa-f:]*+\d|(?:[0-9A-Fa-f]*+:){{3}})(?!(?:[0-9A-Fa-f]*+:){{9}})"
    rf"(?:{_hex}(?::{_hex}){{0,6}})?::(?:{_hex}(?::{_hex}){{0,6}})?"
)
# A digit of a telephone number and what may be before it; where another number begins, it ends.
_ends = r"(?!\d{3}-\d{2}-\d{4}|(?:\d{1,3}\.){3}\d)"
_next = rf"(?:(?:[ ./-]|[ .-]?\(|\)[ .-]?){_ends})?\d"
_plain = rf"(?:[ ./-]{_ends})?\d"
# Ten or nine digits after country codes whose numbers have that many, else 8 to 15 in all; fewer
# where they are grouped.
_international = (
    rf"\+(?:(?:1|7|44|91)(?:{_next}){{10}}|(?:3[0134]|4[18]|61)(?:{_next}){{9}}"
    rf"|\d{{1,3}}[ .-]?\(\d{{1,5}}\)[ .-]?\d(?:{_plain}){{4,11}}|\d(?:{_plain}){{7,14}}"
    rf"|\d{{1,3}}[ .-]?\(\d{{1,4}}\)[ .-]?\d{{2,4}}(?:[ .-]?\d{{2,4}}){{1,3}}|\d{{1,3}}(?:[ .-]\d{{2,4}}){{3,4}})(?!\d)"
)
# Without country code: area and exchange of North America, or a zero and the area.
_national = (
    r"[2-9]\d{2}[ -][2-9]\d{2}[ -]\d{4}|0[1-9]\d \d{4} \d{4}|0[1-9]\d{2} \d{3} \d{3,4}"
    r"|0[1-9]\d{3} \d{3} \d{3}|0[1-9]\d{1,3} \d{6,8}"
)
_ip = rf"(?:{_octet}\.){{3}}{_octet}"
# What a number may be followed by that is no part of it: another address or number with dots.
_other = rf"{_ip}|\d{{3}}\.\d{{3}}[.-]\d{{4}}|(?:{_hex}:){{2}}|{_hex}::|[\p{{L}}\p{{N}}._%+-]++@"
# In order of preference where several match. Each begins with what rules most places out. A "run"
# is all numbers joined by single spaces and hyphens; ``_in_run`` finds the entities in it.
PATTERNS = {
    "email": r"(?<![._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "ipv6": rf"(?=[0-9A-Fa-f]{{0,4}}:)(?<!:)(?:(?:{_hex}:){{7}}{_hex}|{_compressed}){_end}(?!\.\d|:[0-9A-Fa-f:])",
    "ip": rf"(?=\d{{1,3}}\.\d)(?<!\.)(?:{_octet}\.){{3}}{_octet}{_end}(?!\.\d)",
    "iban": rf"(?=[A-Z]{{2}}\d\d)[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{_end}",
    "phone": rf"(?=[0-9+(])(?<!\+)(?:{_international}|\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}"
             rf"|\d{{3}}[.-]\d{{3}}[.-]\d{{4}}|0\d(?:[ .]\d{{2}}){{4}})(?![\p{{L}}\p{{N}}])",
    "run": rf"(?=\d(?:[ -]?\d){{8}})\d++(?!\p{{L}})(?:[ -](?!{_other})\d++(?!\p{{L}}))*+",
    "given": rf"(?=\p{{Lu}})(?:{_names})(?= {_surname})",
    "surname": rf"(?=\p{{Lu}})(?<= )(?:(?<=(?<![\p{{L}}\p{{N}}])(?:{_titles})\.? )|(?<=(?<![\p{{L}}\p{{N}}])(?:{_names}) )){_surname}",
}
# Entities begin where a word does, so nothing is tried inside words.
ANY = _begin + r"(?=[\p{L}\p{N}._%+(:-])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"
_DIGITS_ONLY = ("phone", "card", "ssn")
RUN = r"^\d++(?:[ -]\d++)*+$"
# What may begin at a number of a run.
RUN_SSN = r"^\d{3}-\d{2}-\d{4}(?![\d-])"
RUN_PHONE = rf"^(?:\d{{3}}-\d{{3}}-\d{{4}}|0\d(?: \d{{2}}){{4}}|{_national})(?!\d)"
# Groupings of cards, beginning as issuers' numbers do unless they are in one piece.
RUN_CARDS = (
    r"^\d{13,19}(?!\d)",
    *(rf"^(?=[3-6]|2[2-7])\d{{4,}}(?:[ -]\d{{4,}}){{{n}}}(?!\d)" for n in (3, 2, 1)),
    r"^(?=[3-6]|2[2-7])\d{4}(?:[ -]\d{4}){3}[ -]\d{3}(?!\d)",
)


def _luhn(digits: Column) -> Column:
    """The sum that a valid number has divisible by ten."""
    n = F.length(digits)
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    each = F.transform(
        F.split(digits, ""),
        lambda c, i: F.when((n - i) % 2 == 0, doubled(c.cast("int"))).otherwise(c.cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _mod97(text: Column) -> Column:
    """Remainder of digits and letters (A is 10) read as one number."""
    return F.aggregate(
        F.split(text, ""),
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise(
            (a * 100 + F.ascii(c) - 55) % 97
        ),
    )


def kind_of(found: Column) -> Column:
    """The type of a match that is no run of numbers."""
    shapes = {
        "email": "@", "ipv6": "^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*$", "ip": rf"^(?:{_octet}\.){{3}}{_octet}$",
        "iban": r"^[A-Z]{2}\d{2}[A-Z0-9 ]+$",
        "given": rf"^(?:{_names})$", "surname": r"^\p{Lu}[\p{L}'’-]+$",
    }
    out = F.when(found.rlike(r"^\d{3}[.-]\d{3}[.-]\d{4}$"), F.lit("phone"))
    for kind, shape in shapes.items():
        out = out.when(found.rlike(shape), F.lit(kind))
    return out.otherwise(F.lit("phone"))


def _is_card(found: Column) -> Column:
    digits = F.regexp_replace(found, "[ -]", "")
    return F.length(digits).between(13, 19) & (_luhn(digits) % 10 == 0)


def _at_number(rest: Column, before: Column) -> Column:
    """The entity, struct (s, k), with which ``rest`` of a run begins, or null; ``before`` is the
    number in front of it."""
    first = lambda shape: F.nullif(F.regexp_extract(rest, shape, 0), F.lit(""))
    entity = lambda s, k: F.struct(s.alias("s"), F.lit(k).alias("k"))
    alone = ~F.coalesce(before.endswith("-"), F.lit(False))
    out = F.when(alone & rest.rlike(RUN_SSN), entity(first(RUN_SSN), "ssn"))
    out = out.when(rest.rlike(RUN_PHONE), entity(first(RUN_PHONE), "phone"))
    for shape in RUN_CARDS:
        out = out.when(rest.rlike(shape) & _is_card(first(shape)), entity(first(shape), "card"))
    return out


def _in_run(gap: Column, run: Column) -> Column:
    """Pieces (g, s, k) of a run of numbers: its entities from left to right, each beginning at a
    number, with the text before them; what follows the last is a piece of its own. A run without
    any is a card if its check digit says so."""
    parts = F.regexp_extract_all(run, F.lit(r"\d+[ -]?"), F.lit(0))

    def pieces(parts: Column) -> Column:
        joined = lambda start, n: F.array_join(F.slice(parts, start, n), "")
        starts = F.transform(
            parts,
            lambda _, i: F.struct(
                (i + 1).alias("i"), _at_number(joined(i + 1, F.lit(19)), F.get(parts, i - 1)).alias("e")
            ),
        )
        sized = F.transform(
            F.filter(starts, lambda x: x.e.isNotNull()),
            lambda x: F.struct(
                x.i.alias("i"), (x.i + F.regexp_count(x.e.s, F.lit(r"\d+"))).cast("int").alias("next"),
                x.e.s.alias("s"), x.e.k.alias("k"),
            ),
        )
        picked = F.aggregate(
            sized,
            F.filter(sized, lambda x: F.lit(False)),
            lambda a, x: F.when(
                F.coalesce(F.get(a, F.size(a) - 1).next, F.lit(1)) <= x.i, F.concat(a, F.array(x))
            ).otherwise(a),
        )
        piece = lambda g, s, k: F.struct(g.alias("g"), s.alias("s"), k.alias("k"))
        # From behind the entity ``x`` to number ``end``.
        behind = lambda x, end: F.substr(
            joined(F.coalesce(x.i, F.lit(1)), end - F.coalesce(x.i, F.lit(1))),
            F.coalesce(F.length(x.s), F.lit(0)) + 1,
        )

        def finished(picked: Column) -> Column:
            found = F.transform(
                picked,
                lambda x, j: piece(
                    F.concat(F.when(j == 0, gap).otherwise(F.lit("")), behind(F.get(picked, j - 1), x.i)), x.s, x.k
                ),
            )
            rest = behind(F.get(picked, F.size(picked) - 1), F.size(parts) + 1)
            none = F.lit(None).cast("string")
            tail = F.when(rest != "", F.array(piece(rest, F.lit(""), none))).otherwise(
                F.filter(found, lambda x: F.lit(False))
            )
            whole = F.when(_is_card(run), piece(gap, run, F.lit("card"))).otherwise(
                piece(F.concat(gap, run), F.lit(""), none)
            )
            return F.when(F.size(picked) > 0, F.concat(found, tail)).otherwise(F.array(whole))

        return F.transform(F.array(picked), finished)[0]

    # One transform over one element names a value, so that it is not worked out at each use.
    return F.transform(F.array(parts), pieces)[0]


def pieces_of(text: Column, found: Column, pattern: Column) -> Column:
    """A text with matches as pieces (g, s, k): the text before, an entity and its type (null: none)."""
    return F.flatten(
        F.transform(
            F.arrays_zip(F.split(text, pattern, -1).alias("g"), found.alias("s")),
            lambda x: F.when(
                x.s.isNull(),
                F.array(F.struct(x.g.alias("g"), F.lit("").alias("s"), F.lit(None).cast("string").alias("k"))),
            )
            .when(x.s.rlike(RUN), _in_run(x.g, x.s))
            .otherwise(F.array(F.struct(x.g.alias("g"), x.s.alias("s"), kind_of(x.s).alias("k")))),
        )
    )


def canonical(kind: Column, found: Column) -> Column:
    """What two mentions of one thing have in common."""
    country = F.regexp_extract(found, r"^\+(\d{1,3})(?=[ .(-])", 1)
    digits = F.regexp_replace(found, "[^0-9]", "")
    octets = F.transform(
        F.split(found, r"\."), lambda o: F.lpad(F.lower(F.hex(o.try_cast("bigint"))), 2, "0")
    )
    return (
        F.when(kind == "phone", F.concat(country, F.lit(":"), F.substr(digits, F.length(country) + 1)))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "iban", F.replace(found, F.lit(" "), F.lit("")))
        .when(kind == "ip", F.translate(F.array_join(octets, ""), HEX, HIDDEN))
        .when(kind == "ipv6", F.translate(F.lower(found), HEX, HIDDEN))
        .when(kind.isin("email", "surname"), F.lower(found))
        .otherwise(found)
    )


def _shifted(text: Column, stream: Column) -> Column:
    """Each character moved within its alphabet by a byte of ``stream`` (in hexadecimal)."""
    placed = F.transform(
        F.split(text, ""),
        lambda c, i: F.struct(
            c.alias("c"),
            F.when(c == "", 0).otherwise(F.instr(F.lit(_letters), c)).alias("at"),
            F.conv(F.substr(stream, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int").alias("by"),
        ),
    )
    known = F.transform(
        placed, lambda x: F.struct(x.c.alias("c"), x.at.alias("at"), x.by.alias("by"),
                                   F.substr(F.lit(_group), x.at, F.lit(1)).cast("int").alias("g")),
    )
    starts, sizes = F.array(*map(F.lit, _starts)), F.array(*map(F.lit, _sizes))
    moved = F.transform(
        known,
        lambda x: F.when(x.at == 0, x.c).otherwise(
            F.substr(
                F.lit(_letters), starts[x.g] + (x.at - 1 - starts[x.g] + x.by) % sizes[x.g] + 1, F.lit(1)
            )
        ),
    )
    return F.array_join(moved, "")


def _round(number: int, key: str) -> Callable[[Column], Column]:
    """One step: a half is moved by a digest of the other."""
    fixed, moving = ("a", "b") if number % 2 == 0 else ("b", "a")

    def step(x: Column) -> Column:
        seed = F.concat_ws("|", F.lit(key), F.lit(str(number)), x.tag, x.attempt, x[fixed])
        new = _shifted(x[moving], F.sha2(seed, 256))
        return F.struct(
            x.tag.alias("tag"), x.attempt.alias("attempt"),
            x[fixed].alias(fixed), new.alias(moving),
        )

    return step


def _feistel(values: Column, key: str) -> Column:
    """For an array of structs (tag, text, attempt): the permuted texts. One step per ``transform``,
    so that no expression is written out twice."""
    half = lambda x: F.floor(F.length(x.text) / 2).cast("int")
    out = F.transform(
        values,
        lambda x: F.struct(
            x.tag.alias("tag"), x.attempt.cast("string").alias("attempt"),
            F.substr(x.text, F.lit(1), half(x)).alias("a"), F.substr(x.text, half(x) + 1).alias("b"),
        ),
    )
    for i in range(ROUNDS):
        out = F.transform(out, _round(i, key))
    return F.transform(out, lambda x: F.concat(x.a, x.b))


def _given(kind: Column, text: Column, attempt: Column, key: str) -> Column:
    """The name some places on in its list; how many depends on key and list, never a whole turn."""
    out = text
    for name, names in GIVEN.items():
        at = F.array_position(F.array(*map(F.lit, names)), text)
        by = F.pmod(F.xxhash64(F.lit(f"{key}|{name}")) + attempt, F.lit(len(names) - 1)) + 1
        new = F.array(*map(F.lit, names))[((at - 1 + by) % len(names)).cast("int")]
        out = F.when((kind == "given") & (at > 0), new).otherwise(out)
    return out


def surrogates(values: Column, key: str) -> Column:
    """Canonical surrogates of an array of structs (kind, text, attempt), text canonical."""
    # What stays in front, what is permuted, what stays behind.
    first = lambda x: (
        F.when(x.kind == "card", 1).when(x.kind == "iban", 4)
        .when(x.kind == "phone", F.instr(x.text, F.lit(":"))).otherwise(0)
    )
    last = lambda x: (
        F.when(x.kind == "card", 1)
        .when(x.kind == "email", F.length(F.element_at(F.split(x.text, r"\."), -1)) + 1)
        .otherwise(0)
    )
    body = lambda x: F.substr(x.text, first(x) + 1, F.length(x.text) - first(x) - last(x))
    # Country and length of an IBAN, suffix and first digit, are part of a value's format.
    named = F.transform(
        values,
        lambda x: F.struct(
            F.concat_ws("|", x.kind, F.left(x.text, first(x)), F.right(x.text, F.when(x.kind == "email", last(x)).otherwise(F.lit(0)))).alias("tag"),
            body(x).alias("text"), x.attempt.alias("attempt"),
        ),
    )
    zipped = F.arrays_zip(values.alias("v"), _feistel(named, key).alias("p"))

    def finished(z: Column) -> Column:
        x = z.v
        front = F.left(x.text, first(x))
        country = F.left(x.text, F.lit(2))
        check = F.lpad((98 - _mod97(F.concat(z.p, country, F.lit("00")))).cast("string"), 2, "0")
        short = F.concat(front, z.p)
        luhn = F.pmod(10 - _luhn(F.concat(short, F.lit("0"))) % 10, F.lit(10))
        return (
            F.when(x.kind == "card", F.concat(short, luhn.cast("string")))
            .when(x.kind == "iban", F.concat(country, check, z.p))
            .when(x.kind == "given", _given(x.kind, x.text, x.attempt, key))
            .when(x.kind == "email", F.concat(z.p, F.right(x.text, last(x))))
            .when(x.kind == "phone", short)
            .otherwise(z.p)
        )

    return F.transform(zipped, finished)


def _refilled(found: Column, text: Column) -> Column:
    """``found`` with its digits and capital letters replaced, one after the other, by ``text``."""
    return F.array_join(
        F.transform(
            F.split(found, ""),
            lambda c, i: F.when(
                c.rlike("[0-9A-Z]"),
                F.substr(text, F.length(F.regexp_replace(F.left(found, i + 1), "[^0-9A-Z]", "")), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )


def rendered(kind: Column, found: Column, text: Column) -> Column:
    """The canonical surrogate ``text`` in the format of ``found``."""
    shown = F.translate(text, HIDDEN, HEX)
    octet = lambda i: F.conv(F.substr(shown, F.lit(2 * i + 1), F.lit(2)), 16, 10)
    shaped = F.when(found == F.upper(found), F.upper(text)).otherwise(
        F.concat(F.upper(F.left(text, F.lit(1))), F.substr(text, F.lit(2)))
    )
    return (
        F.when(kind.isin(*_DIGITS_ONLY, "iban"), _refilled(found, F.replace(text, F.lit(":"), F.lit(""))))
        .when(kind == "ip", F.concat_ws(".", *map(octet, range(4))))
        .when(kind == "ipv6", shown)
        .when(kind == "surname", shaped)
        .otherwise(text)
    )


@dataclass(frozen=True)
class Columns:
    """Names for working columns that ``df`` does not have."""

    text: str
    found: str
    again: str
    pieces: str
    taken: str

    @classmethod
    def free(cls, columns: list[str], text: str) -> Columns:
        names: list[str] = []
        for name in ("pii_found", "pii_again", "pii_pieces", "pii_attempts"):
            names.append(free_name([*columns, *names], name))
        return cls(text, *names)


def _again(found: Column, bare_given: bool) -> Column:
    """ANY and, standing alone, the surnames among ``found`` in any case and, if ``bare_given``, the
    given names; null where there are none."""
    listed = F.array(*map(F.lit, [n for names in GIVEN.values() for n in names]))
    plain = F.transform(found, lambda f: F.regexp_replace(f, r"['’]s$|['’-]+$", ""))
    names = F.filter(F.array_distinct(plain), lambda f: f.rlike(r"^\p{Lu}[\p{L}'’-]+$"))
    # Longer names before those they begin with; the first alternative never matches.
    either = lambda names: F.array_join(
        F.concat(F.array(F.lit("(?!)")), F.reverse(F.array_sort(names))), "|"
    )

    def pattern(names: Column) -> Column:
        given = F.filter(names, lambda f: F.lit(bare_given) & F.array_contains(listed, f))
        others = F.filter(names, lambda f: ~F.array_contains(listed, f))
        return F.when(
            F.size(given) + F.size(others) > 0,
            F.concat(
                F.lit(ANY[:-1] + r"|(?=\p{Lu})(?:"), either(given), F.lit("|(?iu:"), either(others), F.lit(f")){_end})")
            ),
        )

    return F.transform(F.array(names), pattern)[0]


def detected(df: DataFrame, c: Columns, bare_given: bool = False) -> DataFrame:
    """``df`` with the matches of each text, and with its pieces, none for a text without matches.
    A text with names is searched once more, for other mentions of them."""
    text, found, again = F.col(c.text), F.col(c.found), F.col(c.again)
    first = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    all_of = F.when(again.isNull(), found).otherwise(F.regexp_extract_all(text, again, F.lit(0)))
    pieces = pieces_of(text, found, F.coalesce(again, F.lit(ANY)))
    return df.withColumn(c.found, F.coalesce(first, F.array().cast("array<string>"))).withColumn(
        c.again, F.when(F.size(c.found) > 0, _again(found, bare_given))
    ).withColumn(c.found, all_of).withColumn(
        c.pieces, F.when(F.size(c.found) > 0, pieces).otherwise(F.array().cast("array<struct<g:string,s:string,k:string>>"))
    )


def _values(pieces: Column, attempt: Callable[[Column, Column], Column]) -> Column:
    return F.transform(
        pieces,
        lambda z: F.struct(
            F.coalesce(z.k, F.lit("none")).alias("kind"),
            F.coalesce(canonical(z.k, z.s), F.lit("")).alias("text"),
            attempt(z.k, canonical(z.k, z.s)).alias("attempt"),
        ),
    )


def entities(df: DataFrame, key: str, text_col: str = "text", bare_given: bool = False) -> DataFrame:
    """Every distinct entity of the corpus: kind, text (canonical), attempt, surrogate; collisions
    are resolved. An entity that half the texts mention is one row per task before the shuffle."""
    c = Columns.free(df.columns, text_col)
    first = lambda k, t: F.lit(0)
    mentions = detected(df.select(text_col), c, bare_given).where(F.size(c.found) > 0)
    distinct = (
        mentions.select(F.explode(_values(F.col(c.pieces), first)).alias("e"))
        .select("e.kind", "e.text", "e.attempt").where("kind <> 'none'").distinct()
    )

    def with_surrogate(rows: DataFrame) -> DataFrame:
        one = F.array(F.struct("kind", "text", "attempt"))
        return rows.select("kind", "text", "attempt", surrogates(one, key)[0].alias("surrogate"))

    # Distinct entities grow with the texts at most.
    files = files_for(df.sparkSession, df.count())
    current = written(with_surrogate(distinct), "entities", files, dealt=True)
    while True:
        free = current.where("kind <> 'given'")
        # The least of the values that share a surrogate keeps it.
        shared = free.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.min("text").alias("keeps"))
        twice = free.join(shared.where("n > 1"), ["kind", "surrogate"]).where("text <> keeps").select("kind", "text")
        known = free.select("kind", F.col("text").alias("known"))
        real = free.join(
            known.withColumnRenamed("kind", "k"), (free.kind == F.col("k")) & (free.surrogate == F.col("known")), "left_semi"
        ).select("kind", "text")
        again = written(twice.unionByName(real).distinct(), "collisions", files)
        if again.isEmpty():
            return current
        marked = again.withColumn("again", F.lit(1))
        current = written(
            with_surrogate(
                current.join(marked, ["kind", "text"], "left").select(
                    "kind", "text", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")
                )
            ),
            "entities", files, dealt=True,
        )


def replaced(
    df: DataFrame, key: str, text_col: str = "text", count_col: str | None = None, bare_given: bool = False
) -> DataFrame:
    """``df`` with the entities of ``text_col`` replaced, all other columns as they are; their number
    goes to ``count_col`` if it is named. Texts without entities are not taken apart. ``bare_given``:
    given names of a text are replaced where they stand alone as well."""
    c = Columns.free([*df.columns, *([count_col] if count_col else [])], text_col)
    corpus = entities(df, key, text_col, bare_given)
    later = corpus.where("attempt > 0").select("kind", "text", "attempt")
    work = detected(df, c, bare_given)
    attempts: Callable[[Column, Column], Column] = lambda k, t: F.lit(0)
    if not later.isEmpty():
        digest, kept = free_name([*work.columns, c.taken], "pii_digest"), "pii_texts"
        work = work.withColumn(digest, F.sha2(F.col(text_col), 256))
        e = _values(F.col(c.pieces), attempts)
        holders = (
            work.select(digest, F.explode(e).alias("e")).select(digest, "e.kind", "e.text").distinct()
            .join(later, ["kind", "text"])
            .groupBy(digest).agg(
                F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "text"), "attempt"))).alias(c.taken)
            ).withColumnRenamed(digest, kept)
        )
        work = work.join(holders, work[digest] == holders[kept], "left")
        attempts = lambda k, t: F.coalesce(
            F.element_at(F.col(c.taken), F.concat_ws("|", k, t)), F.lit(0)
        )
    pieces = F.col(c.pieces)
    new = surrogates(_values(pieces, attempts), key)
    whole = F.zip_with(
        pieces, new, lambda x, s: F.when(x.k.isNull(), x.g).otherwise(F.concat(x.g, rendered(x.k, x.s, s)))
    )
    text = F.when(F.size(pieces) > 0, F.array_join(whole, "")).otherwise(F.col(text_col))
    out = work.withColumn(text_col, text)
    if count_col:
        out = out.withColumn(count_col, F.size(F.filter(pieces, lambda x: x.k.isNotNull())).cast("bigint"))
    names = [*df.columns, *([count_col] if count_col and count_col not in df.columns else [])]
    return out.select(*names)
