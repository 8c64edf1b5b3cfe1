"""Personal data in texts with DataFrame functions only.

Regular expressions propose spans, validators (parts of an address, Luhn, mod 97, numbers of
digits) confirm them, and context words nearby raise the score. Patterns are written with
possessive quantifiers and bounded starts where this cannot change a match, so that a pass needs no
deep stack. Places are running sums of the lengths of the parts between matches, and context is taken
from these parts, so that the time follows the length of the text, also where it is full of matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in the order that breaks ties of equal starts; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]

LOCAL = "[A-Za-z0-9._%+-]"
# An address begins where a run of its characters begins, or where the previous match ended.
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # What follows each place where an account number may begin, as long as it may be; the places
    # take up no text, so that one number cannot hide the next.
    "iban": r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9]))",
}
# Characters of an account number by country; of others every length is taken.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 "
    "EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 "
    "KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 "
    "PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 "
    "VG24 XK20"
)
# A text without this cannot match.
NEEDS = {"email": "@", "phone": "+"}

SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8}
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|bank|account|transfer",
}
CONTEXT_CHARACTERS = 40

OPEN, CLOSE = "\u0001", "\u0002"


def _proposed(text: Column, kind: str) -> Column:
    """array<struct<start, value>> of the matches, in code points: each match is put between two
    marks, and the lengths between the marks give the places."""
    ahead = kind == "iban"  # the match is repeated before the text, not taken out of it
    pattern = PATTERNS[kind] if ahead else f"({PATTERNS[kind]})"
    marked = F.regexp_replace(text, pattern, f"{OPEN}$1{CLOSE}")
    if kind in NEEDS:
        marked = F.when(F.instr(text, NEEDS[kind]) > 0, marked).otherwise(text)

    def plain(part: Column) -> Column:
        """What a part holds of the text."""
        if ahead:
            return F.substring_index(part, CLOSE, -1)
        return F.replace(part, F.lit(CLOSE), F.lit(""))

    def end_of(part: Column) -> Column:
        return F.right(plain(part), F.lit(CONTEXT_CHARACTERS))

    def matches(parts: Column, ends: Column) -> Column:
        def match(part: Column, i: Column) -> Column:
            rest = F.substring_index(part, CLOSE, -1)
            earlier = F.coalesce(end_of(F.get(parts, i - 1)), F.lit(""))
            before = F.concat(earlier, end_of(F.get(parts, i)))
            return F.struct(
                F.get(ends, i).alias("start"),
                F.substring_index(part, CLOSE, 1).alias("value"),
                F.right(before, F.lit(CONTEXT_CHARACTERS)).alias("before"),
                F.left(rest, F.lit(CONTEXT_CHARACTERS)).alias("after"),
            )

        # The part before the first match is none itself.
        return F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), match)

    def placed(parts: Column) -> Column:
        ends = _running(F.transform(parts, lambda x: F.length(plain(x))), lambda x, y: x + y)
        return F.when(F.size(parts) > 1, _with(ends, lambda e: matches(parts, e)))

    none = F.array().cast("array<struct<start: int, value: string, before: string, after: string>>")
    return F.coalesce(_with(F.split(marked, OPEN), placed), none)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each element what all up to it add up to, in rounds of doubled distance: the state of an
    aggregate is copied at every step, so it must not take a step for each element."""
    rounds = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")

    def doubled(so_far: Column, n: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), n)
        return F.transform(
            so_far, lambda x, i: F.when(i < back, x).otherwise(add(x, F.get(so_far, i - back)))
        )

    return F.aggregate(F.sequence(F.lit(0), rounds), values, doubled)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    reverse = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(reverse, i, F.lit(1)).cast("int") * (2 - i % 2)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """Remainder of an account number: its first four characters at the end, letters as 10-35."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 65, (rest * 10 + c - 48) % 97).otherwise((rest * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add)


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _account(value: Column) -> Column:
    """The account number that the match begins with, or NULL: of all ends at a blank or at the end
    that pass mod 97 that of the length of the country, else the longest."""

    def bare(number: Column) -> Column:
        return F.replace(number, F.lit(" "), F.lit(""))

    words = F.split(value, " ")
    ends = F.transform(
        F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " ")
    )
    valid = F.filter(ends, lambda e: F.length(bare(e)).between(15, 34) & (mod97(e) == 1))
    fixed = F.filter(
        valid,
        lambda e: F.lit(IBAN_LENGTHS).contains(
            F.concat(F.substring(e, 1, 2), F.length(bare(e)).cast("string"))
        ),
    )
    return F.coalesce(F.get(fixed, F.lit(0)), F.try_element_at(valid, F.lit(-1)))


def _accounts(proposed: Column) -> Column:
    """The account numbers among the matches; what begins inside one is part of it.

    A match that begins past the ends of all before it is taken. One that does not depends on those
    from the last such match on, which is followed from there.
    """
    found = F.transform(
        proposed,
        lambda m: F.struct(
            m["start"].alias("start"),
            _account(m["value"]).alias("value"),
            m["before"].alias("before"),
            m["after"].alias("after"),
        ),
    )
    valid = F.filter(found, lambda m: m["value"].isNotNull())

    def end(m: Column) -> Column:
        return m["start"] + F.length(m["value"])

    def taken(all_: Column) -> Column:
        def apart(ends: Column) -> Column:
            heads = F.transform(
                all_,
                lambda m, i: F.when((i == 0) | (m["start"] >= F.get(ends, i - 1)), i).otherwise(0),
            )
            return _with(_running(heads, F.greatest), lambda h: followed(all_, h))

        return _with(_running(F.transform(all_, end), F.greatest), apart)

    def followed(all_: Column, heads: Column) -> Column:
        def first(m: Column, i: Column) -> Column:
            head = F.get(heads, i)
            reached = F.aggregate(
                F.slice(all_, head + 1, i - head),
                F.lit(0),
                lambda so_far, x: F.when(x["start"] >= so_far, end(x)).otherwise(so_far),
            )
            return m["start"] >= reached

        return F.filter(all_, first)

    return _with(valid, taken)


def _spans(text: Column, kind: str) -> Column:
    """The confirmed spans of one kind with their scores: context is looked for in the characters
    before a match, in itself, and in those after it as far as the next match of its kind."""

    def scored(m: Column) -> Column:
        end = m["start"] + F.length(m["value"])
        around = F.concat(m["before"], m["value"], m["after"])
        bonus = F.when(F.lower(around).rlike(rf"\b(?:{CONTEXT[kind]})"), 0.1).otherwise(0.0)
        return F.struct(
            m["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            end.alias("end"),
            (F.lit(SCORES[kind]) + bonus).alias("score"),
        )

    if kind == "iban":
        confirmed = _accounts(_proposed(text, kind))
    else:
        confirmed = F.filter(_proposed(text, kind), lambda m: _confirmed(kind, m["value"]))
    return F.transform(confirmed, scored)


def personal_data(df: DataFrame, text_column: str = "text", into: str = "pii_spans") -> DataFrame:
    """``df`` with its spans: array<struct<start, rank, kind, end, score>> in order.

    Start and end count code points, end exclusive; rank is the place of the kind in ``KINDS``;
    score is 0 to 1. NULL and empty texts have no spans. A column named ``into`` is replaced, all
    others and all rows stay as they are; no shuffle.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    # The marks must be ours; what stands in for them matches nothing either.
    has_marks = (F.instr(text, OPEN) > 0) | (F.instr(text, CLOSE) > 0)
    clean = F.when(has_marks, F.translate(text, OPEN + CLOSE, "\u0003\u0003")).otherwise(text)
    # Columns of their own, so that no expression is computed for each use.
    found = df.withColumn("_pii_text", clean).withColumns(
        {f"_pii_{kind}": _spans(F.col("_pii_text"), kind) for kind in KINDS}
    )
    joined = F.array_sort(F.concat(*[F.col(f"_pii_{kind}") for kind in KINDS]))
    return found.withColumn(into, joined).drop("_pii_text", *[f"_pii_{kind}" for kind in KINDS])


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
