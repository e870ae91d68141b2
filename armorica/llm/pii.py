"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Values are found by pattern, validated by their own rule (check digits, ranges,
calendar), and permuted within their format: a card number becomes another number of
the same layout whose check digit is right, a date another date. The permutation
depends on the key and the kind only, so equal values stay equal across documents.
Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armorica.llm.common import named

ROUNDS = 8
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
DIGITS = "0123456789"

# Each starts where no longer run of its characters begins, so no text is scanned twice.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])"
# Characters of an IBAN by country: those of the registry, then countries that use the format without being in it.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST AO CV GW MZ",
    26: "IS TR DZ IR", 27: "BI DJ FR GR IT MC MR SM CF CG CM GA GQ KM MG TD", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV BF BJ CI MA ML NE SN TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_of(size: int, countries: str) -> str:
    groups, rest = divmod(size - 4, 4)
    last = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{last}"


IBAN = rf"(?<![A-Za-z0-9])(?:{'|'.join(_iban_of(*each) for each in IBAN_COUNTRIES.items())})(?![A-Za-z0-9])"
DATE = r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})(?![0-9/-])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9(])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
ADDRESS = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"

# Dates keep to their span of 73,000 days: 365 x 200, counted from the first day.
FIRST_DAY = "1900-01-01"
DATE_SIDES = (365, 200)


def _number(text: Column, most_digits: int = 15) -> Column:
    return F.substring(text, 1, most_digits).try_cast("bigint")


def _digest(key: Column, kind: str, step: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, F.lit(kind), step.cast("string"), half.cast("string")), 512)


def permute_number(value: Column, sides: tuple[int, int], key: Column, kind: str) -> Column:
    """Permutation of 0 ... a * b - 1, by turns on value / b and value % b."""
    a, b = sides

    def step(pair: Column, turn: Column) -> Column:
        left, right = pair["left"], pair["right"]

        def moved(side: Column, other: Column, size: int) -> Column:
            noise = F.conv(F.substring(_digest(key, kind, turn, other), 1, 15), 16, 10).cast("bigint")
            return (side + noise % size) % size

        even = turn % 2 == 0
        return F.struct(
            F.when(even, moved(left, right, a)).otherwise(left).alias("left"),
            F.when(even, right).otherwise(moved(right, left, b)).alias("right"),
        )

    start = F.struct(F.floor(value / b).cast("bigint").alias("left"), (value % b).cast("bigint").alias("right"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda pair: pair["left"] * b + pair["right"])


def permute_text(text: Column, key: Column, kind: str) -> Column:
    """Permutation of texts of one format: every letter and digit moves within its own alphabet, other characters stay.

    A half takes 32 characters of the digest at a time; beyond, they repeat.
    """

    def shifted(half: Column, digest: Column) -> Column:
        def move(letter: Column, at: Column) -> Column:
            noise = F.conv(F.substring(digest, (at % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")

            def within(alphabet: str) -> Column:
                place = (F.position(letter, F.lit(alphabet)) - 1 + noise) % len(alphabet)
                return F.substring(F.lit(alphabet), place + 1, F.lit(1))

            return (
                F.when(letter.rlike("^[0-9]$"), within(DIGITS))
                .when(letter.rlike("^[a-z]$"), within(LOWER))
                .when(letter.rlike("^[A-Z]$"), within(UPPER))
                .otherwise(letter)
            )

        return F.array_join(F.transform(F.filter(F.split(half, ""), lambda x: x != ""), move), "")

    def step(pair: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        left, right = pair["left"], pair["right"]
        return F.struct(
            F.when(even, shifted(left, _digest(key, kind, turn, right))).otherwise(left).alias("left"),
            F.when(even, right).otherwise(shifted(right, _digest(key, kind, turn, left))).alias("right"),
        )

    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("left"), F.substring(text, half + 1, F.length(text)).alias("right"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda pair: F.concat(pair["left"], pair["right"])
    )


def _plain(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9A-Za-z]", "")


def _laid_out(plain: Column, layout: Column) -> Column:
    """Letters and digits of ``plain`` in the places of those of ``layout``."""
    marks = F.filter(F.split(layout, ""), lambda x: x != "")

    def put(state: Column, mark: Column) -> Column:
        is_place = mark.rlike("^[0-9A-Za-z]$")
        return F.struct(
            F.concat(state["text"], F.when(is_place, F.substring(plain, state["at"], F.lit(1))).otherwise(mark)).alias("text"),
            (state["at"] + F.when(is_place, 1).otherwise(0)).alias("at"),
        )

    return F.aggregate(marks, F.struct(F.lit("").alias("text"), F.lit(1).alias("at")), put, lambda state: state["text"])


def _luhn(digits: Column) -> Column:
    """Luhn sum; the last digit counts once, the one before twice."""
    each = F.filter(F.split(F.reverse(digits), ""), lambda x: x != "")

    def value(digit: Column, at: Column) -> Column:
        number = digit.cast("int") * (at % 2 + 1)
        return number - F.when(number > 9, 9).otherwise(0)

    return F.aggregate(F.transform(each, value), F.lit(0), lambda total, x: total + x)


def _mod97(text: Column) -> Column:
    """Remainder of a number in which A is 10 ... Z is 35."""
    marks = F.filter(F.split(text, ""), lambda x: x != "")

    def add(rest: Column, mark: Column) -> Column:
        value = F.position(mark, F.lit(DIGITS + UPPER)) - 1
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(marks, F.lit(0), add)


def _iban_digits(rest: Column, country: Column) -> Column:
    return F.lpad((F.lit(98) - _mod97(F.concat(rest, country, F.lit("00")))).cast("string"), 2, "0")


def _email(value: Column, key: Column) -> Column:
    name = F.regexp_extract(value, r"^(.*)(\.[A-Za-z]+)$", 1)
    return F.concat(permute_text(name, key, "email"), F.regexp_extract(value, r"^(.*)(\.[A-Za-z]+)$", 2))


def _iban(value: Column, key: Column) -> Column:
    plain = _plain(value)
    country, rest = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    moved = permute_text(rest, key, "iban")
    return _laid_out(F.concat(country, _iban_digits(moved, country), moved), value)


def _iban_valid(value: Column) -> Column:
    plain = _plain(value)
    return _mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1


def _day(value: Column) -> Column:
    """Day number of an ISO date, or of day and month (else month and day) before the year."""
    parts = F.regexp_replace(value, "[./]", "-")
    return F.when(value.rlike("^[0-9]{4}"), F.try_to_date(parts, "yyyy-MM-dd")).otherwise(
        F.coalesce(F.try_to_date(parts, "dd-MM-yyyy"), F.try_to_date(parts, "MM-dd-yyyy"))
    )


def _date(value: Column, key: Column) -> Column:
    size = DATE_SIDES[0] * DATE_SIDES[1]
    first = F.lit(FIRST_DAY).cast("date")
    days = F.datediff(_day(value), first).cast("bigint")
    span = F.floor(days / size).cast("bigint")
    moved = F.date_add(first, (span * size + permute_number(days - span * size, DATE_SIDES, key, "date")).cast("int"))
    separator = F.substring(value, 3, 1)
    day_first = F.try_to_date(F.regexp_replace(value, "[./]", "-"), "dd-MM-yyyy").isNotNull()
    return (
        F.when(value.rlike("^[0-9]{4}"), F.date_format(moved, "yyyy-MM-dd"))
        .when(day_first, F.replace(F.date_format(moved, "dd-MM-yyyy"), F.lit("-"), separator))
        .otherwise(F.replace(F.date_format(moved, "MM-dd-yyyy"), F.lit("-"), separator))
    )


def _date_valid(value: Column) -> Column:
    """A day of the calendar, in the spans before and after 1900."""
    size = DATE_SIDES[0] * DATE_SIDES[1]
    return F.datediff(_day(value), F.lit(FIRST_DAY).cast("date")).between(-size, 2 * size - 1)


def _ssn_parts(value: Column) -> tuple[Column, Column, Column]:
    return _number(F.substring(value, 1, 3)), _number(F.substring(value, 5, 2)), _number(F.substring(value, 8, 4))


def _ssn(value: Column, key: Column) -> Column:
    area, group, serial = _ssn_parts(value)
    # Areas 1 to 899 without 666; groups 1 to 99; serials 1 to 9999.
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    moved = permute_number((place * 99 + group - 1) * 9999 + serial - 1, (898, 99 * 9999), key, "ssn")
    place = F.floor(moved / (99 * 9999))
    area = place + 1 + F.when(place >= 665, 1).otherwise(0)
    group, serial = F.floor(moved / 9999) % 99 + 1, moved % 9999 + 1
    return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in ((area, 3), (group, 2), (serial, 4))])


def _ssn_valid(value: Column) -> Column:
    area, group, serial = _ssn_parts(value)
    return area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)


def _phone_digits(value: Column) -> Column:
    return F.substring(_plain(value), -10, 10)


def _phone(value: Column, key: Column) -> Column:
    plain, digits = _plain(value), _phone_digits(value)
    moved = permute_number(_number(digits), (100_000, 100_000), key, "phone")
    prefix = F.substring(plain, F.lit(1), F.length(plain) - 10)
    return _laid_out(F.concat(prefix, F.lpad(moved.cast("string"), 10, "0")), value)


def _address(value: Column, key: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda x: x.try_cast("bigint"))
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, x: total * 256 + x)
    moved = permute_number(number, (65536, 65536), key, "address")
    return F.concat_ws(".", *[(F.floor(moved / 256**n) % 256).cast("string") for n in (3, 2, 1, 0)])


def _address_valid(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda x: x.try_cast("int") < 256)


def _card(value: Column, key: Column) -> Column:
    digits = _plain(value)
    payload = F.concat(
        F.substring(digits, 1, 1), permute_text(F.substring(digits, F.lit(2), F.length(digits) - 2), key, "card")
    )
    check = (F.lit(10) - _luhn(F.concat(payload, F.lit("0"))) % 10) % 10
    return _laid_out(F.concat(payload, check.cast("string")), value)


def _card_valid(value: Column) -> Column:
    digits = _plain(value)
    return (_luhn(digits) % 10 == 0) & ~digits.rlike("^0")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: Callable[[Column], Column]
    pseudonym: Callable[[Column, Column], Column]


# In this order where two patterns fit the same place.
KINDS = (
    Kind("email", EMAIL, lambda value: F.lit(True), _email),
    Kind("iban", IBAN, _iban_valid, _iban),
    Kind("date", DATE, _date_valid, _date),
    Kind("ssn", SSN, _ssn_valid, _ssn),
    Kind("phone", PHONE, lambda value: F.lit(True), _phone),
    Kind("address", ADDRESS, _address_valid, _address),
    Kind("card", CARD, _card_valid, _card),
)
ANY = "|".join(f"(?:{kind.pattern})" for kind in KINDS)
# Without one of these no pattern fits.
HINT = "[@0-9]"


def _kind(value: Column) -> Column:
    """First kind whose whole pattern and rule a found value meets, or null."""
    which = F.when(F.lit(False), F.lit(""))
    for kind in KINDS:
        whole = value.rlike(f"^(?:{kind.pattern})$")
        which = which.when(F.when(whole, F.coalesce(kind.valid(value), F.lit(False))).otherwise(False), kind.name)
    return which


def _pseudonym(value: Column, which: Column, key: Column) -> Column:
    changed = F.when(which.isNull(), value)
    for kind in KINDS:
        changed = changed.when(which == kind.name, kind.pseudonym(value, key))
    return changed


def pseudonymise(
    docs: DataFrame, key: str, text_col: str = "text", out_col: str = "pseudonymised", counts_col: str = "found"
) -> DataFrame:
    """All rows and columns, the text with pseudonyms in ``out_col`` and the number of values replaced in ``counts_col``.

    ``key`` is secret: whoever has it can undo the permutations. It is read from a table
    of one row, so plans and event logs show no more than a subquery. Null text stays null
    (nothing found); a text without valid values is unchanged, to the letter. Repeated
    rows get equal results. An empty table gives no rows. Existing columns of the two
    new names are replaced.
    """
    text = named(text_col)
    taken = {name.lower() for name in (*docs.columns, out_col, counts_col)}
    # Names of working columns that no other has.
    values_col, rebuilt_col, secret_col = (
        name + "_" * next(n for n in range(len(taken) + 1) if name + "_" * n not in taken) for name in ("_values", "_rebuilt", "_secret")
    )
    # A lambda cannot hold a subquery: the secret is a column first.
    secret = F.col(secret_col)
    one_row = docs.sparkSession.createDataFrame(pa.table({"key": [key]}))

    def found(value: Column) -> Column:
        return F.struct(value.alias("value"), _kind(value).alias("kind"))

    # What fails its rule hides nothing: values are looked for at every place, also within others.
    all_values = F.regexp_extract_all(text, F.lit(f"(?=({ANY}))"), F.lit(1))
    values = F.when(text.rlike(HINT) & text.rlike(ANY), F.transform(all_values, found))
    hits = docs.withColumn(values_col, values).withColumn(secret_col, one_row.scalar())
    some = F.exists(values_col, lambda x: x["kind"].isNotNull())
    # A piece begins with each value, and one before the first.
    pieces = F.split(text, f"(?={ANY})", -1)
    pieces = F.when(F.size(pieces) > F.size(values_col), pieces).otherwise(F.concat(F.array(F.lit("")), pieces))
    new = F.transform(
        values_col, lambda x: F.struct(F.length(x["value"]).alias("length"), _pseudonym(x["value"], x["kind"], secret).alias("text"), x["kind"].alias("kind"))
    )
    steps = F.zip_with(F.slice(pieces, F.lit(2), F.size(values_col)), new, lambda piece, value: F.struct(piece.alias("piece"), value.alias("value")))

    def put(state: Column, step: Column) -> Column:
        piece, value = step["piece"], step["value"]
        # A value that begins within a replaced one is not looked at.
        replaced = (state["left"] == 0) & value["kind"].isNotNull()
        left = F.when(replaced, value["length"]).otherwise(state["left"])
        return F.struct(
            F.concat(
                state["parts"], F.array(F.concat(F.when(replaced, value["text"]).otherwise(""), F.substring(piece, left + 1, F.length(piece))))
            ).alias("parts"),
            F.greatest(F.lit(0), left - F.length(piece)).alias("left"),
            (state["found"] + F.when(replaced, 1).otherwise(0)).alias("found"),
        )

    start = F.struct(F.array(F.get(pieces, F.lit(0))).alias("parts"), F.lit(0).alias("left"), F.lit(0).alias("found"))
    rebuilt = F.aggregate(steps, start, put, lambda state: F.struct(F.array_join(state["parts"], "").alias("text"), state["found"].alias("found")))
    changed = hits.withColumn(rebuilt_col, F.when(some, rebuilt))
    changed = changed.withColumn(out_col, F.when(F.col(rebuilt_col).isNull(), text).otherwise(F.col(rebuilt_col)["text"]))
    return changed.withColumn(counts_col, F.coalesce(F.col(rebuilt_col)["found"], F.lit(0))).drop(values_col, rebuilt_col, secret_col)
