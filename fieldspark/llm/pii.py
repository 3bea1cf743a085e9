"""Format-preserving pseudonyms for personal data by keyed Feistel permutations.

Values are found by pattern, validated, and replaced by another value of the same format. Each kind
of value is permuted by a Feistel network on its own domain, keyed by a secret, so that the mapping
is one-to-one and equal values get equal pseudonyms in all documents, whatever their separators:

    card     13 to 19 digits that pass the Luhn check; the check digit is made anew
    phone    + and 8 to 15 digits in any groups, or 6 and 7 in a few layouts, or ten digits in the 3-3-4
             layout; the country code and a trunk zero in brackets stay
    id       3-2-4 digits of an identity number in use; its groups stay
    ip       four numbers up to 255: the 2^32 addresses
    date     a day from 1830 to 2129 as y-m-d, y/m/d, d.m.y, m/d/y, or d/m/y where m/d/y is no day; moves
             within its century
    email    letters and digits before the top-level domain, class by class
    secret   32 to 64 hexadecimal digits, letters all lower or all upper case, at least one of them a
             decimal digit; the case stays, and both spellings of a value are linked

Numbers go through a network on Z_a x Z_b with a * b values: 10^n digits as two halves, 2^16 x 2^16
addresses, 75 x 487 = 36,525 days of a century; so no step is ever repeated to stay inside a
format. Strings go through a network whose halves are the two halves of their characters, each
moved within its own alphabet. Round numbers are SHA-256 of key, kind, round and the other half.

Everything is built from DataFrame functions.

Defined cases: a NULL text stays NULL, an empty one empty; texts without personal data, and values
that fail validation (a wrong check digit, an octet over 255, a 31st of April), stay as they are.
Texts are searched whole in time linear in their length. Rows are never dropped, joined or merged,
and all other columns pass through, whatever their names and types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

# Between two digits of a phone number: nothing, one separator, or a bracket of a closed pair.
_GAP = r"(?:[ .-]?\((?=[0-9]{1,5}\))|(?<=\([0-9]{1,5})\)[ .-]?|[ .-])?"
# What ends a number of at least eight digits before a space: a value of another kind.
_ENDS = (
    r"(?! (?:[0-9]*[A-Za-z@/]|[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])"
    r"|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])))"
)
# A trunk zero, dialled only inside the country: +49 (0)30.
_TRUNK = r"(?:[ .-]?\(0\)[ .-]?)?"

# The patterns of personal data, in the order in which they are tried.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}+|[0-9A-F]{32,64}+)(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "date": r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])",
    # Plans of one length first, so that a number after them is left alone; then the longest run of whole
    # groups, 8 to 15 digits; then short numbers.
    "phone": rf"\+(?:(?:[17](?:{_GAP}[0-9]){{10}}|91{_TRUNK}(?:{_GAP}[0-9]){{10}}|3[34]{_TRUNK}(?:{_GAP}[0-9]){{9}})(?![0-9])"
             rf"|[0-9](?:{_GAP}[0-9]){{7}}(?:{_ENDS}{_GAP}[0-9]){{0,7}}(?![0-9])"
             r"|[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?|[0-9]{1,4}[ .-])?[0-9]{2,4}[ .-]?[0-9]{3,4}(?![0-9]))"
             r"|(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "id": r"(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])",
}
DATE_LAYOUTS = {
    r"^.{4}-": ("yyyy-MM-dd",),
    r"^.{4}/": ("yyyy/MM/dd",),
    r"^.{2}\.": ("dd.MM.yyyy",),
    r"^.{2}/": ("MM/dd/yyyy", "dd/MM/yyyy"),
}
# Country codes; no one begins another.
COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
ALPHABETS = {"[0-9]": "0123456789", "[a-z]": "abcdefghijklmnopqrstuvwxyz", "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
HEX = {"[0-9a-f]": "0123456789abcdef"}
# End of fixed values.

_ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
# A text without any of these characters in a row cannot hold a match; checked first, being cheap.
_HINT = r"@|[0-9]{2}|[0-9a-f]{32}|[0-9A-F]{32}|[0-9]\.|\+[0-9]"
_CENTURY, _FIRST_DAY = 36_525, -14_610  # days from 1930 to 2029; 1930-01-01 as days since 1970


def pseudonymise(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """All columns of ``docs``, with personal data of ``column`` replaced, and then ``n_replaced``.

    ``n_replaced`` counts the replaced values of the row; it is named ``n_replaced_`` (and so on)
    where that name is taken.
    """
    found, masked, count = (_unused(docs, name) for name in ("found", "masked", "n_replaced"))
    text = F.col(f"`{column}`")
    matches = F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)))
    hit = docs.withColumn(found, F.when(F.size(matches) > 0, matches))
    hit = hit.withColumn(masked, F.transform(found, lambda value: pseudonym(value, key)))
    pieces = F.zip_with(
        F.split(text, _ANY, -1), F.col(masked), lambda before, value: F.concat(before, F.coalesce(value, F.lit("")))
    )
    changed = F.filter(F.zip_with(found, masked, lambda old, new: old != new), lambda differs: differs)
    return hit.withColumns({
        column: F.when(F.col(found).isNull(), text).otherwise(F.array_join(pieces, "")),
        count: F.when(F.col(found).isNull(), 0).otherwise(F.size(changed)).cast("long"),
    }).drop(found, masked)


def _unused(docs: DataFrame, name: str) -> str:
    taken = {other.lower() for other in docs.columns}
    while name in taken:
        name += "_"
    return name


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a matched value, or the value itself where validation fails."""
    def is_kind(kind: str) -> Column:
        # The bounds around a value were checked where it was found.
        return value.rlike(rf"\A(?:{PATTERNS[kind]})\z")

    return (
        F.when(is_kind("email"), _email(value, key))
        .when(is_kind("secret"), F.when(value.rlike("[0-9]"), _secret(value, key)).otherwise(value))
        .when(is_kind("ip"), _ip(value, key))
        .when(is_kind("date"), _date(value, key))
        .when(is_kind("phone"), _phone(value, key))
        .when(is_kind("id"), _identity(value, key))
        .otherwise(_card(value, key))
    )


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute a value once for all its uses."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _round_number(key: str, kind: str, turn: Column, other: Column) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{key}|{kind}|"), turn.cast("string"), F.lit("|"), other.cast("string")).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _div(value: Column, by: Column) -> Column:
    return F.call_function("div", value, by)


def permuted(value: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """Keyed permutation of the integers below ``a * b``, as pairs (value div b, value mod b)."""
    def step(pair: Column, turn: Column) -> Column:
        on_left = F.pmod(pair["l"] + F.pmod(_round_number(key, kind, turn, pair["r"]), a), a)
        on_right = F.pmod(pair["r"] + F.pmod(_round_number(key, kind, turn, pair["l"]), b), b)
        even = turn % 2 == 0
        return F.struct(
            F.when(even, on_left).otherwise(pair["l"]).alias("l"), F.when(even, pair["r"]).otherwise(on_right).alias("r")
        )

    right = F.pmod(value, b)
    start = F.struct(_div(value, b).alias("l"), right.alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda pair: pair["l"] * b + pair["r"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """Permute a string of up to 18 digits; strings of each length among themselves."""
    size = F.length(digits)
    half = _div(size, F.lit(2))
    ten = F.lit(10.0)
    a, b = F.pow(ten, half).cast("long"), F.pow(ten, size - half).cast("long")
    number = permuted(digits.cast("long"), a, b, key, kind)
    return F.lpad(number.cast("string"), size, "0")


def _refilled(value: Column, digits: Column) -> Column:
    """The value with its digits, in order, replaced by others."""
    return _let(digits, lambda new: F.array_join(F.transform(F.split(value, ""), lambda char, at: _sign(value, new, char, at)), ""))


def _sign(value: Column, digits: Column, char: Column, at: Column) -> Column:
    earlier = F.length(_digits(F.substr(value, F.lit(1), at)))
    return F.when(char.rlike("[0-9]"), F.substr(digits, earlier + 1, F.lit(1))).otherwise(char)


def _card(value: Column, key: str) -> Column:
    def new_digits(digits: Column) -> Column:
        payload = _permuted_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
        check = F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: d.cast("string")),
            lambda d: F.call_function("luhn_check", F.concat(payload, d)),
        )
        return F.concat(payload, F.element_at(check, 1))

    valid = F.call_function("luhn_check", _digits(value))
    return F.when(valid, _refilled(value, _let(_digits(value), new_digits))).otherwise(value)


def _phone(value: Column, key: str) -> Column:
    # The country code, by the digits alone so that separators do not matter, and a trunk zero stay.
    digits = _digits(value)
    code = F.when(value.startswith("+"), F.regexp_extract(digits, COUNTRY, 0)).otherwise("")
    trunk = F.when(value.rlike(r"^\+[0-9]{1,3}[ .-]?\(0\)"), "0").otherwise("")
    kept = F.concat(code, trunk)
    rest = F.substr(digits, F.length(kept) + 1, F.lit(18))
    return _refilled(value, F.concat(kept, _permuted_digits(rest, key, "phone")))


def _identity(value: Column, key: str) -> Column:
    # In use: area 001 to 899 but 666, group 01 to 99, serial 0001 to 9999: 898 x (99 * 9999) numbers.
    digits = _digits(value)
    area, group, serial = (F.substr(digits, F.lit(i), F.lit(n)).cast("long") for i, n in ((1, 3), (4, 2), (6, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - (area > 666).cast("long")
    inner = F.lit(99 * 9_999).cast("long")
    number = permuted(place * inner + (group - 1) * 9_999 + serial - 1, F.lit(898).cast("long"), inner, key, "id")

    def written(n: Column) -> Column:
        first = _div(n, inner) + 1
        rest = F.pmod(n, inner)
        return F.concat_ws(
            "-", F.lpad((first + (first >= 666).cast("long")).cast("string"), 3, "0"),
            F.lpad((_div(rest, F.lit(9_999)) + 1).cast("string"), 2, "0"),
            F.lpad((F.pmod(rest, F.lit(9_999)) + 1).cast("string"), 4, "0"),
        )

    return F.when(valid, _let(number, written)).otherwise(value)


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda part: part.cast("long"))
    valid = F.forall(octets, lambda octet: octet <= 255)
    address = F.aggregate(octets, F.lit(0).cast("long"), lambda total, octet: total * 256 + octet)
    side = F.lit(1 << 16).cast("long")

    def written(n: Column) -> Column:
        return F.concat_ws(".", *[F.pmod(_div(n, F.lit(256**k)), F.lit(256)).cast("string") for k in (3, 2, 1, 0)])

    return F.when(valid, _let(permuted(address, side, side, key, "ip"), written)).otherwise(value)


def _date(value: Column, key: str) -> Column:
    def moved(layout: str) -> Column:
        days = F.unix_date(F.try_to_date(value, layout)).cast("long")
        place = F.pmod(days - _FIRST_DAY, F.lit(_CENTURY))
        new = days - place + permuted(place, F.lit(75).cast("long"), F.lit(487).cast("long"), key, "date")
        in_use = (days >= _FIRST_DAY - _CENTURY) & (days < _FIRST_DAY + 2 * _CENTURY)
        return F.when(in_use, F.date_format(F.date_from_unix_date(new.cast("int")), layout))

    result = value
    for shape, layouts in DATE_LAYOUTS.items():
        # The first layout in which the value is a day.
        result = F.when(value.rlike(shape), F.coalesce(*[moved(layout) for layout in layouts], value)).otherwise(result)
    return result


def _email(value: Column, key: str) -> Column:
    kept = F.regexp_extract(value, r"\.[A-Za-z]+$", 0)
    named = F.substr(value, F.lit(1), F.length(value) - F.length(kept))
    return F.concat(_string(named, ALPHABETS, key, "email"), kept)


def _secret(value: Column, key: str) -> Column:
    moved = _string(F.lower(value), HEX, key, "secret")
    return F.when(value.rlike("[A-F]"), F.upper(moved)).otherwise(moved)


def _string(value: Column, alphabets: dict[str, str], key: str, kind: str) -> Column:
    """Keyed permutation of strings that moves each character within its own alphabet."""
    def moved(chars: Column, other: Column, turn: Column) -> Column:
        digest = F.sha2(F.concat(F.lit(f"{key}|{kind}|"), turn.cast("string"), F.lit("|"), F.array_join(other, "")).cast("binary"), 256)

        def char_moved(char: Column, at: Column, stream: Column) -> Column:
            # Three digits of the digest for each place; long halves go through it again.
            number = F.conv(F.substr(stream, F.pmod(at * 3, F.lit(61)) + 1, F.lit(3)), 16, 10).cast("int")
            result = char
            for shape, alphabet in alphabets.items():
                place = F.pmod(F.instr(F.lit(alphabet), char) - 1 + number, F.lit(len(alphabet))) + 1
                result = F.when(char.rlike(shape), F.substr(F.lit(alphabet), place, F.lit(1))).otherwise(result)
            return result

        return _let(digest, lambda stream: F.transform(chars, lambda char, at: char_moved(char, at, stream)))

    def step(pair: Column, turn: Column) -> Column:
        return F.when(
            turn % 2 == 0, F.struct(moved(pair["l"], pair["r"], turn).alias("l"), pair["r"].alias("r"))
        ).otherwise(F.struct(pair["l"].alias("l"), moved(pair["r"], pair["l"], turn).alias("r")))

    chars, half = F.split(value, ""), _div(F.length(value), F.lit(2)).cast("int")
    start = F.struct(
        F.slice(chars, F.lit(1), half).alias("l"), F.slice(chars, half + 1, F.length(value)).alias("r")
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda pair: F.array_join(F.concat(pair["l"], pair["r"]), "")
    )
