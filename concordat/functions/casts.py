"""Lenient conversions: a value that does not parse becomes NULL, never an error."""

from __future__ import annotations

import re
import unicodedata
import uuid as _uuid

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.types import DECIMAL, is_number, is_text, is_timestamp

# The date templates sources use, tried in this order.
DATE_FORMATS = (
    'YYYY-MM-DD"T"HH24:mi:ss.SSS',
    "YYYY/MM/DD HH24:mi:ss.SSS",
    "DD/MM/YYYY HH24:mi:ss.SSS",
)

# Words read as true, after trimming and lower-casing.
TRUE_WORDS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1", "oui")
FALSE_WORDS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0", "non")

_DATE_FIELDS = ("YYYY", "YY", "MM", "DD")
_TOKEN = re.compile(r'"[^"]*"|YYYY|YY|MM|DD|HH24|HH|MI|SS|MS|US|S+|.', re.IGNORECASE)
# Any prefix of a clock time, after either separator, with or without a zone.
_ZONE = r"(Z|[+-]\d{2}(:?\d{2})?)"
_CLOCK_SHAPE = rf"([T ]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{{1,9}})?)?{_ZONE}?)?"
# A day or month of one digit, between separators.
_SHORT_FIELD = r"(^|[-/])(\d)(?=[-/T ]|$)"
_INTEGER_SHAPE = r"^[+-]?\d+$"
_NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _date_part(template: str) -> list[str]:
    """Tokens of a template up to its last date field, without the quotes of literals."""
    tokens = _TOKEN.findall(template)
    last = max((i for i, t in enumerate(tokens) if t.upper() in _DATE_FIELDS), default=-1)
    if last < 0:
        raise ValueError(f"no date field in template {template!r}")
    return [t.strip('"') for t in tokens[: last + 1]]


def date_shape(template: str) -> str:
    """Regular expression of text in a template's format.

    The part up to the last date field is as written; whatever clock part the template names is
    optional, so ``2021-01-02`` and ``2021-01-02T10:00`` both match.
    """
    head = [
        rf"\d{{{len(token)}}}" if token.upper() in _DATE_FIELDS else re.escape(token)
        for token in _date_part(template)
    ]
    return "^" + "".join(head) + _CLOCK_SHAPE + "$"


def _iso_date(text: Column, template: str) -> tuple[Column, int]:
    """Year, month and day in ISO order, taken from their fixed places, and the length read."""
    found, place = {}, 1
    for token in _date_part(template):
        if token.upper() in _DATE_FIELDS:
            found[token.upper()] = F.substring(text, place, len(token))
        place += len(token)
    year = found.get("YYYY")
    if year is None:
        short = found.get("YY", F.lit("70"))
        year = F.concat(F.when(short < "70", "20").otherwise("19"), short)
    first = F.lit("01")
    return F.concat_ws("-", year, found.get("MM", first), found.get("DD", first)), place - 1


def blank_to_null(c: Column) -> Column:
    return F.when(F.length(F.trim(c)) > 0, c)


def _padded(c: Column) -> Column:
    """Trimmed text whose days and months have two digits."""
    return F.regexp_replace(F.trim(c.cast("string")), _SHORT_FIELD, "$10$2")


def to_timestamp(c: Column, formats=DATE_FORMATS) -> Column:
    """First format that fits, as a stamp without a zone; a zone in the text is passed over."""
    text = _padded(c)
    tries = []
    for f in formats:
        iso, length = _iso_date(text, f)
        clock = F.regexp_replace(F.substr(text, F.lit(length + 1)), rf"{_ZONE}$", "")
        # A cast is tried on text of the right shape only, because a failed one costs an exception.
        tries.append(F.when(text.rlike(date_shape(f)), F.concat(iso, clock).try_cast("timestamp_ntz")))
    return F.coalesce(*tries)


def to_date(c: Column, formats=DATE_FORMATS) -> Column:
    text = _padded(c)
    tries = [F.when(text.rlike(date_shape(f)), _iso_date(text, f)[0].try_cast("date")) for f in formats]
    return F.coalesce(*tries)


def to_number(c: Column, target: T.DataType) -> Column:
    """As with dates, text that is no number is told by its shape and not by an exception."""
    text = F.trim(c.cast("string"))
    shape = _INTEGER_SHAPE if isinstance(target, T.IntegralType) else _NUMBER_SHAPE
    return F.when(text.rlike(shape), text.try_cast(target))


def to_numeric(c: Column) -> Column:
    return to_number(c, DECIMAL)


to_decimal = to_numeric


def to_integer(c: Column) -> Column:
    return to_number(c, T.IntegerType())


def to_boolean(c: Column, strict: bool = False) -> Column:
    """Known true words are true and any other text is false; ``strict`` makes unknown text NULL."""
    word = F.lower(F.trim(c))
    known_true = F.when(c.isNull(), F.lit(None).cast("boolean")).when(word.isin(*TRUE_WORDS), True)
    if strict:
        return known_true.when(word.isin(*FALSE_WORDS), False)
    return known_true.otherwise(False)


def number_to_boolean(c: Column) -> Column:
    return c != 0


def to_text(c: Column) -> Column:
    """Blank becomes NULL; anything else is kept untrimmed."""
    return blank_to_null(c.cast("string"))


def _accents() -> dict[str, str]:
    """Accented Latin letters and their plain letter, by canonical decomposition."""
    letters = (chr(i) for i in range(0xC0, 0x180))
    return {c: d[0] for c in letters if len(d := unicodedata.normalize("NFD", c)) > 1}


def fold_text(c: Column) -> Column:
    """Upper case without accents, for comparing names."""
    table = _accents()
    plain = F.translate(c, "".join(table), "".join(table.values()))
    for letter, spelled in (("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("Æ", "AE"), ("ß", "ss")):
        plain = F.replace(plain, F.lit(letter), F.lit(spelled))
    return F.upper(plain)


def lenient(
    c: Column,
    source: T.DataType,
    target: T.DataType,
    formats=DATE_FORMATS,
    strict_boolean: bool = False,
) -> Column:
    """Convert ``c`` of type ``source`` to ``target``, giving NULL where it does not fit."""
    if isinstance(target, T.DateType):
        if isinstance(source, T.DateType) or is_timestamp(source):
            return c.cast("date")
        return to_date(c, formats)
    if is_timestamp(target):
        if isinstance(source, T.DateType) or is_timestamp(source):
            return c.cast(target)
        return to_timestamp(c, formats).cast(target)
    if isinstance(target, T.BooleanType):
        if isinstance(source, T.BooleanType):
            return c
        return number_to_boolean(c) if is_number(source) else to_boolean(c, strict_boolean)
    if is_number(target):
        if is_number(source):
            return c if source == target else c.try_cast(target)
        return to_number(c, target)
    if is_text(target):
        return c if is_text(source) else c.cast("string")
    return c if source == target else c.cast("string").try_cast(target)


def uuid_v5(namespace: _uuid.UUID, c: Column) -> Column:
    """Name-based UUID (RFC 4122 version 5) of a text column, as the canonical 36 characters."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(c, "UTF-8")))
    # The variant nibble keeps its two low bits under the fixed high bits 10.
    variant = F.element_at(
        F.array(*[F.lit(v) for v in "89ab"]),
        (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1,
    )
    dash = F.lit("-")
    # concat, unlike concat_ws, keeps a NULL name NULL.
    return F.concat(
        F.substring(digest, 1, 8), dash,
        F.substring(digest, 9, 4), dash,
        F.lit("5"), F.substring(digest, 14, 3), dash,
        variant, F.substring(digest, 18, 3), dash,
        F.substring(digest, 21, 12),
    )


def namespace_uuid(name: str) -> _uuid.UUID:
    """Namespace of a named data model, itself derived from the DNS namespace."""
    return _uuid.uuid5(_uuid.NAMESPACE_DNS, name)
