r"""Delimited text with nested values, as Column expressions.

A value of a nested type is flattened by separator level: fields of a row by the first separator, items of an
array, entries of a map and fields of a struct by the second, the next level down by the third, and so on.
NULL is written ``\N``. Everything here is built-in expressions, so parsing and formatting stay in the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.text import quoted

# NULL marker, and the separators of the levels below the three a caller names.
NULL_TEXT = r"\N"
# Our own code of an empty collection in escaped text.
EMPTY_TEXT = r"\E"
DEEPER_LEVELS = ("\x04", "\x05", "\x06", "\x07", "\x08")

# Accepted text of a whole number (a fraction is cut off), a date, and a timestamp.
WHOLE_NUMBER_TEXT = r"^([+-]?[0-9]+)(\.[0-9]*)?\z"
DATE_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
TIMESTAMP_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,9})?\z"

# Characters that the text of a non-string value may hold.
PLAIN_VALUE_TEXT = set("0123456789+-.:eE NaInfitytruefals")

# One above the largest number of each narrow type; signs and digits that always fit a bigint.
WHOLE_NUMBER_BOUNDS = {T.ByteType: 1 << 7, T.ShortType: 1 << 15, T.IntegerType: 1 << 31}
SAFE_LENGTH = 18

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEXT = (T.StringType, T.VarcharType, T.CharType, T.BinaryType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


@dataclass(frozen=True)
class Separators:
    """Separators by level; ``\\t`` and octal ``\\001`` spellings are taken as the character they name.

    ``escaped`` makes strings safe: separators, line breaks and backslashes inside them are written as
    backslash codes and decoded on the way back.
    """

    sep: str = "\t"
    csep: str = ","
    ksep: str = ":"
    escaped: bool = False

    def __post_init__(self) -> None:
        taken = set("\\nrN01234567")
        if self.escaped and any(len(s) > 1 or s in taken for s in self.levels):
            raise ValueError("escaped text needs one-character separators that no escape code uses")

    @property
    def levels(self) -> tuple[str, ...]:
        return tuple(_spelled(s) for s in (self.sep, self.csep, self.ksep)) + DEEPER_LEVELS

    def null(self, level: int) -> str:
        """The text of NULL. In escaped text the depth is part of it, so an array of one NULL is not a NULL array."""
        return f"{NULL_TEXT}{level}" if self.escaped and level > 1 else NULL_TEXT

    def empty(self, level: int) -> str:
        """The text of an empty collection. In escaped text it isn't that of one empty item."""
        return f"{EMPTY_TEXT}{level}" if self.escaped else ""

    def at(self, level: int) -> str:
        if level >= len(self.levels):
            raise ValueError(f"values may be nested {len(self.levels)} levels deep at most")
        return self.levels[level]


def _spelled(sep: str) -> str:
    if not sep:
        raise ValueError("a separator must not be empty")
    if sep == r"\t":
        return "\t"
    octal = re.fullmatch(r"\\([0-7]{3})", sep)
    return chr(int(octal[1], 8)) if octal else sep


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once for a body that names it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- text -> value ------------------------------------------------------------------------------


def split_row(line: Column | str, seps: Separators) -> Column:
    return F.split(line, quoted(seps.at(0)), -1)


def parse_steps(schema: T.StructType, seps: Separators) -> list[list[Column]]:
    """Columns of consecutive projections from the array ``fields`` to the typed columns of ``schema``.

    In steps no intermediate result is spelled twice, which keeps the generated code of a row small.
    """
    names = [f"c{i}" for i in range(len(schema))]
    typed = list(zip([F.col(n) for n in names], [f.dataType for f in schema], strict=True))
    pieces = [F.get("fields", F.lit(i)) for i in range(len(schema))]
    return [
        _step([_first_text(p, t, seps) for p, (_, t) in zip(pieces, typed, strict=True)], names),
        _step([_second_value(c, t, seps) for c, t in typed], names),
        _step([_narrowed(c, t) if isinstance(t, _WHOLE) else c for c, t in typed], schema.names),
    ]


def _first_text(text: Column, dtype: T.DataType, seps: Separators) -> Column:
    if isinstance(dtype, T.StructType):
        return _struct_parts(F.when(text != seps.null(1), text), seps, 1)
    return _digits(text) if isinstance(dtype, _WHOLE) else text


def _second_value(piece: Column, dtype: T.DataType, seps: Separators) -> Column:
    if isinstance(dtype, T.StructType):
        return F.when(piece.isNotNull(), _struct_of(piece, dtype, seps, 1))
    return _whole_number(piece) if isinstance(dtype, _WHOLE) else parse_value(piece, dtype, seps, 1)


def _step(columns: list[Column], names: list[str]) -> list[Column]:
    return [c.alias(n) for c, n in zip(columns, names, strict=True)]


def parse_value(text: Column, dtype: T.DataType, seps: Separators, level: int) -> Column:
    """The typed value of a piece of text; NULL where the text does not spell one."""
    if isinstance(dtype, _TEXT + _NESTED):
        text = F.when(text != seps.null(level), text)  # no other type reads the marker as a value
    if isinstance(dtype, T.ArrayType):
        parts = _split_nonempty(text, seps, level)
        if isinstance(dtype.elementType, _WHOLE) and not _needs_codes(dtype.elementType, seps, level + 1):
            # In steps over the whole array, as for columns: no text is named twice within a step.
            numbers = F.transform(F.transform(parts, _digits), _whole_number)
            if isinstance(dtype.elementType, T.LongType):
                return numbers
            return F.transform(numbers, lambda n: _narrowed(n, dtype.elementType))
        return F.transform(parts, lambda x: parse_value(x, dtype.elementType, seps, level + 1))
    if isinstance(dtype, T.MapType):
        return _parse_map(text, dtype, seps, level)
    if isinstance(dtype, T.StructType):
        struct = _let(_struct_parts(text, seps, level), lambda parts: _struct_of(parts, dtype, seps, level))
        return F.when(text.isNotNull(), struct)
    return parse_scalar(_decoded(text, dtype, seps, level), dtype)


def _struct_parts(text: Column, seps: Separators, level: int) -> Column:
    return F.split(text, quoted(seps.at(level)), -1)


def _struct_of(parts: Column, dtype: T.StructType, seps: Separators, level: int) -> Column:
    values = [parse_value(F.get(parts, F.lit(i)), f.dataType, seps, level + 1) for i, f in enumerate(dtype)]
    return F.struct(*[v.alias(n) for v, n in zip(values, dtype.names, strict=True)])


def parse_scalar(text: Column, dtype: T.DataType) -> Column:
    """Casts guarded so that they accept exactly the spellings the text format accepts."""
    if isinstance(dtype, _WHOLE):
        return _let(_digits(text), lambda d: _let(_whole_number(d), lambda n: _narrowed(n, dtype)))
    if isinstance(dtype, T.BooleanType):
        word = F.lower(text)
        return F.when(word == "true", True).when(word == "false", False)
    if isinstance(dtype, T.DecimalType):
        return F.when(_no_outer_blanks(text) & (text != NULL_TEXT), text.try_cast(dtype))
    if isinstance(dtype, T.DateType):
        return F.when(text.rlike(DATE_TEXT), text.try_cast(dtype))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.when(text.rlike(TIMESTAMP_TEXT), text.try_cast(dtype))
    if isinstance(dtype, T.BinaryType):
        return F.coalesce(F.try_to_binary(text, F.lit("base64")), F.encode(text, "UTF-8"))
    if isinstance(dtype, T.VarcharType):
        return F.substring(text, 1, dtype.length)
    if isinstance(dtype, T.CharType):
        return F.rpad(F.substring(text, 1, dtype.length), dtype.length, " ")
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when((text != NULL_TEXT) & (text != ""), text.try_cast(dtype))
    raise TypeError(f"type {dtype.simpleString()} cannot be read from delimited text")


# Casts that fail cost an exception per value, so the steps below sort out by comparison what cannot fit.


def _digits(text: Column) -> Column:
    """Sign and digits of a whole number without the fraction, empty if the text is none."""
    return F.regexp_extract(text, WHOLE_NUMBER_TEXT, 1)


def _whole_number(digits: Column) -> Column:
    length = F.length(digits)
    short = F.when(length.between(1, SAFE_LENGTH), digits.cast("bigint"))
    return short.when(length > SAFE_LENGTH, digits.try_cast("bigint"))


def _narrowed(number: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.LongType):
        return number
    bound = WHOLE_NUMBER_BOUNDS[type(dtype)]
    return F.when(number.between(-bound, bound - 1), number.cast(dtype))


def _no_outer_blanks(text: Column) -> Column:
    # A cast trims blanks and control characters, the text format does not accept them.
    last = F.substring(text, -1, 1)
    return (F.substring(text, 1, 1) > " ") & (last >= "!") & (last <= "~")


def _split_nonempty(text: Column, seps: Separators, level: int) -> Column:
    """Empty text is an empty collection, not a collection of one empty item; escaped text has a code for it."""
    empty = F.array().cast("array<string>")
    return F.when(text == seps.empty(level), empty).otherwise(F.split(text, quoted(seps.at(level)), -1))


def _parse_map(text: Column, dtype: T.MapType, seps: Separators, level: int) -> Column:
    ksep = seps.at(level + 1)

    def entry(halves: Column) -> Column:
        return F.struct(
            parse_value(F.get(halves, F.lit(0)), dtype.keyType, seps, level + 2).alias("key"),
            parse_value(F.get(halves, F.lit(1)), dtype.valueType, seps, level + 2).alias("value"),
        )

    def first_wins(entries: Column) -> Column:
        # Only rows that do repeat a key pay for the sort: by key and place, the first of each key stays.
        keys = F.transform(entries, lambda e: e["key"])
        placed = F.array_sort(F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("at"))))

        def heads(sorted_keys: Column) -> Column:
            before = lambda i: F.get(sorted_keys, i - 1)["key"]
            return F.filter(sorted_keys, lambda x, i: (i == 0) | ~x["key"].eqNullSafe(before(i)))

        places = F.array_sort(F.transform(_let(placed, heads), lambda x: x["at"]))
        kept = F.transform(places, lambda i: F.get(entries, i))
        repeats = (F.size(entries) > 1) & (F.size(F.array_distinct(keys)) < F.size(entries))
        return F.when(repeats, kept).otherwise(entries)

    items = F.transform(_split_nonempty(text, seps, level), lambda item: F.split(item, quoted(ksep), 2))
    entries = F.transform(items, entry)
    return F.map_from_entries(_let(F.filter(entries, lambda e: e["key"].isNotNull()), first_wins))


# --- value -> text ------------------------------------------------------------------------------


def format_row(schema: T.StructType, seps: Separators) -> Column:
    """One line of text from all columns of ``schema``."""
    return F.concat_ws(
        seps.at(0), *[format_value(F.col(_name(f.name)), f.dataType, seps, 1) for f in schema]
    )


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def format_value(value: Column, dtype: T.DataType, seps: Separators, level: int) -> Column:
    r"""The text of a value, ``\N`` for NULL; escaped text has the depth after it inside of collections."""
    if isinstance(dtype, T.ArrayType):
        if _is_plain(dtype.elementType, seps, level + 1):
            text = F.array_join(value.cast("array<string>"), seps.at(level), seps.null(level + 1))
        else:
            items = F.transform(value, lambda x: format_value(x, dtype.elementType, seps, level + 1))
            text = F.array_join(items, seps.at(level))
        text = _marked_empty(text, value, seps, level)
    elif isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.concat(
                format_value(e["key"], dtype.keyType, seps, level + 2),
                F.lit(seps.at(level + 1)),
                format_value(e["value"], dtype.valueType, seps, level + 2),
            ),
        )
        text = _marked_empty(F.array_join(entries, seps.at(level)), value, seps, level)
    elif isinstance(dtype, T.StructType):
        fields = [format_value(value[f.name], f.dataType, seps, level + 1) for f in dtype]
        text = F.when(value.isNotNull(), F.concat_ws(seps.at(level), *fields))
    else:
        text = _encoded(_scalar_text(value, dtype), dtype, seps, level)
    return F.coalesce(text, F.lit(seps.null(level)))


def _marked_empty(text: Column, value: Column, seps: Separators, level: int) -> Column:
    return F.when(F.size(value) == 0, F.lit(seps.empty(level))).otherwise(text) if seps.escaped else text


def _scalar_text(value: Column, dtype: T.DataType) -> Column:
    return F.base64(value) if isinstance(dtype, T.BinaryType) else value.cast("string")


def _is_plain(dtype: T.DataType, seps: Separators, level: int) -> bool:
    """Whether a cast to string is the text of the value as it stands."""
    return not isinstance(dtype, _NESTED + (T.BinaryType,)) and not _needs_codes(dtype, seps, level)


def conflicts(schema: T.StructType, seps: Separators) -> Column:
    r"""True for a row in which some value holds a separator, a line break or the NULL marker."""
    return _any([_conflict(F.col(_name(f.name)), f.dataType, seps, 1) for f in schema])


def _conflict(value: Column, dtype: T.DataType, seps: Separators, level: int) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.exists(value, lambda x: _conflict(x, dtype.elementType, seps, level + 1))
    if isinstance(dtype, T.MapType):
        return _any([
            F.exists(F.map_keys(value), lambda x: _conflict(x, dtype.keyType, seps, level + 2)),
            F.exists(F.map_values(value), lambda x: _conflict(x, dtype.valueType, seps, level + 2)),
        ])
    if isinstance(dtype, T.StructType):
        return _any([_conflict(value[f.name], f.dataType, seps, level + 1) for f in dtype])
    outer = seps.levels[:level]
    if not _may_conflict(dtype, outer):
        return F.lit(False)
    text = _scalar_text(value, dtype)
    return _any([text == NULL_TEXT, *[F.contains(text, F.lit(s)) for s in ("\n", "\r", *outer)]])


def _any(conditions: list[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | F.coalesce(condition, F.lit(False))
    return found


def _may_conflict(dtype: T.DataType, separators: tuple[str, ...]) -> bool:
    return isinstance(dtype, _TEXT) or any(set(s) <= PLAIN_VALUE_TEXT for s in separators)


# --- backslash codes ----------------------------------------------------------------------------

# Codes of the line breaks; separators are coded by the number of their level.
LINE_BREAK_CODES = {"\n": r"\n", "\r": r"\r"}


def _needs_codes(dtype: T.DataType, seps: Separators, level: int) -> bool:
    return seps.escaped and _may_conflict(dtype, seps.levels[:level])


def _codes(levels: tuple[str, ...]) -> dict[str, str]:
    by_level = {sep: f"\\{level}" for level, sep in reversed(list(enumerate(levels)))}
    return LINE_BREAK_CODES | by_level


def _encoded(text: Column, dtype: T.DataType, seps: Separators, level: int) -> Column:
    """Text with codes for the separators of the levels around it."""
    if not _needs_codes(dtype, seps, level):
        return text
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for character, code in _codes(seps.levels[:level]).items():
        text = F.replace(text, F.lit(character), F.lit(code))
    return text


def _decoded(text: Column, dtype: T.DataType, seps: Separators, level: int) -> Column:
    if not _needs_codes(dtype, seps, level):
        return text

    def undo(piece: Column) -> Column:
        for character, code in _codes(seps.levels[:level]).items():
            piece = F.replace(piece, F.lit(code), F.lit(character))
        return piece

    # Cutting at double backslashes first keeps a literal backslash before an n from reading as a line break.
    pieces = F.transform(F.split(text, r"\\\\", -1), undo)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(pieces, "\\")).otherwise(text)
