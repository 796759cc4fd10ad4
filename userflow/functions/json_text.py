"""JSON text in the spaced ASCII form: as Python's ``json.dumps`` writes it by default.

A space follows every comma and colon, characters beyond printable ASCII are escaped by
their UTF-16 units, numbers are the shortest that read back. Two producers that hash the same
key into topic partitions must agree on its bytes; Spark's own ``to_json`` writes no spaces
and leaves other characters as they are.

Everything is a native expression. A string that needs no escape, the common case, is passed
as it is; only others are taken apart.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What JSON writes short.
SHORT = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
_PLAIN = r"^[ !#-\[\]-~]*$"
_NUMBER = r"^-?(?:0|[1-9][0-9]*)$"
# A JSON text's strings, its other words, and its signs; nothing of the white space between.
_TOKENS = r'"(?:[^"\\]|\\.)*"|[^\s"{}\[\],:]+|[{}\[\],:]'


def json_text(value: Column, kind: T.DataType) -> Column:
    """A column of the given type as JSON text in the spaced form; null as ``null``, null
    fields of a struct included. Times and dates are strings, as Spark writes them."""
    return F.coalesce(_text(value, kind), F.lit("null"))


def _text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        if not kind.fields:
            return F.when(value.isNotNull(), "{}")
        parts = []
        for number, field in enumerate(kind.fields):
            name = json.dumps(field.name) + ": "
            parts += [F.lit(("{" if number == 0 else ", ") + name), json_text(value.getField(field.name), field.dataType)]
        return F.when(value.isNotNull(), F.concat(*parts, F.lit("}")))
    if isinstance(kind, T.ArrayType):
        each = F.transform(value, lambda v: json_text(v, kind.elementType))
        return F.concat(F.lit("["), F.array_join(each, ", "), F.lit("]"))
    if isinstance(kind, T.MapType):
        pair = F.transform(
            F.map_entries(value),
            lambda e: F.concat(_quoted(e.key.cast("string")), F.lit(": "), json_text(e.value, kind.valueType)),
        )
        return F.concat(F.lit("{"), F.array_join(pair, ", "), F.lit("}"))
    if isinstance(kind, T.FloatType | T.DoubleType):
        return number_text(value.cast("double"))
    if isinstance(kind, T.BooleanType | T.IntegralType | T.DecimalType):
        return value.cast("string")
    if isinstance(kind, T.NullType):
        return F.lit(None).cast("string")
    if isinstance(kind, T.BinaryType | T.VariantType):
        raise TypeError(f"no JSON text of {kind.simpleString()}")
    return _quoted(value.cast("string"))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), escaped(text), F.lit('"'))


def escaped(text: Column) -> Column:
    """The inside of a JSON string."""

    def one(char: Column) -> Column:
        units = F.lower(F.hex(F.encode(char, "UTF-16BE")))
        out = F.when(char.rlike(r"^[ -~]$"), char).otherwise(F.regexp_replace(units, "(.{4})", r"\\u$1"))
        for raw, short in SHORT.items():
            out = F.when(char == raw, short).otherwise(out)
        return out

    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    return F.when(text.rlike(_PLAIN), text).otherwise(F.array_join(F.transform(chars, one), ""))


def number_text(value: Column) -> Column:
    """A double as the shortest decimal number that reads back, with an exponent below 1e-4
    and from 1e16 on. Of two such numbers of one length Java's may be the farther one, which
    happens once in 240,000 random doubles, beyond 2**63."""
    told = F.abs(value).cast("string")
    # Java writes 1.5, 0.0015, 1.5E7: the digits, and where the point stands among them.
    mantissa, power = F.split_part(told, F.lit("E"), F.lit(1)), F.split_part(told, F.lit("E"), F.lit(2))
    whole, part = F.split_part(mantissa, F.lit("."), F.lit(1)), F.split_part(mantissa, F.lit("."), F.lit(2))
    all_digits = F.concat(whole, part)
    zeros = F.length(all_digits) - F.length(F.regexp_replace(all_digits, "^0+", ""))
    digits = F.regexp_replace(F.regexp_replace(all_digits, "^0+", ""), "0+$", "")
    # The value is 0.<digits> times ten to the point.
    point = F.length(whole) - zeros + F.when(power == "", F.lit(0)).otherwise(power.try_cast("int"))
    # Whole numbers beyond 2**53 are exact as integers, more digits than are needed.
    exact = F.abs(value).try_cast("bigint").cast("string")
    wide = (F.abs(value) >= 2.0**53) & (F.abs(value) < 2.0**63)
    shape = F.array(
        F.when(wide, F.struct(exact.alias("digits"), F.length(exact).alias("point"))).otherwise(
            F.struct(digits.alias("digits"), point.cast("int").alias("point"))
        )
    )

    # Java may write digits that are not needed: the shortest form that reads back.
    def shorter(held: Column, fewer: int, down: bool = False) -> Column:
        number = held.digits.try_cast("decimal(20,0)")
        if down:
            number = number - F.lit(5 * 10 ** (fewer - 1))
        rounded = F.round(number, -fewer).cast("decimal(20,0)").cast("string")
        grown = F.length(rounded) - F.length(held.digits)
        short = F.regexp_replace(rounded, "0+$", "")
        reads = F.concat(F.lit("0."), short, F.lit("E"), (held.point + grown).cast("string")).try_cast("double") == F.abs(value)
        fits = ((F.length(held.digits) >= 16) | (F.abs(value) < 1e-300)) & F.coalesce(reads, F.lit(False))
        return F.when(fits, F.struct(short.alias("digits"), (held.point + grown).alias("point")))

    tries = [(4, False), (3, False), (2, False), (1, False), (1, True)]
    trimmed = F.transform(shape, lambda h: F.struct(F.regexp_replace(h.digits, "0+$", "").alias("digits"), h.point.alias("point")))
    shape = F.transform(
        F.arrays_zip(shape.alias("own"), trimmed.alias("trimmed")),
        lambda h: F.coalesce(*[shorter(h["own"], *t) for t in tries], h["trimmed"]),
    )

    def laid_out(held: Column) -> Column:
        d, p = held.digits, held.point
        n = F.length(d)
        power = p - 1
        sign = F.when(power < 0, "-").otherwise("+")
        fraction = F.when(n > 1, F.concat(F.lit("."), F.substring(d, 2, 20))).otherwise("")
        by_power = F.concat(F.substring(d, 1, 1), fraction, F.lit("e"), sign, F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), F.greatest(-p, F.lit(0))), d)
        large = F.concat(d, F.repeat(F.lit("0"), F.greatest(p - n, F.lit(0))), F.lit(".0"))
        between = F.concat(F.substring(d, F.lit(1), p), F.lit("."), F.substring(d, p + 1, F.lit(20)))
        plain = F.when(p <= 0, small).when(p >= n, large).otherwise(between)
        return F.when((power < -4) | (power >= 16), by_power).otherwise(plain)

    text = F.element_at(F.transform(shape, laid_out), 1)
    minus = F.when(value.cast("string").startswith("-"), "-").otherwise("")
    infinite = F.abs(value) == F.lit(float("inf"))
    positive = F.when(value == 0, "0.0").when(infinite, "Infinity").otherwise(text)
    return F.when(F.isnan(value), "NaN").otherwise(F.concat(minus, positive))


def respaced(text: Column) -> Column:
    """A well-formed JSON text in the spaced form, its fields in the order they have. Strings are
    escaped anew, numbers with a point or an exponent written as doubles; repeated fields stay.
    Null for null."""
    tokens = F.regexp_extract_all(text, F.lit("(?s)" + _TOKENS), F.lit(0))

    def one(token: Column) -> Column:
        inside = F.substring(token, F.lit(2), F.length(token) - 2)
        read = F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>")[0]
        string = F.when(inside.rlike(_PLAIN), token).otherwise(_quoted(read))
        number = F.when(token == "-0", "0").when(token.rlike(_NUMBER), token).otherwise(number_text(token.try_cast("double")))
        return (
            F.when(token.startswith('"'), string)
            .when(token == ",", ", ")
            .when(token == ":", ": ")
            .when(token.rlike(r"^-?[0-9]"), number)
            .otherwise(token)
        )

    return F.array_join(F.transform(tokens, one), "")
