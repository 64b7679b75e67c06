"""Cell coercion: one column expression per (source type, logical type) pair.

``coerced`` yields the canonical value, or NULL where the cell cannot become
the declared type; ``is_drift`` tells the two kinds of NULL apart.  Everything
is built from built-in functions, so a whole normalize pass stays inside one
generated stage.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..spec import SPARK_TYPES, FieldType, Mode, field_mode, logical_type

# The characters trimmed at both ends of a text cell.
BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        "
          "        　")

# The words accepted as a boolean.
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")

# Epoch seconds of 0001-01-01 and 10000-01-01, the range of a timestamp cell.
_FIRST_SECOND, _END_SECOND = -62135596800.0, 253402300800.0

_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_INTEGER = rf"^[+-]?{_DIGITS}$"
_SHORT_INTEGER = r"^[+-]?[0-9]{1,18}$"
_DECIMAL = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
_WHOLE_DECIMAL = r"^[+-]?[0-9]{1,15}\.0*$"
_PLAIN_DECIMAL = r"^[+-]?[0-9]+(?:\.[0-9]+)?$"
_INFINITY = r"^[+-]?inf(?:inity)?$"
_NAN = r"^[+-]?nan$"
_EPOCH = r"^(?:-?[0-9]+|[+-]?[0-9]+\.[0-9]+)$"
_ZONE = r"(?:Z|[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2})?)?)$"
_EDGE_DAY = r"^(?:0001-?01-?01|9999-?12-?31)"
_COMMON_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,9})?"
_COMMON_LOCAL = _COMMON_TIME + "$"
_COMMON_ZONED = _COMMON_TIME + r"(?:Z|[+-][0-9]{2}:[0-9]{2})$"
_ANY_TIME = (r"^([0-9]{4})(?:-([0-9]{2})-([0-9]{2})|([0-9]{2})([0-9]{2}))"
             r"(?:[\s\S](?:([0-9]{2})(?::([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?"
             r"|([0-9]{2})(?:([0-9]{2})(?:[.,]([0-9]+))?)?)?)"
             r"(Z|[+-][0-9]{2}(?::?[0-9]{2})?)?)?$")
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_COMPACT_DATE = r"^[0-9]{8}$"
_BASE64 = r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"


def _null(target: T.DataType) -> Column:
    return F.lit(None).cast(target)


def trimmed(col: Column) -> Column:
    """Text without blanks at its ends.  The rules below take text that is trimmed."""
    return F.btrim(col, F.lit(BLANKS))


# --------------------------------------------------------------------------
# text of a value


def double_text(col: Column) -> Column:
    """Shortest decimal text: plain between 1e-4 and 1e16, exponent form outside."""
    x = col.cast("double")
    size = F.abs(x)
    java = x.cast("string")
    # Trailing zeros go, one digit after the point stays.
    fixed = F.regexp_replace(x.cast("decimal(38,21)").cast("string"), r"(\.[0-9]*[1-9])0+$|(\.0)0*$", "$1$2")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    power = F.substring_index(java, "E", -1)
    digits = F.regexp_replace(power, "^-", "")
    digits = F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits)
    sign = F.when(power.startswith("-"), F.lit("-")).otherwise(F.lit("+"))
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(size == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), java)
        .when((size >= 1e-4) & (size < 1e16), fixed)
        .otherwise(F.concat(mantissa, F.lit("e"), sign, digits))
    )


def _clock_text(col: Column, zone: str) -> Column:
    """``YYYY-MM-DD HH:MM:SS``, and six fraction digits where there is a fraction."""
    text = col.cast("string")
    return F.concat(F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text), F.lit(zone))


def to_text(col: Column, source: T.DataType) -> Column:
    """Any value as text."""
    if isinstance(source, (T.StringType, T.CharType, T.VarcharType)):
        return col.cast("string")
    if isinstance(source, T.BooleanType):
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return F.when(col.isNotNull(), double_text(col))
    if isinstance(source, T.TimestampType):
        return _clock_text(col, "+00:00")
    if isinstance(source, T.TimestampNTZType):
        return _clock_text(col, "")
    if isinstance(source, T.VariantType):
        return coerced(col, source, FieldType.STRING)
    if _is_nested(source):
        return F.to_json(col)
    return col.cast("string")


def _is_nested(source: T.DataType) -> bool:
    return isinstance(source, (T.StructType, T.ArrayType, T.MapType))


# --------------------------------------------------------------------------
# numbers


def double_of_text(text: Column) -> Column:
    """Parse trimmed text as a float; Spark's own cast also takes ``1d`` and ``2f``."""
    low = F.lower(text)
    parsed = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    infinity = F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (F.when(text.rlike(_PLAIN_DECIMAL), text.try_cast("double"))
            .when(text.rlike(_DECIMAL), parsed)
            .when(low.rlike(_INFINITY), infinity)
            .when(low.rlike(_NAN), F.lit(float("nan"))))


def _whole(x: Column) -> Column:
    fits = (x == F.floor(x)) & (x >= -9.223372036854775808e18) & (x < 9.223372036854775808e18)
    return F.when(fits, x.try_cast("bigint"))


def _integer(col: Column, source: T.DataType) -> Column:
    if isinstance(source, T.IntegralType):
        return col.cast("bigint")
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return _whole(col.cast("double"))
    if isinstance(source, T.StringType):
        return (F.when(col.rlike(_SHORT_INTEGER), col.try_cast("bigint"))
                .when(col.rlike(_INTEGER), F.replace(col, F.lit("_"), F.lit("")).try_cast("bigint"))
                .when(col.rlike(_WHOLE_DECIMAL), F.substring_index(col, ".", 1).try_cast("bigint"))
                .when(col.rlike(_DECIMAL), _whole(F.replace(col, F.lit("_"), F.lit("")).try_cast("double"))))
    return _null(T.LongType())


def _float(col: Column, source: T.DataType) -> Column:
    if isinstance(source, T.StringType):
        return double_of_text(col)
    if isinstance(source, T.NumericType):
        return col.cast("double")
    return _null(T.DoubleType())


def _boolean(col: Column, source: T.DataType) -> Column:
    if isinstance(source, T.BooleanType):
        return col
    if isinstance(source, T.IntegralType):
        return F.when(col == 1, F.lit(True)).when(col == 0, F.lit(False))
    if isinstance(source, T.StringType):
        word = F.lower(col)
        return (F.when(word.isin(*TRUE_WORDS), F.lit(True))
                .when(word.isin(*FALSE_WORDS), F.lit(False)))
    return _null(T.BooleanType())


# --------------------------------------------------------------------------
# time


def timestamp_of_epoch(seconds: Column) -> Column:
    """Epoch seconds, fraction kept to the microsecond and rounded half to even."""
    x = seconds.cast("double")
    whole = F.when(x < 0, F.ceil(x)).otherwise(F.floor(x))
    micros = whole * F.lit(1000000) + F.rint((x - whole) * 1e6).cast("bigint")
    inside = (x >= _FIRST_SECOND) & (x < _END_SECOND)
    return F.when(inside & ~F.isnan(x), F.timestamp_micros(micros.cast("bigint")))


def timestamp_of_iso(text: Column) -> Column:
    """ISO-8601 text; without an offset it is UTC.  The usual shapes go straight to
    a cast, the rest (compact, hours only, comma fraction) are first spelled out."""
    part = lambda i: F.regexp_extract(text, _ANY_TIME, i)
    zero = lambda c: F.when(c == "", F.lit("00")).otherwise(c)
    month, day = (F.concat(part(2), part(4)), F.concat(part(3), part(5)))
    minute, second = zero(F.concat(part(7), part(10))), zero(F.concat(part(8), part(11)))
    fraction = F.substring(F.rpad(F.concat(part(9), part(12)), 6, "0"), 1, 6)
    offset = F.regexp_replace(part(13), r"^([+-][0-9]{2}):?([0-9]{2})$", "$1:$2")
    offset = F.when((offset == "") | (offset == "Z"), F.lit("Z")).when(
        F.length(offset) == 3, F.concat(offset, F.lit(":00"))).otherwise(offset)
    spelled = F.concat(part(1), F.lit("-"), month, F.lit("-"), day, F.lit("T"), zero(part(6)),
                       F.lit(":"), minute, F.lit(":"), second, F.lit("."), fraction, offset)
    # An offset can push the first and the last day out of the range.
    edge = text.rlike(_EDGE_DAY) & text.rlike(_ZONE)
    moved = F.when(text.rlike(_ANY_TIME), spelled.try_cast("timestamp"))
    seconds = F.unix_seconds(moved)
    return (F.when(edge, F.when((seconds >= _FIRST_SECOND) & (seconds < _END_SECOND), moved))
            .when(text.rlike(_COMMON_LOCAL), F.concat(text, F.lit("Z")).try_cast("timestamp"))
            .when(text.rlike(_COMMON_ZONED), text.try_cast("timestamp"))
            .when(text.rlike(_ANY_TIME), spelled.try_cast("timestamp")))


def _timestamp(col: Column, source: T.DataType) -> Column:
    if isinstance(source, T.TimestampType):
        return col
    if isinstance(source, (T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp")
    if isinstance(source, (T.IntegralType, T.FloatType, T.DoubleType)):
        return timestamp_of_epoch(col)
    if isinstance(source, T.StringType):
        return (F.when(col.rlike(_EPOCH), timestamp_of_epoch(col.try_cast("double")))
                .otherwise(timestamp_of_iso(col)))
    return _null(T.TimestampType())


def _date(col: Column, source: T.DataType) -> Column:
    if isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    if isinstance(source, T.StringType):
        dashed = F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 5, 2), F.substring(col, 7, 2))
        return (F.when(col.rlike(_DATE), col.try_cast("date"))
                .when(col.rlike(_COMPACT_DATE), dashed.try_cast("date")))
    return _null(T.DateType())


# --------------------------------------------------------------------------
# JSON and bytes


def to_json_text(col: Column, source: T.DataType) -> Column:
    """JSON text: text stays as it is, nested values are serialised."""
    if isinstance(source, (T.BooleanType, T.IntegralType, T.DecimalType)):
        return col.cast("string")
    if isinstance(source, T.VariantType):
        return coerced(col, source, FieldType.JSON)
    return to_text(col, source)


def _bytes(col: Column, source: T.DataType) -> Column:
    if isinstance(source, T.BinaryType):
        return col
    if isinstance(source, T.StringType):
        return (F.when((col != "") & col.rlike(_BASE64), F.unbase64(col))
                .otherwise(F.encode(col, "UTF-8")))
    return _null(T.BinaryType())


_RULES = {
    FieldType.STRING: to_text,
    FieldType.INTEGER: _integer,
    FieldType.FLOAT: _float,
    FieldType.BOOLEAN: _boolean,
    FieldType.TIMESTAMP: _timestamp,
    FieldType.DATE: _date,
    FieldType.JSON: to_json_text,
    FieldType.BYTES: _bytes,
}


VERBATIM = (FieldType.STRING, FieldType.JSON)
# A number's rules give the same answer for a variant cell and for the text of that cell
# (a boolean's text is no number either), so these need no kind.
BY_TEXT = (FieldType.INTEGER, FieldType.FLOAT)


@dataclass(frozen=True)
class Parts:
    """What a rule needs of a cell besides the cell: its trimmed text and, for a
    variant, its kind.  Several branches of a rule read them, and a CASE does not share
    what its branches compute, so a batch computes them as columns of their own."""

    text: Column | None = None
    kind: Column | None = None
    raw: Column | None = None

    @classmethod
    def inline(cls, col: Column, source: T.DataType, target: FieldType) -> "Parts":
        if isinstance(source, T.VariantType):
            raw = F.try_variant_get(col, "$", "string")
            return cls(trimmed(raw), None if target in BY_TEXT else F.schema_of_variant(col), raw)
        return cls(trimmed(col)) if isinstance(source, T.StringType) else cls()


def _of_text(raw: Column, text: Column, target: FieldType) -> Column:
    if target is FieldType.STRING:
        return raw
    if target is FieldType.JSON:
        return F.nullif(raw, F.lit(""))
    value = _RULES[target](text, T.StringType())
    # Blank text fits no other rule anyway.
    return F.when(raw != "", value) if target is FieldType.BYTES else value


def _of_variant(col: Column, parts: Parts, target: FieldType) -> Column:
    """A variant cell carries its own type, so the rule is picked per row."""
    kind = parts.kind
    get = lambda t: F.try_variant_get(col, "$", t)
    rule = _RULES[target]
    if kind is None:
        return rule(parts.text, T.StringType())
    out = F.when(kind == "STRING", _of_text(parts.raw, parts.text, target))
    out = out.when(kind == "BIGINT", rule(get("bigint"), T.LongType()))
    out = out.when((kind == "DOUBLE") | kind.startswith("DECIMAL"), rule(get("double"), T.DoubleType()))
    out = out.when(kind == "BOOLEAN", rule(get("boolean"), T.BooleanType()))
    out = out.when(kind == "TIMESTAMP", rule(get("timestamp"), T.TimestampType()))
    out = out.when(kind == "DATE", rule(get("date"), T.DateType()))
    return out.when(kind != "VOID", F.to_json(col)) if target in VERBATIM else out


def coerced(col: Column, source: T.DataType, target: FieldType, parts: Parts | None = None) -> Column:
    """The cell as ``target``; NULL for NULL, for ``""`` (except text) and for misfits."""
    target = FieldType.of(target)
    if isinstance(source, T.NullType):
        return _null(SPARK_TYPES[target])
    parts = parts or Parts.inline(col, source, target)
    if isinstance(source, T.VariantType):
        return _of_variant(col, parts, target)
    if isinstance(source, T.StringType):
        return _of_text(col, parts.text, target)
    return _RULES[target](col, source)


def with_parts(df: DataFrame, targets: Mapping[str, FieldType]) -> tuple[DataFrame, dict[str, Parts]]:
    """``df`` plus the part columns its cells need, and where to find them."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cell = lambda n: F.col(f"`{n}`")
    name = lambda what, n: f"__{what}_{n}"
    variants = [n for n in targets if isinstance(kinds[n], T.VariantType)]
    kinded = [n for n in variants if targets[n] not in BY_TEXT]
    texts = [n for n, t in targets.items() if isinstance(kinds[n], T.StringType) and t not in VERBATIM]
    if variants:
        df = df.select("*", *[F.schema_of_variant(cell(n)).alias(name("kind", n)) for n in kinded])
        text_of = lambda n: F.try_variant_get(cell(n), "$", "string")
        df = df.select("*", *[(F.when(cell(name("kind", n)) == "STRING", text_of(n)) if n in kinded else text_of(n))
                              .alias(name("raw", n)) for n in variants])
    trims = {n: cell(n) for n in texts} | {n: cell(name("raw", n)) for n in variants if targets[n] not in VERBATIM}
    if trims:
        df = df.select("*", *[trimmed(c).alias(name("text", n)) for n, c in trims.items()])
    at = lambda what, n, there: cell(name(what, n)) if there else None
    return df, {n: Parts(at("text", n, n in trims), at("kind", n, n in kinded), at("raw", n, n in variants))
                for n in targets if n in trims or n in variants}


def is_drift(col: Column, source: T.DataType, value: Column, parts: Parts | None = None) -> Column:
    """True where a cell held something and ``value``, its coercion, came out NULL."""
    if isinstance(source, T.NullType):
        return F.lit(False)
    held = col.isNotNull()
    if isinstance(source, T.StringType):
        held = held & (col != "")
    if isinstance(source, T.VariantType):
        raw = parts.raw if parts else F.try_variant_get(col, "$", "string")
        held = held & ~F.is_variant_null(col) & F.coalesce(raw != "", F.lit(True))
    return value.isNull() & held


def coerced_field(col: Column, source: T.DataType, field: T.StructField, parts: Parts | None = None) -> Column:
    """``coerced`` for a declared column; a repeated column is coerced element by element."""
    target = logical_type(field)
    if field_mode(field) is Mode.REPEATED:
        if not isinstance(source, T.ArrayType):
            return _null(field.dataType)
        return F.transform(col, lambda x: coerced(x, source.elementType, target))
    return coerced(col, source, target, parts)


def cannot_become(column: str, col: Column, source: T.DataType, target: FieldType) -> Column:
    """The error text for a cell that misfits, with the value cut short."""
    shown = F.substring(F.coalesce(to_text(col, source), F.lit("")), 1, 80)
    return F.concat(F.lit(f"column {column}: value '"), shown,
                    F.lit(f"' of type {source.simpleString()} cannot become {target.value}"))


