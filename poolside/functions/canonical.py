"""JSON text that does not depend on the order of columns, and keys made of it.

Objects have sorted keys, decimals and dates are strings, nulls are written. A value has one
text in each of two styles: ``COMPACT`` (no blanks, characters as they are) and ``SPACED``
(a blank after commas and colons, all but ASCII escaped). The expression is built from the
type once and runs in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Style:
    comma: str
    colon: str
    ascii_only: bool
    between: str  # of a timestamp's date and time


COMPACT, SPACED = Style(",", ":", False, "T"), Style(", ", ": ", True, " ")
_SHORT = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\f": "\\f", "\b": "\\b"}


def json_string(text: Column, style: Style = COMPACT) -> Column:
    """A JSON string with its quotes."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    escaped = out
    for code in range(32):
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(_SHORT.get(chr(code), f"\\u{code:04x}")))
    out = F.when(text.rlike(r"[\x00-\x1f]"), escaped).otherwise(out)
    if style.ascii_only:
        units = F.regexp_extract_all(F.hex(F.encode(out, "UTF-16BE")), F.lit("(.{4})"), F.lit(1))
        plain = lambda u: F.chr(F.conv(u, 16, 10).cast("int"))
        spelled = F.array_join(F.transform(units, lambda u: F.when(u <= "007E", plain(u)).otherwise(F.concat(F.lit("\\u"), F.lower(u)))), "")
        out = F.when(out.rlike(r"[^\x00-\x7e]"), spelled).otherwise(out)
    return F.concat(F.lit('"'), out, F.lit('"'))


def canonical_json(value: Column, kind: T.DataType, style: Style = COMPACT) -> Column:
    """The text of a value of this type; floating point numbers have none, for engines print them differently."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        parts = [F.concat(F.lit(json_name(f.name, style) + style.colon), canonical_json(value[f.name], f.dataType, style)) for f in fields]
        body = F.concat_ws(style.comma, *parts) if parts else F.lit("")
        out = F.concat(F.lit("{"), body, F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: canonical_json(x, kind.elementType, style)), style.comma), F.lit("]"))
    elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        pair = lambda k: F.concat(json_string(k, style), F.lit(style.colon), canonical_json(F.element_at(value, k), kind.valueType, style))
        out = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_keys(value)), pair), style.comma), F.lit("}"))
    elif isinstance(kind, T.StringType):
        out = json_string(value, style)
    elif isinstance(kind, T.BooleanType | T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        out = value.cast("string")
    elif isinstance(kind, T.DecimalType | T.DateType):
        out = F.concat(F.lit('"'), value.cast("string"), F.lit('"'))
    elif isinstance(kind, T.TimestampNTZType):
        micros = F.date_format(value, ".SSSSSS")
        out = F.concat(F.lit('"'), F.date_format(value, f"yyyy-MM-dd'{style.between}'HH:mm:ss"), F.when(micros != ".000000", micros).otherwise(""), F.lit('"'))
    elif isinstance(kind, T.NullType):
        return F.lit("null")
    else:
        raise TypeError(f"{kind.simpleString()} has no canonical text")
    return F.when(value.isNull(), "null").otherwise(out)


def json_name(name: str, style: Style) -> str:
    import json

    return json.dumps(name, ensure_ascii=style.ascii_only)


def canonical_rows(df: DataFrame, columns: list[str] | None = None, style: Style = COMPACT) -> Column:
    """Each row's columns as an object."""
    kind = T.StructType([df.schema[c] for c in columns or df.columns])
    return canonical_json(F.struct(*(F.col(f"`{f.name}`") for f in kind.fields)), kind, style)


def json_list(values: list[tuple[Column, T.DataType]], style: Style = COMPACT) -> Column:
    return F.concat(F.lit("["), F.concat_ws(style.comma, *(canonical_json(v, k, style) for v, k in values)), F.lit("]"))


def digest_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


_TEXT, _INT, _LONG, _BOOL, _DATE = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType()


def race_key(swimmer_key: Column, number: Column, day: Column, stage: Column, is_relay: Column) -> Column:
    """FN22: a race of a swimmer in a source: event number, date, round and relay, whatever heat or lane."""
    return digest_of(json_list([(swimmer_key, _TEXT), (number.cast("string"), _TEXT), (day.cast("date"), _DATE), (stage, _TEXT), (is_relay, _BOOL)], SPACED))


def identity_key(first_name: Column, last_name: Column, birth_year: Column, gender: Column, club: Column) -> Column:
    """FN22: who a source row names: folded names, birth year, gender and club."""
    from .scalars import folded_name

    return digest_of(json_list([(folded_name(first_name), _TEXT), (folded_name(last_name), _TEXT), (birth_year.cast("int"), _INT), (gender, _TEXT), (club, _TEXT)], SPACED))


#: What makes a swum race the same in another export; names are transliterated on top of these.
PERFORMANCE = {"birth_year": _INT, "gender": _TEXT, "date": _DATE, "time_cs": _INT, "course": _TEXT, "distance": _INT, "stroke": _TEXT, "meet": _TEXT, "city": _TEXT, "meet_country": _TEXT, "round": _TEXT, "heat": _TEXT}


def performance_key(first_name: Column | str = "first_name", last_name: Column | str = "last_name") -> Column:
    """FN22: the race of a performance row, without the swimmer's nation and the source's ids."""
    from .scalars import name_key

    names = [name_key(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in ((first_name, "first_name"), (last_name, "last_name"))]
    kind = T.StructType([T.StructField(c, k) for c, k in PERFORMANCE.items()] + [T.StructField("first_name", _TEXT), T.StructField("last_name", _TEXT)])
    return digest_of(canonical_json(F.struct(*(F.col(c).cast(k).alias(c) for c, k in PERFORMANCE.items()), *names), kind))


def source_key(tag: str, meet_key: Column, result_id: Column) -> Column:
    """FN22: a result's name for readers: a JSON list of a tag, the meet's key and the id."""
    style = Style(", ", ": ", False, "T")
    return json_list([(F.lit(tag), _TEXT), (meet_key, _TEXT), (result_id.cast("long"), _LONG)], style)
