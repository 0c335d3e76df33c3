"""JSON records as VARIANT columns and as text (P1-P4, P7 and field updates).

A record is parsed once into a VARIANT column that is null unless the text is exactly one JSON
object. Strict, fallback and normalising forms are then cheap expressions over that column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parser settings: field names may be unquoted and strings single-quoted.
LENIENT_JSON = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}

# Closes the array a text is wrapped in. A parser stops after the first complete value, so without
# it "{...} trailing" would pass as valid.
END_MARK = "~end~"

_PARSED = "__parsed"
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_ESCAPED_NAME = r'\\.[^"\\]*+(?:\\.[^"\\]*+)*+":'
_TOKEN = rf'{_STRING}|[\[\]{{}},]|[^"\[\]{{}},]+'


def with_json_object(df: DataFrame, value: str = "value", out: str = "obj") -> DataFrame:
    """Add ``out``: the object in ``value`` as VARIANT, null for anything that is not one object.

    The text is parsed in its own projection, because the result is used several times. Numbers that are none
    (``NaN``) make a text bad, and so does, where only VARIANT can render the text, a number that it would round.
    """
    wrapped = F.concat(F.lit("["), F.col(value), F.lit(f',"{END_MARK}"]'))
    parsed = F.from_json(wrapped, "variant", LENIENT_JSON)
    whole = F.try_variant_get(_PARSED, "$[1]", "string").eqNullSafe(F.lit(END_MARK)) & F.variant_get(
        _PARSED, "$[2]", "variant"
    ).isNull()
    is_object = F.col(value).rlike(r"^[ \t\r\n]*\{")
    outside = _outside_strings(value)
    rounded = ~is_standard(value) & outside.rlike(r"[0-9.]{39,}|[0-9.]{16,}[eE]")
    exact = ~outside.rlike(r"\b(?:NaN|Infinity|INF)\b") & ~rounded
    return (
        df.withColumn(_PARSED, parsed)
        .withColumn(out, F.when(whole & is_object & exact, F.variant_get(_PARSED, "$[0]", "variant")))
        .drop(_PARSED)
    )


def _outside_strings(value: str) -> Column:
    return F.regexp_replace(value, _STRING, "")


def is_standard(value: str = "value") -> Column:
    """Of a text that parses: whether its names and strings are all in double quotes."""
    return ~_outside_strings(value).rlike(r"'|[A-Za-z_$][\w$]*\s*:")


def object_text(obj: str = "obj", value: str = "value") -> Column:
    """The JSON text of the object. Standard JSON stays as written, so numbers keep every digit, but for the blanks
    outside of strings; field order, escapes and repeated names stay too. Other texts are rendered by VARIANT."""
    compact = F.regexp_replace(value, rf"({_STRING})|\s+", "$1")
    return F.when(F.col(obj).isNotNull(), F.when(is_standard(value), compact).otherwise(F.to_json(obj)))


def strict_object(obj: str = "obj", value: str = "value") -> Column:
    """The object itself; a bad text fails the query."""
    return F.when(F.col(obj).isNotNull(), F.col(obj)).otherwise(_fail(value).cast("variant"))


def strict_text(obj: str = "obj", value: str = "value") -> Column:
    """The JSON text of the object, every digit kept; a bad text fails the query."""
    return F.coalesce(object_text(obj, value), _fail(value).cast("string"))


def is_checked_object(obj: str = "obj", value: str = "value") -> Column:
    """P1 as a condition: true, or the query fails."""
    return F.when(F.col(obj).isNotNull(), True).otherwise(_fail(value).cast("boolean"))


def _fail(value: str) -> Column:
    return F.raise_error(F.concat(F.lit("not a JSON object: "), F.coalesce(F.col(value), F.lit("null"))))


def json_or_line(obj: str = "obj", value: str = "value") -> Column:
    """JSON text of the object, or ``{"line": <raw text>}`` when it is bad."""
    return F.coalesce(object_text(obj, value), F.to_json(F.struct(F.col(value).alias("line"))))


def json_or_empty(obj: str = "obj", value: str = "value") -> Column:
    """JSON text of the object, or the empty string when it is bad."""
    return F.coalesce(object_text(obj, value), F.lit(""))


def put_in_text(text: Column, name: str, value: Column) -> Column:
    """P4 on text: the compact JSON object in ``text`` with the top-level field ``name`` set to ``value`` (JSON text).

    Fields of that name at the top level go, however their name is escaped, and the new one comes last; all else stays as
    written, nested fields of that name too. The text is scanned by tokens only if it holds the name or a name with an escape.
    """
    may_hold = F.contains(text, F.lit(f'"{name}"')) | text.rlike(_ESCAPED_NAME)
    kept = F.when(may_hold, _without(text, name)).otherwise(F.substring(text, F.lit(2), F.length(text) - 2))
    comma = F.when(kept == "", "").otherwise(",")
    return F.concat(F.lit("{"), kept, comma, F.lit(f'"{name}":'), value, F.lit("}"))


def _without(text: Column, name: str) -> Column:
    """What stands between the outer braces, without the top-level fields ``name``."""
    gaps = F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), _scan(), lambda s, token: _scanned(s, token, name))["gaps"]
    # The gaps from the first brace on to the last one, and what is kept between each two of them.
    edges = F.concat(F.array(_gap(F.lit(0), F.lit(1))), gaps, F.array(_gap(F.length(text) - 1, F.length(text))))
    pairs = F.arrays_zip(F.slice(edges, F.lit(1), F.size(edges) - 1).alias("left"), F.slice(edges, F.lit(2), F.size(edges) - 1).alias("right"))
    kept = F.transform(pairs, lambda x: F.substring(text, x["left"]["end"] + 1, x["right"]["begin"] - x["left"]["end"]))
    return F.rtrim(F.array_join(kept, ""), F.lit(","))


def _gap(begin: Column, end: Column) -> Column:
    return F.struct(begin.cast("int").alias("begin"), end.cast("int").alias("end"))


def _scan() -> Column:
    """How deep a scan is, how many characters it has passed, where the top-level field it is in begins and whether that
    has the name, and the places to leave out."""
    none = F.array().cast("array<struct<begin:int,end:int>>")
    return F.struct(
        F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("begin"), F.lit(False).alias("named"), none.alias("gaps")
    )


def _scanned(s: Column, token: Column, name: str) -> Column:
    end = s["at"] + F.length(token)
    opens, closes = token.isin("{", "["), token.isin("}", "]")
    ends = (s["depth"] == 1) & (closes | (token == ","))
    starts = ends | (s["depth"] == 0)
    plain = F.lit(f'"{name}"')
    unescaped = F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>")[0] == name
    same = F.when(token == plain, True).when(F.contains(token, F.lit("\\")), F.coalesce(unescaped, F.lit(False))).otherwise(False)
    is_name = (s["depth"] == 1) & (s["at"] == s["begin"]) & F.startswith(token, F.lit('"'))
    left_out = F.array(_gap(s["begin"], F.when(token == ",", end).otherwise(s["at"])))
    return F.struct(
        (s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)).alias("depth"),
        end.alias("at"),
        F.when(starts, end).otherwise(s["begin"]).alias("begin"),
        F.when(starts, False).when(is_name, same).otherwise(s["named"]).alias("named"),
        F.when(ends & s["named"], F.concat(s["gaps"], left_out)).otherwise(s["gaps"]).alias("gaps"),
    )


def fields_or_line(obj: str = "obj", value: str = "value") -> Column:
    """P2 as a map from field name to VARIANT, ready for :func:`put_fields`."""
    line = F.create_map(F.lit("line"), F.col(value).cast("variant"))
    return F.when(F.col(obj).isNotNull(), fields_of(obj)).otherwise(line)


def fields_of(obj: str | Column) -> Column:
    """The top-level fields of an object as a map from name to VARIANT."""
    return (F.col(obj) if isinstance(obj, str) else obj).cast("map<string,variant>")


def put_fields(fields: Column, **values: Column) -> Column:
    """Set top-level fields, replacing those already there."""
    kept = F.map_filter(fields, lambda name, _: ~name.isin(*values))
    added = F.create_map(*[part for name, v in values.items() for part in (F.lit(name), v.cast("variant"))])
    return F.map_concat(kept, added)
