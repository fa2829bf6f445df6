"""JSON text in and out.

Written text has ``", "`` / ``": "`` separators and keeps non-ASCII as is.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.text import as_column, let
from chatloom.schemas import ENTITY_FIELDS

# The escapes of a JSON string.
SHORT_ESCAPES = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}

# NaN or an infinity outside strings, with all that stands before it.
NOT_FINITE = r'\G(?<before>(?:[^"NI-]|"(?:[^"\\]|\\.)*+"|-(?!Infinity))*+)(?:-?Infinity|NaN)'


def _escape(c: Column, table: dict[str, str]) -> Column:
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), table.items(), c)


def json_string(c: Column | str) -> Column:
    """A quoted JSON string; a missing value counts as ``""``.

    Control characters come out as ``\\u00xx`` in lower case, which ``to_json``
    prints in upper case. Texts without control characters take the short path.
    """
    c = F.coalesce(as_column(c), F.lit(""))
    usual = {"\\": "\\\\", '"': '\\"', "\n": "\\n"}
    rest = {
        chr(i): SHORT_ESCAPES.get(chr(i), f"\\u{i:04x}") for i in range(0x20) if chr(i) != "\n"
    }
    quoted = _escape(c, usual)
    rare = c.rlike("[\\x00-\\x09\\x0b-\\x1f]")
    return F.concat(F.lit('"'), F.when(rare, _escape(quoted, rest)).otherwise(quoted), F.lit('"'))


def entity_json(entity: Column) -> Column:
    """One entity struct as a JSON object, keys in record order."""
    parts: list[Column] = []
    for i, name in enumerate(ENTITY_FIELDS):
        parts.append(F.lit(("{" if i == 0 else ", ") + f'"{name}": '))
        parts.append(json_string(entity[name]))
    return F.concat(*parts, F.lit("}"))


def json_list(items: Column) -> Column:
    """JSON array from an array of JSON texts."""
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def entities_json(c: Column | str) -> Column:
    """The training target ``{"entities": [...]}``; a missing list is empty."""
    items = F.coalesce(F.transform(as_column(c), entity_json), F.array().cast("array<string>"))
    return F.concat(F.lit('{"entities": '), json_list(items), F.lit("}"))


def variant_at(v: Column, path: str) -> Column:
    """The variant below ``path``; null when the key is missing."""
    return F.try_variant_get(v, path, "variant")


def variant_list(v: Column, path: str = "$") -> Column:
    """A JSON list as ``ARRAY<VARIANT>``; null for anything else."""
    return F.try_variant_get(v, path, "array<variant>")


def parse_json_text(raw: Column | str) -> Column:
    """The JSON document in ``raw``; null unless the whole text is one document.

    The parser stops after the first value, so text after it would go unnoticed.
    Inside a list with a closing mark derived from the text, it does not. NaN and
    infinities are taken as the number 0. Repeated keys in an object are invalid
    unless the plan is made under :func:`repeated_keys`.
    """
    raw = as_column(raw)
    mark = F.xxhash64(raw)

    def parsed(text: Column) -> Column:
        pair = F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]"))
        return let(F.try_parse_json(pair), unwrap)

    def unwrap(p: Column) -> Column:
        whole = (F.try_variant_get(p, "$[1]", "bigint") == mark) & variant_at(p, "$[2]").isNull()
        return F.when(whole, variant_at(p, "$[0]"))

    # Only texts that are refused as they are and hold such a word take the second path.
    finite = F.regexp_replace(raw, NOT_FINITE, "${before}0")
    return F.coalesce(parsed(raw), F.when(raw.rlike("NaN|Infinity"), parsed(finite)))


@contextmanager
def repeated_keys(spark: SparkSession) -> Iterator[None]:
    """Plans made inside take the last of an object's repeated keys, as ``json.loads`` does.

    A plan that is used twice in one (a join or union with itself) is made anew where it
    is put together, so that has to happen inside as well.
    """
    setting = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def parse_json_object(raw: Column | str, fields: str) -> Column:
    """The object in ``raw`` as a struct of ``fields``; null for anything else.

    Same closing mark as :func:`parse_json_text`, with one typed parse.
    """
    raw = as_column(raw)
    mark = F.xxhash64(raw)
    text = F.concat(F.lit("["), raw, F.lit(',{"~mark":'), mark.cast("string"), F.lit("}]"))
    pair = F.from_json(text, f"ARRAY<STRUCT<{fields}, `~mark`: BIGINT>>")
    return let(
        pair, lambda p: F.when((F.size(p) == 2) & (F.get(p, F.lit(1))["~mark"] == mark), F.get(p, F.lit(0)))
    )
