"""Columns that read a response text as a JSON object.

Types are checked on the parsed value: a schema given to ``from_json`` would turn a number into a
string silently, and reject a whole row for a quoted boolean.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..fields import BOOLEAN, Field
from . import text as tx


def unfenced(raw: Column) -> Column:
    """Stripped response without its first and last line, when it opens a code fence and has more than two lines."""
    def body(text: Column) -> Column:
        return tx.let(F.split(text, "\n"), lambda lines: F.when(
            F.startswith(text, F.lit("```")) & (F.size(lines) > 2),
            F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 2, F.lit(0))), "\n"),
        ).otherwise(text))

    return tx.let(tx.strip(raw), body)


def brace_span(text: Column) -> Column:
    """From the first opening to the last closing brace; null when there is no such span."""
    first = F.instr(text, "{")
    last = F.length(text) - F.instr(F.reverse(text), "}") + 1
    return F.when((first > 0) & (F.instr(text, "}") > 0) & (last > first), F.substring(text, first, last - first + 1))


def parsed(text: Column) -> Column:
    """The JSON value a text consists of, or null.

    The parser ignores what follows a complete value.  Inside a frame with a second key, anything
    that follows breaks the frame or adds a key.
    """
    keys = F.try_variant_get(F.try_parse_json(_framed(text)), "$", "map<string,variant>")
    return tx.let(keys, lambda m: F.when(F.size(m) == 2, F.try_element_at(m, F.lit("value"))))


def _framed(text: Column) -> Column:
    return F.concat(F.lit('{"value":'), text, F.lit(',"end":1}'))


_STRICT = {"allowSingleQuotes": "false"}


def is_json(text: Column) -> Column:
    """Whether a text is one JSON value; keys may repeat."""
    return F.coalesce(F.size(F.from_json(_framed(text), "map<string,string>", _STRICT)) == 2, F.lit(False))


def repeating_members(text: Column) -> Column:
    """Members of a JSON object that repeats a key, with the last value of each; null for every other text.

    The variant parser rejects such objects, the map parser keeps all entries.  Keys may repeat in the object itself, not in objects inside it.
    """
    def last_values(entries: Column) -> Column:
        keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        return F.when(F.size(keys) < F.size(entries), F.map_from_arrays(
            keys, F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"])))

    read = F.map_entries(F.from_json(text, "map<string,variant>", _STRICT))
    return F.when(is_json(text) & F.startswith(F.ltrim(text), F.lit("{")), tx.let(read, last_values))


def members(value: Column) -> Column:
    """Members of a JSON object as a map, null for any other value."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def is_absent(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def field_value(value: Column, field: Field) -> Column:
    """Typed value of a field; null when absent or of another type."""
    text = F.try_variant_get(value, "$", "string")
    if field.kind != BOOLEAN:
        return F.when(F.schema_of_variant(value) == "STRING", text)
    word = F.lower(text)
    return F.when(word.isin(*fv.TRUE_WORDS), True).when(word.isin(*fv.FALSE_WORDS), False)


def is_valid(value: Column, field: Field) -> Column:
    """Absent, or of the declared type.  Booleans may also be written as a word or as 0 or 1."""
    return is_absent(value) | field_value(value, field).isNotNull()
