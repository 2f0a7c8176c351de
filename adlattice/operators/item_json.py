"""Reading the loosely typed JSON blocks of an item page."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from adlattice.functions.scalars import as_column, url_unquoted

# Keys that hold nested items, that name an item, and that can be a heading (fixed values).
NESTED_KEYS = ["items", "value", "values", "list", "children"]
NAME_KEYS = ["label", "title", "value", "name", "text"]
HEADING_KEYS = ["heading", "title", "label", "name", "text"]

# JSON texts that count as missing where a fallback is tried next (fixed values).
FALSY = ["null", '""', "0", "-0", "0.0", "-0.0", "false", "[]", "{}"]


def tolerant_json(text: Column | str) -> Column:
    """JSON as a variant: as it is, percent-decoded once, or twice; the first that parses wins."""
    text = as_column(text)
    once = url_unquoted(text)
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(once), F.try_parse_json(url_unquoted(once)))


def is_object(value: Column) -> Column:
    """Only an object can be read as a struct; its members are not looked into for this."""
    return F.try_variant_get(value, "$", "struct<a: variant>").isNotNull()


# The functions below take and give SQL text, as one item page needs some hundred of these small
# expressions and parsing text is far cheaper than assembling them call by call.


class Fields:
    """Values at a fixed list of paths of a variant, read once into one struct.

    ``reading(variant)`` gives the struct: per path the JSON text, the same with missing-like values
    as NULL, and the value as text. ``[path]`` on fields bound to a struct gives one of them.
    """

    def __init__(self, paths: list[str], struct: str = ""):
        self.paths, self.struct = paths, struct

    def reading(self, variant: str) -> str:
        """NULL if the variant is no object. Its members are taken out in one pass, so a path is followed in a small variant only."""
        members = list(dict.fromkeys(p.split(".")[0] for p in self.paths))
        taken = f"try_variant_get({variant}, '$', 'struct<{', '.join(f'{m}: variant' for m in members)}>')"

        def read(path: str, kind: str) -> str:
            member, _, inner = path.partition(".")
            return f"try_variant_get(o.{member}, '${inner and '.' + inner}', '{kind}')"

        jsons = ", ".join(f"to_json({read(p, 'variant')})" for p in self.paths)
        texts = ", ".join(read(p, "string") for p in self.paths)
        falsy = ", ".join(f"'{text}'" for text in FALSY)
        kept = f"transform(js, j -> if(j IN ({falsy}), NULL, j))"
        fields = f"get(transform(array(array({jsons})), js -> struct(js AS jsons, {kept} AS raws, array({texts}) AS texts)), 0)"
        return f"get(transform(array({taken}), o -> if(o IS NULL, NULL, {fields})), 0)"

    def bound(self, struct: str) -> Fields:
        return Fields(self.paths, struct)

    def __getitem__(self, path: str) -> Field:
        i = self.paths.index(path)
        return Field(f"{self.struct}.jsons[{i}]", f"{self.struct}.raws[{i}]", f"{self.struct}.texts[{i}]")


class Field:
    """SQL of one value: JSON text, JSON text unless it counts as missing, and plain text."""

    def __init__(self, json_text: str, raw: str, text: str):
        self.json, self.raw, self.text = json_text, raw, text


def coalesced(*texts: str) -> str:
    return f"coalesce({', '.join(texts)})"


def scalar(field: Field) -> str:
    """Text of a present scalar; objects and arrays give NULL."""
    return f"if(left({field.raw}, 1) NOT IN ('{{', '['), {field.text}, NULL)"


def first_scalar(*fields: Field) -> str:
    return coalesced(*[scalar(f) for f in fields])


def quoted_scalar(field: Field) -> str:
    """Text of a present JSON string."""
    return f"if(startswith({field.raw}, '\"'), {field.text}, NULL)"


def whole_number(field: Field) -> str:
    """Integer text of a scalar: numbers are truncated, the digits of a text are joined."""
    digits = f"nullif(regexp_replace({field.text}, '[^0-9]', ''), '')"
    return f"if(startswith({field.raw}, '\"'), {digits}, string(try_cast(try_cast({field.raw} AS double) AS bigint)))"


def number_or_text(field: Field) -> str:
    """Numbers truncated, texts as they are."""
    return f"if(startswith({field.raw}, '\"'), {field.text}, {whole_number(field)})"


def from_first(read, *fields: Field) -> str:
    """``read`` on the first present field; later ones are not tried after it."""
    chain = "NULL"
    for field in reversed(fields):
        chain = f"if({field.raw} IS NOT NULL, {read(field)}, {chain})"
    return chain


def first_whole_number(*fields: Field) -> str:
    return f"try_cast({from_first(whole_number, *fields)} AS int)"


def strict_integer(text: str) -> str:
    """JSON text of a number (truncated) or of a string that is one integer; else NULL."""
    inside = f"nullif(regexp_extract({text}, '^\" *([+-]?[0-9]+) *\"$', 1), '')"
    return f"coalesce(try_cast({inside} AS int), try_cast(try_cast({text} AS double) AS int))"


class Summary(NamedTuple):
    """What is kept of an object once it has been parsed."""

    items: list[str]  # its own item texts
    labelled: list[str]  # the items of all objects in it, itself included, under the heading asked for


def opened(value) -> Iterator:
    """Texts and object summaries of a value, with lists of any depth opened."""
    pending = [value]
    while pending:
        one = pending.pop()
        if isinstance(one, list):
            pending += one[::-1]
        elif isinstance(one, str | Summary):
            yield one


def item_texts(value) -> list[str]:
    """Item texts of a parsed value: trimmed texts, and those of its objects."""
    texts = []
    for one in opened(value):
        texts += one.items if isinstance(one, Summary) else filter(None, [one.strip()])
    return texts


def summariser(label: str) -> Callable[[dict], Summary]:
    """Decoder hook: objects are reduced from the innermost outwards, so no tree is kept or walked."""

    def first_text(fields: dict, keys: list[str]) -> str:
        return next((fields[k] for k in keys if isinstance(fields.get(k), str)), "")

    def summary(fields: dict) -> Summary:
        nested = item_texts([fields.get(k) for k in NESTED_KEYS])
        labelled = nested.copy() if first_text(fields, HEADING_KEYS).strip().lower() == label else []
        for one in opened(list(fields.values())):
            labelled += one.labelled if isinstance(one, Summary) else []
        return Summary(nested or item_texts([v for k in NAME_KEYS if isinstance(v := fields.get(k), str)])[:1], labelled)

    return summary


def labelled_items(label: str):
    """Arrow UDF over arrays of JSON texts: the first is searched for ``label``, the others are item lists.

    Depth is unbounded, which column functions cannot follow. NULL texts cost nothing, so callers
    pass only the texts that can contain the label.
    """

    @F.arrow_udf("array<array<string>>")
    def read(column: pa.Array) -> pa.Array:
        decode = json.JSONDecoder(object_hook=summariser(label)).decode

        def found(place: int, text: str | None) -> list[str]:
            value = None if text is None else decode(text)
            if place > 0:
                return item_texts(value)
            return [t for one in opened(value) if isinstance(one, Summary) for t in one.labelled]

        rows = ([found(i, t) for i, t in enumerate(texts or [])] for texts in column.to_pylist())
        return pa.array(list(rows), pa.list_(pa.list_(pa.string())))

    return read


def first_non_empty(lists: Column) -> Column:
    """The first list with any element."""
    return F.get(F.filter(lists, lambda x: F.coalesce(F.size(x), F.lit(0)) > 0), F.lit(0))

