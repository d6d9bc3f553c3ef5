"""Landed messages kept whole, and what in them differs from the expected shape.

A message is stored as a VARIANT beside the columns that are read from it: a field that a feed
adds is there when it is wanted, without the feed being fetched again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NumericType, StringType, StructType, _parse_datatype_string

DOCUMENTS = "symbol string, document variant"
ANY = "other"
#: kinds of the types in which Spark writes a document's shape
KINDS = {"BIGINT": "number", "DOUBLE": "number", "FLOAT": "number", "DECIMAL": "number", "STRING": "text", "BOOLEAN": "truth"}
_TOKEN = re.compile(r"`((?:[^`]|``)*)`: |([^<>,:`]+): |(OBJECT<|ARRAY<)|(>)|(, )|([A-Z]+(?:\([0-9,]*\))?)")


def documents(messages: DataFrame) -> DataFrame:
    """``symbol, message`` with the message parsed whole as ``document``; null where it is no JSON."""
    return messages.select("symbol", F.try_parse_json("message").alias("document"))


def shape(text: str) -> dict[str, str]:
    """The kind of value at each path of a shape as ``schema_of_variant`` writes it.

    Paths are JSON paths: ``$.prices[*].date``. Values that are null everywhere have no kind.
    """
    found: dict[str, str] = {}
    stack: list[tuple[str, str]] = []  # (path, kind) of what is open
    path = "$"
    for quoted, name, opens, closes, comma, scalar in _TOKEN.findall(text):
        if quoted or name:
            path = f"{stack[-1][0]}.{(quoted or name).replace('``', '`')}"
        elif opens:
            kind = "object" if opens == "OBJECT<" else "list"
            found[path] = kind
            stack.append((path, kind))
            path = path + "[*]" if kind == "list" else path
        elif closes:
            stack.pop()
        elif scalar and scalar != "VOID":
            found[path] = KINDS.get(scalar.split("(")[0], ANY)
    return found


def expected_shape(schema: str | DataType) -> dict[str, str]:
    """The kind of value at each path of a schema in DDL."""

    def walk(path: str, of: DataType) -> Iterator[tuple[str, str]]:
        if isinstance(of, StructType):
            yield path, "object"
            for field in of.fields:
                yield from walk(f"{path}.{field.name}", field.dataType)
        elif isinstance(of, ArrayType):
            yield path, "list"
            yield from walk(path + "[*]", of.elementType)
        else:
            kinds = ((NumericType, "number"), (StringType, "text"))
            yield path, next((kind for known, kind in kinds if isinstance(of, known)), "truth")

    return dict(walk("$", _parse_datatype_string(schema) if isinstance(schema, str) else schema))


def differences(found: dict[str, str], expected: dict[str, str]) -> list[tuple[str, str]]:
    """(path, problem): fields that are not expected, without those inside them, and other kinds."""
    unknown = [p for p in found if p not in expected]
    inside = {p for p in unknown if any(p.startswith((f"{q}.", f"{q}[")) for q in unknown)}
    inside |= {p for p in unknown for q, kind in found.items() if q in expected and kind != expected[q] and p.startswith((f"{q}.", f"{q}["))}
    new = [(p, "unknown field") for p in unknown if p not in inside]
    return new + [(p, f"{kind} instead of {expected[p]}") for p, kind in found.items() if p in expected and kind != expected[p]]


def drift(landed: DataFrame, schema: str) -> DataFrame:
    """``path``, ``problem``, ``messages``: how many documents differ from ``schema``, by path.

    Documents are first counted by shape, of which there are few, in the JVM; shapes are then
    compared by all tasks. Documents that were no JSON are counted under ``$``. Elements
    of a list are looked at together, so that a field some of them lack is no difference.
    """
    expected = json.dumps(expected_shape(schema))
    shapes = landed.groupBy(F.schema_of_variant("document").alias("shape")).agg(F.count("*").alias("n"))

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = json.loads(expected)
        for batch in batches:
            rows = [
                (path, problem, n)
                for text, n in zip(batch["shape"], batch["n"])
                for path, problem in ([("$", "unreadable message")] if text is None else differences(shape(text), known))
            ]
            yield pd.DataFrame(rows, columns=["path", "problem", "n"])

    every = shapes.mapInPandas(compared, "path string, problem string, n bigint")
    return every.groupBy("path", "problem").agg(F.sum("n").alias("messages"))
