"""Reading lists of facts out of a model's answer."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Quotation marks read as plain ones, list markers, and what is cut off at the ends.
QUOTES = str.maketrans(dict.fromkeys("«»„“”", '"'))
MARKERS = "-*•0123456789. \t"
EDGES = "\"',.;:[]() \t"
MIN_RUNES = 8

QUOTED = re.compile(r'"((?:[^"\\]|\\.)*)"', re.S)
FENCE = "`" * 3


def unfenced(answer: str) -> str:
    """The answer without a code fence around it."""
    answer = answer.strip()
    if not answer.startswith(FENCE):
        return answer
    _, newline, rest = answer.partition("\n")
    return (rest if newline else answer).strip().removesuffix(FENCE)


def tidy(items: list[str]) -> list[str]:
    """Items without list markers and edge punctuation; short ones, ones without a letter and repeats (ignoring case) go."""
    kept: dict[str, str] = {}
    for item in items:
        fact = item.strip().lstrip(MARKERS).strip(EDGES).strip()
        if len(fact) >= MIN_RUNES and any(c.isalpha() for c in fact):
            kept.setdefault(fact.lower(), fact)
    return list(kept.values())


def parse_list(answer: str | None) -> list[str]:
    """A JSON array of strings if there is one, else all quoted strings, else the lines."""
    text = unfenced(answer or "").translate(QUOTES)
    opening, closing = text.find("["), text.rfind("]")
    if 0 <= opening < closing:
        try:
            items = json.loads(text[opening : closing + 1])
        except ValueError:
            items = None
        if isinstance(items, list) and all(x is None or isinstance(x, str) for x in items):
            return tidy([x or "" for x in items])
    return tidy(QUOTED.findall(text) or text.split("\n"))


def _parsed(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The last column's answers as lists, in runs of rows that begin within the same ``size`` bytes of answers."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        begins = (np.cumsum(lengths) - lengths) // size
        cuts = [0, *(np.flatnonzero(np.diff(begins)) + 1).tolist(), batch.num_rows]
        for at, to in zip(cuts, cuts[1:], strict=False):
            *others, answers = batch.slice(at, to - at).columns
            yield pa.RecordBatch.from_arrays([*others, pa.array([parse_list(x) for x in answers.to_pylist()], pa.list_(pa.string()))], names=batch.schema.names)


def parse_lists(rows: DataFrame, answer: str, name: str) -> DataFrame:
    """``rows`` with the facts of the answers in column ``answer`` as ``name`` in its place, at the end; none for null.

    A worker holds one Arrow batch, to which Spark gives 64 MB and the row that
    exceeds them, and strings of about 1 MB of it or of one longer row.
    """
    others = rows.drop(answer)
    schema = StructType([*others.schema.fields, StructField(name, ArrayType(StringType()))])
    return rows.select(*others.columns, answer).mapInArrow(_parsed, schema)


def fact_key(text: Column) -> Column:
    """What makes two facts the same."""
    return F.lower(F.trim(text))
