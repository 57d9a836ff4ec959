"""Whole texts as single JSON objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_array(text: Column, schema: str) -> Column:
    """Parse JSON object text as the only element of an array.

    The array has another length, or is NULL, for text that is no single JSON object. That also
    refuses text that goes on after the object, which ``from_json`` on the object alone
    would pass over.
    """
    return F.when(F.rtrim(text).endswith("}"),
                  F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{schema}>"))
