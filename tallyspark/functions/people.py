"""Normalised personal and team names."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship


def normalise(name: str | None) -> str | None:
    """Without accents and marks, lower case, words parted by one blank; null if nothing is left."""
    if name is None:
        return None
    flat = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c)).lower()
    return re.sub(r"[^a-z0-9]+", " ", flat).strip() or None


@F.arrow_udf(T.StringType())
def _normalised(names: pa.Array) -> pa.Array:
    coded = names.dictionary_encode()
    words = pa.array([normalise(n) for n in coded.dictionary.to_pylist()], pa.string())
    return words.take(coded.indices)


def normalised_name(name: Column) -> Column:
    ship()
    return _normalised(name)


def surname(normalised: Column) -> Column:
    return F.element_at(F.split(normalised, " "), -1)


def first_name(normalised: Column) -> Column:
    return F.element_at(F.split(normalised, " "), 1)


def first_initial(normalised: Column) -> Column:
    return F.substring(normalised, 1, 1)
