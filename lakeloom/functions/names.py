"""Column names and the all-strings form of bronze tables."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType, VariantType

from lakeloom.constants import UNCLEAN_NAME_CHARACTERS
from lakeloom.functions import named

NESTED = (ArrayType, MapType, StructType, VariantType)


def require_distinct(names: list[str]) -> None:
    twice = sorted(n for n, k in Counter(n.lower() for n in names).items() if k > 1)
    if twice:
        raise ValueError(f"More than one column would be called {twice}.")


def clean_name(name: str) -> str:
    """Dots become underscores; anything but letters, digits and underscores goes."""
    return re.sub(UNCLEAN_NAME_CHARACTERS, "", name.replace(".", "_"))


def clean_names(df: DataFrame) -> DataFrame:
    names = [clean_name(n) for n in df.columns]
    if nameless := [old for old, new in zip(df.columns, names) if not new]:
        raise ValueError(f"Nothing would be left of the names {nameless}.")
    require_distinct(names)
    return df.toDF(*names)


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text: nested ones as JSON, the others by cast."""
    return df.select(
        *[
            (
                F.to_json(named(f.name))
                if isinstance(f.dataType, NESTED)
                else named(f.name).cast(StringType())
            ).alias(f.name)
            for f in df.schema.fields
        ]
    )
