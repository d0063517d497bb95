"""The change hash of history tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.constants import HASH_BITS, HASH_NULL, HASH_SEPARATOR
from lakeloom.functions import named


def row_hash(columns: Sequence[str]) -> Column:
    """Hash of the tracked columns as text.  NULL has its own mark, so (NULL, 'a') and
    ('a', NULL) differ, and full builds agree with increments."""
    texts = [F.coalesce(named(c).cast("string"), F.lit(HASH_NULL)) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *texts), HASH_BITS)
