"""Order of extraction stamps, one rule for folders, rows and marks.

A stamp is text.  Stamps of digits alone compare as numbers, whatever their width and leading
zeros; others compare as text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits up to which a stamp is a number.
WIDTH = 40
_DIGITS = f"^[0-9]{{1,{WIDTH}}}$"


def stamp_key(stamp: object) -> str:
    """What to compare instead of a stamp."""
    text = str(stamp)
    return text.zfill(WIDTH) if re.match(_DIGITS, text) else text


def stamp_order(stamp: Column) -> Column:
    """The same for a column."""
    return F.when(stamp.rlike(_DIGITS), F.lpad(stamp, WIDTH, "0")).otherwise(stamp)
