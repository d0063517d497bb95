"""Column expressions and projections; nothing here shuffles."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column called exactly ``name``, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")
