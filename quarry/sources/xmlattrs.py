"""``<row K="v" .../>`` attribute lines -> typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scan_xml_attrs(lines: DataFrame, schema: str, col: str = "value") -> DataFrame:
    """Parse each line as one XML element; attributes arrive as ``_Name``.

    ``from_xml`` in PERMISSIVE mode gives nulls for a row it cannot read,
    so unparsable rows fall out at the first null filter downstream.
    """
    parsed = lines.select(F.from_xml(F.col(col), schema).alias("r"))
    return parsed.select("r.*")
