"""Comparison only: the cell column made by a Python function per row instead of a native expression.

Everything after the cell column is the library's own plan, so the difference
in time is that of the function alone.  Never used by the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.operators.enrich import cell_column


@F.udf("long")
def cell_of(lat, lng):
    """Packed cell id of precision 4: ten bits an axis."""
    if lat is None or lng is None or not -90 <= lat <= 90 or not -180 <= lng <= 180:
        return None
    row, column = (min(1023, int((v - low) / step)) for v, low, step in ((lat, -90.0, 180 / 1024), (lng, -180.0, 360 / 1024)))
    return row << 10 | column


def with_python_cells(df: DataFrame) -> DataFrame:
    return df.withColumn(cell_column(4), cell_of("lat", "lng"))
