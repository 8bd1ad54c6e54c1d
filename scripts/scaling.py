"""Scaling check: the enrichment on growing inputs, its cells as expressions or by a Python function per row.

Usage: python scripts/scaling.py [sf_dir] [factor ...]

Observations are derived from the ``events`` table by Spark itself: each
event is fanned out ``factor`` times (``explode(sequence)``) with new ids,
which feed the same coordinate formula as the ``observations`` view.  Each
run goes through the noop sink.  Prints one JSON line per factor.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from geoweave.operators.enrich import enrich  # noqa: E402
from geoweave.session import get_session  # noqa: E402
from geoweave.sources import testdata as td  # noqa: E402
from scripts.python_cells import with_python_cells  # noqa: E402


def fanned_observations(spark, sf: str, factor: int):
    # the source is one small file: spread its rows over the cores before fanning out
    e = td.table(spark, sf, "events").repartition(spark.sparkContext.defaultParallelism)
    k = F.col("event_id") * factor + F.col("rep")
    return e.select("*", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("rep")).select(
        k.alias("event_id"),
        (F.lit(30.0) + (k * 6007 % 800).cast("double") / 100).alias("lat"),
        (F.lit(-10.0) + (k * 6011 % 997).cast("double") / 100).alias("lng"),
        (F.col("value") * 9 / 5 + 32).alias("avg_tmpr_f"), F.col("value").alias("avg_tmpr_c"),
        F.date_format("ts", "yyyy-MM-dd").alias("wthr_date"))


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and "/" in args[0] else "/root/testdata/sf0.1"
    factors = [int(a) for a in args if "/" not in a] or [1, 10, 100]
    spark = get_session("local[8]", "geoweave-scaling", shuffle_partitions=16,
                        conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    places = td.places(spark, sf)
    timed(enrich(places, fanned_observations(spark, sf, 1)))  # warm-up
    for f in factors:
        obs = fanned_observations(spark, sf, f)
        rows = td.table(spark, sf, "events").count() * f
        native = median(timed(enrich(places, obs)) for _ in range(3))
        udf = median(timed(enrich(with_python_cells(places), with_python_cells(obs))) for _ in range(3))
        print(json.dumps({"factor": f, "observations": rows, "native_sec": native, "python_cells_sec": udf,
                          "ratio": round(udf / native, 2)}))


if __name__ == "__main__":
    main()
