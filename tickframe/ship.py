"""Make the package importable in Python workers that were not started beside it, and keep these small."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that a worker is given at once, where the session has Spark's own 10,000: texts can be long, and
#: a worker holds several columns made from each.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Send the package to all workers, once per application, and bound the rows of an Arrow batch."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tickframe-"), "tickframe.zip")
    with zipfile.ZipFile(target, "w") as z:
        for place, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(place, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _sent.add(app)
