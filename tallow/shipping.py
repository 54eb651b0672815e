"""Makes this package importable in Python workers, wherever the driver was started."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's source to the executors of this application, once."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(root.rglob("*")):
            if source.suffix in (".py", ".yaml"):
                z.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
