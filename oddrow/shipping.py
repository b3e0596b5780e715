"""Makes the package importable in Python workers, which run on other machines."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from oddrow.sources.storage import shared_folder, write_bytes

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package to the application's files, once; a no-op if it came with the submit."""
    context = spark.sparkContext
    home = Path(__file__).resolve().parent
    if context.applicationId in _shipped or not home.is_dir():
        return
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(home.rglob("*.py")):
            out.write(path, path.relative_to(home.parent))
    folder = f"{shared_folder(spark)}/oddrow-package-{context.applicationId}"
    context.addPyFile(write_bytes(spark, f"{folder}/oddrow.zip", archive.getvalue()))
    _shipped.add(context.applicationId)
