"""Functions for Python workers on machines that do not have this package."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).parent


def ship(spark: SparkSession) -> None:
    """Sends this package to every executor, once an application, through Spark's own file server."""
    sc = spark.sparkContext
    if getattr(sc, "_pluvio_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="pluvio-package-")) / f"{PACKAGE.name}.zip"  # the driver's own copy, served from here
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(PACKAGE.rglob("*.py")):
            z.write(source, source.relative_to(PACKAGE.parent))
    sc.addPyFile(str(archive))
    sc._pluvio_shipped = True


def portable(f: Callable) -> Callable:
    """``f`` for workers of the active session, after its package has been sent to them."""
    ship(SparkSession.getActiveSession())
    return f
