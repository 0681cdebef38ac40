"""Settings and code that a Spark session needs for this package."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings the record functions rely on: mainframe charsets, unmappable text replaced and so found, one time zone, and times of day.
SETTINGS = {"spark.sql.legacy.javaCharsets": "true", "spark.sql.legacy.codingErrorAction": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.timeType.enabled": "true"}

_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Set what the record functions rely on; a session may come from anywhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once for each application, so that their Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="tapelake-")) / "tapelake.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark


def scratch(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, a run on one machine (a local master) gets a temporary folder; a cluster gets an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; it names the folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tapelake-")
    return f"{root}/{uuid.uuid4().hex}"
