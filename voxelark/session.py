"""Session settings the engine is tuned for."""

from __future__ import annotations

import tempfile
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _package() -> str:
    """This package as a zip file, for Python workers that don't find it on their path."""
    folder = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="voxelark-")) / "voxelark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(folder.rglob("*.py")):
            out.write(source, source.relative_to(folder.parent))
    return str(archive)


def build_session(app: str = "voxelark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with AQE, skew-join handling and UTC timestamps switched on, and this package on its workers.

    On a cluster leave ``master`` unset and let spark-submit supply it together
    with ``spark.checkpoint.dir`` (a shared folder every executor can reach).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.addPyFile(_package())
    return session
