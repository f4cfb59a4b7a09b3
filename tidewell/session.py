"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the plans in this package rely on. AQE splits skewed join
# partitions; "force" keeps the split even where the join feeds a grouping on
# the same key, which is the usual shape here (join, then collapse).
# Wide projections (a feed has up to 60 columns) can make one generated method too
# long for the JVM to compile; above this many bytes Spark generates smaller ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}

def build_session(app: str = "tidewell", cores: int | str = "*", **extra: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                # Recording the Python line of every column costs more than building the plan.
                "spark.python.sql.dataFrameDebugging.enabled": "false", **SETTINGS, **extra}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that was made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster shares between its machines.

    ``spark.checkpoint.dir`` names it, or the folder the session was given by
    ``setCheckpointDir``. A machine-local folder is used only by a local session
    that has neither.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all machines")
        root = tempfile.mkdtemp(prefix="tidewell-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/tidewell-{uuid.uuid4().hex}"
