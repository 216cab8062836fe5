"""Session helpers.

On a cluster the session is created by the platform; these helpers only fill
in settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings the library relies on for correct results (UTC wall clock) and for
# plans that survive skew (AQE with skew-join splitting).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "pasture",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; cluster jobs use their own."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "10g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, resolved by Hadoop's default file system; ``file:/x`` becomes ``file:///x``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString()
    return re.sub(r"^([a-zA-Z][\w+.-]*):/(?!/)", r"\1:///", uri).rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, as a URI.

    A cluster names a shared, durable folder in ``spark.checkpoint.dir`` or on the context; neither is ever replaced.
    Where both are unset, a session in local mode gets a fresh scratch folder, kept on its context; any other session
    is refused, since its executors would not see a folder of this machine.
    """
    sc = spark.sparkContext
    here = sc.getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None) or here
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("name a folder that driver and executors share in spark.checkpoint.dir")
        d = tempfile.mkdtemp(prefix="pasture-ckpt-")
    if not here:
        sc.setCheckpointDir(d)
    return _qualified(spark, d)


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the settings the library needs on an existing session (UTC) and ship the package."""
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, _DEFAULTS[k])
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pasture`` importable in executor Python workers (``mapInPandas`` solvers).

    The package is zipped once per driver process and added with ``addPyFile``,
    which distributes it to every executor of the application.
    """
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="pasture-pyfiles-"), "pasture.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            if "__pycache__" in root:
                continue
            for f in files:
                if f.endswith((".py", ".yaml")):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
