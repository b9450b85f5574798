"""Session helpers: a local session for tests and benches, and the shared scratch root.

Library code never creates its own session; callers pass one in. Everything that
has to outlive a task (raw layer, staged tables, stream checkpoints) goes under
the folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings the shaping operators rely on (also applied by ``ensure_json_semantics``).
JSON_CONF = {
    # JSON objects with a repeated key keep the last value, as Python's json does.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tributary",
                  extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and ``bench.py`` (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**JSON_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_json_semantics(spark: SparkSession) -> None:
    for k, v in JSON_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def shared_root(spark: SparkSession) -> str:
    """The shared folder for durable intermediate data.

    Read from ``spark.checkpoint.dir`` (or a checkpoint dir set on the context).
    Where neither is set a local session (one machine, as in tests) gets a fresh
    temporary folder; any other master raises.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tributary-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``tributary`` importable in Python workers (``addPyFile`` of a zip), once
    per application — needed where code runs in Python workers (the REST reader)."""
    sc = spark.sparkContext
    with _SHIP_LOCK:
        if sc.applicationId in _SHIPPED:
            return
        submitted = sc.getConf().get("spark.submit.pyFiles", "") or ""
        if "tributary" in submitted:  # already shipped with --py-files
            _SHIPPED.add(sc.applicationId)
            return
        import tributary

        pkg = os.path.dirname(os.path.abspath(tributary.__file__))
        # a unique archive name, so it never clashes with a file the user added
        target = os.path.join(tempfile.mkdtemp(prefix="tributary-pyfiles-"),
                              f"tributary_pkg_{uuid.uuid4().hex[:8]}")
        archive = shutil.make_archive(target, "zip", root_dir=os.path.dirname(pkg), base_dir="tributary")
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)


def local_path(path: str) -> str:
    """A shared-root path as a local filesystem path (only for ``file:`` roots)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    if ":" in path.split("/", 1)[0]:
        raise ValueError(f"not a local path: {path}")
    return path


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names under ``path`` on whatever filesystem it is on; none if it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on whatever filesystem it lives on (Hadoop API)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.delete(p, True))
