"""Session defaults and the shared scratch folder.

Scratch data (staged tables, stream checkpoints, lineage cuts) always goes under
``spark.checkpoint.dir``, which a cluster points at storage every executor can reach.  Only a
local session that leaves the setting empty gets a temporary folder of its own.
"""

import contextlib
import contextvars
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Folders that were staged inside the ``scratch`` blocks of this thread, outermost block first.
_scratch = contextvars.ContextVar("scratch", default=())


def build_session(app_name="starsync", master=None, **conf):
    """A session with the settings the plans in this package are written for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` under the shared checkpoint folder of the session."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster is a cluster
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="starsync-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by=None, keep=False) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage with a table in shared storage, so that several consumers read the same
    rows (also after an executor is lost) and still get column pruning and filter pushdown.  A table
    to ``keep`` outlives the innermost ``scratch`` block.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    blocks = _scratch.get()[:-1] if keep else _scratch.get()
    if blocks:
        blocks[-1].append(path)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Delete what is staged inside this block when it ends: for steps whose result does not read it."""
    paths = []
    token = _scratch.set((*_scratch.get(), paths))
    try:
        yield
    finally:
        _scratch.reset(token)
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run_all(tasks, at_once=8) -> list:
    """Submit independent Spark jobs together, so that small ones fill the gaps of large ones."""
    tasks = list(tasks)
    if len(tasks) < 2:
        return [task() for task in tasks]
    with ThreadPoolExecutor(min(at_once, len(tasks))) as pool:
        inherit = inheritable_thread_target(SparkSession.active())
        futures = [pool.submit(contextvars.copy_context().run, inherit(task)) for task in tasks]
        return [f.result() for f in futures]
