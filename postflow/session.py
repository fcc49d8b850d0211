"""Session helpers: a tuned SparkSession for local runs and a shared scratch area.

On a cluster the caller owns the session; the library only reads settings from it.
``shared_dir`` resolves the cluster-wide folder named by ``spark.checkpoint.dir``
(never a machine-local temp folder) and only invents one when the setting is
absent, as in unit tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings applied by ``build_session``. They are defaults: anything the caller
# already set (spark-defaults.conf, --conf) wins.
SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "postflow",
                  input_bytes: int | None = None, slots: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session; library defaults fill in what the caller has
    not set. With ``input_bytes`` and ``slots`` the shuffle sizes come from
    ``sizing``; ``extra`` is set in any case."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if input_bytes and slots:
        conf.update(sizing(input_bytes, slots))
    active = SparkSession.getActiveSession()
    own = active.conf.getAll if active else dict(SparkConf().getAll())
    conf = {k: v for k, v in conf.items() if k not in own}
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


# State of long joins: RocksDB with change logs, small write buffers, blocks that compress well, no room set aside on
# disk, one store for both sides of a join.
STATE_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass": SESSION_DEFAULTS["spark.sql.streaming.stateStore.providerClass"],
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "16",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "16",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
# A query that takes what is there and stops has too few batches for its change logs to be merged: snapshots without
# dropped rows in their place, the last two versions, no shuffle kept beyond its batch, and the stores of ended queries
# (a copy of the state on the executors' disks) closed soon. Not by unloadOnCommit: in Spark 4.1 that neither closes
# nor tidies the stores of a join.
DRAIN_SETTINGS = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.ratioExtraSpaceAllowedInCheckpoint": "0",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
STATE_OURS = "spark.postflow.stateSettings"     # the settings that use_state_on_disk has made in a session


def use_state_on_disk(spark: SparkSession) -> None:
    """Keep stream state in RocksDB instead of the executors' heaps; to be called before a query
    starts. What the caller has set wins, and a query that goes on from an old checkpoint keeps its store."""
    own = spark.conf.getAll
    provider = "spark.sql.streaming.stateStore.providerClass"
    if own.get(provider, STATE_DEFAULTS[provider]) != STATE_DEFAULTS[provider]:
        return                                            # one store for a join needs RocksDB
    new = [k for k in STATE_DEFAULTS if k not in own]
    for k in new:
        spark.conf.set(k, STATE_DEFAULTS[k])
    spark.conf.set(STATE_OURS, ",".join([x for x in own.get(STATE_OURS, "").split(",") if x] + new))


@contextmanager
def drain_settings(spark: SparkSession, trigger: str | None):
    """Inside, a query started with ``trigger`` availableNow gets ``DRAIN_SETTINGS`` (it keeps what holds at its start),
    in a session whose state is on disk by ``use_state_on_disk``. What the caller has set wins."""
    own = spark.conf.getAll
    ours = own.get(STATE_OURS, "").split(",")
    drains = trigger == "availableNow" and STATE_OURS in own
    new = {k: v for k, v in DRAIN_SETTINGS.items() if drains and (k not in own or k in ours)}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in new:
            spark.conf.set(k, own[k]) if k in own else spark.conf.unset(k)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir``. Only a session whose executors run in this
    process (``local``, as in tests) may leave it unset: it gets a fresh folder
    below the system temp dir. On a cluster such a folder would be another one
    on every machine, so there a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="postflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder; a fresh leaf per call by default."""
    root = checkpoint_root(spark).rstrip("/")
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    path = "/".join([root, "postflow", *leaf])
    if _file_system(spark, path).getScheme() == "file":      # Spark's writers make remote folders
        os.makedirs(path.removeprefix("file://").removeprefix("file:"), exist_ok=True)
    return path


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme by which Spark would open it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return _file_system(spark, path).makeQualified(at).toString()


def stored_whole(spark: SparkSession, path: str) -> bool:
    """Whether a finished write lies at ``path``: data files, and no writer's ``_temporary`` left."""
    fs, at = _file_system(spark, path), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return "_temporary" not in names and any(not n.startswith(("_", ".")) for n in names)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below a path of any file system Spark reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return int(_file_system(spark, path).getContentSummary(at).getLength())


def file_count(spark: SparkSession, path: str) -> int:
    """Number of files below a path (0 if there is none) of any file system Spark reads."""
    fs, at = _file_system(spark, path), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return int(fs.getContentSummary(at).getFileCount()) if fs.exists(at) else 0


def apply_sizing(spark: SparkSession, input_bytes: int, slots: int) -> None:
    """Set ``sizing`` on a running session, but for what its caller has set."""
    own = spark.conf.getAll
    for k, v in sizing(input_bytes, slots).items():
        if k not in own:
            spark.conf.set(k, v)


def sizing(input_bytes: int, slots: int) -> dict[str, str]:
    """Shuffle sizing from the input size and the cluster's task slots.

    Target partition = input / (16 x slots), clamped to [64 KB, 256 MB]: at
    100 TB on 8,000 slots that is 256 MB partitions; on a laptop-sized input
    it keeps every core busy instead of letting AQE merge a few MB of shuffle
    into one task. The initial partition count is one per 256 MB of input
    (at least ``slots``, at most 100,000); AQE coalesces down from there.
    """
    if input_bytes <= 0 or slots <= 0:
        raise ValueError("sizing needs the input's size and the number of slots")
    kb, mb = 1024, 1024 * 1024
    target = max(64 * kb, min(256 * mb, input_bytes // max(1, 16 * slots)))
    parts = max(slots, -(-input_bytes // (256 * mb)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(max(64 * kb, target // 4)),
        "spark.sql.files.maxPartitionBytes": str(max(8 * mb, min(256 * mb, 4 * target))),
    }


def folder_bytes(path: str) -> int:
    """Total size of the files below a local folder, before there is a session
    (``path_bytes`` measures any path)."""
    if not os.path.isdir(path):
        raise ValueError(f"{path} is no local folder; use path_bytes")
    total = 0
    for dirpath, _, files in os.walk(path):
        total += sum(os.path.getsize(os.path.join(dirpath, f)) for f in files)
    return total
