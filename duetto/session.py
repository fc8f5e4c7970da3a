"""Session helpers: local sessions for tests/bench, checkpoint directory,
lineage cuts and size-checked broadcasts.

On a cluster the checkpoint directory is whatever the cluster names in
``spark.checkpoint.dir`` (a shared, fault-tolerant folder).  We only pick our
own folder when none is configured, which happens in local tests and in the
driver's smoke runs.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Broadcast budget used when the session has no (or a disabled) auto threshold.
_DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "duetto") -> SparkSession:
    """A local session configured like the test/bench harness."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The configured checkpoint directory, or None."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return conf or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; create a scratch one only if unset.

    A cluster sets ``spark.checkpoint.dir`` to a shared folder; local runs
    (tests, bench, smoke checks) get a fresh folder under the temp dir.  Without
    either, this raises: other machines would not see a local folder.
    """
    d = checkpoint_dir(spark)
    if d is None:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set for the cluster {master}")
        d = tempfile.mkdtemp(prefix="duetto-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


#: Rows of one file of a written table, or of one task, whose size is known.
ROWS_PER_FILE = 500_000


def row_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for ``rows`` rows of which a task sorts or groups its own: what it
    holds does not grow with the table."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_FILE))


def few_partitions(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, in no more partitions than there are cores or
    than these rows need, whatever the number of shuffle partitions is."""
    return df.coalesce(row_partitions(df.sparkSession, rows))


class Tables:
    """Written tables of one run, in a folder in the shared checkpoint folder.

    A loop that cuts its lineage this way also starts anew from measured sizes,
    where a checkpoint would keep estimates that grow with every join.  With a
    ``name`` of its own the folder outlives the driver: notes written there say from
    where a new one goes on.
    """

    def __init__(self, spark: SparkSession, stem: str, name: str | None = None):
        self.spark = spark
        self.folder = os.path.join(ensure_checkpoint_dir(spark), name) if name else scratch_path(spark, stem)
        self.paths: dict[str, str] = {}
        self.count = 0

    def put(self, name: str, df: DataFrame, rows: int | None = None) -> DataFrame:
        """``df`` written and read back; what ``name`` was before is deleted then.
        Of at most ``rows`` rows, no more files are made than their number asks for."""
        self.count += 1
        df = df if rows is None else few_partitions(df, rows)
        path, old = f"{self.folder}/{name}-{self.count}-{uuid.uuid4().hex[:8]}", self.paths.get(name)
        df.write.parquet(path)
        self.paths[name] = path
        if old:
            self.forget(old)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                self.forget(self.paths.pop(name))

    def forget(self, path: str) -> None:
        """Deletes one table."""
        fs, where = self._file_system(path)
        fs.delete(where, True)

    def note(self, number: int, text: str) -> None:
        """Writes an ASCII note: whole under its number or not at all."""
        fs, draft = self._file_system(f"{self.folder}/note-{uuid.uuid4().hex}.tmp")
        out = fs.create(draft, True)
        out.writeBytes(text)
        out.close()
        _, final = self._file_system(f"{self.folder}/note-{number:09d}")
        fs.delete(final, False)
        if not fs.rename(draft, final):
            raise OSError(f"{final} can't be written")

    def last_note(self) -> str | None:
        """The note with the largest number, if there is one."""
        fs, where = self._file_system(self.folder)
        found = fs.globStatus(self._file_system(f"{self.folder}/note-?????????")[1]) if fs.exists(where) else None
        paths = sorted(f.getPath().toString() for f in found or [])
        return self.spark.read.text(paths[-1], wholetext=True).first()[0] if paths else None

    def _file_system(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where


def cut_lineage(df: DataFrame, keep_layout: bool = False) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder.

    Reliable checkpoints survive executor loss (unlike local checkpoints).
    With ``keep_layout`` the checkpoint also records the plan's hash
    partitioning and sort order, so later rounds reuse them without a new
    exchange or sort.  An adaptive plan reports its layout as unknown, so
    adaptive execution is switched off for the duration of this one
    materialisation (a repartition + local sort gains nothing from it) and
    restored right after.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not keep_layout:
        return df.checkpoint(eager=True)
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set(key, before)


# Edge rows per partition of a laid-out edge table (~25 MB of 4-column rows, about
# 80 MB while a task sorts them).
EDGES_PER_PARTITION = 1_000_000


def layout_partitions(spark: SparkSession, n_rows: int) -> int:
    """Partitions for a laid-out table of ``n_rows``: enough to keep each
    partition near ``EDGES_PER_PARTITION`` rows, never fewer than the
    cluster's default parallelism (so every core gets work)."""
    cores = spark.sparkContext.defaultParallelism
    return max(cores, -(-n_rows // EDGES_PER_PARTITION))


def pin_layout(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` with its layout, then keep a cached copy for reuse.

    The loops read the same laid-out edges every round.  The checkpoint is
    the fault-tolerant copy (a lost cache block is rebuilt from it, not from
    the lineage); the memory-and-disk cache saves decoding the checkpoint
    files every round.  The cached plan keeps the checkpoint's partitioning
    and ordering.  Call ``unpersist()`` when the loop is done.
    """
    return cut_lineage(df, keep_layout=True).persist(StorageLevel.MEMORY_AND_DISK)


def compacted(live: DataFrame, old: DataFrame) -> DataFrame:
    """``live``, rows of the laid-out ``old``, pinned in its place (layout kept)."""
    new = pin_layout(live)
    new.count()         # filled from the checkpoint before the old copy goes
    old.unpersist()
    return new


def broadcast_budget(spark: SparkSession) -> int:
    """Bytes we allow to broadcast: the session's auto threshold if enabled."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(_DEFAULT_BROADCAST_BYTES))
    return max(0, byte_size(raw))


def byte_size(text: str) -> int:
    """A size as Spark writes it: digits and an optional binary unit (b, k, m, g,
    t, p, each with or without a b); without a unit, bytes."""
    m = re.fullmatch(r"\s*(-?\d+)\s*(?:([kmgtp])b?|b)?\s*", str(text).lower())
    if not m:
        raise ValueError(f"not a size in bytes: {text!r}")
    return int(m[1]) * 1024 ** ("kmgtp".index(m[2]) + 1 if m[2] else 0)


def fits_broadcast(spark: SparkSession, max_rows: int, row_bytes: int = 32) -> bool:
    """Whether ``max_rows`` rows of ``row_bytes`` fit the broadcast budget."""
    budget = broadcast_budget(spark)
    return bool(budget) and max_rows * row_bytes <= budget


def bounded_broadcast(df: DataFrame, max_rows: int, row_bytes: int = 32) -> DataFrame:
    """Broadcast ``df`` only if ``max_rows`` (a proven upper bound on its row
    count) times ``row_bytes`` fits in the broadcast budget.

    Beyond the budget the frame is returned with a ``shuffle_hash`` hint, so
    the planner shuffles this (small) side to the big side's partitioning
    instead of sorting the big side.
    """
    if fits_broadcast(df.sparkSession, max_rows, row_bytes):
        return F.broadcast(df)
    return df.hint("shuffle_hash")


def counted_broadcast(df: DataFrame, row_bytes: int = 32) -> DataFrame:
    """Like :func:`bounded_broadcast` but the bound is measured (one count).

    Use on frames that were just materialised, where counting is cheap.
    """
    budget = broadcast_budget(df.sparkSession)
    if not budget:
        return df.hint("shuffle_hash")
    limit = budget // row_bytes
    n = df.limit(limit + 1).count()
    return bounded_broadcast(df, n, row_bytes)
