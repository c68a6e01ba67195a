"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Bytes of text that one partition takes before its words become rows.
TEXT_BYTES = 8 << 20

# Frames kept in the innermost open scope; None outside of all scopes.
_SCOPE: ContextVar[list[DataFrame] | None] = ContextVar("larkspur_scope", default=None)


def build_session(app_name: str = "larkspur", master: str | None = None,
                  **conf: object) -> SparkSession:
    """A session with adaptive execution and skew handling on.

    Shuffle partition counts are left to the cluster's own settings unless given
    in ``conf`` (keys with ``__`` in place of dots).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def text_parts(df: DataFrame, text: str) -> int:
    """How many partitions the ``text`` of all rows needs at ``TEXT_BYTES`` each, a task for every
    core at least. The sizes are summed up in a read of their own."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TEXT_BYTES))


def dealt(df: DataFrame, key: str, text: str) -> DataFrame:
    """The rows placed by ``key`` in as many partitions as their ``text`` needs at ``TEXT_BYTES`` each.

    What becomes of a text in a task takes many times its size, so partitions are not joined up to
    the size that suits plain rows.
    """
    return df.repartition(text_parts(df, text), key)


def shared_folder(spark: SparkSession) -> str | None:
    """The folder the cluster names in ``spark.checkpoint.dir``, if it names one."""
    context = spark.sparkContext
    folder = (context.getCheckpointDir() or context.getConf().get(CHECKPOINT_DIR)
              or spark.conf.get(CHECKPOINT_DIR, None))
    if folder and not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def _owned(kept: DataFrame) -> DataFrame:
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(kept)
    return kept


@contextmanager
def frames_released() -> Iterator[list[DataFrame]]:
    """Own every frame that is kept inside the block, and release all of them at its end.

    A frame that is returned reads kept ones only when it is worked out, so the block has to
    hold that work, too: write or collect the result inside. The list shows what is kept at a time.
    Scopes can be nested; each owns what is kept directly in it. Checkpoint files are left to
    ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    kept: list[DataFrame] = []
    token = _SCOPE.set(kept)
    try:
        yield kept
    finally:
        for frame in reversed(list(kept)):
            release(frame)
        _SCOPE.reset(token)


def stable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, keeping partitions and row order.

    Used where row positions must not change if an executor is lost and its tasks run
    again. Without a shared folder the frame is persisted: a lost block is computed again
    from the same plan with the same range bounds, so under a unique order the rows come
    back in the same places.
    """
    if shared_folder(df.sparkSession):
        return df.checkpoint(eager=True)
    return _owned(df.persist())


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it from there.

    Used where several later steps read the same rows: each reads only its columns and
    row groups, and join strategies are chosen from the real size of the files. The
    table belongs to the scope it was stored in (:func:`frames_released`); outside of one, whoever
    owns the folder decides when to empty it. Without a shared folder the frame is persisted.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not folder:
        return _owned(df.persist())
    path = f"{folder.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._larkspur_path = path
    return _owned(kept)


def materialised(df: DataFrame) -> DataFrame:
    """``stored``, and worked out now also where the frame is persisted."""
    kept = stored(df)
    if not hasattr(kept, "_larkspur_path"):
        kept.count()
    return kept


def release(kept: DataFrame) -> None:
    """Give up a frame that ``stored`` returned and that nothing will read any more: its table is
    deleted, or its blocks are freed. Frames derived from it must have been written themselves."""
    scope = _SCOPE.get()
    if scope is not None:
        scope[:] = [frame for frame in scope if frame is not kept]
    path = getattr(kept, "_larkspur_path", None)
    if path is None:
        kept.unpersist()
        return
    context = kept.sparkSession.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
