"""Cutting the plan between the steps of a long chain, and the life of the tables written for that."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# the scopes that are open, the innermost last: its folder, and lasting tables written within
_scopes: ContextVar[tuple[tuple[str, list[str]], ...]] = ContextVar("scopes", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one is made up only on a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="rollcall-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def files_at(spark: SparkSession, path: str):
    """The file system of a path and the path in its terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


@contextmanager
def setting(spark: SparkSession, name: str, value) -> Iterator[None]:
    """A setting of the session for what runs within; the session's own comes back at the end."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def compilable(spark: SparkSession):
    """What runs within keeps generated methods short enough for the JVM to compile.

    Steps over all columns of a sheet give methods beyond the 8,000 bytes up to which the JVM compiles, which then
    run interpreted; with this limit Spark runs such steps as several short methods.
    """
    return setting(spark, "spark.sql.codegen.hugeMethodLimit", 8000)


def shuffles_removed(spark: SparkSession):
    """What a query within has shuffled is removed from disk when the query has ended."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[str]:
    """Tables settled within are removed at the end, also after a failure.

    Nothing lazy may be used beyond the end but what was settled with ``lasting``, which belongs to the
    scope around this one, or to nobody; after a failure it is removed too.  Threads started inside take
    part if they run in a copy of the context.
    """
    folder, lasting = f"{shared_folder(spark)}/rollcall-scope-{uuid.uuid4().hex}", []
    token = _scopes.set((*_scopes.get(), (folder, lasting)))
    over = [folder]
    try:
        yield folder
    except BaseException:
        over += lasting
        raise
    finally:
        _scopes.reset(token)
        for path in over:
            files, at = files_at(spark, path)
            files.delete(at, True)


def settle(df: DataFrame, by: str | None = None, *, lasting: bool = False, deal: tuple[str, int] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and continue from that table.

    Several steps use their input more than once; settling between them keeps the work of a
    chain linear in its steps, and fixes row ordinals against recomputation.  Being a columnar
    table, it lets later passes read only the columns they need, and only the ``by`` value they
    filter on.  Outside of a ``scope`` the tables are not removed, like checkpoints.  With ``deal`` (a column and a
    number) rows are kept in so many buckets, and what groups them by that column need not shuffle them again.
    """
    spark = df.sparkSession
    around = _scopes.get()
    owners = around[:-1] if lasting else around
    path = f"{owners[-1][0] if owners else shared_folder(spark)}/rollcall-{uuid.uuid4().hex}"
    if lasting and around:
        around[-1][1].append(path)
    if deal is not None:
        name = f"rollcall_{uuid.uuid4().hex}"
        df.write.bucketBy(deal[1], deal[0]).option("path", path).saveAsTable(name, format="parquet")
        table = spark.table(name)
        spark.sql(f"DROP TABLE {name}")  # its files stay, like those of other tables
        return table
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
