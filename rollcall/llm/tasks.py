"""Small helpers for Arrow-fed tasks and for tables that later steps read again."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from rollcall.functions.lineage import settle

SLICE = 256  # rows turned into Python objects at a time
BATCH_ROWS = 1024  # rows Spark sends to a task's Python at a time
SHIPPED = 1 << 20  # bytes of results gathered before they go back


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of at most SLICE rows as tuples."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield list(zip(*[column.to_pylist() for column in part.columns]))


def by_arrow(df: DataFrame, work: Callable[[Iterator[list[tuple]]], Iterator[dict]], ddl: str) -> DataFrame:
    """Map ``df`` in Arrow batches.

    ``work`` is a generator: it gets slices of the task's rows and yields the columns of its results, so
    a task holds one slice and whatever the generator keeps.
    """
    return over_batches(df, lambda batches: work(rows_of(batches)), ddl)


def over_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], ddl: str) -> DataFrame:
    """As ``by_arrow`` for work that reads the batches themselves."""
    kind: StructType = _parse_datatype_string(ddl)
    schema = to_arrow_schema(kind)

    def run(batches):
        held, size = [], 0
        for out in work(batches):
            held.append(pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in schema], schema=schema))
            size += held[-1].nbytes
            if size >= SHIPPED:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        yield from pa.Table.from_batches(held, schema).combine_chunks().to_batches()

    conf = df.sparkSession.conf
    # whole texts are long rows: a batch of the usual 10,000 would be large
    if not 0 < int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df.mapInArrow(run, kind)


def merged(texts: DataFrame, places: DataFrame, work: Callable, ddl: str) -> DataFrame:
    """Bring the places found in a document back to its text.

    ``texts`` has (doc, packed), ``places`` has (doc, place).  Both are dealt by document and sorted, so
    a task streams each document's text and then its places, without collecting lists.  ``work`` gets an
    iterator of (doc, packed, places as an int array) of documents that have places and yields columns.
    """
    rows = texts.select("doc", F.lit(-1).cast("bigint").alias("place"), "packed").unionByName(
        places.select("doc", F.col("place").cast("bigint").alias("place"), F.lit(None).cast("binary").alias("packed")))
    dealt = rows.repartition("doc").sortWithinPartitions("doc", "place")

    def groups(batches):
        doc, packed, found = None, [], []

        def done():
            if found:
                at = np.unique(np.concatenate(found))
                for p in packed:
                    yield doc, p, at

        for batch in batches:
            docs = batch.column(0).to_numpy()
            at = batch.column(1).to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(docs[1:] != docs[:-1]) + 1, [len(docs)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if a == b:
                    continue
                if docs[a] != doc:
                    yield from done()
                    doc, packed, found = docs[a], [], []
                n = int(np.searchsorted(at[a:b], 0))
                packed += [batch.column(2)[k].as_py() for k in range(a, a + n)]
                if n < b - a:
                    found.append(at[a + n:b].copy())
        yield from done()

    return over_batches(dealt, lambda batches: work(groups(batches)), ddl)


def pack(docs: DataFrame, kind: str = "bigint") -> DataFrame:
    """(doc, text as bytes) with the text compressed, to be shuffled; ``kind`` is the type of doc."""
    def work(slices):
        squeeze = zstandard.ZstdCompressor(level=3)
        for rows in slices:
            yield {"doc": [d for d, _ in rows], "packed": [squeeze.compress(t) for _, t in rows]}

    return by_arrow(docs.select("doc", "text"), work, f"doc {kind}, packed binary")


def doc_key(doc_id: str, text: str) -> Column:
    """The id; for rows without one a hash of the text, so equal rows share a key."""
    return F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.xxhash64(F.col(f"`{text}`"), F.lit("no id")))


def rows_apart(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(user, id, doc, text as bytes), where ``doc`` tells rows of unlike texts apart.

    It is ``doc_key``, and for rows that share an id with an unlike text a hash of id and text, so rows share a
    key only if they are equal in both.  Ids of unlike texts are listed in a written table; hashes alone are shuffled.
    """
    known = F.col(f"`{doc_id}`").cast("bigint")
    seen = F.xxhash64(as_bytes(text))
    unlike = settle(docs.where(known.isNotNull()).groupBy(known.alias("shared"))
                    .agg(F.min(seen).alias("least"), F.max(seen).alias("most")).where("least != most").select("shared"))
    rows = docs.select(whole_row(docs), known.alias("id"), as_bytes(text).alias("text"), doc_key(doc_id, text).alias("key"))
    doc = F.when(F.col("shared").isNull(), F.col("key")).otherwise(F.xxhash64("id", "text", F.lit("unlike")))
    return rows.join(unlike, F.col("id") == F.col("shared"), "left").select("user", "id", doc.alias("doc"), "text")


def whole_row(docs: DataFrame) -> Column:
    """All columns of a user's table as one struct, ``user``, beside which internal columns may have any name."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("user")


def as_bytes(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")


def sent(spark, thing):
    """Broadcast a model or table of bounded size, classes by value; ``cloudpickle.loads(x.value)`` in tasks."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(thing))


def lowest(rows: DataFrame, n: int, *, key: str, by: str | None = None) -> DataFrame:
    """The n rows of each group whose ``key`` hashes lowest: a bounded sample that does not depend on the
    partitioning.

    Groups are counted first, and rows whose hash lies clearly beyond the n-th are dropped where they are,
    so about 1.5 n rows of a group are ranked, however many it has.
    """
    group = F.col(by) if by else F.lit(0)
    unit = F.shiftrightunsigned(F.xxhash64(key, F.lit("sample")), 11) / F.lit(float(1 << 53))
    marked = rows.withColumns({"_group": group, "_unit": unit})
    totals = {r["_group"]: r["n"] for r in marked.groupBy("_group").agg(F.count(F.lit(1)).alias("n")).collect()}
    limits = [x for g, total in totals.items() for x in (F.lit(g), F.lit(min(1.0, (1.5 * n + 50) / total)))]
    if not limits:
        return rows.limit(0)
    near = marked.where(F.col("_unit") <= F.element_at(F.create_map(*limits), F.col("_group")))
    nth = F.row_number().over(Window.partitionBy("_group").orderBy("_unit", key))
    return near.withColumn("nth", nth).where(F.col("nth") <= n).drop("_group", "_unit")
