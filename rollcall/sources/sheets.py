"""CSV sources: facility sheets, manifest, entity registry, reconciliation inputs."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rollcall.operators.entity import REGISTRY_COLUMNS
from rollcall.spec import SHEET, SHEET_COLUMNS, PanelSpec, text_schema

# Cell texts that a spreadsheet export uses for "missing".
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

MANIFEST_COLUMNS = ("State", "Entry", "Final")


def read_text_table(spark: SparkSession, paths, columns: Iterable[str] | None = None, *,
                    multi_line: bool = True, missing=MISSING_TEXT, source: str | None = None) -> DataFrame:
    """CSV with a header, every column as text, short rows padded with null.

    With ``columns`` the header must name exactly these, but for blanks around a name; without, it
    supplies the names.
    ``multi_line`` admits line breaks inside cells but reads each file in one task; switch it
    off for large files that have none.
    """
    reader = (spark.read.option("header", True).option("multiLine", multi_line)
              .option("quote", '"').option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False))
    if columns is not None:
        check_headers(spark, paths, columns)
        reader = reader.schema(text_schema(columns))
    df = reader.csv(paths)
    cells = [F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) for c in df.columns]
    return df.select(*cells, *([F.col("_metadata.file_path").alias(source)] if source else []))


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file, compressed or not, of which no more than a buffer beyond it is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = at.getFileSystem(conf).open(at)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        plain = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def check_headers(spark: SparkSession, paths, columns: Iterable[str]) -> None:
    """Fail unless the first line of every file names ``columns``, in order, blanks around a name aside.

    Only the beginnings of files are read, several at a time, and no Spark job runs; an empty file has
    no header to check.
    """
    wanted = [c.strip() for c in columns]

    def wrong(file: str) -> str | None:
        head = first_line(spark, file)
        if head is None:
            return None
        names = [n.strip().lstrip("\ufeff") for n in next(csv.reader([head]), [])]
        return None if names == wanted else f"header of {file} names {names}, not {wanted}"

    with ThreadPoolExecutor(32) as pool:
        for error in pool.map(wrong, spark.read.text(paths).inputFiles()):
            if error:
                raise ValueError(error)


def with_row_order(df: DataFrame, spec: PanelSpec = SHEET) -> DataFrame:
    """Number the rows of a frame just read, in file order.

    Blocks of one file are read in order, so the ids rank the rows of a file.  They belong to
    one evaluation of the read: settle the frame before using it more than once.
    """
    return df.withColumn(spec.order, F.monotonically_increasing_id())


def read_sheets(spark: SparkSession, paths, *, columns=SHEET_COLUMNS, spec: PanelSpec = SHEET,
                multi_line: bool = True, source: str | None = None) -> DataFrame:
    """Facility sheets of any number of states in one frame, rows numbered.

    ``source`` names an extra column holding the path of each row's file.
    """
    table = read_text_table(spark, paths, columns, multi_line=multi_line, source=source)
    return with_row_order(table, spec)


def read_registry(spark: SparkSession, path, *, spec: PanelSpec = SHEET) -> DataFrame:
    """Entity registry with empty text in place of missing cells, rows numbered."""
    table = with_row_order(read_text_table(spark, path), spec)
    return table.select(*REGISTRY_COLUMNS, spec.order).na.fill("", list(REGISTRY_COLUMNS))


def read_export(spark: SparkSession, paths, counts: Iterable[str], *, multi_line: bool = True) -> DataFrame:
    """A reconciliation input (federal table or national export) with its header's names.

    The columns in ``counts`` become whole numbers: ``3`` and ``3.0`` read 3, text that is no number
    reads as missing.  All others stay text.
    """
    table = read_text_table(spark, paths, multi_line=multi_line)
    number = {c: F.trim(F.col(f"`{c}`")).try_cast("double").try_cast("bigint") for c in counts}
    return table.select(*[number.get(c, F.col(f"`{c}`")).alias(c) for c in table.columns])


def read_manifest(spark: SparkSession, path) -> DataFrame:
    """State, Entry (input path) and Final (target path)."""
    return with_row_order(read_text_table(spark, path)).select(*MANIFEST_COLUMNS, SHEET.order)


def manifest_paths(manifest: DataFrame, column: str, states: Iterable[str] | None = None) -> dict[str, str]:
    """State -> path from the manifest; the first row of a state counts."""
    rows = manifest if states is None else manifest.where(F.col("State").isin(*states))
    listed = (rows.where(F.col("State").isNotNull()).groupBy("State")
              .agg(F.min_by(column, SHEET.order).alias("path")).collect())
    return {r["State"]: r["path"] for r in listed}


def read_states(spark: SparkSession, manifest: DataFrame, states: Iterable[str] | None = None, *,
                column: str = "Entry", spec: PanelSpec = SHEET, **options) -> DataFrame:
    """The sheets of the given states, or of all, read together."""
    paths = [p for p in manifest_paths(manifest, column, states).values() if p]
    return read_sheets(spark, sorted(set(paths)), spec=spec, **options)


def read_processed(spark: SparkSession, paths, *, columns: Iterable[str] | None = None, format: str = "csv",
                   multi_line: bool = True, missing=MISSING_TEXT, states: Iterable[str] | None = None,
                   source: str | None = None) -> DataFrame:
    """Own output, for checking.  Cells are text, with the same texts for "missing" as in raw sheets,
    and rows are numbered anew.

    With ``states`` only their directories are read.  ``source`` names an extra column holding the
    path of each row's file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    read = spark.read
    if format == "csv":
        read = (read.option("header", True).option("multiLine", multi_line)
                .option("quote", '"').option("escape", '"')
                .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
        if columns is not None:
            read = read.schema(StructType([*text_schema(columns).fields, StructField("sheet", StringType())]))
    parts = []
    for path in paths:
        part = read.format(format).load(path)
        if states is not None and "sheet" in part.columns:
            part = part.where(F.col("sheet").isin(*states))
        names = [c for c in (columns or part.columns) if c != "sheet"]
        cells = [F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`")
                 for c, t in part.dtypes if c in names]
        parts.append(part.select(*cells, *([F.col("_metadata.file_path").alias(source)] if source else [])))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part, allowMissingColumns=True)
    return with_row_order(table)
