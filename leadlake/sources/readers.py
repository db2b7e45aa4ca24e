"""Scans: CSV, Parquet, folders, ARFF and JSON records, always with a declared schema where the format has none."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _by_header(spark: SparkSession, path: str, most: int = 1000) -> list[list[str]]:
    """Files grouped by their first line. One pass over the text; a driver row per file, as in the file listing."""
    files = [unquote(f) for f in spark.read.text(path).inputFiles()]
    if len(files) < 2:
        return [files] if files else []
    # Ids rise along each file: the least is its first line.
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("_at"))
    first = lines.groupBy("f").agg(F.min_by("value", "_at").alias("h"))
    groups = [sorted(map(unquote, r.files)) for r in first.groupBy("h").agg(F.collect_list("f").alias("files")).orderBy("h").limit(most + 1).collect()]
    if len(groups) > most:
        raise ValueError(f"over {most} different headers below {path}: these files are not one table")
    return groups


def read_csv(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """CSV with a header: columns are found by their names in it, in any order, and typed as ``schema`` says.

    Columns the schema does not know are read as text, columns the file does not have are left out. Files of a folder may
    carry different headers: each header is read by itself, and columns that a file lacks are NULL in its rows. Malformed rows are
    kept as text in ``_corrupt_record`` when asked for.
    """
    groups = _by_header(spark, path)
    if len(groups) < 2:
        return _read_csv(spark, groups[0] if groups else [path], schema, keep_corrupt)
    names, out = {f.name.lower(): f.name for f in schema.fields}, None
    for files in groups:
        part = _read_csv(spark, files, schema, keep_corrupt)
        # One spelling for a column that files write in different ways.
        part = part.toDF(*[c if c == CORRUPT else names.get(c.strip().lower(), c.strip().lower()) for c in part.columns])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _read_csv(spark: SparkSession, files: list[str], schema: T.StructType, keep_corrupt: bool) -> DataFrame:
    """Files with one header. Names are told apart by case only where the contract does not know them."""
    names = spark.read.option("header", True).option("inferSchema", False).csv(files).columns
    known = {f.name.lower(): f for f in schema.fields}
    found = [known.get(n.strip().lower()) for n in names]
    if names:
        schema = T.StructType([T.StructField(n, f.dataType if f else T.StringType()) for n, f in zip(names, found)])
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(files)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """All batches of one table folder, whatever columns each batch brought."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_batch_file(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One delivered batch: Parquet by suffix, otherwise CSV."""
    return read_parquet(spark, path) if path.rstrip("/").lower().endswith(".parquet") else read_csv(spark, path, schema)


def read_json_leads(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def parse_json_leads(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Payloads that already sit in a string column, for example from a message source."""
    return df.select(F.from_json(F.col(column), schema).alias("lead")).select("lead.*")


_ATTRIBUTE = re.compile(r"@attribute\s+('[^']*'|\"[^\"]*\"|\S+)\s+(.+)", re.IGNORECASE)


def _arff_schema(lines: list[str]) -> T.StructType:
    fields = []
    for line in lines:
        text = line.strip()
        if text.lower().startswith("@data"):
            return T.StructType(fields)
        found = _ATTRIBUTE.match(text)
        if found:
            name, kind = found.group(1).strip("'\""), found.group(2).strip().lower()
            numeric = kind.split()[0] in ("numeric", "real", "integer")
            fields.append(T.StructField(name, T.DoubleType() if numeric else T.StringType()))
    raise ValueError("no @data line within the header lines read")


def read_arff(spark: SparkSession, path: str, header_path: str | None = None) -> DataFrame:
    """ARFF: the header gives the schema, the body is parsed in parallel as delimited text.

    A header goes from ``@relation`` to the first ``@data`` line of its file; only header lines reach the driver, however long
    they are and however many rows follow. All lines behind it are rows, also those that look like header lines, as are all
    lines of a file that has no header. A data set split over many files may have one header (in ``header_path``) or one each.
    """
    def lines(of: str) -> DataFrame:
        # Ids rise along each file: its pieces are read in their order.
        return spark.read.text(of).select(
            F.trim("value").alias("value"), F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))

    def headers(rows: DataFrame) -> DataFrame:
        def first(mark: str) -> Column:
            return F.min(F.when(F.lower("value").startswith(mark), F.col("_at")))

        ends = rows.groupBy("_file").agg(first("@relation").alias("_begin"), first("@data").alias("_end"))
        return ends.filter("_begin < _end").select("_file", "_end")

    head = lines(header_path or path)
    chosen = headers(head).orderBy("_file").first()
    if chosen is None:
        raise ValueError("no header from @relation to @data")
    described = head.filter((F.col("_file") == chosen["_file"]) & (F.col("_at") <= chosen["_end"]))
    schema = _arff_schema([r.value for r in described.orderBy("_at").collect()])
    body = lines(path)
    # One row per file at most: less than the file listing that the driver holds anyway.
    rows = body.join(F.broadcast(headers(body)), "_file", "left").filter(
        (F.col("_end").isNull() | (F.col("_at") > F.col("_end"))) & ~F.col("value").rlike(r"^(%|$)")).select("value")
    options = {"quote": "'", "nullValue": "?", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return rows.select(F.from_csv(F.col("value"), ddl, options).alias("row")).select("row.*")
