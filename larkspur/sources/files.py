"""Reading and writing staged files."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.session import durable, scratch_dir

# Named reader options; pass one of these, or your own, to the loaders.
CSV_FORMAT = {
    "header": True,
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
    "nullValue": "NULL",
    "emptyValue": "",
    "encoding": "UTF-8",
}
CORRUPT = "_corrupt"

# fixed values: date patterns a detecting load tries, in the order that settles a tie
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy", "dd-MMM-yyyy", "yyyyMMdd")
# fixed values: name endings of files that Spark's line reader would unpack
PACKED = (".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst", ".zstd")


def append_table(spark: SparkSession, parts: list[DataFrame], label: str) -> DataFrame:
    """Write the first part, append the others, and read the whole back."""
    path = scratch_dir(spark, label)
    for part in parts:
        part.write.mode("append").parquet(path)
    return spark.read.schema(parts[0].schema).parquet(path)


def write_csv(df: DataFrame, path: str, partition_by: str | None = None, max_records: int | None = None, **options) -> None:
    """Unload as CSV parts, optionally split by a column or by rows per file."""
    writer = df.write.mode("overwrite").options(**{"header": True, "quote": '"', "escape": '"', **options})
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, pattern: str | None = None, **options) -> DataFrame:
    """Typed load of one file or a folder; ``pattern`` is a file-name glob."""
    reader = spark.read.schema(schema).options(**{**CSV_FORMAT, **options})
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.csv(path)


def select_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """Files by column position (_c0, _c1, ...), with the file each row came from."""
    raw = spark.read.options(**{**CSV_FORMAT, "header": False, **options}).csv(path)
    return raw.select("*", F.col("_metadata.file_path").alias("file_path"))


def literal_path(path: str) -> str:
    """A path that a reader takes as it is, not as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def load_tolerant(spark: SparkSession, path: str | list[str], schema: T.StructType, **options) -> DataFrame:
    """All rows with their file; rows that do not fit the schema carry their text in ``_corrupt``.

    Every column is parsed once and the rows are stored: which rows are bad must not
    depend on the columns a later query happens to read.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return durable(
        spark.read.schema(wide)
        .options(**{**CSV_FORMAT, **options})
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("file_path"))
    )


def on_error(rows: DataFrame, policy: str, limit: int = 0) -> DataFrame:
    """Apply ABORT, CONTINUE or SKIP_FILE (files with more than ``limit`` bad rows) to tolerant rows."""
    bad = F.col(CORRUPT).isNotNull()
    if policy == "ABORT":
        checked = F.when(bad, F.raise_error(F.concat(F.lit("bad row: "), F.col(CORRUPT)))).otherwise(F.lit(True))
        return rows.filter(checked).drop(CORRUPT)
    if policy == "CONTINUE":
        return rows.filter(~bad).drop(CORRUPT)
    if policy == "SKIP_FILE":
        report = rows.groupBy("file_path").agg(F.count_if(bad).alias("errors")).filter(F.col("errors") > limit)
        return rows.filter(~bad).join(report.select("file_path"), "file_path", "left_anti").drop(CORRUPT)
    raise ValueError(f"unknown policy {policy}")


def rejects(rows: DataFrame) -> DataFrame:
    """The text of every row that was not loaded, with its file."""
    return rows.filter(F.col(CORRUPT).isNotNull()).select("file_path", F.col(CORRUPT).alias("rejected_record"))


def read_bytes(spark: SparkSession, path: str, schema: str, invalid: str = "replace", **options) -> DataFrame:
    """CSV lines whose bytes may be no UTF-8: each bad sequence becomes U+FFFD, or the load fails, or the line is dropped.

    ``invalid`` is replace, error or skip. Lines come from the bytes of the files, so a bad
    sequence never hides a separator; fields with line breaks need ``read_csv``.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    decode = {"replace": F.make_valid_utf8, "error": F.validate_utf8, "skip": F.try_validate_utf8}[invalid]
    lines = lines.select(decode("value").alias("value")).filter("value IS NOT NULL")
    return lines.select(F.from_csv("value", schema, {k: str(v) for k, v in {**CSV_FORMAT, **options}.items() if k != "header"}).alias("r")).select("r.*")


def detect_dates(rows: DataFrame, columns: list[str], formats: tuple[str, ...] = DATE_FORMATS) -> dict[str, list[str]]:
    """For each text column the patterns that read any value of it, those that read most first; one pass over the rows."""
    votes = {(c, f): F.count_if(_date(c, f).isNotNull()) for c in columns for f in formats}
    found = rows.agg(*[n.alias(f"v{i}") for i, n in enumerate(votes.values())]).first()
    count = {key: found[i] for i, key in enumerate(votes)}
    return {c: sorted((f for f in formats if count[c, f]), key=lambda f: -count[c, f]) for c in columns}


def parse_dates(rows: DataFrame, detected: dict[str, list[str]]) -> DataFrame:
    """The columns as dates: the pattern that won the vote first, the others for what it cannot read, null beyond."""
    null = F.lit(None).cast("date")
    return rows.withColumns({c: F.coalesce(*[_date(c, f) for f in formats], null) for c, formats in detected.items()})


def _date(column: str, pattern: str) -> Column:
    return F.try_to_timestamp(column, F.lit(pattern)).cast("date")


def load_report(rows: DataFrame) -> DataFrame:
    """Per file: rows parsed, loaded, bad rows, first bad row in text order, status."""
    bad = F.col(CORRUPT).isNotNull()
    counts = rows.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("rows_parsed"),
        F.count_if(~bad).alias("rows_loaded"),
        F.count_if(bad).alias("errors_seen"),
        F.min(CORRUPT).alias("first_error"),
    )
    status = (
        F.when(F.col("errors_seen") == 0, "LOADED")
        .when(F.col("rows_loaded") == 0, "LOAD_FAILED")
        .otherwise("PARTIALLY_LOADED")
    )
    return counts.withColumn("status", status)


def fit_width(col: Column, width: int, truncate: bool) -> Column:
    """VARCHAR(width): cut longer text, or fail on it."""
    if truncate:
        return F.substring(col, 1, width)
    return F.when(F.length(col) > width, F.raise_error(F.lit(f"text longer than {width}"))).otherwise(col)


def infer_schema(spark: SparkSession, path: str, **options) -> DataFrame:
    """Column order, name and type of staged files, as rows."""
    found = spark.read.options(**{**CSV_FORMAT, "inferSchema": True, **options}).csv(path).schema
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(found.fields)]
    return spark.createDataFrame(rows, "order_id int, column_name string, type string")


#: files up to this size are read whole for their digest, larger ones line by line
WHOLE = 64 << 20


def list_files(spark: SparkSession, path: str, with_md5: bool = True, pattern: str | None = None, whole: int = WHOLE) -> DataFrame:
    """Path, file_path (as in ``_metadata``), size, time and md5 of each file.

    Content is read only where the digest is asked for: that of small files by the row, that of
    larger ones as lines in file order, so no file need fit into a row. Packed files are read by
    the row whatever their size, as line readers would unpack them.
    """
    reader = spark.read.format("binaryFile")

    def listed(source: DataFrame, *more: Column) -> DataFrame:
        return source.select("path", F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"), *more)

    plain = reader.option("recursiveFileLookup", True)
    if pattern:
        plain = plain.option("pathGlobFilter", pattern)
    found = plain.load(path)
    if not with_md5:
        return listed(found)
    digest = F.md5("content").alias("md5")
    out = listed(found.filter(F.col("length") <= whole), digest)
    large = [r["path"] for r in found.filter(F.col("length") > whole).select("path").toLocalIterator()]
    packed = [literal_path(p) for p in large if p.endswith(PACKED)]
    lines = [literal_path(p) for p in large if not p.endswith(PACKED)]
    if packed:
        out = out.unionByName(listed(spark.read.format("binaryFile").load(packed), digest))
    if lines:
        sizes = listed(spark.read.format("binaryFile").load(lines))
        out = out.unionByName(sizes.join(_line_digests(spark, lines), "file_path").select(*out.columns))
    return out


def _line_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_path, md5) of files that are read as lines: by splits in parallel, digested in order of place."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    placed = lines.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("nth"),
    )
    dealt = placed.repartition("file_path").sortWithinPartitions("file_path", "start", "nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            done = []
            for path, size, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if current is None or path != current.path:
                    if current is not None:
                        done.append(current.finish())
                    current = _LineDigest(path, size)
                current.add(value.as_py())
            yield _digest_rows(done)
        yield _digest_rows([] if current is None else [current.finish()])

    return dealt.select("file_path", "size", "value").mapInArrow(run, "file_path string, md5 string")


def _digest_rows(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["file_path", "md5"])


class _LineDigest:
    """MD5 of a file from its lines; its size tells whether a last break or a leading mark was dropped."""

    MARK = b"\xef\xbb\xbf"

    def __init__(self, path: str, size: int):
        self.path, self.left = path, size
        self.plain, self.marked, self.first = hashlib.md5(), hashlib.md5(self.MARK), True

    def add(self, line: bytes) -> None:
        if not self.first:
            self._feed(b"\n")
        self.first = False
        self._feed(line)

    def _feed(self, data: bytes) -> None:
        self.plain.update(data)
        self.marked.update(data)
        self.left -= len(data)

    def finish(self) -> tuple[str, str]:
        if self.left in (1, 1 + len(self.MARK)):
            self._feed(b"\n")
        if self.left not in (0, len(self.MARK)):
            raise ValueError(f"{self.path} changed while it was read")
        return self.path, (self.marked if self.left else self.plain).hexdigest()
