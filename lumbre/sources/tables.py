"""Scans: JSON Lines with counted rejects, captured responses, checkpoints, class catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre import schemas
from lumbre.functions.text import decode_body
from lumbre.operators import parse
from lumbre.operators.dedup import last_wins


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


#: Where a line stands: files by the age of the write they belong to and by name, then by place.
SEQ = T.StructType([T.StructField("file_time", T.TimestampType()), T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("line", T.LongType())])


def _write_of(file: Column) -> Column:
    """What Spark calls all files of one write by; empty for other files."""
    return F.regexp_extract(file, r"/part-\d+-([0-9a-f-]{36})[^/]*$", 1)


def _write_times(spark: SparkSession, path: str) -> DataFrame:
    """(write, write_time) of the writes below ``path``, listed without reading a file. Tasks of
    one write end in any order, so that its files' own times say nothing about their lines."""
    files = spark.read.format("binaryFile").load(path).select(_write_of(F.col("path")).alias("write"), "modificationTime")
    return files.filter("write != ''").groupBy("write").agg(F.max("modificationTime").alias("write_time"))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, seq: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines) of a JSON Lines table; a missing file is an empty table.
    ``seq`` names a column for the place of each line."""
    if not exists(spark, path):
        named = T.StructType([*schema.fields, *([T.StructField(seq, SEQ)] if seq else [])])
        return spark.createDataFrame([], named), spark.createDataFrame([], "line string")
    marked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    if seq:
        place = [F.col("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")]
        lines = lines.select("value", *place).withColumn("write", _write_of(F.col("file")))
        # Fewer rows than files, all of which the driver lists for any scan.
        lines = lines.join(F.broadcast(_write_times(spark, path)), "write", "left")
        lines = lines.select("value", F.struct(F.coalesce("write_time", "file_time").alias("file_time"), "file", "block", "line").alias(seq))
    read = lines.withColumn("row", F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    broken = F.col("row._corrupt_record").isNotNull()
    return read.filter(~broken).select("row.*", *([seq] if seq else [])).drop("_corrupt_record"), read.filter(broken).select(F.col("value").alias("line"))


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """The dead letters, the later line of a key winning."""
    rows, _ = read_json_lines(spark, path, schemas.FAILURE, "seq")
    return last_wins(rows, ["key"], "seq").drop("seq")


def _is_folder(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The class catalogue; empty where the file is missing or is no JSON."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.JUDICIAL_CLASS)
    rows = spark.read.schema(schemas.JUDICIAL_CLASS).option("multiLine", not _is_folder(spark, path)).option("mode", "DROPMALFORMED").json(path)
    return rows.filter(F.col("codigo").isNotNull() & F.col("nome").isNotNull())


def sorted_catalogue(classes: DataFrame) -> DataFrame:
    """By name in Portuguese order."""
    return classes.orderBy(F.collate("nome", "pt"))


def captured_text(captured: DataFrame) -> DataFrame:
    """Captured responses with their body decoded by their own charset."""
    return captured.withColumn("html", decode_body(F.col("body"), F.col("content_type")))


def read_captured(spark: SparkSession, path: str) -> DataFrame:
    return captured_text(spark.read.schema(schemas.CAPTURED).parquet(path))


def search_results(captured: DataFrame, base: str) -> DataFrame:
    """Captured searches with ``result`` and ``outcome``: ok, expired, refused or failed."""
    good = captured.withColumn("_page", F.when(F.col("status") == 200, F.col("html"))).withColumn("_base", F.lit(base))
    found = parse.parsed(good, parse.search_result, ["_page", "_base"], schemas.RESULT, "result", without=["_page", "_base"])
    outcome = (
        F.when(F.col("result").isNull(), "failed")
        .when(F.col("result.message").isNotNull() & (F.size("result.rows") == 0), "refused")
        .when(~F.col("result.has_grid"), "expired")
        .otherwise("ok")
    )
    return found.withColumn("outcome", outcome)


def case_pages(captured: DataFrame) -> DataFrame:
    """(key, case): captured case pages (key, url, html) as nested cases."""
    return parse.parsed(captured.select("key", "html", "url"), parse.case_page, ["html", "key", "url"], schemas.CASE, "case", without=["html", "url"])


def remaining(pagers: DataFrame, captured: DataFrame) -> DataFrame:
    """Each page that a pager has left, joined to its captured answer; a page without one has failed.

    ``pagers``: (ca, url, form, currentPage, lastPage), the url being the case's. ``captured``:
    (key, page, html), key being the case, and perhaps form.
    """
    from lumbre.operators.limits import remaining_pages

    by = ["ca", "page", *(["form"] if "form" in captured.columns else [])]
    answers = captured.select(F.col("key").alias("ca"), "html", *by[1:])
    joined = remaining_pages(pagers).join(answers, by, "left")
    found = parse.parsed(joined, parse.extra_page, ["html", "url"], parse.EXTRA_PAGE, "extra", "error", without=["html"])
    return found.withColumn("read", F.coalesce(F.col("extra.read"), F.lit(False)))


def write_catalogue(classes: DataFrame, path: str) -> None:
    """Replace the class catalogue, a small table, by one file of JSON in Portuguese order."""
    sorted_catalogue(classes.select("codigo", "nome")).coalesce(1).write.mode("overwrite").json(path)
