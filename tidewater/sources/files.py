"""Readers and writers of the file formats the pipeline exchanges. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OCR_PAGE = "text string, status string, processing_time double, image string, model string, error string"
REVIEW = (
    "port_type string, original_port string, ship_count int, best_match_canonical string, similarity_score string, "
    "normalization_tier string, year_range string, action string, map_to_port string, notes string, web_search_query string"
)
INSTRUCTIONS = "=== INSTRUCTIONS ==="
ACTIONS = ["MAP", "ACCEPT", "ERROR"]


def empty_to_null(c: Column) -> Column:
    """Empty and blank strings as null."""
    return F.nullif(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), F.lit(""))


def page_keys(name: Column) -> list[Column]:
    """doc_key and page_no of a file name: ``base_pNNN.txt`` is page NNN of base, any other name page 0 of its own."""
    numbered = r"^(.+?)_p(\d{3})\.txt$"
    base, page = F.regexp_extract(name, numbered, 1), F.regexp_extract(name, numbered, 2)
    doc = F.when(base != "", base).otherwise(F.regexp_replace(name, r"\.txt$", ""))
    return [doc.alias("doc_key"), F.when(page != "", page.cast("int")).otherwise(F.lit(0)).alias("page_no")]


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row for each text file: file_name, doc_key, page_no, value."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt").select(F.col("_metadata.file_name").alias("file_name"), "value")
    return files.select("file_name", *page_keys(F.col("file_name")), "value")


def lines(pages: DataFrame, text: str = "value", keep: tuple[str, ...] = ("doc_key", "page_no")) -> DataFrame:
    """The numbered lines of each page, from 1."""
    return pages.select(*keep, F.posexplode(F.split(text, "\n")).alias("pos", "line")).select(*keep, (F.col("pos") + 1).alias("line_number"), "line")


def text_or_json(value: Column) -> Column:
    """The member ``text`` of a JSON object, else the value itself."""
    return F.coalesce(F.get_json_object(value, "$.text"), value)


def read_csv(spark: SparkSession, path: str, schema: str, encoding: str = "UTF-8") -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("encoding", encoding).csv(path)


def encoding_of(spark: SparkSession, path: str) -> str:
    """UTF-8 if all files of ``path`` are valid, else ISO-8859-1."""
    whole = spark.read.format("binaryFile").load(path)
    return "UTF-8" if whole.filter(~F.is_valid_utf8(F.col("content").cast("string"))).isEmpty() else "ISO-8859-1"


def read_review(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Review decisions without the instruction row; without a given ``encoding`` the files decide (see ``encoding_of``)."""
    return read_csv(spark, path, REVIEW, encoding or encoding_of(spark, path)).filter(F.col("port_type") != INSTRUCTIONS)


def read_ocr(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OCR_PAGE).option("multiLine", True).json(path)


def read_json_list(spark: SparkSession, path: str) -> DataFrame:
    """A file with one JSON array of strings, as rows."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "array<string>")).alias("value"))


def read_json_counts(spark: SparkSession, path: str) -> DataFrame:
    """A file with one JSON object of counts, as rows of name and count."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "map<string,bigint>")).alias("name", "count"))


def undecided(review: DataFrame) -> DataFrame:
    """Review rows without an action so far."""
    return review.filter(F.col("action").isNull() | (F.trim("action") == ""))


def unknown_actions(review: DataFrame) -> DataFrame:
    """(action, rows): actions of a review that nobody knows, to be warned of; case and blanks around them don't matter."""
    action = F.upper(F.trim("action"))
    odd = review.filter(F.col("action").isNotNull() & (action != "") & ~action.isin(ACTIONS))
    return odd.groupBy(action.alias("action")).agg(F.count("*").alias("rows"))


def images(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Image files: path, length, content; nothing sorts rows that carry images, so order by path what is taken from them."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.{png,PNG,jpg,JPG,jpeg,JPEG}").load(path)
    return found.select("path", "length", "content")


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Just ``columns``, in that order, with a header."""
    df.select(*columns).write.mode("error").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("error").json(path)


def write_batches(numbered: DataFrame, path: str, size: int, number: str = "n", line: str = "line") -> None:
    """Text files of ``size`` lines; ``number`` counts lines from 0."""
    numbered.select(F.floor(F.col(number) / size).alias("batch"), line).write.mode("error").partitionBy("batch").text(path)


def not_done(found: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no result yet."""
    return found.join(done.select(key).distinct(), key, "left_anti")


def with_instructions(review: DataFrame, text: str) -> DataFrame:
    """A review table with the instruction row before all others; ``position`` orders it."""
    first = review.sparkSession.createDataFrame([(INSTRUCTIONS, text)], "port_type string, notes string").withColumn("position", F.lit(0))
    return first.unionByName(review.withColumn("position", F.lit(1)), allowMissingColumns=True)
