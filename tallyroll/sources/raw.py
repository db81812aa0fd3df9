"""Readers for raw files: JSON documents and CSV tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroll.session import settle
from tallyroll.sources.schemas import RAW


class MissingInput(FileNotFoundError):
    """A named input does not exist; says which one."""


def is_missing_path(error: AnalysisException) -> bool:
    # A folder without a single file has no schema to infer.
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


# Why a document is put aside.
UNREADABLE, NO_DOCUMENT, OTHER_TYPE, EMPTY_FILE = "not one JSON document or array", "not an object", "a field of another type", "empty file"


def _closed(kind: T.DataType) -> T.StructType:
    """The schema of a text that ``_enclose`` has put into an array with a mark behind it."""
    return T.StructType([T.StructField("many", T.ArrayType(T.ArrayType(kind))), T.StructField("one", T.ArrayType(kind)), T.StructField(_DAMAGED, T.StringType())])


_DAMAGED, _MARK = "_damaged", "_mark"


def _enclose(text: Column, mark: str) -> Column:
    """A JSON reader stops behind the first value and ignores what follows, be it more documents.

    Here the text becomes the first of two elements, and the second one is a mark that no text has. Whatever
    follows a first value then is an error, another element, or hides the mark.
    """
    end = f'{{"{_MARK}":"{mark}"}}'
    lone, text = text.rlike(r"^\uFEFF?\s*\{"), F.when(text.startswith("\uFEFF"), F.substring(text, 2, 1 << 30)).otherwise(text)
    return F.when(lone, F.concat(F.lit('{"one":['), text, F.lit(f",{end}]}}"))).otherwise(F.concat(F.lit('{"many":['), text, F.lit(f",[{end}]]}}")))


def _enclosed(p: Column) -> tuple[Column, Column, Column]:
    """Documents of an enclosed text, its mark, and the number of elements, which is two."""
    mark = F.coalesce(F.try_element_at(p["one"], F.lit(2)), F.try_element_at(F.try_element_at(p["many"], F.lit(2)), F.lit(1)))
    return F.coalesce(F.slice(p["one"], 1, 1), F.try_element_at(p["many"], F.lit(1))), mark, F.coalesce(F.size(p["one"]), F.size(p["many"]))


def parse_raw(spark: SparkSession, kind: str, path: str, multi_line: bool = True) -> DataFrame:
    """All documents of some files, and all that could not be read: ``document, file, place, reason, text``.

    ``reason`` is null for a document that was read with its fixed schema as a whole: the text of its file is one JSON
    array (or one document, or has one on each line), and no field has a value of another type. Otherwise ``document``
    is null, ``text`` is that of the document, or of the file (the line) if it is no JSON, and ``place`` the
    position in the array. Missing fields and nulls are no damage. In a file with a damaged document all others are read.

    A file whose documents are all good is parsed once, in one expression; others are parsed
    again as variants, document by document. Blank lines and files of blanks in a folder of JSON lines hold no document; an
    empty file of arrays is damaged.
    """
    schema, mark = RAW[kind], uuid.uuid4().hex
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _DAMAGED}
    marked = T.StructType([*schema.fields, T.StructField(_MARK, T.StringType())])
    raw_texts = spark.read.text(path, wholetext=multi_line)
    texts = raw_texts.select(F.col("_metadata.file_path").alias("file"), "value")
    if not multi_line:
        texts = texts.where(F.trim("value") != "")
    closed = texts.withColumn("closed", _enclose(F.col("value"), mark))
    parsed = closed.withColumn("p", F.from_json("closed", _closed(marked), options))
    first, last, size = _enclosed(F.col("p"))
    good = F.coalesce(F.col(f"p.{_DAMAGED}").isNull() & (size == 2) & (last[_MARK] == mark), F.lit(False))
    checked = parsed.select("file", F.when(good, first).alias("documents"), F.when(~good, F.col("value")).alias("value"), F.when(~good, F.col("closed")).alias("closed"))
    # The rest, document by document. What comes of whole files is null.
    again = checked.withColumn("v", F.when(F.col("closed").isNotNull(), F.from_json("closed", _closed(T.VariantType()), options)))
    items, end, size = _enclosed(F.col("v"))
    whole = (size == 2) & (F.try_variant_get(end, f"$.{_MARK}", "string") == mark)
    again = again.select("file", "documents", F.when(whole, F.transform(items, lambda i: F.to_json(i))).alias("texts"), "value")
    none, nothing = F.lit(None).cast(marked), F.lit(None).cast("string")

    def row(document: Column, text: Column, whole: bool) -> Column:
        return F.struct(document.alias("document"), text.alias("text"), F.lit(whole).alias("whole"))

    rows = (
        F.when(F.col("documents").isNotNull(), F.transform("documents", lambda d: row(d, nothing, True)))
        .when(F.col("texts").isNotNull(), F.transform("texts", lambda t: row(none, t, True))).otherwise(F.array(row(none, F.col("value"), False)))
    )
    exploded = again.select("file", F.posexplode(rows).alias("place", "row")).select("file", "place", "row.*")
    tried = exploded.withColumn("again", F.when(F.col("whole") & F.col("text").isNotNull(), F.from_json("text", T.StructType([*schema.fields, T.StructField(_DAMAGED, T.StringType())]), options)))
    reason = (
        F.when(~F.col("whole"), F.lit(UNREADABLE)).when(F.col("text").isNull() & F.col("document").isNotNull(), F.lit(None).cast("string"))
        .when(~F.coalesce(F.ltrim("text"), F.lit("null")).startswith("{"), F.lit(NO_DOCUMENT)).when(F.col(f"again.{_DAMAGED}").isNotNull(), F.lit(OTHER_TYPE))
    )
    found = tried.withColumn("reason", reason)
    document = F.struct(*(F.coalesce(F.col(f"document.{f.name}"), F.col(f"again.{f.name}")).alias(f.name) for f in schema.fields))
    bad = F.col("reason").isNotNull()
    # An array of a file and a line have a place of their own; what is no array has none.
    place = F.when(F.col("whole"), F.col("place").cast("long"))
    out = found.select(F.when(~bad, document).alias("document"), "file", place.alias("place"), "reason", F.when(bad, F.coalesce("text", F.lit("null"))).alias("text"))
    if not multi_line:
        return out
    empties = [(None, file, None, EMPTY_FILE, "") for file in empty_files(raw_texts, path)]
    return out.unionByName(spark.createDataFrame(empties, out.schema)) if empties else out


def empty_files(texts: DataFrame, path: str) -> list[str]:
    """Files of ``texts`` without a byte, which scans leave out: listed, but with no row of their sizes."""
    listed = texts.inputFiles()
    there = texts.sparkSession.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    if there.count() == len(listed):
        return []
    local = F.regexp_replace("file", "^file:/+", "file:/").alias("file")
    files = texts.sparkSession.createDataFrame([(file,) for file in listed], "file string")
    return [r.file for r in files.select(local).join(there.select(local), "file", "left_anti").collect()]


def read_raw(
    spark: SparkSession,
    kind: str,
    path: str,
    multi_line: bool = True,
    missing: str = "error",
    quarantine: str | None = None,
) -> DataFrame:
    """Read ``users``, ``products`` or ``carts`` JSON with its fixed schema; nothing is lost without a word.

    ``multi_line`` fits files that hold one indented JSON array; such a file is one task, so
    large history belongs in the landed Parquet tables. Pass False for JSON lines, as Spark
    writes them. A missing path raises ``MissingInput`` or, with ``missing="empty"``, gives no rows.

    A file or document that can't be read as a whole (``parse_raw``) is an error that names it, raised where the rows are
    used. Given a path ``quarantine``, the rows are read at once, what is damaged is appended to the table there
    with its file, place, reason and text, and the rest is returned.
    """
    try:
        parsed = parse_raw(spark, kind, path, multi_line)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        if missing == "empty":
            return empty(spark, RAW[kind])
        raise MissingInput(f"no {kind} at {path}") from error
    if quarantine is not None:
        parsed = settle(parsed, "raw")
        damaged = parsed.where("reason IS NOT NULL").select(F.lit(kind).alias("kind"), "file", "place", "reason", "text")
        if not damaged.isEmpty():
            damaged.write.mode("append").parquet(quarantine)
        return parsed.where("reason IS NULL").select("document.*")
    # A filter, since no choice of columns removes it.
    said = F.concat_ws(" ", F.lit("DAMAGED_INPUT"), "file", F.concat(F.lit("document "), "place"), F.concat(F.lit("- "), "reason"))
    return parsed.where(F.when(F.col("reason").isNull(), F.lit(True)).otherwise(F.raise_error(said).cast("boolean"))).select("document.*")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """What was put aside: ``kind, file, place, reason, text``; no rows if nothing ever was."""
    try:
        return spark.read.schema(QUARANTINE).parquet(path)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return empty(spark, T.StructType.fromDDL(QUARANTINE))


QUARANTINE = "kind string, file string, place bigint, reason string, text string"


def write_json_arrays(df: DataFrame, path: str, per_file: int = 1000) -> None:
    """Files that hold one indented JSON array of about ``per_file`` documents each, as the raw data comes."""
    n = max(1, -(-df.count() // per_file))
    document = F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("document")
    groups = df.select(F.pmod(F.xxhash64(document), F.lit(n)).alias("file"), document).repartition(n, "file").groupBy("file")
    arrays = groups.agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("document"), ",\n"), F.lit("\n]")).alias("value"))
    arrays.write.option("maxRecordsPerFile", 1).partitionBy("file").text(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred, which reads the files twice."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.schema(schema).csv(path, header=True)
