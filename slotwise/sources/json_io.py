"""JSON sources: webhook event documents, spend files (array or lines), manifests.

All scans take an explicit schema: no inference pass over the input, and column
names that do not depend on the batch. ``layout="document"`` reads each file as one
JSON value (a file is then one task: JSON documents are not splittable, so many small
files are packed by ``spark.sql.files.maxPartitionBytes``); ``layout="lines"`` reads
JSON lines and splits large files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise import schemas as S


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType,
              layout: str = "lines", path_glob: str | None = None,
              recursive: bool = False, corrupt_col: str | None = None) -> DataFrame:
    if layout not in ("lines", "document", "array"):
        raise ValueError(f"unknown layout {layout!r}")
    reader = spark.read.schema(schema).option("multiLine", layout != "lines")
    if corrupt_col:
        reader = (reader.schema(T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())]))
                  .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.json(path if isinstance(path, str) else list(path))


def read_event_documents(spark: SparkSession, path: str, layout: str = "lines",
                         corrupt_col: str | None = None, schema: T.StructType = S.BOOKING_EVENT_DOC) -> DataFrame:
    """Booking documents plus ``event_date`` taken from the file's folder
    (``.../event_date=YYYY-MM-DD/...``); a path without it gives NULL."""
    docs = read_json(spark, path, schema, layout, recursive=True, corrupt_col=corrupt_col)
    folder_day = F.regexp_extract(F.col("_metadata.file_path"), S.EVENT_DATE_PATTERN, 1)
    return docs.withColumn("event_date", F.nullif(folder_day, F.lit("")))


def _extended(known: T.DataType, found: T.DataType) -> T.DataType:
    """``known`` with the fields of ``found`` that it does not name; known types stay."""
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        more = {f.name: f.dataType for f in found.fields}
        fields = [T.StructField(f.name, _extended(f.dataType, more[f.name]) if f.name in more else f.dataType) for f in known.fields]
        return T.StructType(fields + [T.StructField(n, _plain(t)) for n, t in more.items() if n not in known.fieldNames()])
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(_extended(known.elementType, found.elementType))
    return known


def _plain(found: T.DataType) -> T.DataType:
    """Types of fields that only the data name: where documents differ (VARIANT) or hold
    only nulls, the JSON text."""
    if isinstance(found, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in found.fields])
    if isinstance(found, T.ArrayType):
        return T.ArrayType(_plain(found.elementType))
    if isinstance(found, T.DecimalType):
        return T.DoubleType()
    return T.StringType() if isinstance(found, (T.VariantType, T.NullType)) else found


def document_schema(documents: DataFrame, col: str = "value", known: T.StructType = S.BOOKING_EVENT_DOC) -> T.StructType:
    """``known`` extended by the fields that the documents (JSON text) hold beyond it, found
    in one aggregate over their VARIANT form; one schema string reaches the driver. Documents that
    are no JSON object add nothing."""
    # The first character tells an object: a filter on the parsed value would parse every text twice.
    shape = documents.where(F.col(col).rlike(r"^[ \t\r\n]*\{")) \
        .agg(F.schema_of_variant_agg(F.try_parse_json(col)).alias("shape")).first()[0]
    if shape is None or not shape.startswith("OBJECT<"):
        return known
    return _extended(known, T._parse_datatype_string(shape.replace("OBJECT<", "STRUCT<")))


def read_open_documents(spark: SparkSession, path: str, known: T.StructType = S.BOOKING_EVENT_DOC,
                        corrupt_col: str | None = None) -> DataFrame:
    """JSON-lines documents with every field that they hold: those of ``known`` with their
    types, further ones (nested too) with the types the data show. ``event_date`` as in
    ``read_event_documents``."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    schema = document_schema(lines, "value", known)
    return read_event_documents(spark, path, "lines", corrupt_col, schema)


def read_spend_files(spark: SparkSession, path: str | list[str], layout: str = "array",
                     path_glob: str | None = None,
                     schema: T.StructType = S.SPEND_RECORD_RAW) -> DataFrame:
    """Spend records of every file below ``path`` (whatever its name) but the
    manifest; ``spend`` is read as text so numbers, text and gaps all load (they are
    typed later with ``try_cast``)."""
    return read_json(spark, path, schema, layout, path_glob=path_glob, recursive=True) \
        .where(~F.col("_metadata.file_path").contains(f"/{S.MANIFEST_NAME}")) \
        .withColumn("file_path", F.col("_metadata.file_path"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The distinct file names listed by a manifest: one or several
    ``{"files": [...]}`` objects, indented or one per line."""
    whole = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    # one object as a document, else one per line
    document = F.from_json("value", S.MANIFEST)
    lines = F.transform(F.split("value", r"\r?\n"), lambda line: F.from_json(line, S.MANIFEST)["files"])
    files = F.when(document["files"].isNotNull() & (F.size(F.split(F.trim("value"), r"\}\s*\{")) == 1), document["files"]) \
        .otherwise(F.flatten(F.filter(lines, lambda x: x.isNotNull())))
    return (whole.select(F.explode(files).alias("file_name"))
            .where(F.col("file_name").isNotNull()).distinct())


def _children(spark: SparkSession, path: str) -> dict[str, str]:
    """Name -> path of what lies directly in a folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(root)}


def listed_files(spark: SparkSession, data_path: str, manifest_path: str) -> tuple[dict[str, str], list[str]]:
    """The listed files that are there (name -> path), and the names that are not. One
    name per day of spend: the list is as long as the folder's own listing."""
    there = _children(spark, data_path)
    names = sorted(r["file_name"] for r in read_manifest(spark, manifest_path).collect())
    return {n: there[n] for n in names if n in there}, [n for n in names if n not in there]


_OBJECT_END = "}"


def read_array_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of files that hold one JSON array of flat objects each: ``date, channel, spend``
    (text), ``place`` (from 0 in the file), ``file_path``, ``file_name``.

    A large array is read by several tasks: the text scan takes ``}`` as its line end, so
    every piece of a file split is one object, and a piece's place is its number in the split
    plus the pieces of the file's earlier splits (one count per split). A file of which a
    piece is no object by itself (braces in a text or nested values, other elements) is
    read as one document instead."""
    pieces = spark.read.option("lineSep", _OBJECT_END).text(paths).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("mid"),
        F.regexp_replace("value", r"^\uFEFF?[\s,]*\[?\s*", "").alias("body"))
    tail = F.trim(F.translate("body", "\n\r\t", "   ")).isin("", "]", "[", "[]")
    broken = T.StructType([*S.SPEND_RECORD_RAW.fields, T.StructField("_broken", T.StringType())])
    parsed = pieces.where(~tail).withColumn(
        "r", F.from_json(F.concat("body", F.lit(_OBJECT_END)), broken, {"columnNameOfCorruptRecord": "_broken"}))
    # No piece holds a brace of its own: it is one whole flat object.
    whole = F.col("r._broken").isNull() & F.col("body").startswith("{") & ~F.substring("body", 2, 1 << 30).contains("{")
    splits = parsed.groupBy("file_path", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min("mid").alias("first"), F.count_if(~F.coalesce(whole, F.lit(False))).alias("odd"))
    of_file = Window.partitionBy("file_path")
    before = F.coalesce(F.sum("n").over(of_file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file_path", "split", "first", before.alias("before"), F.sum("odd").over(of_file).alias("odd"))
    # A split's pieces are the consecutive rows of one task, so their numbers have no gap but the array's tail.
    plain = parsed.join(splits.where("odd = 0"), ["file_path", "split"]).select(
        "r.date", "r.channel", "r.spend", (F.col("before") + F.col("mid") - F.col("first")).alias("place"), "file_path", "file_name")
    documents = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"), "value")
    odd = splits.where("odd > 0").select("file_path").distinct()
    others = documents.join(odd, "file_path", "left_semi").select(
        F.posexplode(F.from_json("value", T.ArrayType(S.SPEND_RECORD_RAW))).alias("place", "r"), "file_path", "file_name") \
        .select("r.date", "r.channel", "r.spend", F.col("place").cast("long").alias("place"), "file_path", "file_name")
    return plain.unionByName(others)


def load_listed_files(spark: SparkSession, data_path: str, manifest_path: str,
                      layout: str = "array") -> DataFrame:
    """Every record of every file the manifest lists, in one distributed scan of
    exactly those files: ``date, channel, spend`` (text), ``position``, ``file_name``.

    ``array``: a file is one JSON array, read in splits (``read_array_records``); ``position``
    is the place in it, after those of the day's files of smaller number
    (``<day>.00001.json``). ``lines``: a
    file (or folder of parts) holds JSON lines; ``position`` is read from the records.
    """
    found, _ = listed_files(spark, data_path, manifest_path)
    if not found:
        return spark.createDataFrame([], T.StructType(S.SPEND_RECORD_RAW_POS.fields + [T.StructField("file_name", T.StringType())]))
    paths = list(found.values())
    if layout == "array":
        number = F.coalesce(F.regexp_extract("file_name", S.SPEND_FILE_NUMBER, 1).try_cast("long"), F.lit(0))
        return read_array_records(spark, paths).select(
            "date", "channel", "spend", (F.shiftleft(number, 32) + F.col("place")).alias("position"), "file_name")
    records = read_json(spark, paths, S.SPEND_RECORD_RAW_POS, layout, recursive=True)
    parts = F.split(F.col("_metadata.file_path"), "/")
    name = F.when(F.element_at(parts, -1).startswith(S.SPEND_FILE_PREFIX), F.element_at(parts, -1)) \
        .otherwise(F.element_at(parts, -2))              # a folder of parts has the file's name
    return records.select("date", "channel", "spend", "position", name.alias("file_name"))
