"""CSV and JSON sources with declared columns; every column is a string, and null, empty and blank mean "no value"."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import has_value, split_list, strip, text_or_empty

_OPTIONS = {"multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}
BAD_ROW = "_bad_row"


class MissingColumns(ValueError):
    pass


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first file's header, without a byte-order mark."""
    row = spark.read.options(**_OPTIONS).option("header", "false").csv(path).limit(1).collect()
    if not row:
        raise MissingColumns(f"{path} has no header")
    return [(v or "").lstrip("\ufeff").strip() for v in row[0]]


def read_csv(spark: SparkSession, path: str, required: list[str] | tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """All columns of a CSV file as strings, with "" for missing cells.

    Missing required columns raise an error that names them.  `strict` also rejects duplicate column names and, when
    the result is used, rows with too many or too few cells.
    """
    names = header(spark, path)
    absent = sorted(set(required) - set(names))
    if absent:
        raise MissingColumns(f"{path} lacks the columns {', '.join(absent)}")
    if strict and len(set(names)) < len(names):
        raise ValueError(f"{path} has duplicate column names")
    seen: dict[str, int] = {}
    unique = []
    for n in names:
        seen[n] = seen.get(n, 0) + 1
        unique.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in unique])
    if strict:
        schema = schema.add(BAD_ROW, T.StringType())
    reader = spark.read.options(**_OPTIONS).option("header", "true").option("enforceSchema", "true").option("mode", "PERMISSIVE")
    df = reader.option("columnNameOfCorruptRecord", BAD_ROW).schema(schema).csv(path)
    if strict:
        checked = F.when(F.col(BAD_ROW).isNotNull(), F.raise_error(F.concat(F.lit(f"{path}: row with a wrong number of cells: "), F.col(BAD_ROW))))
        df = df.withColumn(unique[0], F.coalesce(checked.cast("string"), F.col(unique[0]))).drop(BAD_ROW)
    return df.na.fill("")


def read_csv_lenient(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, warnings): short rows padded with "", long rows cut; warnings (issue, n) counts what was mended."""
    names = header(spark, path)
    raw = spark.read.options(**_OPTIONS).option("header", "true").schema(T.StructType([*[T.StructField(f"c{i}", T.StringType()) for i in range(len(names))], T.StructField(BAD_ROW, T.StringType())]))
    df = raw.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_ROW).csv(path)
    unique = [n if names.index(n) == i else f"{n}_{names[: i + 1].count(n)}" for i, n in enumerate(names)]
    rows = df.select(*[F.coalesce(f"c{i}", F.lit("")).alias(n) for i, n in enumerate(unique)])
    # the reader refuses to read the column of bad rows alone; the second condition always holds
    wrong = F.col(BAD_ROW).isNotNull() & (F.length(F.coalesce("c0", F.lit(""))) >= 0)
    bad = df.agg(F.count(F.when(wrong, 1)).alias("n")).select(F.lit("rows with a wrong number of cells").alias("issue"), "n")
    dup = df.sparkSession.createDataFrame([("duplicate column names", len(names) - len(set(names)))], "issue string, n long")
    return rows, bad.unionByName(dup).where("n > 0")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(name, id, seq) of a JSON object of name to integer, in document order; other shapes raise an error when used."""
    text = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string,bigint>", {"mode": "FAILFAST"})
    rows = text.select(F.posexplode(F.map_entries(m)).alias("seq", "e"))
    bad = F.raise_error(F.concat(F.lit("no integer for "), F.col("e.key")))
    return rows.select(F.col("e.key").alias("name"), F.coalesce(F.col("e.value"), bad.cast("bigint")).alias("id"), "seq")


def invert_mapping(mapping: DataFrame) -> DataFrame:
    """(id, name): where an id has several names, the last one in document order."""
    return mapping.groupBy("id").agg(F.max_by("name", "seq").alias("name"))


def labelled_documents(rows: DataFrame, names: DataFrame, source_type: str = "dataset", filename: str = "train.csv", split: str = "train") -> DataFrame:
    """Documents of a (text, label) table: stripped, blank texts dropped, bad or unknown labels an error, the first of
    equal (text, label) kept; in the order of the file.

    (filename, page_number, text, source_type, metadata) with the name and the text below each other.
    """
    t = rows.select(F.monotonically_increasing_id().alias("seq"), text_or_empty("text").alias("t"), text_or_empty("label").alias("l")).where("t <> ''")
    label = F.coalesce(F.col("l").try_cast("bigint"), F.raise_error(F.concat(F.lit("label is no integer: "), F.col("l"))).cast("bigint"))
    first = t.select("seq", "t", label.alias("id")).groupBy("t", "id").agg(F.min("seq").alias("seq"))
    j = first.join(names.select("id", "name"), "id", "left")
    name = F.coalesce("name", F.raise_error(F.concat(F.lit("unknown label "), F.col("id").cast("string"))).cast("string"))
    meta = F.struct(
        F.col("id").alias("disease_id"), name.alias("disease_name"), F.col("t").alias("raw_symptom_text"), F.lit(source_type).alias("data_source"), F.lit(split).alias("dataset_split")
    )
    d = j.select("seq", meta.alias("metadata"))
    text = F.concat(F.lit("Disease: "), F.col("metadata.disease_name"), F.lit("\nSymptoms: "), F.col("metadata.raw_symptom_text"))
    return d.orderBy("seq").select(F.lit(filename).alias("filename"), F.lit(None).cast("int").alias("page_number"), text.alias("text"), F.lit(source_type).alias("source_type"), "metadata")


def ids_of_log(rows: DataFrame, column: str = "pmids") -> DataFrame:
    """(id, n): ids packed with commas in a log, blanks dropped, with how often each occurs."""
    return rows.select(F.explode(split_list(column, ",")).alias("id")).groupBy("id").agg(F.count("*").alias("n"))


def read_pages(spark: SparkSession, path: str, extract, glob: str = "*.pdf") -> DataFrame:
    """(filename, page_number, text, source_type, metadata) of paged files; `extract` maps the bytes of a file to its page texts."""
    import pandas as pd

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    out = "filename string, page_number int, text string, source_type string, metadata map<string,string>"

    def run(batches):
        for pdf in batches:
            rows = []
            for p, content in zip(pdf["path"], pdf["content"]):
                name = p.rpartition("/")[2]
                rows += [(name, i, t, "PDF", {"file_path": p}) for i, t in enumerate(extract(content), 1)]
            yield pd.DataFrame(rows, columns=["filename", "page_number", "text", "source_type", "metadata"])

    return files.select("path", "content").mapInPandas(run, out).orderBy("filename", "page_number")


def manifest_files(manifest: DataFrame, listing: DataFrame, route: str = "pmc") -> DataFrame:
    """(pmcid, path), sorted: the distinct ids of a route whose file <id>.xml is in the listing (path)."""
    wanted = manifest.where((F.lower(strip("acquisition_route")) == route) & has_value("pmcid")).select(strip("pmcid").alias("pmcid")).distinct()
    there = listing.select("path", F.regexp_extract("path", r"([^/]+)[.]xml$", 1).alias("pmcid")).where("pmcid <> ''")
    return there.join(wanted, "pmcid", "left_semi").select("pmcid", "path").orderBy("pmcid")
