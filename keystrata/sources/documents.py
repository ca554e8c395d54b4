"""Versioned JSON documents (G1, G2) with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The shape of the shipped inventories' features.
FEATURE = "parentId STRING, name STRING, component STRING, geometryStatus STRING, osmType STRING, osmId BIGINT, evidence STRING, note STRING, lon DOUBLE, lat DOUBLE, areaDka DOUBLE, sourceCrs STRING"


def documents(spark: SparkSession, paths: str | list[str], schema: str, lines: bool = False) -> DataFrame:
    """Pretty-printed JSON documents, one row each, with their path; lines: files of one document a line."""
    return spark.read.schema(schema).option("multiLine", not lines).json(paths).withColumn("path", F.input_file_name())


def exploded(docs: DataFrame, array: str, *keep: str) -> DataFrame:
    """One row an element of an array of structs, with its position from 0."""
    return docs.select(*keep, F.posexplode(array).alias("pos", "row")).select(*keep, "pos", "row.*")


def evidence_list(evidence: Column) -> Column:
    """A plain string, or a JSON array of strings read as a string, as an array; '[' begins plain strings, too."""
    parsed = F.from_json(evidence, T.ArrayType(T.StringType()))
    return F.when(evidence.isNull(), None).when(evidence.startswith("["), F.coalesce(parsed, F.array(evidence))).otherwise(F.array(evidence))


def unified(spark: SparkSession, paths: str | list[str], array: str, fields: dict[str, tuple[list[str], str]], lines: bool = False) -> DataFrame:
    """One row an element of an array of all documents, its fields under one name and type each, with path and pos.

    fields: for each name the names it goes by in the documents, the first that is there counting, and its
    type. Documents may differ in both: every field is read as JSON text first, so a string in one and an array
    in another are in one scan. array<string> takes plain text for an array of one; for other types text
    that can't be cast is null.
    """
    given = ", ".join(dict.fromkeys(f"`{n}` string" for names, _ in fields.values() for n in names))
    rows = exploded(documents(spark, paths, f"`{array}` array<struct<{given}>>", lines), array, "path")

    def typed(names: list[str], kind: str) -> Column:
        text = F.coalesce(*(F.col(f"`{n}`") for n in names))
        return evidence_list(text) if kind == "array<string>" else text.try_cast(kind)

    return rows.select("path", "pos", *(typed(*f).alias(n) for n, f in fields.items()))


def manifest(spark: SparkSession, index_path: str, field: str = "files") -> list[str]:
    """Paths an index document lists, in its order, beside it. An index is a small document."""
    rows = documents(spark, index_path, f"{field} ARRAY<STRING>").select(field).collect()
    folder = index_path.rsplit("/", 1)[0]
    return [f"{folder}/{name.rsplit('/', 1)[-1]}" for r in rows for name in r[0] or []]


def from_manifest(spark: SparkSession, index_path: str, schema: str, field: str = "files") -> DataFrame:
    """All documents of an index, with their order in it."""
    paths = manifest(spark, index_path, field)
    if not paths:
        return documents(spark, index_path, schema).where("false").withColumn("file_no", F.lit(0))
    names = F.array(*(F.lit(p.rsplit("/", 1)[-1]) for p in paths))
    return documents(spark, paths, schema).withColumn("file_no", F.array_position(names, F.element_at(F.split("path", "/"), -1)).cast("int") - 1)


def write_documents(folder: str, documents: dict[str, DataFrame]) -> None:
    """Write each named DataFrame's rows, one JSON object each, as folder/name; one object makes one document.

    Names stay as given, so an index can list them. Each is written by one task: documents are small.
    """
    for name, rows in documents.items():
        context = rows.sparkSession.sparkContext
        made = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}")
        rows.coalesce(1).write.mode("overwrite").json(made.toString())
        files = made.getFileSystem(context._jsc.hadoopConfiguration())
        part = next(p for p in (f.getPath() for f in files.listStatus(made)) if p.getName().startswith("part-"))
        target = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        files.delete(target, True)
        files.rename(part, target)
        files.delete(made, True)
