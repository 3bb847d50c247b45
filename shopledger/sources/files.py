"""CSV drops: schemas, lineage columns, writing."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, TimestampType

# The lineage columns and the column for text that does not fit the stored type.
LINEAGE = ("_ingest_ts", "_file_mod_time", "_source_file")
RESCUED = "_rescued_data"
# The header of the file a rescued record came from.
RESCUED_HEADER = "_rescued_header"


def read_schema(spark: SparkSession, path: str) -> StructType | None:
    """The latest schema saved by ``save_schema``, or None."""
    latest = latest_row(spark, path, "version long, value string")
    return StructType.fromJson(json.loads(latest.value)) if latest else None


def save_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """A new version beside the old ones, so that a failed write leaves the old one readable."""
    append_row(spark, path, "version long, value string", schema.json())


def latest_row(spark: SparkSession, path: str, columns: str) -> Row | None:
    """The row of the highest version of a small append-only file set, or None."""
    try:
        return spark.read.schema(columns).json(path).orderBy(F.col("version").desc()).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_row(spark: SparkSession, path: str, columns: str, value: object) -> None:
    latest = latest_row(spark, path, columns)
    put_row(spark, path, columns, latest.version + 1 if latest else 0, value)


def put_row(spark: SparkSession, path: str, columns: str, version: int, value: object) -> None:
    """``append_row`` for a caller that knows the next version."""
    row = spark.createDataFrame([(version, value)], columns)
    row.coalesce(1).write.mode("append").json(path)


def file_schema(spark: SparkSession, source: str, infer: bool) -> StructType:
    """Column names in file order; all text, or with types inferred from every row present."""
    return spark.read.option("header", True).option("inferSchema", infer).csv(source).schema


def stored_schema(spark: SparkSession, source: str, schema_path: str, infer: bool) -> StructType:
    """The schema of the source, fixed at its first use so that later files cannot change types."""
    schema = read_schema(spark, schema_path)
    if schema is None:
        schema = file_schema(spark, source, infer)
        if infer:
            schema = StructType([*schema.fields, StructField(RESCUED, StringType())])
        save_schema(spark, schema_path, schema)
    return schema


def csv_options(schema: StructType) -> dict[str, str]:
    """Header checked against the schema: Spark assigns CSV columns by position, so a file with
    another layout has to fail rather than shift values into wrong columns."""
    options = {"header": "true", "enforceSchema": "false"}
    if RESCUED in schema.names:
        options["columnNameOfCorruptRecord"] = RESCUED
    return options


def ingested_schema(stored: StructType) -> StructType:
    """What an ingested table holds: the source's columns and the lineage."""
    types = (TimestampType(), TimestampType(), StringType())
    lineage = [StructField(name, kind) for name, kind in zip(LINEAGE, types)]
    return StructType([*stored.fields, *lineage])


# What a type can become without losing a value it held, narrowest first.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double", "string"),
    "smallint": ("int", "bigint", "double", "string"),
    "int": ("bigint", "double", "string"),
    "bigint": ("double", "string"),
    "float": ("double", "string"),
    "double": ("string",),
    "date": ("timestamp", "string"),
    "timestamp": ("string",),
    "boolean": ("string",),
}


def wider(kept: str, found: str) -> str | None:
    """The narrowest type that holds what both types do, or None where that is the kept one.

    A whole number above 2^53 is not exact as a double; ``bigint`` meets ``double`` there all the
    same, as a reader of mixed numbers expects.
    """
    if found == kept or kept == "string" or kept in WIDER.get(found, ()):
        return None
    if found in WIDER.get(kept, ()):
        return found
    return next((t for t in WIDER.get(kept, ()) if t in WIDER.get(found, ())), "string")


def stored_as(field: StructField) -> str:
    """The column that holds a field's values since its type was last widened."""
    return field.metadata.get("stored_as", field.name)


def earlier(field: StructField) -> list[tuple[str, str]]:
    """Columns and types that held a field's values before its type was widened, oldest first."""
    return [(name, kind) for name, kind in field.metadata.get("earlier", [])]


def widened(field: StructField, kind: str) -> StructField:
    """The field with a wider type, stored in a column of its own from now on."""
    before = [*earlier(field), (stored_as(field), field.dataType.simpleString())]
    history = {"earlier": [list(entry) for entry in before], "stored_as": f"{field.name}#{len(before)}"}
    return StructField(field.name, DataType.fromDDL(kind), metadata={**field.metadata, **history})


def physical_schema(stored: StructType) -> StructType:
    """The columns of the files: every column a field was or is stored in."""
    fields = []
    for field in stored:
        fields += [StructField(name, DataType.fromDDL(kind)) for name, kind in earlier(field)]
        fields.append(StructField(stored_as(field), field.dataType))
    if RESCUED in stored.names:
        fields.append(StructField(RESCUED_HEADER, StringType()))
    return StructType(fields)


def field_sql(field: StructField, stored: StructType) -> str:
    """SQL that reads a field from the files' columns, under its present type.

    A widened field is looked for in its earlier columns too, and in the rescued records: there its
    place in the record is its name's place in the header.
    """
    kind = field.dataType.simpleString()
    if not earlier(field):
        return f"try_cast(`{stored_as(field)}` AS {kind})"
    columns = [stored_as(field), *[name for name, _ in reversed(earlier(field))]]
    parts = [f"try_cast(`{name}` AS {kind})" for name in columns]
    if RESCUED in stored.names:
        names = [f"c{i}" for i in range(len(stored))]
        shape = ", ".join(f"{name} STRING" for name in names)

        def cells(column: str) -> str:
            # One parse, then its fields as an array.
            listed = ", ".join(f"s.{name}" for name in names)
            return f"get(transform(array(from_csv({column}, '{shape}')), s -> array({listed})), 0)"

        name = field.name.replace("\\", "\\\\").replace("'", "\\'")
        at = f"cast(array_position({cells(RESCUED_HEADER)}, '{name}') AS INT) - 1"
        # First, as a record's fields may have been cut to the narrower type.
        parts.insert(0, f"try_cast(get({cells(RESCUED)}, {at}) AS {kind})")
    return f"coalesce({', '.join(parts)})"


def with_lineage(raw: DataFrame) -> DataFrame:
    """All source columns plus ingest time, file modification time and file path."""
    return raw.select(
        "*",
        F.current_timestamp().alias("_ingest_ts"),
        F.col("_metadata.file_modification_time").alias("_file_mod_time"),
        F.col("_metadata.file_path").alias("_source_file"),
    )


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with header, replacing what is there. ``files`` fixes the file count of small drops."""
    out = df.coalesce(files) if files else df
    out.write.mode("overwrite").option("header", True).csv(path)
