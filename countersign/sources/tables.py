"""What to compare, and how each side is opened."""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from countersign.sources.catalog import table_metadata

INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"
# Formats whose files tell their number of rows, and the settings by which Spark asks them for it.
COUNTED_FORMATS = ("parquet", "orc")
FOOTER_COUNTS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.orc.aggregatePushdown": "true",
    INFERENCE: "false",
}
# Formats whose partition values are only text in directory names, so that Spark guesses a type.
DIRECTORY_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro")


@dataclass(frozen=True)
class Stored:
    """A copy that is opened by storage path.

    Give the schema of a very large directory tree, so that it is not listed twice.
    """

    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | str | None = None


Side = str | Stored | DataFrame


@dataclass(frozen=True)
class TableSpec:
    """A pair of copies. A side is a catalog name, a ``Stored`` path or a DataFrame."""

    table_name: str
    left: Side
    right: Side
    partition_column: str | None = None


def open_side(spark: SparkSession, side: Side) -> DataFrame:
    if isinstance(side, DataFrame):
        return side
    return open_path(spark, side) if isinstance(side, Stored) else spark.table(side)


def open_path(spark: SparkSession, stored: Stored) -> DataFrame:
    """Open by format and path, keeping partition keys from directory names as text.

    Spark would read ``pt=20250101`` as an integer: leading zeros would be lost and the key
    would count as a numeric column. So the schema is asked of a session that does not guess: its
    keys are those that Spark finds below the path. Give a schema to list the files once only.
    """
    reader = spark.read.format(stored.format).options(**stored.options)
    if stored.schema is not None:
        return reader.schema(stored.schema).load(stored.path)
    if stored.format.lower() not in DIRECTORY_FORMATS or spark.conf.get(INFERENCE) != "true":
        return reader.load(stored.path)
    plain = spark.newSession()
    plain.conf.set(INFERENCE, "false")
    schema = plain.read.format(stored.format).options(**stored.options).load(stored.path).schema
    return reader.schema(schema).load(stored.path)


def _session_like(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A session of its own with the settings of the given one, but for those that are named."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name not in settings and own.conf.isModifiable(name) and own.conf.get(name, None) != value:
            own.conf.set(name, value)
    for name, value in settings.items():
        own.conf.set(name, value)
    return own


def open_for_counts(spark: SparkSession, side: Side) -> DataFrame:
    """Like ``open_side``, for a table of which only rows are counted, as a whole or by directory key.

    Spark then takes the numbers from the footers of Parquet and ORC files and reads no column. Keys that are
    ordinary columns, filters on such, other formats and copies given otherwise are scanned as ever, with the same counts.
    """
    if not isinstance(side, Stored) or side.format.lower() not in COUNTED_FORMATS:
        return open_side(spark, side)
    reader = _session_like(spark, FOOTER_COUNTS).read.format(side.format).options(**side.options)
    return (reader.schema(side.schema) if side.schema is not None else reader).load(side.path)


def _folder(location: str) -> str:
    """A location in one form: ``file:/a``, ``file:///a`` and ``/a/`` are the same folder."""
    scheme, colon, rest = location.partition(":")
    path = rest if colon and "/" not in scheme else location
    path = "/" + path.strip("/") if not path.startswith("//") or path.startswith("///") else path.rstrip("/")
    return path if not colon or scheme == "file" else f"{scheme}:{path}"


def check_two_copies(spark: SparkSession, spec: TableSpec) -> None:
    """A table must not be compared with itself: that passes and says nothing."""
    if isinstance(spec.left, Stored) and isinstance(spec.right, str):
        location, _ = table_metadata(spark, spec.right)
        if location and _folder(location) == _folder(spec.left.path):
            raise ValueError(f"both copies of {spec.table_name} are the same folder: {location}")
