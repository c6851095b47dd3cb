"""What the footers of single files declare."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession

COLUMNS = "path string, column_name string, actual_type string"
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
# Names of the same types in both.
_TYPES = {
    "int64": "bigint", "int32": "int", "int16": "smallint", "int8": "tinyint", "double": "double", "float": "float",
    "bool": "boolean", "string": "string", "large_string": "string", "date32[day]": "date", "binary": "binary",
}
_JSON_TYPES = {"long": "bigint", "integer": "int", "short": "smallint", "byte": "tinyint"}


def footer_columns(uri: str) -> list[tuple[str, str]]:
    """(column, type) of one file, types named as Spark names them."""
    # Hadoop writes local paths with one slash.
    files, path = pyarrow.fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if "://" not in uri else uri)
    schema = pyarrow.parquet.read_schema(path, filesystem=files)
    told = json.loads((schema.metadata or {}).get(SPARK_SCHEMA, b"{}")).get("fields", [])
    by_spark = {f["name"]: _JSON_TYPES.get(f["type"], f["type"]) for f in told if isinstance(f["type"], str)}
    return [(f.name, by_spark.get(f.name) or _TYPES.get(str(f.type), str(f.type))) for f in schema]


def file_columns(spark: SparkSession, folder: str) -> DataFrame:
    """(path, column_name, actual_type) of every parquet file below ``folder``, from its own footer.

    Files are listed by Spark and their footers read in tasks, so their number does not matter.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                found = [{"path": uri, "column_name": c, "actual_type": t} for c, t in footer_columns(uri)]
                yield pa.RecordBatch.from_pylist(found, pa.schema([(c, pa.string()) for c in ("path", "column_name", "actual_type")]))

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    paths = listed.load(folder).select("path")
    # Listed files are packed by their sizes, which have nothing to do with reading footers.
    return paths.repartition("path").mapInArrow(read, COLUMNS)
