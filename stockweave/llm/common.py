"""What the operators share: access to whole texts inside tasks, tables, scratch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

# The ASCII white space that separates words, as bytes.split() does.
WHITE_SPACE = b" \t\n\r\x0b\x0c"
SLICE = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text; NULL reads as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows, so that a task never unpacks many texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; NULL reads as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def arrow_type(kind: T.DataType) -> pa.DataType:
    simple = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return simple[kind.simpleString()]


def with_computed(
    df: DataFrame,
    added: str,
    prepare: Callable[[], Callable[[pa.RecordBatch], Iterable]],
    drop: Iterable[str] = (),
) -> DataFrame:
    """``df`` with the columns of the DDL text ``added``, computed slice by slice in Python.

    ``prepare`` runs once per task and returns the function of one slice, which gives one
    sequence per added column. Columns in ``drop`` are seen by that function but not returned.
    A column of ``df`` that has the name of an added one is seen too, and replaced.
    """
    fields = T.StructType.fromDDL(added).fields
    gone = {f.name.lower() for f in fields} | {name.lower() for name in drop}
    out = [f for f in df.schema.fields if f.name.lower() not in gone]
    schema = T.StructType([*out, *fields])

    def run(batches):
        compute = prepare()
        for part in slices(batches):
            columns = [part.column(f.name) for f in out]
            new = [
                c if isinstance(c, pa.Array) else pa.array(c, type=arrow_type(f.dataType))
                for c, f in zip(compute(part), fields, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=[f.name for f in schema.fields])
        # Workers live on between tasks; give back what this one no longer holds.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


class WordIds(dict):
    """Word to a 64-bit number that depends on the word alone; remembers a bounded number of words."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = xxh3_64_intdigest(word)
        if len(self) < self.most:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (multiply, shift, twice); equal inputs stay equal, others differ."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# One odd multiplier per place of a window; they follow from the place.
def place_factors(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit number for every window of ``size`` consecutive ids."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for place, factor in enumerate(place_factors(size)):
        total += mix(ids[place : place + n] ^ factor) * factor if size <= 2 else ids[place : place + n] * factor
    return mix(total)


def set_aside(docs: DataFrame, *inputs: str) -> DataFrame:
    """``inputs`` as they are and all other columns in one struct, ``row``, where no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in inputs]
    return docs.select(F.struct(F.lit(0).alias("_"), *rest).alias("row"), *inputs)


def restored(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Undo :func:`set_aside`: exactly ``columns``, in their order."""
    own = {f.name for f in rows.schema["row"].dataType.fields}
    return rows.select(*[F.col(f"row.`{c}`") if c in own else F.col(f"`{c}`") for c in columns])
