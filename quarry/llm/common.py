"""Small helpers shared by the corpus operators: reading tables, stage tables
in the cluster's shared folder, and word splitting on UTF-8 bytes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quarry.session import ensure_checkpoint_dir, shuffle_cleanup

#: ASCII A-Z to a-z; every other byte stays.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Lower-cases A-Z and turns every byte outside [0-9a-z\x80-\xFF] into a space.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stages:
    """Stage tables of one operator run, as Parquet in the shared folder.  A
    lost executor costs only the tasks of the current stage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.written: set[str] = set()
        _OPEN.append(self)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path, schema = f"{self.root}/{name}", df.schema
        with shuffle_cleanup(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        self.written.add(name)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a stage table of this run that no later stage reads."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
        self.written.discard(name)


#: The runs of this process whose tables may still be read.
_OPEN: list[Stages] = []


def drop_stages(since: int) -> None:
    """Delete the stage tables of the runs begun after the first ``since``:
    for a caller who has written their results."""
    for run in _OPEN[since:]:
        for name in sorted(run.written):
            run.drop(name)
    del _OPEN[since:]


def open_runs() -> int:
    return len(_OPEN)


def byte_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, null as None."""
    return column.cast(pa.binary()).to_pylist()


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``f`` turns each Arrow batch into the columns of its result."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = f(batch)
                yield pa.RecordBatch.from_arrays([pa.array(columns[x.name], x.type) for x in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def mapped(df: DataFrame, f, schema: str) -> DataFrame:
    """``f`` turns a task's batches into lists of columns, one list a batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in f(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that near values get unrelated bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
