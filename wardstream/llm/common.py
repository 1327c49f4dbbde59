"""Small helpers shared by the training-data operators."""

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of text in a file, of tables that have more shuffle partitions than that.
FILE_ROWS, FILE_BYTES = 1 << 12, 8 << 20

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _ship(application: str) -> str:
    """The package as a ZIP file on the driver, from where Spark hands it to the executors."""
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="wardstream-")) / "wardstream.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    return str(path)


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors, once."""
    context = spark.sparkContext
    path = _ship(context.applicationId)
    if path not in _shipped:
        context.addPyFile(path)
        _shipped.add(path)


def map_batches(df: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """``df.mapInArrow`` for a function that uses this package, which the executors need not have."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def fields(df: DataFrame, *names: str, more: str = "") -> T.StructType:
    """The columns ``names`` of ``df`` (all, if none are named) and those declared in ``more``."""
    own = [f for f in df.schema if not names or f.name in names]
    return T.StructType(own + (list(T.StructType.fromDDL(more)) if more else []))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def hashable(df: DataFrame) -> list[Column]:
    """The columns that Spark can hash (maps and variants it cannot)."""

    def ok(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return ok(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(ok(f.dataType) for f in kind)
        return not isinstance(kind, T.MapType | T.VariantType)

    return [F.col(f"`{f.name}`") for f in df.schema if ok(f.dataType)]


def rows_and_files(rows: DataFrame, text: str) -> tuple[int, int]:
    """The number of rows, and how many files are enough for a table that grows with them.

    It follows rows and text, with two a core at the least, so files and tasks don't become small where there are many partitions.
    """
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(text).cast("string")))).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return n, max(2 * cores, -(-n // FILE_ROWS), -(-(size or 0) // FILE_BYTES))


def slices(
    batch: pa.RecordBatch, sizes: str | pa.Array, limit: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``limit`` in size, one row at the least.

    ``sizes``: a column of texts, whose bytes count, or the sizes.
    """
    if isinstance(sizes, str):
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(sizes)), 0)
    ends = sizes.to_numpy(zero_copy_only=False).astype("int64").cumsum()
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(ends.searchsorted(base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
