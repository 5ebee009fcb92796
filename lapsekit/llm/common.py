"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: The white space that separates words: space and the control characters 9 to 13.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it (a checkout that is not installed)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in (have := env.get("PYTHONPATH", "")).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, have)))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (``spark.checkpoint.dir``).

    Where the session names none, a temporary folder is used on ``local`` masters
    only; on a cluster that is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-scratch-"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later jobs start
    from the files, so a lost executor costs only the tasks that ran there."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(*frames: DataFrame) -> None:
    """Delete the files of intermediate ``stored`` tables that nothing reads any more."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row: a lambda variable keeps the
    optimizer from copying the expression to each place where it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The runs of non-space characters of a text, in order (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def without_space(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def frame(rows: list[tuple], names: list[str], ids: tuple[str, ...] = ()) -> pd.DataFrame:
    """Rows as a pandas frame; the columns ``ids`` are nullable integers, never floating point."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pd.DataFrame({n: pd.array([None if x is None else int(x) for x in c], "Int64") if n in ids
                         else pd.Series(list(c), dtype=None if c else object) for n, c in zip(names, columns, strict=True)})


SLICE = 256  # rows that a worker holds as Python values at once


def map_slices(df: DataFrame, schema: str | StructType, fn, rows: int = SLICE) -> DataFrame:
    """``mapInArrow`` by small slices: ``fn`` takes {column: values} and returns the same for ``schema``,
    so that a worker's memory follows the slice and not the batch."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, rows):
                out = fn(b.slice(at, rows).to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    return df.mapInArrow(run, schema)
