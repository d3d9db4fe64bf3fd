"""Helpers shared by the operators: staged tables and hashing of row keys."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.session import scratch_path


#: Rows that a Python step of a staged table is handed at a time: texts are long, and each batch is held several times over.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Python steps of what is run inside get at most ``rows`` rows at a time; the session's own setting comes back."""
    own = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(int(own), rows) if int(own) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, own)


class Scratch:
    """The staged tables of one piece of work; those not `kept` go when it ends, as no later step reads them."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, {}

    def add(self, df: DataFrame, path: str) -> None:
        self._paths[id(df)] = df, path

    def kept(self, df: DataFrame) -> DataFrame:
        """``df`` (as `staged` gave it) outlives this work; it belongs to the work around it, if any."""
        df, path = self._paths.pop(id(df))
        if _open[:-1]:
            _open[-2].add(df, path)
        return df

    def drop(self, *frames: DataFrame) -> None:
        """Deletes what `staged` gave as ``frames``."""
        for df in frames:
            _, path = self._paths.pop(id(df))
            folder = self._spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(folder, True)


_open: list[Scratch] = []


@contextmanager
def scratch(spark: SparkSession):
    """Owns the tables staged inside. What it returns to the outside must be `kept`, also when read lazily."""
    own = Scratch(spark)
    _open.append(own)
    try:
        yield own
    finally:
        own.drop(*(df for df, _ in list(own._paths.values())))
        _open.pop()


#: Narrow rows of a file of a staged table whose size is known beforehand, and its least number of files.
FILE_ROWS, LEAST_FILES = 100_000, 4


def staged(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS, at_most: int | None = None, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; its Python steps get ``batch_rows`` rows at a time.

    Where it has ``at_most`` so many rows of a few numbers, these take as
    many tasks and files as they need, however many shuffle partitions there are.

    This cuts the lineage: a lost executor costs a re-read of the files, not
    a recomputation, and no later step computes ``df`` again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if at_most is not None:
        df = df.coalesce(max(LEAST_FILES, -(-at_most // FILE_ROWS)))
    with small_batches(spark, batch_rows):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if _open:
        _open[-1].add(out, path)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """The fold of a row: crc32 of its key as text, modulo ``folds`` (a null key counts as '')."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores in front as it takes to differ from all ``taken`` (in any case)."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def smallest_hashes(rows: DataFrame, wanted: int) -> DataFrame:
    """``wanted`` of the different (doc_id, text_hash) of ``rows``, those with the smallest hashes of both (all, if fewer); null keys never; staged.

    The number is exact whatever the number of rows, and a repeated key or
    row is one.
    """
    keys = rows.where("doc_id is not null").select("doc_id", "text_hash").distinct()
    return staged(keys.orderBy(F.xxhash64("doc_id", "text_hash"), "doc_id", "text_hash").limit(min(wanted, (1 << 31) - 1)), "sampled-keys")


def plain_key(df: DataFrame, key: str, *columns: Column) -> DataFrame:
    """``key`` as a long that is never null, ``no_key`` where it was, and further columns.

    Pandas turns longs next to nulls into floats, which lose the last digits;
    `restore_key` undoes this after the Python step.
    """
    value = F.col(key).cast("long")
    return df.select(F.coalesce(value, F.lit(0)).alias(key), value.isNull().alias("no_key"), *columns)


def restore_key(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, F.when(~F.col("no_key"), F.col(key))).drop("no_key")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes up to which a table is sent to all executors.
BROADCAST_BYTES = 16 << 20
#: Bytes that a row of such a table takes besides its strings and arrays.
ROW_BYTES = 64


def sent_if_small(df: DataFrame, row_bytes: int | Column = ROW_BYTES) -> DataFrame:
    """The staged table ``df``, to be sent to all executors if its bytes allow that; else the join shuffles.

    ``row_bytes``: the most that a row takes (fixed-size columns), or a column
    that says it for each row, which is added up over the table.
    """
    if isinstance(row_bytes, Column):
        small = (df.agg(F.sum(row_bytes + ROW_BYTES)).first()[0] or 0) <= BROADCAST_BYTES
    else:
        small = is_small(df, BROADCAST_BYTES // row_bytes)
    return F.broadcast(df) if small else df


def is_small(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` (a staged table) has at most ``max_rows`` rows; reads no more than that."""
    return df.limit(max_rows + 1).count() <= max_rows
