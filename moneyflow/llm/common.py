"""Helpers shared by the training-data operators: table reads, shared storage, word folding.

Conventions that every operator of this subpackage keeps:

* an operator takes a DataFrame and the names of the columns it needs; other columns are never read, so
  extra columns with clashing names do no harm;
* a null text counts as the empty text, unless the operator's docstring says otherwise;
* intermediate results that must not be recomputed go to the folder in ``spark.checkpoint.dir`` as Parquet,
  which survives the loss of any executor.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def bounded_batches(spark: SparkSession) -> None:
    """Python workers get batches bounded by rows and by bytes, for the sake of long texts.

    Spark takes these from the session, so they hold there; what the caller has set stays.
    """
    own = spark.conf.getAll
    for key, value in BATCH.items():
        if key not in own:
            spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with so many underscores before it that no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where ``spark.checkpoint.dir`` is unset, as in tests."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="moneyflow-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each execution within go at its end, not when the driver happens to collect its garbage.

    For what is executed once only. The session has its own setting back afterwards.
    """
    own = spark.conf.getAll.get(REMOVE_SHUFFLES)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, own)


def stash(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and fixes the rows' order in files.

    The write leaves no shuffle files behind.
    """
    spark = df.sparkSession
    path = shared_path(spark, tag)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stash_path = path
    return out


def discard(*stashed: DataFrame) -> None:
    """Delete stashed tables that nothing reads any more: what was made of them must be written already."""
    for df in stashed:
        place = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stash_path)
        place.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


#: Bits of the table of hashes that ``split`` broadcasts, at most, and bits for each hash while there are fewer.
MAX_BITS, BITS_A_HASH = 1 << 26, 32
BITMAP = 1 << 15


def split(rows: DataFrame, hashed: Column, hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have a value of ``hashed`` (long, evenly spread) among the ``hashes`` (one column, staged), and those that have none.

    The first are all that have one and few others: a join with them gives what a join with all rows gives, and the
    others are in no shuffle. A bit is set for each hash; the bits are broadcast, eight megabytes of them at most,
    however many hashes there are: more only make the first part larger. Nulls are in the second.
    """
    with shuffles_removed(rows.sparkSession):
        n, bits = hashes.count(), BITMAP
    while bits < min(MAX_BITS, BITS_A_HASH * n):
        bits *= 2
    number, bitmap = unused(rows, "bitmap_number", "bitmap")
    bit = F.pmod(F.col(hashes.columns[0]), F.lit(bits))
    own = hashes.select((bit / BITMAP).cast("int").alias(number), (bit % BITMAP).alias("bit"))
    bitmaps = own.groupBy(number).agg(F.bitmap_construct_agg("bit").alias(bitmap))
    place = F.pmod(hashed, F.lit(bits))
    byte = F.ascii(F.decode(F.substring(F.col(bitmap), (place % BITMAP / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    known = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    marked = rows.join(F.broadcast(bitmaps), (place / BITMAP).cast("int") == F.col(number), "left")
    return marked.where(known).drop(number, bitmap), marked.where(~known).drop(number, bitmap)


_KEPT: dict = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` returns, kept in this Python worker for later tasks with the same key; one at a time."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
