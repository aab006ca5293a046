"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netlens.session import materialize

#: rows that ``with_column`` works on at once: its new column and the copies of it on the way to
#: Spark are held for these only, not for a whole record batch
ROWS_AT_ONCE = 1000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str) -> Column:
    """The text, with null counted as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


@contextmanager
def shuffle_files_dropped(spark: SparkSession):
    """Shuffle files of the queries run inside go when each query ends, not when
    the driver happens to collect garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back."""
    with shuffle_files_dropped(df.sparkSession):
        return materialize(df, name)


_FORGET: dict[str, Callable[[], None]] = {}


def taken_over(operator: str, forget: Callable[[], None] | None = None) -> None:
    """To be called where a task of ``operator`` begins: Python workers outlive stages, so what
    tasks of other operators remembered in this one is dropped.  ``forget`` drops what those of
    ``operator`` remember."""
    gone = [_FORGET.pop(o) for o in [*_FORGET] if o != operator]
    for drop in gone:
        drop()
    if gone:
        gc.collect()
        pa.default_memory_pool().release_unused()
    if forget:
        _FORGET[operator] = forget


def with_column(df: DataFrame, name: str, kind: T.DataType, add) -> DataFrame:
    """``df`` with the Arrow column that ``add`` makes of each (part of a) record batch as its
    last column; a column of that name is replaced."""
    kept = [c for c in df.columns if c != name]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(name, kind)])

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(at, ROWS_AT_ONCE)
                columns = [b.column(b.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, add(b)], [*kept, name])

    return df.mapInArrow(run, schema)


# --- bounded samples of labelled rows ----------------------------------------------------

def train_rows(labels: DataFrame, label_col: str, fold_of: Column, max_per_class: int,
               id_col: str = "doc_id") -> DataFrame:
    """(__id, __y): at most ``max_per_class`` ids of either label where ``fold_of`` holds."""
    rows = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & fold_of)
            .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("__y")))
    by_hash = [F.xxhash64("__id"), F.col("__id")]
    return (rows.filter("__y = 1").orderBy(*by_hash).limit(max_per_class)
            .unionByName(rows.filter("__y <> 1").orderBy(*by_hash).limit(max_per_class)))


def train_texts(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__y, __t): label and text of the chosen rows (a bounded sample, so broadcast)."""
    texts = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__t"))
    return texts.join(F.broadcast(chosen), "__id").select("__y", "__t")


# --- a set of 64-bit keys as a bit table of fixed size ---------------------------------

BITS = 1 << 23


def bits_for(keys: int, most: int, least: int = 1 << 16) -> int:
    """Bits of a table for so many keys: 16 each as a power of two, ``least`` to ``most``."""
    return min(most, max(least, 1 << (16 * keys).bit_length()))


def _slot(key: Column, bits: int) -> Column:
    return F.pmod(key, F.lit(bits))


def bit_table(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """Rows (__word, __bits): bit ``key mod bits`` is set for every key.

    At most ``bits / 64`` rows of two longs (131,072 rows, 2 MB, at the default),
    whatever the number of keys, so it may be broadcast.  A probe never misses a
    key that is in the set; it may let others through.
    """
    slot = _slot(F.col(key), bits)
    return (keys.select(F.shiftright(slot, 6).alias("__word"),
                        F.expr(f"shiftleft(1L, cast(pmod({key}, 64) as int))").alias("__bit"))
            .groupBy("__word").agg(F.bit_or("__bit").alias("__bits")))


def flag_members(df: DataFrame, key: str, bit_rows: DataFrame, flag: str,
                 bits: int = BITS) -> DataFrame:
    """``df`` with a boolean ``flag``: false only where ``key`` is surely not in the set."""
    probed = (df.withColumn("__word", F.shiftright(_slot(F.col(key), bits), 6))
              .join(F.broadcast(bit_rows), "__word", "left"))
    hit = F.expr(f"coalesce(__bits & shiftleft(1L, cast(pmod({key}, 64) as int)), 0L) <> 0L")
    return probed.withColumn(flag, hit).drop("__word", "__bits")


def bit_array(keys: DataFrame, key: str, bits: int = BITS):
    """The bit table of ``keys`` as a numpy array of ``bits / 64`` words (8 MB at 2**26 bits),
    to be broadcast and probed with ``probe``."""
    rows = bit_table(keys, key, bits).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    if rows.num_rows:
        words[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return words


def probe(words, hashes):
    """For each uint64 hash whether its bit is set."""
    slot = hashes & np.uint64(len(words) * 64 - 1)
    return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
