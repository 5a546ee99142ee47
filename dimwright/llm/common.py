"""Helpers shared by the training-data operators.

Conventions of all operators here:

* a null text counts as the empty text;
* ``doc_id`` identifies a document; rows that repeat a ``doc_id`` with the same
  text are repeats of that document and share its result;
* a null ``doc_id`` ranks after every other id;
* only the named input columns are read, so extra columns never clash.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.session import delete_path, work_path

#: Stands for a null doc_id in orderings: after every other id.
LAST_ID = (1 << 63) - 1
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Odd multiplier of the polynomial word-sequence hashes (2^64 / golden ratio).
_M = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ship_package(spark: SparkSession) -> None:
    """Hand this package's code to the Python workers (as ``--py-files`` would), once per application."""
    sc = spark.sparkContext
    name = "dimwright-code.zip"
    if any(str(f).endswith(name) for f in sc._python_includes or ()):
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="dimwright-code-"), name)
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)  # code only; Spark copies it to every executor


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with the empty text for null; ``doc_id`` may stay null."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Drop the shuffle files of each finished write inside the block.

    Intermediate results are written tables, so a finished write's shuffle files
    are never read again; without this they stay until the driver collects garbage.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage with a table that every executor can read, so a lost
    executor never forces the steps before it to run again.  ``small`` is for
    tables far smaller than the input: eight shuffle partitions share a file.
    """
    spark = df.sparkSession
    if small:
        df = df.coalesce(max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    path = work_path(spark, f"llm-{name}")
    with shuffle_cleanup(spark):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def forget(table: DataFrame) -> None:
    """Delete a table of ``stored`` once all that was derived from it is stored itself."""
    delete_path(table.sparkSession, table._stored_at)


# ----------------------------------------------------------------------------
# words and word-sequence hashes (numpy, inside Arrow batches)
# ----------------------------------------------------------------------------


def split_words(text: str) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+``: bytes.split() uses exactly this white space."""
    return text.encode().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A keyed 64-bit hash of each word, the same in every process."""
    out = np.empty(len(words), dtype=object)
    out[:] = words
    return hash_array(out, categorize=False)


def gram_hashes(h: np.ndarray, k: int, mult: int = _M) -> np.ndarray:
    """Polynomial hashes of all ``k``-word sequences of the word hashes ``h``.

    Built by doubling, so it costs about 2 log2(k) vector operations.
    """
    if len(h) < k:
        return np.empty(0, dtype=np.uint64)
    n = len(h) - k + 1
    result, have = None, 0
    power, size = h, 1
    while True:
        if k & size:
            if result is None:
                result, have = power, size
            else:  # the words so far, then ``size`` more
                m = len(power) - have
                result = result[:m] * np.uint64(pow(mult, size, 1 << 64)) + power[have : have + m]
                have += size
        if size * 2 > k:
            break
        power = power[:-size] * np.uint64(pow(mult, size, 1 << 64)) + power[size:]
        size *= 2
    return mix(result[:n])


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the entropy of ``x`` over all 64 bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``rows`` rows (bounded work buffers)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
