"""What the operators of this subpackage share: tables written between stages, one object
per Python worker, and hashing of words."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions that run in tasks travel with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORKER_SETTINGS = {
    # Texts may be long: a batch of rows must fit a Python worker several times over.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tuned(spark: SparkSession) -> SparkSession:
    for key, value in WORKER_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`. Only a local master may go without that
    setting; it then gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{shared.rstrip('/')}/{name}-{os.urandom(8).hex()}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written in here deletes its shuffle files as it ends. A write has a plan and
    shuffles of its own, so nothing can ask for them again."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def write_parquet(df: DataFrame, path: str, **options) -> None:
    with freed_shuffles(df.sparkSession):
        df.write.options(**options).parquet(path)


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """`df` as a Parquet table in the shared folder: lineage ends there, and a lost
    executor costs only its running tasks."""
    path = shared_folder(df.sparkSession, name)
    write_parquet(df, path, compression="zstd", **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that the table does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text column; null is empty."""
    return F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b"").cast("binary"))


def binary_array(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def worker_state(key: object, make):
    """One object per Python worker process, kept between tasks."""
    store = sys.__dict__.setdefault("_llm_worker_state", {})
    if key not in store:
        store[key] = make()
    return store[key]


def worker_large(version: str, make):
    """The worker's one large object, which makes way for the next stage's with all else
    that the worker holds: it goes through many stages, and its memory must hold each alone."""
    store = worker_state("large", dict)
    if version not in store:
        sys.__dict__["_llm_worker_state"].clear()
        store.clear()
        give_back()
        worker_state("large", lambda: store)[version] = make()
        give_back()
    return store[version]


def worker_alone(stage: str) -> None:
    """Let go of what the worker holds of other stages."""
    worker_large(stage, lambda: None)


def give_back() -> None:
    """Return freed memory to the system, which allocators else keep for the process."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # not the GNU C library


MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(MIX[1])
    h ^= h >> np.uint64(27)
    h = h * np.uint64(MIX[2])
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, computed once while the word is held."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes() -> WordHashes:
    return worker_state("word_hashes", WordHashes)


def hashed_words(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def chained(h: np.ndarray, steps: tuple[int, ...]) -> np.ndarray:
    """Hashes of the n-grams that start at each position and take the words at `steps`
    from it: (0, 1) are bigrams, (0, 2) skip one word."""
    last = steps[-1]
    if len(h) <= last:
        return np.empty(0, np.uint64)
    n = len(h) - last
    out = np.full(n, (last + 1) * MIX[0] % (1 << 64), np.uint64)
    for s in steps:
        out = mixed(out * np.uint64(0x100000001B3) + h[s : s + n])
    return out
