"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.session import shared_dir

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes of an Arrow batch, which bound what a Python worker holds at a time.
BATCH_ROWS, BATCH_BYTES = 1000, 8 * 2**20

_words = re.compile(WORD).findall
_ascii_lower = {c: c + 32 for c in range(65, 91)}


#: Where this package was imported from; where executors have it too, their workers find it there.
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of the session that a query runs in, and let workers import this package."""
    workers = spark.sparkContext.environment
    if _ROOT not in workers.get("PYTHONPATH", "").split(os.pathsep):
        workers["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, workers.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the folder that all executors share.

    Cuts the lineage, so that neither a second use nor a lost executor computes it again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_held: dict[str, Callable[[], None]] = {}


def hold(name: str = "", free: Callable[[], None] | None = None) -> None:
    """In a worker: keep what an operator remembers between tasks, and free what others do.

    Workers outlive their tasks, so one that turns to another operator would keep both.
    """
    for other in [n for n in _held if n != name]:
        _held.pop(other)()
    if free is not None:
        _held[name] = free


def fold(key: str, buckets: int) -> Column:
    """crc32 of an id's decimal text, modulo ``buckets``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % buckets


def lower_ascii(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_ascii_lower)


def words_of(text: str | None) -> list[str]:
    return _words(text) if text else []


def lower_words(texts: pa.Array) -> Iterator[list[bytes]]:
    """The words of each text, with A-Z in lower case, as UTF-8; a null text has none."""
    return ((text or b"").lower().split() for text in texts.cast(pa.binary()).to_pylist())


def appended(
    df: DataFrame, fields: Sequence[tuple[str, str]], compute: Callable[[pa.RecordBatch], Sequence], keep: Sequence[str] | None = None
) -> DataFrame:
    """``df`` with further columns that ``compute`` makes from an Arrow batch.

    A column of the input that has the name of a new one is replaced, as with ``withColumn``.
    ``keep``: the input columns to return, all by default.
    """
    names = [n for n, _ in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in {n.lower() for n in names}]
    added = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in fields))
    schema = T.StructType([*(df.schema[c] for c in kept), *added.fields])
    arrow_types = [_arrow(f.dataType) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                new = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(compute(batch), arrow_types)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new], names=[*kept, *names])

    return df.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {
        T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.FloatType: pa.float32(),
        T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(),
    }
    return pa.list_(_arrow(kind.elementType)) if isinstance(kind, T.ArrayType) else simple[type(kind)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def code_runs(texts: Sequence[str], size: int = 2**18, overlap: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points of whole texts in runs of bounded length: (codes, first positions, text numbers).

    Non-empty texts only.  A text longer than ``size`` goes on in the next run, ``overlap``
    characters earlier, so that windows of ``overlap`` + 1 are seen exactly once.
    """
    parts: list[str] = []
    numbers: list[int] = []
    filled = 0

    def run():
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        return codes, np.cumsum([0, *map(len, parts)])[:-1], np.array(numbers)

    for number, text in enumerate(texts):
        at = 0
        while at == 0 and text or at + overlap < len(text):
            part = text[at : at + size]
            if filled and filled + len(part) > size:
                yield run()
                parts, numbers, filled = [], [], 0
            parts.append(part)
            numbers.append(number)
            filled += len(part)
            at += max(1, size - overlap)
    if parts:
        yield run()


def share_of_ids(key: str, salt: int) -> Column:
    """A number in [0, 1) that an id always gets, for samples of a stated expected size."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(2**30)) / F.lit(float(2**30))


def largest_counts(counts: DataFrame, limit: int, key: str) -> DataFrame:
    """The rows of ``counts`` (with a count ``n``) above the least bound that leaves at most ``limit`` of them.

    The bound comes from the number of rows of each count, where counts above ``limit`` are told apart
    by their first thirteen bits; so a bounded number of rows comes to the driver.  If the highest of these
    classes alone has more rows than ``limit``, the largest of it by ``n``, then the least by ``key``, are returned.
    """
    steps = F.expr("shiftleft(1L, greatest(0, cast(floor(log2(n)) AS int) - 12))")
    at = F.when(F.col("n") <= limit, F.col("n")).otherwise(F.greatest(F.col("n") - F.pmod(F.col("n"), steps), F.lit(limit + 1)))
    classes = counts.groupBy(at.alias("n")).agg(F.count("*").alias("k")).collect()
    total, least = 0, None
    for n, k in sorted(((r["n"], r["k"]) for r in classes), reverse=True):
        total += k
        if total > limit:
            break
        least = n
    if least is None and classes:
        top = counts.where(F.col("n") >= max(r["n"] for r in classes))
        return top.orderBy(F.desc("n"), key).limit(limit)
    return counts.where(F.lit(False) if least is None else F.col("n") >= least)
