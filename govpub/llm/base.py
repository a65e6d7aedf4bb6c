"""Registration, staged tables and small text helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Folders of local sessions that name none, by application.
_OWN: dict[str, str] = {}

#: Rows of an Arrow batch. Texts are long, so a task holds few of them at a time; Spark also ends a batch at
#: `spark.sql.execution.arrow.maxBytesPerBatch` (64 MB unless the session says otherwise).
BATCH_ROWS = 256
#: Bytes of text that a task works on together.
PORTION = 1_000_000


def query(sql: str | None = None) -> Callable:
    """Register a query under its function name, with the SQL that has to give the same rows."""
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`. Where the session names none, a local master
    gets a folder of its own; a cluster has to name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; it has to name a folder that driver and executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="govpub-shared-")
    return _OWN[context.applicationId]


def valid(text: str | Column) -> Column:
    """The text with every ill-formed UTF-8 sequence replaced by U+FFFD, as Python would decode it."""
    return F.make_valid_utf8(F.col(text) if isinstance(text, str) else text)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where a column has them already."""
    taken = {c.lower() for c in df.columns}
    return [next(n for k in range(len(taken) + 1) if (n := name + "_" * k).lower() not in taken) for name in names]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/govpub-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage ends here, a lost executor loses nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | T.StructType) -> DataFrame:
    """mapInArrow in small batches."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(task, schema)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                                       for c, f in zip(columns, schema)], schema=schema)


def text_hash(text: str | Column = "text") -> Column:
    return F.xxhash64(F.col(text) if isinstance(text, str) else text)


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def portions(texts: list, size: int = PORTION) -> Iterator[slice]:
    """Neighbouring texts of about `size` bytes together; a longer text stays alone."""
    begin = held = 0
    for k, text in enumerate(texts):
        if k > begin and held + len(text) > size:
            yield slice(begin, k)
            begin, held = k, 0
        held += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


# --- words -----------------------------------------------------------------------------

#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z; all other bytes separate words. A byte of a
#: character beyond ASCII is never a separator.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased words of letters, digits and characters beyond ASCII."""
    return text.translate(_WORD_BYTES).split()


def texts_as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


# --- 64 bit hashes in numpy ------------------------------------------------------------

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64 bit finaliser (splitmix64)."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """Word -> 64 bit hash, filled as words come, emptied when it holds `limit` words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words; a shorter text that has words is one shingle."""
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    out = mix(words[: n - size + 1])
    for k in range(1, size):
        out = mix(out ^ words[k: n - size + 1 + k])
    return out
