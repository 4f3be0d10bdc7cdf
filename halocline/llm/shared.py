"""Helpers of the operators: stored intermediates, text batches, word hashes, shipping the package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from halocline.session import ensure_checkpoint_dir

ROOT = Path(__file__).resolve().parents[2]
#: Characters of text that a task holds as arrays at once; a longer text is a batch of its own.
BATCH_CHARS = 1_000_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    folder = ensure_checkpoint_dir(spark)
    if folder is None:
        raise ValueError("name a shared folder in spark.checkpoint.dir")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back, so that lost executors cost no recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0].rpartition("/")[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers unless their path already has it."""
    context = spark.sparkContext
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(":")]
    if any(k and Path(k).resolve() == ROOT for k in known) or getattr(context, "_halocline_sent", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="halocline-package-")) / "halocline-package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted((ROOT / "halocline").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    context.addPyFile(str(archive))
    context._halocline_sent = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of ids that no model learns from; null ids count as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; plain ASCII takes the faster function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower()))


def text_slices(batch: pa.RecordBatch, at: int, chars: int = BATCH_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Successive slices of a batch with the texts of column ``at``, about ``chars`` characters in each; null is empty.

    Texts become Python strings a few rows at a time, so a wide batch is never held twice.
    """
    start, size, texts = 0, 0, []
    for low in range(0, batch.num_rows, 64):
        for t in batch.column(at).slice(low, 64).to_pylist():
            texts.append(t or "")
            size += len(texts[-1])
            if size >= chars:
                yield batch.slice(start, len(texts)), texts
                start, size, texts = start + len(texts), 0, []
    if texts:
        yield batch.slice(start, len(texts)), texts


def columns_of(batches: Iterable[pa.RecordBatch], chars: int = BATCH_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """``text_slices`` of batches whose last column is the text."""
    for batch in batches:
        yield from text_slices(batch, batch.num_columns - 1, chars)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


#: Of a byte: a random-looking number, and whether it is a space or one of 0x09 to 0x0D.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BASE = 0x9E3779B97F4A7C15
#: Bytes hashed at once; a word may go on in the next piece.
PIECE_BYTES = 1 << 19


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64, for the places of a piece."""
    def of(base: int) -> np.ndarray:
        out = np.full(PIECE_BYTES, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return of(_BASE), of(pow(_BASE, -1, 1 << 64))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a whole text, A-Z lower-cased, in order.

    A word's hash is the sum of its bytes' numbers times powers of the base, taken from
    running sums over a piece of the text, and mixed.  The sum of a word that a piece breaks off is
    carried into the next, so memory does not grow with a word's length.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    up, down = _powers()
    out: list[np.ndarray] = []
    open_sum, open_bytes = np.uint64(0), 0
    with np.errstate(over="ignore"):
        for low in range(0, len(data), PIECE_BYTES):
            piece = data[low:low + PIECE_BYTES]
            edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[piece], [True]])))
            start, end = edge[::2], edge[1::2]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[piece] * up[:len(piece)], dtype=np.uint64)])
            h = (sums[end] - sums[start]) * down[start]
            goes_on = open_bytes > 0 and len(start) > 0 and start[0] == 0
            if goes_on:
                h[0] = open_sum + np.uint64(pow(_BASE, open_bytes, 1 << 64)) * h[0]
            elif open_bytes:
                out.append(np.array([open_sum], np.uint64))
            before = open_bytes if goes_on else 0
            open_bytes = 0
            if len(end) and end[-1] == len(piece):
                open_sum, open_bytes = h[-1], int(end[-1] - start[-1]) + (before if len(h) == 1 else 0)
                h = h[:-1]
            out.append(h)
    if open_bytes:
        out.append(np.array([open_sum], np.uint64))
    return mix(np.concatenate(out)) if out else np.empty(0, np.uint64)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k successive words; fewer words than k make one shingle, none make none."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        if n < k:
            h = np.full(1, n, np.uint64)
            for w in words:
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w)
            return h
        h = np.full(n - k + 1, k, np.uint64)
        for i in range(k):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i:n - k + 1 + i])
        return h


def fresh(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
