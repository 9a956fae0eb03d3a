"""Helpers shared by the operators: tables, folds, written stages, Arrow text buffers.

Word and line conventions of every operator here: a word is a run of characters
other than space and TAB..CR (0x09-0x0D), which is also how ASCII splitting in
Arrow works; a null text counts as an empty one.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.session import ensure_checkpoint_dir

#: Word of the contracts, as a Java pattern.
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package where PYTHONPATH doesn't name it:
    the sources go to the executors once an application, as ``--py-files`` does."""
    package = Path(__file__).resolve().parents[1]
    sc = spark.sparkContext
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_ledgerscope_shipped", False):
        return
    path = f"{tempfile.mkdtemp(prefix='ledgerscope-src-')}/ledgerscope-src.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(path)
    sc._ledgerscope_shipped = True


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, tokenizes: bool = False) -> DataFrame:
    """mapInArrow; a task that doesn't tokenize lets go of what its (reused) worker
    remembers of earlier tokenizing tasks, so stages don't add up their memory."""

    def task(batches):
        if not tokenizes and (tokens := sys.modules.get("ledgerscope.llm.tokens")):
            tokens.forget()
        yield from run(batches)

    ship(df.sparkSession)
    return df.mapInArrow(task, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text, modulo n; a null id counts as an empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % n


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once under the shared checkpoint folder and read back.

    Cuts the lineage with column pruning kept: later steps read only the
    columns they use, and a lost executor rereads files instead of replaying.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], *names: str) -> list[str]:
    """Names that clash with none of ``columns``, whatever their case."""
    have = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def as_text(arr: pa.Array) -> pa.Array:
    """A string array without nulls, with 64-bit offsets."""
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    return arr.cast(pa.large_string())


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string array (nulls as empty)."""
    arr = as_text(arr)
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 12 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of the batches with at most ``most`` bytes of text each, or one row."""
    for b in batches:
        if not b.num_rows:
            continue
        _, off = utf8(b.column(column))
        at = 0
        while at < b.num_rows:
            to = int(np.searchsorted(off, off[at] + most, side="right")) - 1
            to = min(max(to, at + 1), b.num_rows)
            yield b.slice(at, to - at)
            at = to


def sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each row's range; 0 for an empty range."""
    out = np.zeros(len(off) - 1, np.float64 if flags.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(off[1:] > off[:-1])
    if len(full):
        out[full] = np.add.reduceat(flags, off[:-1][full], dtype=out.dtype)
    return out


def owners(off: np.ndarray) -> np.ndarray:
    """Row number of each element."""
    return np.repeat(np.arange(len(off) - 1), np.diff(off))


def split_words(arr: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after the other, and each text's offsets."""
    lists = pc.ascii_split_whitespace(as_text(arr))
    off = np.asarray(lists.offsets, dtype=np.int64)
    words = lists.values
    words = words.slice(off[0], off[-1] - off[0]) if len(off) else words
    off = off - off[0]
    lens = np.asarray(pc.binary_length(words), dtype=np.int64)
    if len(lens) and not lens.all():  # white space at a text's ends gives empty words
        keep = lens > 0
        off = np.concatenate([[0], np.cumsum(sums(keep.astype(np.int8), off))])
        words = words.filter(pa.array(keep))
    return words, off


def crc_of_ids(ids: np.ndarray) -> int:
    import zlib

    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
