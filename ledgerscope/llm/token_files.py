"""Token ids as binary files: written in document order, read back in parallel.

Documents are range-sorted by id; each task encodes its range of whole texts and
emits runs of about RUN ids (see rans.py for their bytes), so a task holds one
run at a time. A row of the files is a run: its partition, place, document ids
and bytes. Rows decode independently of each other. They are written with
Spark's own committer to the given (shared) folder, uncompressed since they are
entropy-coded.

Defined cases: a null or empty text is its end id alone; null ids come first;
rows with equal ids follow one another by a hash of the text, then the text; an
empty table gives files without runs; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerscope.llm import rans
from ledgerscope.llm.common import map_arrow, ship, slices, table
from ledgerscope.llm.tokens import tokenizer, with_end
from ledgerscope.session import ensure_checkpoint_dir

RUN, END_ID = 1 << 22, 0


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID) -> None:
    def run(batches):
        from pyspark import TaskContext

        tok, pid = tokenizer(vocabulary), TaskContext.get().partitionId()
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        rows = first = 0

        def out():
            nonlocal held, rows, first
            names = pa.concat_arrays([h[0] for h in held])
            ids, lengths = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            doc_ids = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
            data = pa.array([rans.encode(ids, lengths)], pa.binary())
            b = pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([rows], pa.int32()), pa.array([first]), pa.array([len(ids)]), doc_ids, data], names=["pid", "run", "first", "n_tokens", "doc_ids", "data"])
            held, rows, first = [], rows + 1, first + len(ids)
            return b

        for b in slices(batches, 1, 6 << 20):
            ids, off = with_end(*tok.encode(b.column(1)), end_id)
            held.append((b.column(0), ids, np.diff(off)))
            if sum(len(h[1]) for h in held) >= RUN:
                yield out()
        if held:
            yield out()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    h = F.xxhash64("text")
    d = d.repartitionByRange(n, F.col("doc_id"), h).sortWithinPartitions(F.col("doc_id"), h, F.col("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    files = map_arrow(d, run, f"pid int, run int, first long, n_tokens long, doc_ids array<{kind}>, data binary", tokenizes=True)
    files.write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, and
    ``ids`` if asked for."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids, lengths = rans.decode(b.column(3)[i].as_py())
                names = b.column(2)[i].values
                if len(names) != len(lengths):
                    raise ValueError("a run's document ids don't fit its lengths")
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                raw = ids.astype("<u4")
                crc = pa.array([zlib.crc32(raw[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64())
                pid = pa.array(np.full(len(names), b.column(0)[i].as_py(), np.int32))
                cols = [pid, names, pa.array(starts + b.column(1)[i].as_py()), pa.array(lengths.astype(np.int64)), crc]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(raw.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(cols, names=["pid", "doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    ship(spark)
    schema = f"pid int, doc_id {kind}, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    rows = map_arrow(files.select("pid", "first", "doc_ids", "data"), run, schema)
    totals = files.groupBy("pid").agg(F.sum("n_tokens").alias("_n"))  # one row a partition
    w = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select("pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_earlier"))
    out = rows.join(earlier, "pid").withColumn("start", F.col("start") + F.col("_earlier"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path)
