"""JSON files of records: one array, one object, or one object a line.

``multiLine`` JSON reads a whole file in one task, so one big array would be one
task's work. Here Spark's text source cuts every file at closing braces, in byte
ranges like any text file. Whether a brace ends a record depends on what stands
before it: inside a string, or how many objects are open. So each byte range is
summed up once for both cases (one row a range), the ranges of a file are chained
in order, and with its start known each range is cut into records by itself. Only
records that cross the border of two ranges are put together by a shuffle.

Results: the file's objects as text, in any layout and with any white space; objects
inside an object stay part of it. What lies between objects (brackets, commas) is
skipped. A record that the file's end cuts off comes out as it stands, and parses to
nulls. An empty file or array gives no record. A file without closing braces is one
piece, so it must fit a task. Compressed files are one range each, and there a record
cut off before its last brace gets one.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.session import cut_lineage, ensure_checkpoint_dir

#: beyond so many byte ranges their start states (about 100 bytes each) are joined by a shuffle
MAX_BROADCAST_RANGES = 100_000

_ESCAPED = re.compile(r"\\.", re.DOTALL)


def piece_effect(piece: str, quoted: int) -> tuple[int, int]:
    """(objects opened outside strings, whether a string is open at the end)."""
    plain = _ESCAPED.sub("", piece) if "\\" in piece else piece
    parts = plain.split('"')
    return sum(p.count("{") for p in parts[quoted::2]), quoted ^ (len(parts) - 1) & 1


def _effects(batches):
    """One row a range: for both start states the change of depth, its lowest point
    and the state at the end."""
    import pyarrow as pa

    state: dict[tuple, list] = {}
    for b in batches:
        for path, block, piece, size, file_size in zip(*[b.column(i).to_pylist() for i in range(5)]):
            s = state.setdefault((path, block), [[0, 0, 0], [0, 0, 1], 0, file_size])
            s[2] += size + 1
            for case in s[:2]:
                opened, case[2] = piece_effect(piece, case[2])
                case[0] += opened
                if not case[2]:
                    case[0] -= 1
                    case[1] = min(case[1], case[0])
    rows = [(p, b, *s[0], *s[1], s[2], s[3]) for (p, b), s in state.items()]
    names = [n.split()[0] for n in _EFFECT.split(", ")]
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    kinds = [pa.string(), pa.int64(), *[pa.int64()] * 8]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


_EFFECT = "path string, block long, net0 long, low0 long, end0 long, net1 long, low1 long, end1 long, bytes long, size long"
_START = "path string, block long, quoted int, depth long, origin long, cut boolean"


def _chain(ranges):
    """Start states of one file's ranges, in order (one row for each 128 MB or so).
    ``origin`` is the range in which the open record began; ``cut`` marks the last
    range of a file that doesn't end in a closing brace."""
    import pandas as pd

    out, quoted, depth, origin = [], 0, 0, -1
    r = ranges.sort_values("block")
    total = int(r["bytes"].sum())
    for row in r.itertuples():
        out.append((row.path, row.block, quoted, depth, origin, False))
        net, low, end = (row.net1, row.low1, row.end1) if quoted else (row.net0, row.low0, row.end0)
        if depth + low <= 0:
            origin = row.block
        quoted, depth = int(end), max(depth + net, net - low)
    got = pd.DataFrame(out, columns=["path", "block", "quoted", "depth", "origin", "cut"])
    got.loc[got.index[-1], "cut"] = total == int(r["size"].iloc[0]) + 1  # one brace more than there is
    return got


def _records(batches):
    """Pieces of ranges with known start -> (path, origin, block, text, whole): whole
    records, and at a range's ends the parts of records that cross them."""
    import pyarrow as pa

    names = ["path", "origin", "block", "text", "whole"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    here, buf, out = None, [], []
    quoted = depth = origin = 0
    cut, held = False, None

    def take(piece, closed):
        """One piece; ``closed`` where a closing brace follows it."""
        nonlocal quoted, depth, origin, buf
        at_top = depth == 0 and not buf
        if at_top and not quoted:
            first = piece.find("{")
            start = piece if first < 0 else piece[:first]
            _, quoted = piece_effect(start, quoted)
            piece = "" if first < 0 else piece[first:]
        opened, quoted = piece_effect(piece, quoted)
        depth += opened
        if depth == 0:
            return
        if at_top:
            origin = here[1]
        buf.append(piece + "}" if closed else piece)
        if closed and not quoted:
            depth -= 1
            if depth == 0:
                out.append((here[0], origin, here[1], "".join(buf), origin == here[1]))
                buf = []

    def leave(last):
        nonlocal buf, held
        if held is not None:
            take(held, not (last and cut))
            held = None
        if last and buf:
            out.append((here[0], origin, here[1], "".join(buf), False))
            buf = []

    for b in batches:
        for path, block, piece, q, d, o, c in zip(*[b.column(i).to_pylist() for i in range(7)]):
            if here != (path, block):
                if here is not None:
                    leave(True)
                here, quoted, depth, origin, cut = (path, block), q, d, o, c
                # a record open at the start goes on in the buffer
                buf = [""] if d > 0 else []
            else:
                leave(False)
            held = piece
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)
            out = []
    if here is not None:
        leave(True)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)


def read_json_text(spark: SparkSession, path: str, max_broadcast: int = MAX_BROADCAST_RANGES) -> DataFrame:
    """Every object of the JSON files at ``path`` as one text column, ``record``."""
    pieces = spark.read.option("lineSep", "}").text(path)
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    measured = pieces.select(*place, "value", F.octet_length("value").cast("long").alias("size"), F.col("_metadata.file_size").alias("file_size"))
    starts = cut_lineage(measured.mapInArrow(_effects, _EFFECT).groupBy("path").applyInPandas(_chain, _START))
    placed = pieces.select(*place, "value", F.monotonically_increasing_id().alias("_n"))
    columns = ["path", "block", "value", "quoted", "depth", "origin", "cut"]
    if starts.count() <= max_broadcast:  # a map-side join keeps the order of the scan
        known = placed.join(F.broadcast(starts), ["path", "block"]).select(*columns)
    else:
        known = placed.join(starts.hint("shuffle_hash"), ["path", "block"]).sortWithinPartitions("path", "block", "_n").select(*columns)
    found = known.mapInArrow(_records, "path string, origin long, block long, text string, whole boolean")
    whole = found.filter("whole").select(F.col("text").alias("record"))
    parts = found.filter("not whole").groupBy("path", "origin").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("p"))
    return whole.unionByName(parts.select(F.array_join(F.transform("p", lambda x: x["text"]), "").alias("record")))


def write_json_array(df: DataFrame, path: str | None = None, compression: str = "none") -> str:
    """A folder of JSON arrays, one a partition (an empty partition writes none). A compressed
    file is one range for its reader, as large as the partition that wrote it."""
    spark = df.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/io/json-array-{uuid.uuid4().hex[:12]}"

    def bracket(batches):
        import pyarrow as pa

        lead = "["
        for b in batches:
            lines = []
            for text in b.column(0).to_pylist():
                lines.append(lead + text)
                lead = ","
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        if lead == ",":
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], names=["value"])

    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInArrow(bracket, "value string")
    lines.write.option("compression", compression).option("zlib.compress.level", "BEST_SPEED").text(path)
    return path
