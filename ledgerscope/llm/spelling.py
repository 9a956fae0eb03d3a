"""Spelling variants: exact neighbours of words by pairs of trie nodes.

The words are range-sorted and their forward trie is numbered: a node is named by
the place where its first word lies and its depth, so each task numbers its
own range, and only the nodes on the way to a range's first word may belong to
earlier ranges. Those are looked up in one row a range (its first and last word and
the last word's nodes). The reversed words are numbered the same way. Forward
numbers grow with the words' order.

A word of length L gives L skips (node before position i, reversed node after it) and
L + 1 gaps (node before i, reversed node from i on): integer pairs. Words with
one skip in common differ by a replaced code point; a skip of one that is a gap of
another is an inserted or deleted one. Of a run of equal code points only the first is
skipped for that, so each two near words meet exactly once. A pair has at most as
many skips as there are code points and one gap, and is summed up: counts and the
most frequent word, never the pairs of words. A word's form is its near word of
largest count, if that is ``factor`` times its own or more, so the most frequent
word of a group suffices for all the others of the group.

Chains of forms end, since counts grow along them; their ends are found by pointer
doubling.

Defined cases: null and empty texts have no words; repeated rows count again; a
null id is an empty text in the hash; without words there are no rows; other columns
are ignored, whatever their names. A long word is one row: 16 bytes a code point.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import takewhile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerscope.llm.common import as_text, map_arrow, owners, slices, table, written

LEAST_LENGTH, LEAST_COUNT, FACTOR, EVERY = 7, 2, 10, 31
LETTERS = "A-Za-zÀ-ÿ"


def _slice_counts(ids: list, arr: pa.Array, least: int, every: int) -> Counter:
    """Occurrences of each word in the texts, after the contract's deletions."""
    text = pc.replace_substring_regex(as_text(arr), f"[^{LETTERS}]+", " ")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    off = np.asarray(lists.offsets, np.int64)
    coded = lists.values.slice(off[0], off[-1] - off[0]).dictionary_encode()
    words = coded.dictionary.to_pylist()
    doc, code = owners(off - off[0]), np.asarray(coded.indices, np.int64)
    fits = np.array([len(w) >= least for w in words], bool)[code] if words else np.zeros(0, bool)
    # one look at each different word of a text: all its occurrences there share the hash
    both, times = np.unique(doc[fits] * max(1, len(words)) + code[fits], return_counts=True)
    out: Counter = Counter()
    raw = [w.encode() for w in words]
    heads = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids]
    crc = zlib.crc32
    for d, c, n in zip((both // max(1, len(words))).tolist(), (both % max(1, len(words))).tolist(), times.tolist(), strict=True):
        h = crc(raw[c], heads[d])
        if h % every:
            out[words[c]] += n
        else:
            w = words[c]
            k = h % len(w)
            w = w[:k] + w[k + 1 :]
            if len(w) >= least:
                out[w] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, every: int = EVERY) -> DataFrame:
    """(word, n) of the words of all texts; a word whose hash ``every`` divides loses one code point."""

    def run(batches):
        for b in slices(batches, 1, 8 << 20):
            got = _slice_counts(b.column(0).to_pylist(), b.column(1), least_length, every)
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], names=["word", "n"])

    d = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = map_arrow(d, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least_count)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    return sum(1 for _ in takewhile(lambda x: x[0] == x[1], zip(a, b, strict=False)))


def trie_nodes(words: DataFrame, reverse: bool = False) -> DataFrame:
    """(word, nodes array<long>): the numbers of the trie nodes of all prefixes of
    each different word, from the empty one to the word (of all suffixes if
    ``reverse``)."""
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    w = words.select((F.reverse("word") if reverse else F.col("word")).alias("word"))
    ranges = w.repartitionByRange(n, "word").sortWithinPartitions("word")

    def run(batches):
        from pyspark import TaskContext

        part, last, path, free = TaskContext.get().partitionId(), "", [], 0
        for b in batches:
            if not b.num_rows:
                continue
            column = b.column(0).to_pylist()
            flat: list[int] = []
            for word in column:
                keep = _shared(last, word) + 1 if path else 0  # nodes of the way to the last word
                path = path[:keep]
                new = len(word) + 1 - keep
                path.extend(range(free, free + new))
                free += new
                flat += path
                last = word
            off = np.concatenate([[0], np.cumsum([len(x) + 1 for x in column])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(column), part, np.int32)), b.column(0), pa.ListArray.from_arrays(pa.array(off), pa.array(flat, pa.int64()))], names=["part", "word", "nodes"])

    local = written(map_arrow(ranges, run, "part int, word string, nodes array<long>"), "trie-nodes")
    # one row a range: its ends, and how many nodes it numbered (the last word's last node is the latest)
    ends = local.groupBy("part").agg(F.min("word").alias("first"), F.max_by("word", "word").alias("last"), F.max_by("nodes", "word").alias("nodes"))
    base, inherited = 0, {}
    before: tuple[str, list[int]] | None = None
    for r in sorted(ends.collect(), key=lambda r: r["part"]):
        own = [base + x for x in r["nodes"]]
        keep = _shared(before[0], r["first"]) + 1 if before else 0
        held = before[1][:keep] if before else []
        inherited[r["part"]] = (base, held)
        # the last word shares the nodes of the first one's way up to where they part
        both = min(_shared(r["first"], r["last"]) + 1, keep)
        before = (r["last"], held[:both] + own[both:])
        base += r["nodes"][-1] + 1
    return _renumbered(local, inherited)


def _renumbered(local: DataFrame, inherited: dict[int, tuple[int, list[int]]]) -> DataFrame:
    """Numbers of the whole trie. A range's first word has its local nodes 0, 1, 2...,
    so those below the number of inherited nodes are the inherited ones."""

    def run(batches):
        for b in batches:
            for p in np.unique(np.asarray(b.column(0))).tolist():
                rows = b.filter(pc.equal(b.column(0), p))
                base, held = inherited[p]
                lists = rows.column(2)
                off = np.asarray(lists.offsets, np.int64)
                nodes = np.asarray(lists.values, np.int64)[off[0] : off[-1]]
                known = np.array([*held, 0], np.int64)
                nodes = np.where(nodes < len(held), known[np.minimum(nodes, len(held))], nodes + base)
                yield pa.RecordBatch.from_arrays([rows.column(1), pa.ListArray.from_arrays(pa.array((off - off[0]).astype(np.int32)), pa.array(nodes))], names=["word", "nodes"])

    return map_arrow(local, run, "word string, nodes array<long>")


def near_words(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n, id, n_near, best struct<n, order>) for different words (word, n):
    ``id`` numbers them in their order; ``best`` is the near word of largest count
    (ties: first in order, which is -order) if that is ``factor`` times n or more."""
    words = written(words, "words")
    forward = trie_nodes(words)
    backward = trie_nodes(words, reverse=True).select(F.reverse("word").alias("word"), F.reverse("nodes").alias("back"))
    both = words.join(forward, "word").join(backward, "word").withColumn("id", F.element_at("nodes", -1))
    both = written(both, "node-pairs")
    at = F.posexplode("nodes").alias("i", "a")
    rows = both.select("id", "n", "word", "back", at)
    size = F.size("back")
    gap = F.struct(F.lit(True).alias("gap"), F.lit(False).alias("lone"), F.element_at("back", F.col("i") + 1).alias("b"))
    lone = (F.col("i") == 0) | (F.substring("word", F.col("i") + 1, F.lit(1)) != F.substring("word", F.col("i"), F.lit(1)))
    skip = F.struct(F.lit(False).alias("gap"), lone.alias("lone"), F.element_at("back", F.col("i") + 2).alias("b"))
    entries = rows.select("id", "n", "a", F.explode(F.when(F.col("i") + 1 < size, F.array(gap, skip)).otherwise(F.array(gap))).alias("e"))
    entries = entries.select("id", "n", "a", "e.gap", "e.lone", "e.b")
    pair = Window.partitionBy("a", "b")  # one skip for each code point and a gap at most
    top = lambda kind: F.max(F.when(kind, F.struct("n", (-F.col("id")).alias("order")))).over(pair)
    met = {"skips": F.count_if(~F.col("gap")).over(pair), "lones": F.count_if("lone").over(pair), "skip_top": top(~F.col("gap")), "lone_top": top(F.col("lone")), "gap_top": top(F.col("gap"))}
    j = entries.withColumns(met).filter("skips > 1 or (lones > 0 and gap_top is not null)")
    others = F.when(F.col("gap"), F.col("lones")).otherwise(F.col("skips") - 1 + F.when(F.col("lone") & F.col("gap_top").isNotNull(), 1).otherwise(0))
    best = F.when(F.col("gap"), F.col("lone_top")).otherwise(F.greatest("skip_top", F.when(F.col("lone"), F.col("gap_top"))))
    # a group's most frequent word is its own best here, too rare beside itself to count
    per = j.select("id", others.alias("others"), F.when(best["n"] >= F.col("n") * factor, best).alias("best")).groupBy("id").agg(F.sum("others").alias("n_near"), F.max("best").alias("best"))
    return both.select("id", "word", "n").join(per, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best")


def forms(near: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) from ``near_words``' rows."""
    near = written(near, "near")
    step = near.filter("best is not null").select("id", (-F.col("best.order")).alias("to"))
    step = written(step, "forms")
    while True:  # rounds: the logarithm of the longest chain, itself at most log(largest n) / log(factor)
        ahead = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
        j = step.join(ahead, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
        j = written(j, "forms")
        step = j.select("id", "to")
        if not j.filter("moved").limit(1).count():
            break
    name = lambda k: near.select(F.col("id").alias(f"{k}_id"), F.col("word").alias(k))
    linked = near.filter("best is not null").select("id", (-F.col("best.order")).alias("form_id")).join(step.withColumnRenamed("to", "root_id"), "id")
    linked = linked.join(name("form"), "form_id").join(name("root"), "root_id").select("id", "form", "root")
    out = near.join(linked, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("best.n").alias("form_n"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forms(near_words(word_counts(table(spark, sf_dir, "documents"))))
