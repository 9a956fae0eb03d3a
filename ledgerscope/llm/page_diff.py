"""Main text by nearest-URL page differencing.

Pages of a host are sorted by URL path; each is paired with the neighbour whose
path starts more like its own (the earlier one if both do), where pages with
one path (but for query, fragment, ``index``, ``.html`` and a last slash) are
one page and never a pair: addresses that differ in the query alone are mostly
copies, and pairing copies would delete their text. So a host that tells all its
pages apart by the query has no pairs. The lines (text blocks) of the two are aligned by
longest common subsequence, and the shared lines, being the site's template, are
deleted. What an article or main element marks as content is protected, since
copies and quoted passages are shared lines, too: there, a shared line goes only if
the whole line is a notice and at least half of the article's other lines differ
from the neighbour's. Of what is left, the page's content element is the
text where it has one, else all that is no page furniture by its element, role
or class.

Only hashes of lines travel to be aligned. Hosts spread over as many tasks as
their pages need (see prefix.py); no host's pages meet in a task.

Defined cases: null or empty html gives an empty text; a null url, or one
without host, counts as the empty host and is paired by its path there; repeated
rows get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm.common import map_arrow, slices, table, written
from ledgerscope.llm.html_blocks import Block, blocks
from ledgerscope.llm.prefix import running_sums

#: A whole line that calls on the reader or names what follows, as templates place it inside articles.
NOTICE = re.compile(
    r"(?:please )?(?:"
    r"(?:subscribe|sign up)(?: now| today| here)?(?: (?:to|for) (?:our |the |this |a )?(?:free |daily |weekly )?(?:newsletters?|mailing list|updates|channel|site))?"
    r"|(?:sign|log) in(?: or (?:register|sign up))?(?: to (?:comment|reply|continue))?"
    r"|share this(?: (?:article|page|post|story))?(?: on \w+)?|follow us(?: on \w+)?"
    r"|read more|related (?:articles|posts|stories)|advertisement|sponsored(?: (?:content|post|links?))?"
    r"|(?:we use|this (?:site|website|page) uses) cookies"
    r")(?: now| today| here)?[.!:\u2026]*",
    re.I,
)


def page_key(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL, alike for addresses of one page."""
    try:
        u = urlsplit((url or "").strip())
        host, path = u.netloc.rpartition("@")[2].lower(), u.path
    except ValueError:
        host, path = "", url or ""
    path = re.sub(r"\.(?:html?|php|aspx?|jsp)$", "", path.rstrip("/"))
    return host, re.sub(r"/(?:index|default)$", "", path) or "/"


def line_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``. Equal ends go
    first; then, where lines are mostly different, Hunt and Szymanski's longest
    increasing chain of matches; where few different lines repeat, so that matches
    are many, rows of bits."""
    lo, hi_a, hi_b = 0, len(a), len(b)
    while lo < hi_a and lo < hi_b and a[lo] == b[lo]:
        lo += 1
    while hi_a > lo and hi_b > lo and a[hi_a - 1] == b[hi_b - 1]:
        hi_a, hi_b = hi_a - 1, hi_b - 1
    x, y = a[lo:hi_a], b[lo:hi_b]
    where: dict[int, list[int]] = {}
    for j in range(len(y) - 1, -1, -1):
        where.setdefault(y[j], []).append(j)
    matches = sum(len(where.get(v, ())) for v in x)
    middle = _increasing_chain(x, where) if matches <= 8 * (len(x) + len(y)) else _by_bits(x, y)
    return [*range(lo), *[lo + i for i in middle], *range(hi_a, len(a))]


def _increasing_chain(a: list[int], where: dict[int, list[int]]) -> list[int]:
    ends: list[int] = []
    chain: list[tuple[int, tuple | None]] = []
    for i, v in enumerate(a):
        for j in where.get(v, ()):
            k = bisect_left(ends, j)
            link = (i, chain[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chain.append(link)
            else:
                ends[k], chain[k] = j, link
    out = []
    link = chain[-1] if chain else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


#: Bits kept to walk back through; longer pairs are halved first.
_BITS = 1 << 28


def _bit_rows(a: list[int], b: list[int], keep: bool) -> list[int]:
    """For each line of ``a`` (or the last alone) an integer whose bit j is 0 where
    the common subsequence with the first lines of ``b`` grows at line j."""
    masks: dict[int, int] = {}
    for j, v in enumerate(b):
        masks[v] = masks.get(v, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for v in a:
        u = row & masks.get(v, 0)
        row = ((row + u) | (row - u)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def _by_bits(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > _BITS and len(a) > 1:  # the cut of b at which both halves' lengths add up to most
        mid = len(a) // 2
        grows = lambda rows: np.unpackbits(np.frombuffer(rows[-1].to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")[: len(b)] == 0
        head = np.concatenate([[0], np.cumsum(grows(_bit_rows(a[:mid], b, False)))])
        tail = np.concatenate([[0], np.cumsum(grows(_bit_rows(a[mid:][::-1], b[::-1], False)))])[::-1]
        at = int(np.argmax(head + tail))
        return _by_bits(a[:mid], b[:at]) + [mid + i for i in _by_bits(a[mid:], b[at:])]
    rows = _bit_rows(a, b, True)
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            j -= 1
            out.append(i)
    return out[::-1]


def main_text(page: list[Block], shared: set[int]) -> str:
    """What is left of a page's blocks, ``shared`` being the aligned ones."""
    own = [i for i, b in enumerate(page) if b.content and not b.furniture]
    notices = {i for i in own if NOTICE.fullmatch(page[i].text)}
    rest = [i in shared for i in own if i not in notices]
    gone = notices if rest and 2 * sum(rest) <= len(rest) else set()  # copies of an article keep theirs
    left = [b for i, b in enumerate(page) if i not in shared or (b.content and not b.furniture and i not in gone)]
    left = [b for b in left if not b.furniture]
    content = [b for b in left if b.content]
    return "\n\n".join(b.text for b in (content or left))


def _start_alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def line_hashes(pages: DataFrame) -> DataFrame:
    """(host, path, h, lines) of pages (page_id, url, html); h tells rows of one path apart."""

    def run(batches):
        for b in slices(batches, 1):
            keys = [page_key(u) for u in b.column(0).to_pylist()]
            lines = [[line_hash(x.text) for x in blocks(h or "")] for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(lines, pa.list_(pa.int64()))], names=["host", "path", "lines"]
            )

    return map_arrow(pages.select("url", "html"), run, "host string, path string, lines array<long>")


def shared_places(lines: DataFrame) -> DataFrame:
    """(host, path, other): for each path with a neighbour, the lines of the page
    it is paired with. One page stands for a path: the one with the most lines, of
    these the last by array order, so that reruns agree."""
    most = F.max(F.struct(F.size("lines").alias("n"), "lines"))
    one = written(lines.groupBy("host", "path").agg(most.alias("most")).select("host", "path", F.col("most.lines").alias("lines")), "paths")
    order = running_sums(one.select("host", "path", F.lit(1).cast("long").alias("one")), "host", ["path"], "one", "place")
    at = order.select("host", "path", "place")
    sides = []
    for step in (-1, 1):
        near = at.select(F.col("host").alias("nh"), F.col("path").alias("near"), (F.col("place") - step).alias("np"), F.lit(step).alias("step"))
        sides.append(at.join(near, (F.col("host") == F.col("nh")) & (F.col("place") == F.col("np"))).select("host", "path", "near", "step"))

    def alike(batches):
        for b in batches:
            n = [_start_alike(x, y) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int32())], names=["host", "path", "near", "step", "alike"])

    both = map_arrow(sides[0].unionByName(sides[1]), alike, "host string, path string, near string, step int, alike int")
    best = both.groupBy("host", "path").agg(F.max_by("near", F.struct("alike", (-F.col("step")).alias("s"))).alias("near"))
    theirs = one.select(F.col("host").alias("oh"), F.col("path").alias("op"), F.col("lines").alias("other"))
    return best.join(theirs, (F.col("host") == F.col("oh")) & (F.col("near") == F.col("op"))).select("host", "path", "near", "other")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_shared) of every row; n_shared: aligned lines."""
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    lines = written(line_hashes(p), "lines")
    pairs = written(shared_places(lines), "pairs")

    def keyed(batches):
        for b in slices(batches, 0):
            keys = [page_key(u) for u in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string())], names=["u", "host", "path"])

    # an address's pair is looked up by the address: the wide rows shuffle once
    urls = map_arrow(p.select("url").distinct(), keyed, "u string, host string, path string")
    near = urls.join(pairs, ["host", "path"]).select("u", "other")
    wide = p.join(near, F.col("url").eqNullSafe(F.col("u")), "left").select("page_id", "url", "html", "other")

    def run(batches):
        for b in slices(batches, 2):
            texts, counts = [], []
            for html, other in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                page = blocks(html or "")
                shared = common_lines([line_hash(x.text) for x in page], other) if other else []
                texts.append(main_text(page, set(shared)))
                counts.append(len(shared))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_shared"]
            )

    return map_arrow(wide, run, f"page_id {p.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long, n_shared long")


def op3_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
