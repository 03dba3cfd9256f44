"""Benchmark decontamination with Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark items. A table over blocks of two
words says how far the search may jump; where a block ends a pattern the jump is
zero and the block's bucket names the patterns to compare word by word. Patterns
of other lengths (whole short items) have tables of their own, since the jump is
bounded by the shortest pattern of a table.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm.common import UPPER, lower_ascii, q, small_batches

WINDOW = 10
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = {ord(c): c.lower() for c in UPPER}
# Words of benchmark items in one set of tables; more items make more sets and passes.
BLOCK_WORDS = 1_000_000


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(FOLD)) if text else []


class Tables:
    """Wu-Manber tables for patterns of one length, in words."""

    def __init__(self, length: int, patterns: dict[tuple[str, ...], list[int]]):
        self.length = length
        self.block = min(2, length)
        self.far = length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            self.bucket[pattern[-self.block :]].append((pattern[0], pattern, items))

    def find(self, text: list[str]) -> Iterator[tuple[int, list[int]]]:
        """Start and items of every occurrence."""
        m, block, far, shift = self.length, self.block, self.far, self.shift
        i, n = m, len(text)
        while i <= n:
            key = (text[i - 2], text[i - 1]) if block == 2 else (text[i - 1],)
            jump = shift.get(key, far)
            if jump:
                i += jump
                continue
            first = text[i - m]
            for lead, pattern, items in self.bucket.get(key, ()):
                # The first word is a cheap test before the whole comparison.
                if lead == first and tuple(text[i - m : i]) == pattern:
                    yield i - m, items
            i += 1


def build_tables(items: Iterable[tuple[object, str | None]], window: int) -> list[Tables]:
    """Tables by pattern length; an item shorter than the window is one pattern."""
    by_length: dict[int, dict[tuple[str, ...], list]] = defaultdict(lambda: defaultdict(list))
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            owners = by_length[size][tuple(w[k : k + size])]
            if item not in owners:
                owners.append(item)
    return [Tables(n, patterns) for n, patterns in sorted(by_length.items())]


def search(text: str | None, tables: list[Tables]) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, merged [start, end) runs of hit words, and the items found."""
    w = words(text)
    runs, found = [], set()
    for table in tables:
        for start, items in table.find(w):
            runs.append((start, start + table.length))
            found.update(items)
    return len(w), merged(runs), found


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[list]:
    """The items in sets of about ``block_words`` words, each small enough for a broadcast."""
    length = F.length(lower_ascii(F.col(q(text_col))))
    total = benchmark.agg(F.sum(length)).first()[0] or 0
    n = total // (block_words * 6) + 1
    part = F.pmod(F.xxhash64(F.col(q(item_col)), F.col(q(text_col))), F.lit(n))
    for k in range(n):
        rows = benchmark.where(part == k).select(F.col(q(item_col)).cast("string"), q(text_col)).collect()
        yield [(r[0], r[1]) for r in rows if r[1] and r[0] is not None]


_built: dict[str, list[Tables]] = {}


def _tables(shared, name: str, window: int) -> list[Tables]:
    """Tables of a broadcast set of items, built once per Python worker; ``name`` is the set's own."""
    if name not in _built:
        _built.clear()
        _built[name] = build_tables(shared.value, window)
    return _built[name]


RUNS = "array<struct<start: long, end: long>>"


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs, items.

    ``runs`` are the merged [start, end) word ranges inside occurrences, ``items`` the
    ids (as text) of the items with occurring windows. Null and empty texts have no
    words and no runs; items without words or without id match nothing; items that
    repeat an id count once. Other columns of either input are not read. An empty
    ``docs`` gives no rows, an empty ``benchmark`` rows without runs.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    frame = docs.select(
        F.col(q(id_col)).alias("doc_id"), F.col(q(text_col)).alias("text"),
        F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(RUNS).alias("runs"), F.lit(None).cast("array<string>").alias("items"),
    )
    schema = f"doc_id {id_type}, text string, n_words long, runs {RUNS}, items array<string>"
    blocks = item_blocks(benchmark.select(q(item_col), q(item_text_col)), item_col, item_text_col, block_words)
    for k, block in enumerate(blocks):
        if k:  # one set of tables in memory at a time
            frame = stage(frame, "hits")
        shared = spark.sparkContext.broadcast(block)

        def scan(batches, shared=shared, name=uuid.uuid4().hex):
            tables = _tables(shared, name, window)
            for batch in batches:
                counts, runs, items = [], [], []
                for text, old_runs, old_items in zip(*(batch.column(c).to_pylist() for c in ("text", "runs", "items"))):
                    n, new_runs, new_items = search(text, tables)
                    known = [(r["start"], r["end"]) for r in old_runs or ()]
                    counts.append(n)
                    runs.append([{"start": a, "end": b} for a, b in merged(new_runs + known)])
                    items.append(sorted(new_items | set(old_items or ())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"), pa.array(counts, pa.int64()),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(items, pa.list_(pa.string()))],
                    ["doc_id", "text", "n_words", "runs", "items"],
                )

        frame = frame.mapInArrow(scan, schema)
    return frame.drop("text")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, in its own columns.

    Null and wordless texts stay; rows are judged one by one, repeated ones alike. Items
    without words have no window, so an empty benchmark leaves all rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    blocks = item_blocks(benchmark.select(q(item_col), q(item_text_col)), item_col, item_text_col, block_words)
    for k, block in enumerate(blocks):
        if k:
            docs = stage(docs, "clean")
        shared = spark.sparkContext.broadcast(block)

        def clean(batches, shared=shared, name=uuid.uuid4().hex):
            tables = _tables(shared, name, window)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
                yield batch.filter(pa.array([not search(t, tables)[1] for t in texts], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
