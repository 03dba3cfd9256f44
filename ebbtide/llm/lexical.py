"""Ranked lexical search by presence masks.

Documents become blocks of postings of the items' terms. In a block each term has a
bitmap of its documents; for one item the bitmaps of its terms are turned on their
side, which gives every document a mask of the terms that it holds. Documents with
one mask form a group with a common highest possible score. Groups are scored from
the highest down until no other group can reach an item's twentieth score.

Blocks are searched in place: a task keeps twenty documents per item over all its
blocks. A first search of a fixed share of the blocks gives each item a score that
its twentieth document has at least; groups below that are passed over anywhere.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm.common import batches_of, lower_ascii, q
from ebbtide.llm.words import ALNUM, LOWERED, chunks, word_hashes

TOP = 20
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = {c: c + 32 for c in range(0x41, 0x5B)}
# A block ends at so many documents with a term of an item, or so many postings.
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 20
# Characters of items whose terms are looked up in one pass over the documents.
ITEM_CHARS = 4_000_000
# One block in so many is searched first, for scores that the top must reach.
FIRST_SHARE = 32
# Blocks that pass to a Python worker at once.
BATCH_BLOCKS = 4

_BLOCK = "docs long, words long, ids binary, known binary, sizes binary, terms binary, offsets binary, rows binary, counts binary"


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(FOLD))


@dataclass
class Vocabulary:
    """Terms of the items by 64-bit hash, with their lengths in bytes."""

    hashes: np.ndarray
    lengths: np.ndarray

    @staticmethod
    def of(terms: list[str]) -> tuple[Vocabulary, dict[str, int]]:
        chunk = next(chunks(pa.array([" ".join(terms)]), ALNUM, block=1 << 62))
        hashes = word_hashes(chunk)
        order = np.argsort(hashes)
        place = {terms[k]: j for j, k in enumerate(order.tolist())}
        return Vocabulary(hashes[order], (chunk.ends - chunk.starts)[order]), place

    def find(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of each word's term, -1 for other words."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where((self.hashes[at] == hashes) & (self.lengths[at] == lengths), at, -1)


@dataclass
class Item:
    """Distinct terms of an item by number, and how often it has each."""

    terms: np.ndarray
    repeats: np.ndarray


def posting_blocks(batches, vocabulary: Vocabulary):
    """Blocks of postings of a partition's (id, text) batches."""
    ids, known, sizes, keys, tallies = [], [], [], [], []
    held = docs = words = postings = 0
    n_terms = len(vocabulary.hashes)

    def block():
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        tally = np.concatenate(tallies) if tallies else np.zeros(0, np.int64)
        row, term = key // n_terms, key % n_terms
        order = np.lexsort((row, term))
        present, begins = np.unique(term[order], return_index=True)
        one = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind).tobytes()
        return pa.RecordBatch.from_pylist([{
            "docs": docs, "words": words, "ids": one(ids, np.int64), "known": one(known, np.bool_), "sizes": one(sizes, np.int64),
            "terms": present.astype(np.int32).tobytes(), "offsets": np.append(begins, len(key)).astype(np.int64).tobytes(),
            "rows": row[order].astype(np.int32).tobytes(), "counts": tally[order].astype(np.int32).tobytes(),
        }], pa.schema([("docs", pa.int64()), ("words", pa.int64())] + [(c, pa.binary()) for c in ("ids", "known", "sizes", "terms", "offsets", "rows", "counts")]))

    for batch in batches:
        column = batch.column("id")
        is_known = np.asarray(column.is_valid())
        values = np.asarray(column.fill_null(0), np.int64)
        for chunk in chunks(batch.column("text"), ALNUM, LOWERED):
            n = np.diff(chunk.row_words)
            docs, words = docs + int((n > 0).sum()), words + int(n.sum())
            term = vocabulary.find(word_hashes(chunk), chunk.ends - chunk.starts)
            row = np.repeat(np.arange(chunk.rows), n)[term >= 0]
            key, tally = np.unique(row * n_terms + term[term >= 0], return_counts=True)
            rows, numbered = np.unique(key // n_terms, return_inverse=True)
            at = chunk.first + rows
            ids.append(values[at])
            known.append(is_known[at])
            sizes.append(n[rows])
            keys.append((held + numbered) * n_terms + key % n_terms)
            tallies.append(tally)
            held, postings = held + len(rows), postings + len(key)
            if held >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                yield block()
                ids, known, sizes, keys, tallies = [], [], [], [], []
                held = docs = words = postings = 0
    if docs:
        yield block()


class Block:
    """Postings of one block, by term, with the share of a score that each gives before its weight."""

    def __init__(self, row: dict, all_docs: int, all_words: int):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.known, sizes = read("ids", np.int64), read("known", np.bool_), read("sizes", np.int64)
        self.terms, self.offsets, self.rows = read("terms", np.int32), read("offsets", np.int64), read("rows", np.int32)
        counts = read("counts", np.int32).astype(np.int64)
        length = 75 + (25 * sizes * all_docs) // all_words
        self.shares = (1_000_000_000 * counts) // (1000 * counts + 12 * length[self.rows])
        self.peaks = np.maximum.reduceat(self.shares, self.offsets[:-1]) if len(self.terms) else self.shares
        self.bitmaps = np.zeros((len(self.terms), -(-len(self.ids) // 8)), np.uint8)
        for first in range(0, len(self.terms), 512):  # bits of some terms at a time
            last = min(first + 512, len(self.terms))
            part = slice(self.offsets[first], self.offsets[last])
            bits = np.zeros((last - first, len(self.ids)), np.bool_)
            bits[np.repeat(np.arange(last - first), np.diff(self.offsets[first : last + 1])), self.rows[part]] = True
            self.bitmaps[first:last] = np.packbits(bits, axis=1, bitorder="little")

    def masks(self, terms: np.ndarray) -> np.ndarray:
        """For each document its mask over ``terms`` as words of 64 bits."""
        bits = np.unpackbits(self.bitmaps[terms], axis=1, count=len(self.ids), bitorder="little")
        packed = np.packbits(bits, axis=0, bitorder="little")
        padded = np.zeros((len(self.ids), -(-len(packed) // 8) * 8), np.uint8)
        padded[:, : len(packed)] = packed.T
        return padded.view(np.uint64)

    def scores(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of the sorted ``rows``."""
        total = np.zeros(len(rows), np.int64)
        for term, weight in zip(terms.tolist(), weights.tolist()):
            begin, end = self.offsets[term], self.offsets[term + 1]
            postings = self.rows[begin:end]
            at = np.minimum(np.searchsorted(postings, rows), len(postings) - 1)
            total += np.where(postings[at] == rows, weight * self.shares[begin + at], 0)
        return total


@dataclass
class Best:
    """The best documents of an item so far: highest score, then smallest id, rows without id last."""

    scores: np.ndarray
    ids: np.ndarray
    known: np.ndarray

    @staticmethod
    def none() -> Best:
        return Best(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.bool_))

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray, top: int) -> None:
        scores, ids, known = np.append(self.scores, scores), np.append(self.ids, ids), np.append(self.known, known)
        order = np.lexsort((ids, ~known, -scores))[:top]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]

    def floor(self, top: int) -> int:
        return int(self.scores[top - 1]) if len(self.scores) >= top else 0


def search_block(block: Block, item: Item, weights: np.ndarray, best: Best, floor: int, top: int) -> None:
    """Adds the documents of a block that can be among an item's best."""
    at = np.minimum(np.searchsorted(block.terms, item.terms), max(len(block.terms) - 1, 0))
    here = block.terms[at] == item.terms if len(block.terms) else np.zeros(0, np.bool_)
    terms, worth = at[here], (item.repeats * weights[item.terms])[here] if len(block.terms) else None
    if not len(block.terms) or not len(terms):
        return
    masks = block.masks(terms)
    rows = np.flatnonzero(masks.any(axis=1))
    masks = masks[rows]
    flat = masks[:, 0] if masks.shape[1] == 1 else np.ascontiguousarray(masks).view(np.dtype((np.void, masks.shape[1] * 8)))[:, 0]
    groups, first, group_of, sizes = np.unique(flat, return_index=True, return_inverse=True, return_counts=True)
    bits = np.unpackbits(masks[first].view(np.uint8), axis=1, count=len(terms), bitorder="little")
    highest = bits @ (worth * block.peaks[terms])
    order = np.argsort(-highest, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    members = rows[np.argsort(rank[group_of], kind="stable")]
    ends, highest = np.cumsum(sizes[order]), highest[order]
    group = done = 0
    step = 2 * top
    while group < len(groups) and highest[group] >= max(1, floor, best.floor(top)):
        group = max(group + 1, int(np.searchsorted(ends, done + step, "right")))
        some = np.sort(members[done : ends[group - 1]])
        score = block.scores(some, terms, worth)
        keep = score >= max(1, floor)
        best.add(score[keep], block.ids[some[keep]], block.known[some[keep]], top)
        done, step = int(ends[group - 1]), step * 2


def _search(index: DataFrame, shared, top: int) -> DataFrame:
    """(item, doc_id, score): the best of every partition of ``index``."""

    def run(batches):
        items, weights, floors, all_docs, all_words = shared.value
        best = [Best.none() for _ in items]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, all_docs, all_words)
                for item, found, floor in zip(items, best, floors):
                    search_block(block, item, weights, found, floor, top)
        for number, found in enumerate(best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found.ids), number, np.int32)), pa.array(found.ids, mask=~found.known), pa.array(found.scores)],
                ["item", "doc_id", "score"],
            )

    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    found = index.mapInArrow(run, "item int, doc_id long, score long")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def _term_documents(index: DataFrame) -> DataFrame:
    """(term, df) over all blocks."""

    def count(batches):
        for batch in batches:
            for terms, offsets in zip(batch.column("terms").to_pylist(), batch.column("offsets").to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(terms, np.int32)), pa.array(np.diff(np.frombuffer(offsets, np.int64)))], ["term", "df"]
                )

    return index.select("terms", "offsets").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _search_items(docs: DataFrame, rows: list[Row], top: int, first_share: int) -> DataFrame | None:
    """(item, rank, doc_id, score) for one set of items, ``item`` being the place in ``rows``."""
    spark = docs.sparkSession
    tallies = [Counter(terms_of(r["text"])) for r in rows]
    terms = sorted(set().union(*tallies))
    if not terms:
        return None
    vocabulary, place = Vocabulary.of(terms)
    items = []
    for tally in tallies:
        numbered = sorted((place[t], c) for t, c in tally.items())
        items.append(Item(np.array([t for t, _ in numbered], np.int64), np.array([c for _, c in numbered], np.int64)))
    lookup = spark.sparkContext.broadcast(vocabulary)
    with batches_of(spark, BATCH_BLOCKS * 64):
        index = stage(docs.mapInArrow(lambda batches: posting_blocks(batches, lookup.value), _BLOCK), "postings")
    all_docs, all_words = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    if not all_docs:
        return None
    weights = np.zeros(len(vocabulary.hashes), np.int64)
    with batches_of(spark, BATCH_BLOCKS):
        for r in _term_documents(index).collect():  # one row per term of the items at most
            weights[r["term"]] = math.floor(1000 * math.log((2 * all_docs + 2) / (2 * r["df"] + 1)))
        given = lambda floors: spark.sparkContext.broadcast((items, weights, floors, all_docs, all_words))
        some = index.where(F.pmod(F.xxhash64("ids"), F.lit(first_share)) == 0)
        floors = [0] * len(items)
        for r in _search(some, given(floors), top).where(F.col("rank") == top).collect():  # one row per item at most
            floors[r["item"]] = r["score"]
        return stage(_search(index, given(floors), top), "ranked")


def ranked_documents(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", top: int = TOP, item_chars: int = ITEM_CHARS, first_share: int = FIRST_SHARE,
) -> DataFrame:
    """The ``top`` highest-scoring rows of ``docs`` for every item: item_id, rank, doc_id, score.

    Ids of documents are integers. Equal scores go by ascending doc_id, rows without
    id last; rows that repeat an id are documents of their own. A null or empty text
    has no terms: such documents count nowhere and such items have no rows. Items
    that repeat both id and text are one; an id with several texts is ranked for each.
    Other columns of either input are not read. Empty inputs give no rows.
    """
    spark = docs.sparkSession
    frame = docs.select(F.col(q(id_col)).cast("long").alias("id"), F.col(q(text_col)).alias("text"))
    wanted = items.select(F.col(q(item_col)).alias("item_id"), lower_ascii(F.col(q(item_text_col))).alias("text")).distinct()
    total = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = total // item_chars + 1
    id_type = wanted.schema["item_id"].dataType.simpleString()
    ranked = None
    for part in range(parts):
        rows = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        found = _search_items(frame, rows, top, first_share) if rows else None
        if found is None:
            continue
        names = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(rows)], f"item int, item_id {id_type}")
        named = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        ranked = named if ranked is None else ranked.unionByName(named)
    return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long") if ranked is None else ranked
