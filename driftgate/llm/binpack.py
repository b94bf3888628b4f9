"""Best-fit packing into sequences of several permitted lengths.

Texts longer than the longest sequence are split into pieces at words, without loss. Pieces are dealt into groups by
a hash, about ``GROUP_BYTES`` of text each, and each group is packed by itself: pieces by falling size, each
into the open bin that it leaves fullest. Where none has room a bin is opened, of the permitted length that costs least
for each word it will hold: a length costs its words, ``OVERHEAD`` more, and for attention its square over ``ATTENTION``; it
will hold the piece and what the largest pieces still to come fill of its room, and costs no more than the length that suffices
for these. At the end every bin shrinks to the least permitted length that holds its contents. So the number of bins of each
length comes out of all lengths together: long bins waste less room, short ones cost less a word.

Defined results: a null or wordless text is packed nowhere; repeated rows are each packed by themselves; an empty table
gives an empty packing.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

LENGTHS = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 64
ATTENTION = 65_536
GROUP_BYTES = 32 << 20


def word_starts(text: bytes) -> np.ndarray:
    """Where the words of a text start."""
    codes = np.frombuffer(text, np.uint8)
    space = np.ones(len(codes) + 1, bool)
    space[1:] = (codes == 32) | ((codes >= 9) & (codes <= 13))
    return np.flatnonzero(space[:-1] & ~space[1:])


def pieces_of(text: bytes, most: int) -> Iterator[tuple[int, int, bytes]]:
    """Pieces of up to ``most`` words: number, words, bytes. Joined, they are the text."""
    if len(text) <= most or (n := len(text.split())) <= most:
        n = len(text.split())
        if n:
            yield 0, n, text
        return
    cuts = [0, *word_starts(text)[most::most].tolist(), len(text)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        yield i, min(most, n - i * most), text[a:b]


def cost(length: int, overhead: int = OVERHEAD, attention: float = ATTENTION) -> float:
    """What a bin of this length costs, in words."""
    return length + overhead + length * length / attention


def _filled(room: int, falling: np.ndarray, ends: np.ndarray, first: int) -> int:
    """How much of ``room`` the pieces from place ``first`` on fill, the largest that still fits first."""
    free = room
    at = first
    while free > 0:
        # Sizes fall, so the pieces that fit are those from here on.
        at = max(at, int(ends[min(free, len(ends) - 1)]))
        if at >= len(falling):
            break
        free -= int(falling[at])
        at += 1
    return room - free


def pack_sizes(
    sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, attention: float = ATTENTION,
) -> tuple:
    """The bin of each size (none above the longest length), its offset there, and the length of each bin."""
    lengths = tuple(sorted(lengths))
    costs = {x: cost(x, overhead, attention) for x in lengths}
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order]
    # Place of the first piece of at most each size.
    ends = np.searchsorted(-falling, -np.arange(lengths[-1] + 1), side="left")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    used: list[int] = []
    room: list[tuple[int, int]] = []  # free words and bin, sorted

    def price(length: int, size: int, after: int) -> float:
        words = size + _filled(length - size, falling, ends, after)
        return costs[lengths[bisect_left(lengths, words)]] / max(words, 1)

    for place, i in enumerate(order.tolist()):
        size = int(sizes[i])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, own = room.pop(at)
        else:
            free = min((x for x in lengths if x >= size), key=lambda x: (price(x, size, place + 1), x))
            own = len(used)
            used.append(0)
        bins[i], offsets[i] = own, used[own]
        used[own] += size
        if free > size:
            insort(room, (free - size, own))
    return bins, offsets, np.array([lengths[bisect_left(lengths, u)] for u in used], np.int64)


def pieces(docs: DataFrame, most: int) -> DataFrame:
    """The pieces of all texts: doc_id (as text), piece, n_words, text."""

    def cut_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                (doc, *piece) for doc, text in zip(frame["doc_id"], frame["text"], strict=True)
                for piece in pieces_of(text, most)
            ]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "n_words", "text"])

    # Ids cross to Python as text: beside a null, pandas would round whole numbers to doubles.
    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_bytes().alias("text"))
    return source.mapInPandas(cut_up, "doc_id string, piece int, n_words int, text binary")


def pack(
    docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, group_bytes: int = GROUP_BYTES,
    attention: float = ATTENTION,
) -> DataFrame:
    """The packing of ``docs``, a row for each piece: group, bin, length (of the bin), offset (of the piece in it),
    doc_id, piece, n_words, text."""
    volume = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    groups = max(1, -(-volume // group_bytes))
    found = pieces(docs, max(lengths))
    found = found.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "text"), F.lit(groups)).cast("int"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A partition for each group: hashes of so few numbers would put several into one.
    found = found.repartitionById(max(parts, groups), F.col("group"))

    schema = "group int, bin long, length long, offset long, doc_id string, piece int, n_words int, text binary"

    def fill(own: pa.Table) -> pa.Table:
        # Whatever order the rows came in, equal groups are packed alike. Texts stay where Arrow has them until the end.
        keys = [("n_words", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("text", "ascending")]
        order = pc.sort_indices(own, sort_keys=keys).to_numpy()
        bins, offsets, sizes = pack_sizes(own["n_words"].to_numpy()[order].astype(np.int64), lengths, overhead, attention)
        at = np.lexsort((offsets, bins))
        found = {"bin": bins[at], "length": sizes[bins[at]], "offset": offsets[at]}
        own = own.take(pa.array(order[at]))
        names = [x.split()[0] for x in schema.split(", ")]
        return pa.table([pa.array(found[c]) if c in found else own[c] for c in names], names=names)

    packed = found.groupBy("group").applyInArrow(fill, schema)
    doc_id = F.col("doc_id").cast(docs.schema["doc_id"].dataType)
    return packed.withColumns({"group": F.col("group").cast("long"), "doc_id": doc_id, "text": F.col("text").cast("string")})
