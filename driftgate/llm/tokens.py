"""Token ids, packed into id matrices of fixed width.

Texts become ids of a public byte-level vocabulary; each document ends with ``END``. Documents longer than a row are split
into pieces of a row's width, without loss. Pieces are dealt into groups by a hash, each group small enough for
one task, and packed best fit decreasing: a segment tree over the free room of the open rows, 0 … width,
finds the least room that suffices in a logarithmic number of steps. Each row is written as little-endian 16-bit ids,
padded with ``END``, with cumulative segment lengths and the places at which positions start again from zero.

Defined results: a null or empty text is its end mark alone; repeated rows are each packed by themselves; an empty table
gives no rows.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 2048
END = 50_256
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
GROUP_BYTES = 24 << 20
#: How the vocabulary's texts are cut before merging: a fixed value that belongs to it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_HELD = 400_000
#: Spaces that have other white space or an end of the text beside them, and the places where it is safe to cut.
_SPACES = re.compile(r" \s|\s |^ | $")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def read_ranks(spark: SparkSession, path: str = VOCABULARY) -> dict[bytes, int]:
    """The vocabulary of a ``.tiktoken`` file (some 50,000 lines), by way of Spark."""
    if "://" not in path:
        path = f"file://{path}"
    lines = spark.read.text(path).collect()
    return {base64.b64decode(a): int(b) for a, b in (r["value"].split() for r in lines if r["value"])}


class Encoder:
    """Texts to ids, as little-endian bytes. A text is cut before each single space between two other characters, where
    no token of the pattern can cross; the ids of those chunks are kept, since most come again."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.held: dict[str, bytes] = {}  # ids of a chunk and the space before it

    def whole(self, text: str) -> bytes:
        return array("H", self.encoding.encode_ordinary(text)).tobytes()

    def encode(self, text: str) -> bytes:
        first, *chunks = _CUT.split(text) if _SPACES.search(text) else text.split(" ")
        held = self.held
        if len(held) > _HELD:
            held.clear()
        for c in {*chunks}.difference(held):
            held[c] = self.whole(" " + c)
        return self.whole(first) + b"".join([held[c] for c in chunks])


class Rooms:
    """A segment tree that counts the open rows by free room."""

    def __init__(self, width: int) -> None:
        self.base = 1 << width.bit_length()
        self.tree = [0] * (2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def _add(self, room: int, n: int) -> None:
        node = room + self.base
        while node:
            self.tree[node] += n
            node >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """The least room of at least ``size`` and a row that has it."""
        node = size + self.base
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.base:
                node *= 2
                node += not self.tree[node]
        room = node - self.base
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(sizes: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """The row of each size, by best fit decreasing, and the number of rows."""
    rows, count, rooms = np.zeros(len(sizes), np.int64), 0, Rooms(width)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = rooms.take(size)
        if found is None:
            found, count = (width, count), count + 1
        room, row = found
        rows[i] = row
        if room > size:
            rooms.put(room - size, row)
    return rows, count


def encoded(docs: DataFrame, ranks: dict[bytes, int], width: int = WIDTH) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start (the id of the document it begins with), n, ids."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    end = END.to_bytes(2, "little")

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(sent.value)
        for frame in frames:
            rows = []
            for doc, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids = encoder.encode(text) + end
                for k, a in enumerate(range(0, len(ids) // 2, width)):
                    own = ids[2 * a : 2 * (a + width)]
                    rows.append((doc, k, a, len(own) // 2, own))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "n", "ids"])

    # Ids cross to Python as text: beside a null, pandas would round whole numbers to doubles.
    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInPandas(encode, "doc_id string, piece int, start long, n int, ids binary")


def pack_tokens(
    docs: DataFrame, ranks: dict[bytes, int], width: int = WIDTH, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """The rows of the id matrices.

    group, row: the place of the row; ids: ``width`` ids of 16 bits; n_ids: those that are not padding; cu_lengths: where
    each segment starts, and the end of the last; resets: where position ids start again from zero, the padding's
    start included; doc_ids, starts: the document of each segment and the id of it at which the segment begins.
    """
    volume = docs.agg(F.sum(F.octet_length("text")), F.count("*")).head()
    groups = max(1, -(-((volume[0] or 0) + volume[1]) // group_bytes))  # a text has no more ids than bytes, and an end
    found = encoded(docs, ranks, width)
    found = found.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids"), F.lit(groups)))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        # Whatever order the pieces came in, equal groups are packed alike.
        frame = frame.sort_values(["n", "doc_id", "piece", "ids"], ascending=[False, True, True, True])
        rows, count = best_fit(frame["n"].to_numpy(np.int64), width)
        order = np.argsort(rows, kind="stable")
        cuts = np.searchsorted(rows[order], np.arange(count + 1))
        ids, ns = frame["ids"].to_numpy(object)[order], frame["n"].to_numpy(np.int64)[order]
        docs_, starts = frame["doc_id"].to_numpy(object)[order], frame["start"].to_numpy(np.int64)[order]
        pad = np.array([END], "<u2").tobytes()
        out = []
        for row, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            ends = np.cumsum(ns[a:b])
            total = int(ends[-1])
            lengths = [0, *ends.tolist()]
            resets = lengths if total < width else lengths[:-1]
            own = [None if pd.isna(d) else int(d) for d in docs_[a:b]]
            out.append((
                int(frame["group"].iloc[0]), row, b"".join(ids[a:b]) + pad * (width - total), total, lengths, resets,
                own, starts[a:b].tolist(),
            ))
        return pd.DataFrame(out, columns=[x.split()[0] for x in schema.split(", ")])

    schema = (
        "group long, row long, ids binary, n_ids int, cu_lengths array<int>, resets array<int>, "
        "doc_ids array<long>, starts array<long>"
    )
    return found.repartition(max(parts, groups), "group").groupBy("group").applyInPandas(fill, schema)
