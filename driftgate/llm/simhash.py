"""SimHash near-duplicates: a byte-position inverted index with count filtering.

Equal fingerprints are one class. Fingerprints that differ in ``BITS`` bits share at least ``8 - BITS`` of their eight
positional bytes, so a pair is looked for in the index under each set of that many positions: a posting list is keyed by
the bytes there, and whoever shares a list has tallied the guaranteed minimum of matches. Its members differ in at
most ``BITS`` bytes, so a list holds at most 65,536 different fingerprints at 2 bits. Within it pairs are verified bit by
bit, and every linked set is passed on as a star, so that the links stay as many as the members. The classes and
stars then go through connected components.

Defined results: a null or wordless text has fingerprint zero, linked like any other; a null doc_id is judged like any
other row, and a component's id is its smallest doc_id that is not null; repeated rows each give a row.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, cut, fresh_name, text_bytes
from .components import components

SHINGLE = 3
BITS = 2
SEED = 42
_SOME = 1 << 16
#: Members up to which every pair of a list is compared; beyond it partners are looked up by their bit patterns.
_FEW = 64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles, A-Z lower-cased, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    count = max(len(words) - shingle + 1, 1)
    lasts = ends[min(shingle, len(words)) - 1 :] - 1
    firsts = np.concatenate([[0], ends[: count - 1]])
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    spans = zip(firsts.tolist(), lasts.tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, count)
    for i in range(0, count, _SOME):
        octets = hashes[i : i + _SOME].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def with_fingerprints(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint as a long."""

    @F.pandas_udf("long")
    def prints(text: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in text], dtype="int64")

    return docs.withColumn(name, prints(text_bytes()))


def _stars(members: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Links within one posting list, as (member, least member it is connected to)."""
    parent = list(range(len(members)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def link(i: int, j: int) -> None:
        i, j = sorted((root(i), root(j)))
        parent[j] = i

    members = sorted(members)
    if len(members) <= _FEW:
        for i, j in combinations(range(len(members)), 2):
            # Members are signed: a negative number's bit_count is that of its absolute value.
            if ((members[i] ^ members[j]) & (2**64 - 1)).bit_count() <= most:
                link(i, j)
    else:
        spread = 0
        for m in members:
            spread |= (m ^ members[0]) & (2**64 - 1)
        masks = [1 << b for b in range(64) if spread >> b & 1]
        flips = [sum(x) for k in range(1, most + 1) for x in combinations(masks, k)]
        place = {m & (2**64 - 1): i for i, m in enumerate(members)}
        for m, i in place.items():
            for flip in flips:
                if (j := place.get(m ^ flip, i)) > i:
                    link(i, j)
    for i, m in enumerate(members):
        if root(i) != i:
            yield m, members[root(i)]


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Stars (a, b) that connect the different fingerprints (``fp``) within ``bits`` bits of each other."""
    octet = [F.shiftright("fp", 8 * k).bitwiseAND(F.lit(255)) for k in range(8)]
    keys = [
        F.struct(
            F.lit(i).alias("set"),
            sum((F.shiftleft(octet[p], 8 * k) for k, p in enumerate(chosen)), F.lit(0).cast("long")).alias("octets"),
        )
        for i, chosen in enumerate(combinations(range(8), 8 - bits))
    ]
    lists = (
        prints.select("fp", F.explode(F.array(*keys)).alias("key"))
        .groupBy("key").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1).select("members")
    )

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = defaultdict(set)
            for members in frame["members"]:
                for a, b in _stars(members.tolist(), bits):
                    found[a].add(b)
            pairs = [(a, b) for a, others in found.items() for b in others]
            yield pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    return lists.mapInPandas(verify, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Each row's doc_id, its fingerprint as 16 hex digits, and the smallest doc_id of its component."""
    own = cut(with_fingerprints(docs.select("doc_id", "text"), "fp", shingle).select("doc_id", "fp"))
    return grouped(own, bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def classes(rows: DataFrame, bits: int = BITS, fp: str = "fp") -> DataFrame:
    """Each fingerprint (``fp``) with its component's root and smallest doc_id (component_id)."""
    each = cut(rows.groupBy(F.col(fp).alias("fp")).agg(F.min("doc_id").alias("least")))
    joined = components(links(each.select("fp"), bits))
    ids = each.join(joined, each["fp"] == joined["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    return ids.join(smallest, "root").select(F.col("fp").alias("_class"), "root", "component_id")


def grouped(rows: DataFrame, bits: int = BITS, fp: str = "fp") -> DataFrame:
    """``rows`` (doc_id, ``fp``) with component_id."""
    return rows.join(classes(rows, bits, fp), F.col(fp) == F.col("_class"), "left").drop("_class", "root")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One document of each group, the one with the smallest doc_id; columns as they came.

    Rows that repeat a group's doc_id are one document: the first by its text's hash stays. Of a group without any
    doc_id likewise. Which rows stay is settled on ids and hashes; the texts then move once.
    """
    fp, row = fresh_name(docs, "fp"), fresh_name(docs, "row_number")
    marked = cut(with_fingerprints(docs, fp, shingle).withColumn(row, F.monotonically_increasing_id()))
    rows = marked.select("doc_id", F.col(fp).alias("fp"), F.xxhash64("text").alias("hash"), F.col(row).alias("at"))
    known = rows.join(classes(rows, bits), F.col("fp") == F.col("_class"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "hash", "at")).alias("first")
    own = fresh_name(marked, "winner")
    winners = known.groupBy("root").agg(first).select(F.col("first.at").alias(own))
    return marked.join(winners, F.col(row) == F.col(own), "left_semi").select(*[f"`{c}`" for c in docs.columns])
