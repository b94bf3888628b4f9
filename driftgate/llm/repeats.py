"""Repeated passages: suffixes sorted one bucket at a time.

Every byte position starts a suffix; what counts is the first ``LENGTH`` bytes of it. Suffixes are dealt into buckets by
the least hash of the 12-byte strings in their first ``LENGTH`` bytes, so neighbours mostly share a bucket and
travel as one run of bytes. Each bucket is sorted by itself, in one task's memory, and its number follows the input.
Suffixes that tie there have equal hashes; they are compared byte by byte before they count. A cover sample's
ranks would decide ties beyond its period; any period of ``LENGTH`` or more leaves none to decide, since two suffixes that agree
for ``LENGTH`` bytes are a repeat whatever follows. So none is computed.

What a task can decide from the texts it has at hand is not sent: of a string that several of them share only the
smallest doc_id's goes on, so a group of copies reaches its buckets once per task, not once per copy.

Defined results: a null text is empty; texts shorter than ``LENGTH`` keep all; rows without doc_id neither remove nor lose
anything; rows that share a doc_id are one document in this respect, each with a row of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh_name, slices, text_bytes

LENGTH = 50
#: Bytes of text whose suffixes a bucket holds, on average.
BUCKET_BYTES = 2 << 20
_CORE = 12
_PIECE = 2 << 20
_STRETCH = 1 << 17
_MULT = 0x9E3779B97F4A7C15


def _window_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """A polynomial hash of the ``length`` bytes at each position that has them."""
    out = np.empty(max(len(codes) - length + 1, 0), np.uint64)
    for i in range(0, len(out), _STRETCH):
        out[i : i + _STRETCH] = _stretch_hashes(codes[i : i + _STRETCH + length - 1], length)
    return out


def _stretch_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """The same by doubling, for a stretch short enough for the processor's caches."""
    out, done = None, 0
    power = codes.astype(np.uint64) + np.uint64(1)  # of strings of ``step`` bytes
    step = 1
    total = len(codes) - length + 1
    while True:
        if length & step:
            part = power[done : done + total]
            if out is None:
                out = part.copy()
            else:
                out = out * np.uint64(pow(_MULT, step, 1 << 64)) + part
            done += step
        if 2 * step > length:
            return out
        power = power[: len(power) - step] * np.uint64(pow(_MULT, step, 1 << 64)) + power[step:]
        step *= 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return x if span == width else np.minimum(x[: len(x) - (width - span)], x[width - span :])


def _tied(hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that occur more than once, sorted by hash.

    The leading bits are sorted first, with the places in the trailing ones; only what ties there is sorted in full."""
    bits = np.uint64(int(len(hashes)).bit_length())
    packed = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    packed.sort()
    same = (packed[1:] ^ packed[:-1]) >> bits == 0
    some = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
    order = (packed[some] & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    del packed
    keys = hashes[order]
    turn = np.argsort(keys)
    order, keys = order[turn], keys[turn]
    same = keys[1:] == keys[:-1]
    if not len(order):
        return order
    return order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]


def _pack(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Runs of suffixes (document, start, end), those of a document together."""
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    per = np.diff(np.append(first, len(docs)))
    steps = starts.copy()
    steps[1:] -= starts[:-1]
    head = np.array([len(docs), len(first)], "<i8").tobytes()
    body = b"".join((
        docs[first].astype("<i8").tobytes(), per.astype("<i4").tobytes(), steps.astype("<i4").tobytes(),
        (ends - starts).astype("<i4").tobytes(),
    ))
    return zstandard.ZstdCompressor(level=1).compress(head + body)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, k = np.frombuffer(raw, "<i8", 2).tolist()
    docs = np.frombuffer(raw, "<i8", k, 16)
    per = np.frombuffer(raw, "<i4", k, 16 + 8 * k)
    steps = np.frombuffer(raw, "<i4", n, 16 + 12 * k)
    starts = np.cumsum(steps, dtype=np.int64)
    return np.repeat(docs, per), starts, starts + np.frombuffer(raw, "<i4", n, 16 + 12 * k + 4 * n)


def _unpack_all(blobs: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs, starts, ends = zip(*(_unpack(b) for b in blobs), strict=True)
    return np.concatenate(docs), np.concatenate(starts), np.concatenate(ends)


def _later(
    owner: np.ndarray, ids: np.ndarray, inside: np.ndarray, codes: np.ndarray, length: int,
) -> np.ndarray:
    """Which of the strings at the places ``inside`` of ``codes`` also stand in a smaller document.

    owner: whose each place is, as a place in ``ids``."""
    out = np.zeros(len(inside), bool)
    at = np.flatnonzero(inside).astype(np.int32 if len(inside) < 1 << 31 else np.int64)
    if len(at) < 2:
        return out
    hashes = _window_hashes(codes, length)[at]
    order = _tied(hashes)
    if not len(order):
        return out
    keys, own = hashes[order], ids[owner[at[order]]]
    del hashes
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(first, len(order)))
    smallest = np.repeat(np.minimum.reduceat(own, first), sizes)
    group = np.repeat(np.arange(len(first)), sizes)
    model = np.zeros(len(first), np.int64)
    holds = np.flatnonzero(own == smallest)
    model[group[holds]] = at[order[holds]]
    late = np.flatnonzero(own > smallest)
    view = np.lib.stride_tricks.sliding_window_view(codes, length)
    right = np.ones(len(late), bool)
    for i in range(0, len(late), 1 << 18):
        part = late[i : i + (1 << 18)]
        right[i : i + (1 << 18)] = (view[at[order[part]]] == view[model[group[part]]]).all(axis=1)
    out[at[order[late[right]]]] = True
    for g in np.unique(group[late[~right]]).tolist():  # equal hashes of different strings
        members = order[first[g] : first[g] + sizes[g]]
        least: dict[bytes, int] = {}
        texts = [view[p].tobytes() for p in at[members]]
        held = ids[owner[at[members]]].tolist()
        for text, doc in zip(texts, held, strict=True):
            least[text] = min(doc, least.get(text, doc))
        out[at[members]] = [doc > least[t] for t, doc in zip(texts, held, strict=True)]
    return out


def _spans(marked: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each unbroken run of marked places; a run ends before a place in ``breaks`` (bool)."""
    at = np.flatnonzero(marked)
    if not len(at):
        return at, at
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | breaks[at[1:]]])
    return at[new], at[np.concatenate([new[1:], [True]])]


def _places(sizes: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of strings laid end to end: whose each place is, whether ``length`` bytes from there are the same
    string's, and whether a string begins there. Places with less than that behind them are left out."""
    total = int(sizes.sum()) - length + 1
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[:total]
    inside = np.zeros(total + length, np.int8)
    inside[starts] += 1
    np.add.at(inside, starts + sizes - length + 1, -1)
    edge = np.zeros(total, bool)
    edge[starts[starts < total]] = True
    return owner, np.cumsum(inside[:total], dtype=np.int8) > 0, edge


def _prints(text: bytes, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A hash of what each span holds: by it a span is known to belong to one text of several with the same doc_id."""
    spans = zip(low.tolist(), high.tolist(), strict=True)
    return np.fromiter((xxhash.xxh3_64_intdigest(text[a:b]) for a, b in spans), np.uint64, len(low)).astype(np.int64)


def _suffixes(items: list[tuple[int, bytes]], buckets: int, length: int) -> Iterator[tuple]:
    """For some documents, sorted by doc_id: spans decided here (bucket -1), and a blob of runs for each bucket."""
    whole = b"".join(t for _, t in items)
    codes = np.frombuffer(whole, np.uint8)
    sizes = np.array([len(t) for _, t in items])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    ids = np.array([d for d, _ in items], np.int64)
    owner, inside, edge = _places(sizes, starts, length)
    late = _later(owner, ids, inside, codes, length)
    low, high = _spans(late, edge)
    own = owner[low]
    marks = _prints(whole, low, high + length).astype("<i8").tobytes()
    yield -1, ids[own], low - starts[own], high - starts[own] + length, marks
    core = _mixed(_window_hashes(codes, _CORE))
    bucket = (_mixed(_least(core, length - _CORE + 1)) % np.uint64(buckets)).astype(np.int64)
    edge[1:] |= bucket[1:] != bucket[:-1]
    low, high = _spans(inside & ~late, edge)
    order = np.argsort(bucket[low], kind="stable")
    low, high = low[order], high[order] + length
    which = bucket[low]
    cuts = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]])) if len(which) else []
    pairs = list(zip(low.tolist(), high.tolist(), strict=True))
    pack = zstandard.ZstdCompressor(level=1)
    for a, b in zip(cuts, [*cuts[1:], len(low)], strict=True):
        own = owner[low[a:b]]
        data = pack.compress(b"".join([whole[x:y] for x, y in pairs[a:b]]))
        yield int(which[a]), ids[own], low[a:b] - starts[own], high[a:b] - starts[own], data


_BLOB = "bucket long, runs binary, data binary"


def _shipped(buckets: int, length: int):
    names = [x.split()[0] for x in _BLOB.split(", ")]

    def ship(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, bytes]] = []
        for frame in frames:
            held += [(d, t) for d, t in zip(frame["doc_id"].tolist(), frame["text"], strict=True)]
            while held:
                ranges = list(slices([t for _, t in held], _PIECE))
                if len(ranges) == 1 and sum(len(t) for _, t in held) < _PIECE:
                    break
                yield from send(held[: ranges[0][1]])
                held = held[ranges[0][1] :]
        if held:
            yield from send(held)

    def send(items: list[tuple[int, bytes]]) -> Iterator[pd.DataFrame]:
        items = sorted(items)
        rows = [
            (bucket, _pack(docs, a, b), data)
            for bucket, docs, a, b, data in _suffixes(items, buckets, length)
            if len(docs)
        ]
        if rows:
            yield pd.DataFrame(rows, columns=names)

    return ship


def _sort_bucket(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """The spans of one bucket's suffixes that a smaller document has too: doc, a, b, and a hash of what they hold."""
    ids, a, b = _unpack_all(frame["runs"])
    unpack = zstandard.ZstdDecompressor()
    whole = b"".join(unpack.decompress(x) for x in frame["data"])
    codes = np.frombuffer(whole, np.uint8)
    sizes = b - a
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    run, inside, edge = _places(sizes, first, length)
    late = _later(run, ids, inside, codes, length)
    low, high = _spans(late, edge)
    own = run[low]
    offset = a[own] - first[own]
    marks = _prints(whole, low, high + length)
    return pd.DataFrame({"doc": ids[own], "a": low + offset, "b": high + offset + length, "mark": marks})


def repeated_spans(docs: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Spans of bytes (doc, a, b, and a hash of them as mark; overlapping ones are not merged) that stand in a document
    of smaller doc_id too."""
    if length < _CORE:
        raise ValueError(f"passages have {_CORE} bytes at least")
    volume = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(1, -(-volume // bucket_bytes))
    source = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    source = source.filter(F.octet_length("text") >= length)
    sent = source.mapInPandas(_shipped(buckets, length), _BLOB)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def decide(key, frames):
        if key[0] >= 0:
            return _sort_bucket(frames, length)
        ids, a, b = _unpack_all(frames["runs"])
        marks = np.frombuffer(b"".join(frames["data"]), "<i8")
        return pd.DataFrame({"doc": ids, "a": a, "b": b, "mark": marks})

    # Spans decided on the way stay dealt out: each blob of them is a group by itself.
    tag = F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("runs"), F.lit(1 << 20))).otherwise(-1)
    grouped = sent.withColumn("own", tag).repartition(max(parts, buckets), "bucket", "own").groupBy("bucket", "own")
    return grouped.applyInPandas(decide, "doc long, a long, b long, mark long")


def _kept(text: bytes, starts: np.ndarray | None, ends: np.ndarray | None) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed, and the number of runs they form."""
    if starts is None or not len(starts):
        return text, 0, 0
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    low, high = starts[new], ends[np.concatenate([new[1:], [True]])]
    parts, last = [], 0
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        parts.append(text[last:a])
        last = b
    parts.append(text[last:])
    return b"".join(parts), int((high - low).sum()), len(low)


def remove_repeats(docs: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with a last column ``repeats``: kept (the bytes left), n_bytes, n_removed, n_spans, kept_sha256."""
    name = fresh_name(docs, "repeats")
    spans = cut(repeated_spans(docs, length, bucket_bytes))
    doc, own_spans = fresh_name(docs, "span_doc"), fresh_name(docs, "spans")
    by_doc = spans.groupBy(F.col("doc").alias(doc)).agg(F.collect_list(F.struct("a", "b", "mark")).alias(own_spans))

    @F.pandas_udf("kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def remove(text: pd.Series, a: pd.Series, b: pd.Series, mark: pd.Series) -> pd.DataFrame:
        rows = []
        for t, x, y, m in zip(text, a, b, mark, strict=True):
            if x is not None:
                own = _prints(t, x, y) == m
                x, y = x[own], y[own]
            kept, removed, count = _kept(t, x, y)
            rows.append((kept, len(t), removed, count, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(rows, columns=["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = docs.join(by_doc, F.col("doc_id").cast("long") == F.col(doc), "left")
    found = joined.withColumn(name, remove(text_bytes(), *[F.col(f"{own_spans}.{c}") for c in ("a", "b", "mark")]))
    return found.drop(doc, own_spans)
