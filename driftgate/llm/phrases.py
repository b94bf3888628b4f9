"""Phrase collocations, counted with one FM-index per shard of the corpus.

Texts lose their A-Z, break into pieces at ``BREAKS`` and into words. Each task turns its texts into word ids, language by
language, and parts them into shards of about ``SHARD_WORDS`` words; a shard may end between any two pieces. A shard's
positions are sorted by the words that follow, as far as the longest phrase reaches, and what is kept of it is an FM-index:
the word in front of each sorted position (its Burrows-Wheeler transform) and where each word's rows start. From these the
mapping between a row and the row of the next position follows, in either direction.

Phrases are enumerated in rounds, one word longer each. All occurrences of a phrase are one interval of rows. The rows
whose first d words and whose words 2 to d+1 both are phrases that live make the intervals of d+1 words: an interval is
extended to the right, and at the same time that of its rest to the left, so that neither end can be a phrase that is rare in
the corpus. Each round sums the sizes of a phrase's intervals over all shards; phrases seen ``least`` times live on. Shards only
send intervals, and get back those that live, so no table of all n-grams exists anywhere.

The score of a phrase compares its count with those of the two parts it is cut into, at the cut where that looks least
remarkable, in exact arithmetic. A phrase is dropped if one that holds it is (nearly) as frequent: the largest count among
its extensions by one word to the left or to the right tells, as no longer phrase can be more frequent.

Defined results: a null text is empty, a null language is ``und``; repeated rows count each; a piece longer than a shard
makes one longer shard; phrases with equal counts and scores stand in byte order; an empty table gives no rows. Columns
other than text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, cut, text_bytes

LEAST = 100
LONGEST = 5
MOST = 2000
#: Percent of a phrase's count that a longer phrase has to reach for the shorter one to be dropped.
SHARE = 100
#: Words of a shard, about: some 200 MB while it is sorted.
SHARD_WORDS = 1 << 22
BREAKS = b".,;:!?\n\x0b\x0c\r"

_UPPER = bytes(range(65, 91))
_PLAIN = bytes.maketrans(_UPPER + BREAKS + b"\t", _UPPER.lower() + b"\n" * len(BREAKS) + b" ")
#: Bytes of a text that are split into words at once.
_PIECE = 1 << 20
_SHARDS = "shard long, lang string, n_words long, vocabulary binary, starts binary, front binary"
_ROWS = "lang string, shard long, lo int, hi int, phrase binary"


class _Ids(dict):
    """Ids of words in the order they come: 0 is the break between pieces, -1 no word at all."""

    def __init__(self) -> None:
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self) - 1
        return found


class _Gathered:
    """Word ids of one language until they are a shard."""

    def __init__(self) -> None:
        self.ids, self.parts, self.size, self.breaks = _Ids(), [np.zeros(1, np.int32)], 1, 0

    def add(self, words: list[bytes]) -> None:
        found = np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))
        found = found[found >= 0]
        self.parts.append(found)
        self.size += len(found)
        self.breaks += int((found == 0).sum())

    def cut(self, whole: bool) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        """The ids up to the last break, or all of them, the words by id, and the words behind that break."""
        ids = np.concatenate([*self.parts, np.zeros(int(whole), np.int32)])
        last = int(np.flatnonzero(ids == 0)[-1])
        words = list(self.ids)[1:]  # the first is no word
        return ids[: last + 1], words, [words[i] for i in ids[last + 1 :].tolist()]


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text and its breaks, some at a time."""
    at = 0
    text = text.translate(_PLAIN)
    while at < len(text):
        end = len(text) if at + _PIECE >= len(text) else text.find(b" ", at + _PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].replace(b"\n", b" \n ").split(b" ")
        at = end


def sorted_rows(ids: np.ndarray, width: int) -> np.ndarray:
    """Positions ordered by the ``width`` words from there on (around the end), by doubling what is compared."""
    rank, known = ids.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while known < width:
        step = min(known, width - known)
        keys = rank * (int(rank.max()) + 1) + np.roll(rank, -step)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(keys[1:] != keys[:-1])])
        known += step
    return order


def _index(ids: np.ndarray, words: list[bytes], width: int) -> tuple[bytes, bytes, bytes]:
    """Vocabulary, first row of each word (and the end), and the word in front of each row."""
    used, dense = np.unique(ids, return_inverse=True)  # a word only the next shard has is left out
    dense = dense.astype(np.int32)
    starts = np.concatenate([[0], np.cumsum(np.bincount(dense, minlength=len(used)))]).astype(np.int32)
    front = dense[sorted_rows(dense, width) - 1]
    return b" ".join([b"", *[words[i] for i in used.tolist()[1:]]]), starts.tobytes(), front.tobytes()


def shards(docs: DataFrame, width: int = LONGEST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The FM-index of every shard, written to the shared folder: vocabulary (the first entry is the break),
    starts and front."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        held: dict[str, _Gathered] = {}

        def finished(lang: str, whole: bool) -> pa.RecordBatch:
            nonlocal made
            ids, words, rest = held.pop(lang).cut(whole)
            if rest:
                held[lang] = _Gathered()
                held[lang].add(rest)
            made += 1
            row = base + made, lang, int((ids > 0).sum()), *_index(ids, words, width)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            names = [x.split()[0] for x in _SHARDS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for words in _word_lists(text.as_py()):
                    held.setdefault(lang, _Gathered()).add(words)
                    if held[lang].size > shard_words and held[lang].breaks:
                        yield finished(lang, False)
                if lang in held:
                    held[lang].add([b"\n"])
        for lang in list(held):
            if held[lang].size > 1:
                yield finished(lang, True)

    lang = F.coalesce(column(docs, "lang"), F.lit("und")).alias("lang")
    return cut(docs.select(lang, text_bytes().alias("text")).mapInArrow(build, _SHARDS))


def _words_of(vocabulary: bytes) -> pa.Array:
    return pa.array(vocabulary.split(b" "), pa.binary())


def _intervals(lang: str, shard: int, lo: np.ndarray, hi: np.ndarray, phrase: pa.Array) -> pa.Table:
    n = len(lo)
    columns = [pa.array([lang] * n, pa.string()), pa.array(np.full(n, shard)), pa.array(lo, pa.int32())]
    names = [x.split()[0] for x in _ROWS.split(", ")]
    return pa.table([*columns, pa.array(hi, pa.int32()), phrase], names=names)


def _single_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The intervals of single words."""
    for batch in batches:
        for row in batch.to_pylist():
            starts = np.frombuffer(row["starts"], np.int32)
            words = _words_of(row["vocabulary"])[1:]
            yield from _intervals(row["lang"], row["shard"], starts[1:-1], starts[2:], words).to_batches(100_000)


def extended(front: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of one word more, from those that live: where they start and end, and each row's next row."""
    order = np.argsort(lo)
    lo, hi = lo[order], hi[order]
    sizes = hi - lo
    own = np.full(len(front), -1, np.int32)
    own[np.arange(sizes.sum()) + np.repeat(lo - np.cumsum(sizes) + sizes, sizes)] = np.repeat(lo, sizes)
    after = np.argsort(front, kind="stable")  # rows of one word in front keep their order: the row behind each row
    rest = own[after]
    at = np.flatnonzero((own >= 0) & (rest >= 0))
    if not len(at):
        return at, at, after
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (np.diff(own[at]) != 0) | (np.diff(rest[at]) != 0)
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1] + 1, after


def _longer(depth: int):
    """For one shard and its intervals of ``depth`` words that live, those of one word more."""

    def extend(index: pa.Table, live: pa.Table) -> pa.Table:
        empty = np.zeros(0, np.int32)
        if not len(index) or not len(live):
            return _intervals("", 0, empty, empty, pa.array([], pa.binary()))
        (row,) = index.to_pylist()
        lo, hi = (live.column(c).to_numpy() for c in ("lo", "hi"))
        lo, hi, after = extended(np.frombuffer(row["front"], np.int32), lo, hi)
        starts, words = np.frombuffer(row["starts"], np.int32), _words_of(row["vocabulary"])
        at, parts = lo, []
        for _ in range(depth + 1):
            parts.append(words.take(pa.array(np.searchsorted(starts, at, "right") - 1)))
            at = after[at]
        return _intervals(row["lang"], row["shard"], lo, hi, pc.binary_join_element_wise(*parts, b" "))

    return extend


def counted(docs: DataFrame, least: int, longest: int, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """How often each phrase of up to ``longest`` words occurs that occurs ``least`` times: lang, phrase, words, f; and all
    words of each language: lang, n."""
    index = shards(docs, longest, shard_words)
    totals = index.groupBy("lang").agg(F.sum("n_words").alias("n"))
    rows = index.select("shard", "lang", "vocabulary", "starts").mapInArrow(_single_words, _ROWS)
    everywhere = Window.partitionBy("lang", "phrase")  # one row for each shard at most
    levels = []
    for depth in range(1, longest + 1):
        summed = rows.withColumn("f", F.sum((F.col("hi") - F.col("lo")).cast("long")).over(everywhere))
        live = cut(summed.filter(F.col("f") >= least))
        levels.append(
            live.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
            .select("lang", F.col("phrase").cast("string").alias("phrase"), F.lit(depth).alias("words"), "f")
        )
        rows = (
            index.groupBy("shard").cogroup(live.select("shard", "lo", "hi").groupBy("shard"))
            .applyInArrow(_longer(depth), _ROWS)
        )
    return cut(reduce(DataFrame.unionAll, levels)), totals


def _part(words: str) -> F.Column:
    return F.expr(f"substring_index(phrase, ' ', {words})")


def mine(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = MOST, share: int = SHARE,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The ``most`` phrases of each language that stand out: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = counted(docs, least, longest, shard_words)
    phrases = counts.filter("words > 1").withColumnRenamed("f", "a")
    extensions = (
        counts.filter("words > 2")
        .select("lang", "f", F.explode(F.array(_part("words - 1"), _part("1 - words"))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    )
    kept = phrases.join(extensions, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))
    )
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    sides = cuts.select("*", _part("k").alias("left"), _part("k - words").alias("right"))
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = sides.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang").withColumn(
        "score",  # of decimals, as the products may pass 64 bits
        F.expr("""(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0)))
            div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"""),
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(lowest)
    # With the rank bounded, Spark cuts each task's rows to as many before they meet.
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select(
        "lang", F.col("rank").cast("long"), "phrase", "a", F.col("cut.l"), F.col("cut.r"), "n", F.col("cut.score"),
    )
