"""Mixing sources to target weights, block by block.

The words of each source, in an order that its documents' hashes fix, are packed into blocks of ``BLOCK`` words at most, all
of a source equal but for one word. Targets become whole words, what rounding leaves carried to the next source; a source's
last draw takes only the words that its target still lacks, so small sources meet theirs too. The mix
has output shards of ``SLOTS`` slots each. Every shard draws how many of its slots go to each source: multinomial counts,
conditioned on the totals that the targets ask for, found by splitting the totals down a binary tree of shards. So
each task knows by itself which draws of a source came before. The n-th draw of a source takes the block at place n of
a keyed permutation of its blocks, a new permutation each time round, and blocks join slots by that index. Nothing
depends on a task's order or place: reruns agree.

The source table (one row per source, at most ``MOST_SOURCES``, else an error) is the only thing on the driver.

Defined results: a null text has no words and is never taken; null is a source like any other, the last; rows equal in
doc_id, source and text count each by itself; an empty table or one without words gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, column, cut, fresh_name

BLOCK = 64
SLOTS = 4096
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_TIMES = 2
MOST_SOURCES = 1_000_000
BUCKETS = 1024
SEED = 20_240_601

#: What numpy's generator takes.
_NUMPY = 10**9


@dataclass(frozen=True)
class Mix:
    """What a mix draws on, by source: sizes in words, targets, blocks, draws, words that the last draw takes at most."""

    names: list[str | None]
    sizes: np.ndarray
    targets: np.ndarray
    blocks: np.ndarray
    draws: np.ndarray
    last: np.ndarray
    seed: int


def targets(sizes: np.ndarray, weights: np.ndarray, total: float, most_times: float = MOST_TIMES) -> np.ndarray:
    """``total`` shared by weight; what would exceed ``most_times`` a source's size is shared again by the others."""
    limits = most_times * sizes.astype(float)
    held = np.zeros(len(sizes), bool)
    out = np.zeros(len(sizes))
    while not held.all():
        free = weights[~held].sum()
        out = np.where(held, limits, (total - limits[held].sum()) * weights / free)
        above = ~held & (out > limits)
        if not above.any():
            break
        held |= above
    return np.where(held, limits, out)


def plan(
    sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, block: int = BLOCK, seed: int = SEED,
) -> Mix:
    """The mix of ``sized`` (source, size): sources by code point, null last, weights in turn."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8", "surrogatepass")))
    sizes = np.array([r["size"] for r in rows], np.int64)
    given = np.array([weights[i % len(weights)] for i in range(len(rows))], float)
    wanted = targets(sizes, given, share * float(sizes.sum())) if len(rows) else np.zeros(0)
    blocks = -(-sizes // block)
    draws, last = draws_of(sizes, blocks, wanted)
    return Mix([r["source"] for r in rows], sizes, wanted, blocks, draws, last, seed)


def draws_of(sizes: np.ndarray, blocks: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many blocks are drawn of each source, and how many words of the last one, for ``wanted`` words."""
    words = np.diff(np.rint(np.cumsum(wanted)), prepend=0).astype(np.int64)
    words = np.minimum(words, MOST_TIMES * sizes)
    whole, rest = np.divmod(words, np.maximum(sizes, 1))
    # The rest in blocks; a block has the source's words divided by its blocks, rounded down or up.
    base, larger = np.divmod(sizes, np.maximum(blocks, 1))
    mean = sizes / np.maximum(blocks, 1)
    more = np.minimum(np.floor(rest / np.maximum(mean, 1)).astype(np.int64), np.maximum(blocks - 1, 0))
    lacking = rest - np.rint(more * mean).astype(np.int64)
    lacking = np.clip(lacking, 0, base + (larger > 0))
    partial = lacking > 0
    return whole * blocks + more + partial, np.where(partial, lacking, base + (larger > 0))

def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(at: np.ndarray, size: int, key: int) -> np.ndarray:
    """Places 0 … ``size`` - 1 under a keyed permutation: a Feistel network, walked until inside."""
    half = np.uint64(max(1, (int(size - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _scramble(np.uint64(key & (2**64 - 1)) + np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = at.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (_scramble(right ^ k) & mask)
        out[todo] = x = (left << half) | right
        todo = todo[x >= size]
    return out.astype(np.int64)


def _hypergeometric(own: int, others: int, slots: int, rng: np.random.Generator) -> int:
    """How many of ``slots`` drawn from ``own`` and ``others`` are of the own: exactly that law for any size.

    numpy draws from up to ``_NUMPY`` items. Beyond, one uniform number is looked up in the distribution function, summed over the
    counts around the mode that hold all but a part in 10^17 of it.
    """
    rest = own + others
    if rest < _NUMPY:
        return int(rng.hypergeometric(own, others, slots))
    low, high = max(0, slots - others), min(own, slots)
    mode = min(max((own + 1) * (slots + 1) // (rest + 2), low), high)
    spread = (slots * (own / rest) * (others / rest) * ((rest - slots) / (rest - 1))) ** 0.5
    reach = int(9 * spread) + 60  # Bernstein's bound for 40 nats
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.int64)
    steps = np.log(own - k) + np.log(slots - k) - np.log(k + 1) - np.log(others - slots + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    below = np.cumsum(np.exp(logs - logs.max()))
    return low + min(int(np.searchsorted(below, rng.random() * below[-1], "right")), high - low)


def _split(counts: np.ndarray, first: int, rng: np.random.Generator) -> np.ndarray:
    """How many of ``first`` slots, of ``counts.sum()``, go to each source."""
    out = np.zeros(len(counts), np.int64)
    rest, slots = int(counts.sum()), first
    for i, own in enumerate(counts.tolist()):
        others = rest - own
        low, high = max(0, slots - others), min(own, slots)
        out[i] = low if low == high else _hypergeometric(own, others, slots, rng)
        slots -= int(out[i])
        rest = others
    return out


def shard_counts(mix: Mix, shard: int, shards: int, held: dict) -> tuple[np.ndarray, np.ndarray]:
    """How many slots of a shard go to each source, and how many of the shards before it did."""
    low, high = 0, shards
    counts, before = mix.draws, np.zeros_like(mix.draws)
    while high - low > 1:
        middle = (low + high) // 2
        if (low, high) not in held:
            held[low, high] = _split(counts, (middle - low) * SLOTS, np.random.default_rng([mix.seed, low, high]))
        left = held[low, high]
        if shard < middle:
            counts, high = left, middle
        else:
            before, counts, low = before + left, counts - left, middle
    return counts, before


def slots(spark, mix: Mix) -> DataFrame:
    """Every slot of the mix: shard, slot, source (its place in ``mix.names``), pass, block, words of it at most."""
    shards = -(-int(mix.draws.sum()) // SLOTS)

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for frame in frames:
            for shard in frame["id"].tolist():
                counts, before = shard_counts(mix, shard, shards, held)
                parts = []
                for s in np.flatnonzero(counts).tolist():
                    ranks = before[s] + np.arange(counts[s])
                    turn, place = ranks // mix.blocks[s], ranks % mix.blocks[s]
                    blocks = np.empty(len(ranks), np.int64)
                    for t in np.unique(turn).tolist():
                        key = mix.seed + s * 0x5851F42D4C957F2D + t * 0x14057B7EF767814F
                        blocks[turn == t] = permuted(place[turn == t], int(mix.blocks[s]), key)
                    most = np.where(ranks == mix.draws[s] - 1, mix.last[s], 1 << 30)
                    parts.append(pd.DataFrame({"source_at": s, "turn": turn, "block": blocks, "most": most}))
                if parts:
                    out = pd.concat(parts)
                    out["shard"] = shard
                    out["slot"] = np.random.default_rng([mix.seed, shards, shard]).permutation(len(out))
                    yield out[["shard", "slot", "source_at", "turn", "block", "most"]]

    ids = spark.range(0, shards, 1, max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return ids.mapInPandas(draw, "shard long, slot int, source_at int, turn long, block long, most int")


def row_names() -> list[Column]:
    """Two hashes of doc_id, source and text, which name a row."""
    parts = [F.col("doc_id"), F.col("source"), F.col("text")]
    marks = [p.isNull() for p in parts]
    return [F.xxhash64(*parts, *marks).alias("k1"), F.xxhash64(*marks, *reversed(parts), F.lit(1)).alias("k2")]


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and the names of the rows."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    return docs.select("doc_id", "source", size, *row_names())


def placed(rows: DataFrame, mix: Mix) -> DataFrame:
    """Each row of ``sized`` with its source's place and the word of it at which it starts.

    Offsets add up in two steps: over ``BUCKETS`` sums per source, then within each bucket.
    """
    facts = zip(mix.names, mix.sizes.tolist(), mix.targets.tolist(), mix.blocks.tolist(), strict=True)
    names = rows.sparkSession.createDataFrame(
        [(n, i, *own) for i, (n, *own) in enumerate(facts)],
        "name string, source_at int, source_size long, target double, blocks long",
    )
    rows = rows.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    rows = rows.withColumn("bucket", F.pmod("k1", F.lit(BUCKETS)))
    sums = rows.groupBy(F.col("source_at").alias("s"), F.col("bucket").alias("b")).agg(F.sum("size").alias("n"))
    before = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("s", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_at", "bucket").orderBy("k1", "k2").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (
        rows.join(sums, (F.col("s") == F.col("source_at")) & (F.col("b") == F.col("bucket")))
        .withColumn("start", F.col("base") + F.col("inside")).drop("s", "b", "base", "inside", "bucket")
    )


def segments(rows: DataFrame) -> DataFrame:
    """The parts of each row of ``placed`` with words, by block: source_at, start, block, at (in the block), first (word), n."""
    # The first ``larger`` blocks of a source have ``base`` + 1 words, the others ``base``.
    spans = rows.filter("size > 0").select(
        "source_at", "start", "size", F.expr("source_size div blocks").alias("base"), F.expr("source_size % blocks").alias("larger"),
    )

    def block_of(word: str) -> str:
        return f"if({word} < larger * (base + 1), {word} div (base + 1), larger + ({word} - larger * (base + 1)) div base)"

    spans = spans.select("*", F.explode(F.expr(f"sequence({block_of('start')}, {block_of('(start + size - 1)')})")).alias("block"))
    opens = F.col("block") * F.col("base") + F.least("block", "larger")
    low = F.greatest(F.col("start"), opens)
    high = F.least(F.col("start") + F.col("size"), opens + F.col("base") + F.when(F.col("block") < F.col("larger"), 1).otherwise(0))
    return spans.select(
        "source_at", "start", "block", (low - opens).alias("at"), (low - F.col("start")).alias("first"), (high - low).alias("n"),
    )


def mixed(rows: DataFrame, mix: Mix) -> DataFrame:
    """The mix, as parts of documents: shard, slot, turn, source_at, start, first, n. ``rows``: of ``placed``."""
    # Spark takes the slots for as few as the shards they are drawn from, and would broadcast them all.
    found = segments(rows).join(slots(rows.sparkSession, mix).hint("merge"), ["source_at", "block"])
    return found.filter("at < most").withColumn("n", F.least("n", F.col("most") - F.col("at"))).drop("at", "most")


def taken(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """How many words of each document the mix takes: doc_id, source, size, source_size, target, taken."""
    rows = cut(sized(docs))
    mix = plan(rows, block=block)
    rows = cut(placed(rows, mix))
    words = mixed(rows, mix).groupBy("source_at", "start").agg(F.sum("n").alias("taken"))
    full, none = rows.filter("size > 0"), rows.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    found = full.join(words, ["source_at", "start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    wanted = ["doc_id", "source", "size", "source_size", "target", "taken"]
    return found.select(*wanted).unionByName(none.select(*wanted))


def _cut_words(text: bytes, first: np.ndarray, n: np.ndarray) -> bytes:
    """The parts of a text that hold these ranges of words, adjoining ones as they stand, others on new lines."""
    codes = np.frombuffer(text, np.uint8)
    inside = np.ones(len(codes) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    order = np.argsort(first, kind="stable")
    parts, low, high = [], None, None
    for a, b in zip(first[order].tolist(), (first + n)[order].tolist(), strict=True):
        if a == high:
            high = b
            continue
        if low is not None:
            parts.append(text[starts[low] : ends[high - 1]])
        low, high = a, b
    parts.append(text[starts[low] : ends[high - 1]])
    return b"\n".join(parts)


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as documents, columns as they came: a row for each time round that takes words of a document, its text
    cut down to those words (``n_chars``, where there is one, with it). Of rows equal in doc_id, source and text the
    other columns of one stand for all."""
    rows = cut(sized(docs))
    mix = plan(rows, block=block)
    rows = cut(placed(rows, mix))
    picked = (
        mixed(rows, mix).groupBy("source_at", "start", "turn")
        .agg(F.collect_list("first").alias("first"), F.collect_list("n").alias("n"))
        .join(rows.filter("size > 0").select("source_at", "start", "k1", "k2"), ["source_at", "start"])
        .select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), "first", "n")
    )
    whole = docs.select(*row_names(), F.struct(*[column(docs, c).alias(c) for c in docs.columns]).alias("row"))
    # Reruns agree on which: the one whose other columns, as JSON, have the least hash.
    others = F.to_json(F.struct(*[F.col("row")[c].alias(c) for c in docs.columns if c != "text"]))
    whole = whole.groupBy("k1", "k2").agg(F.min_by("row", F.xxhash64(others)).alias("row"))

    @F.pandas_udf("binary")
    def words(text: pd.Series, first: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([_cut_words(t, f, m) for t, f, m in zip(text, first, n, strict=True)])

    joined = whole.join(picked, (F.col("k1") == F.col("p1")) & (F.col("k2") == F.col("p2")))
    text = fresh_name(docs, "mixed_text")
    out = joined.select("row.*", words(F.col("row.text").cast("binary"), "first", "n").cast("string").alias(text))
    out = out.withColumn("text", F.col(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[column(out, c) for c in docs.columns])
