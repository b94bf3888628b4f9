"""Quality rules: counts of each text, and perplexity under an n-gram model of its language.

The model is an interpolated modified Kneser-Ney model of byte 4-grams over the words of a text, joined by
single spaces. It is trained on prose: texts with more than one symbol in ``PROSE`` words would make their own junk
likely, so they are judged but not learnt from, unless they are most of their language. Spark counts every such text; the counts per language, context and lower order come from those by
aggregation. N-grams seen less often than ``FEWEST`` times in their language are then left to back-off; the rest is
the model, however large the corpus and whatever the other languages. It is held as sorted arrays of hashed n-grams. Models of
up to ``HELD`` entries are broadcast at once; beyond that languages are taken in ranges, one after the other. A document is rejected when its perplexity lies
outside the band of its language: ``WIDTH`` robust deviations around the median on the logarithmic scale, wider
for short texts.

Defined results: a null text has no words; a null language is a language of its own; a text without words has no
perplexity; repeated rows each give a row; an empty table gives none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, cut, fresh_name, lookup, slices, text_bytes

ORDER = 4
#: Entries of models that the driver holds and broadcasts at once; a language is never divided.
HELD = 1 << 21
#: What is seen once is left to back-off at any size, so that no text vouches for itself.
FEWEST = 2
#: Robust standard deviations that a document's log-perplexity may lie from the median of its language.
WIDTH = 6.0
#: Least half-width of a band: a language whose documents are all alike rejects nobody for less.
LEAST_WIDTH = 0.1
#: A text is learnt from if it has at most one symbol in so many words.
PROSE = 10
#: Words at which a text is so short that its band is twice as wide.
SHORT = 25
WINDOW = 5
SYMBOLS = b"#*$%&|<>"

_PIECE = 1 << 20
_ODD = np.uint32(0x9E3779B1)
_MULT = np.uint64(0x5851F42D4C957F2D)
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))

FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_perplexity double"
)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse, modulo 2**64."""
    steps = np.full(n, _MULT)
    steps[:1] = 1
    back = np.full(n, np.uint64(pow(int(_MULT), -1, 1 << 64)))
    back[:1] = 1
    return np.multiply.accumulate(steps), np.multiply.accumulate(back)


#: Made by the worker that needs them.
_POWERS: list[np.ndarray] = []


def _word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word; equal words have equal hashes."""
    if not _POWERS or len(_POWERS[0]) < len(buf) + 1:
        _POWERS[:] = _powers(max(_PIECE, len(buf)) + 1)
    forth, back = _POWERS
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * forth[: len(buf)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * back[starts]
    return hashes ^ (hashes >> np.uint64(29))


def _repeated(words: list[bytes], at: np.ndarray) -> int:
    """How many words lie in windows that occur twice or more; ``at``: windows whose hashes do."""
    windows = [tuple(words[i : i + WINDOW]) for i in at.tolist()]
    seen = Counter(windows)
    edge = np.zeros(len(words) + 1, np.int64)
    for i, window in zip(at.tolist(), windows, strict=True):
        if seen[window] > 1:
            edge[i] += 1
            edge[i + WINDOW] -= 1
    return int((np.cumsum(edge) > 0).sum())


def _repeat_words(split: list[list[bytes]], joined: list[bytes]) -> list[int]:
    """The repeated words of each text: windows are compared by hash, then word by word."""
    out = [0] * len(split)
    counts = np.array([len(w) for w in split])
    if not (counts > WINDOW).any():
        return out
    buf = np.frombuffer(b" ".join(x for x, n in zip(joined, counts, strict=True) if n) + b" ", np.uint8)
    ends = np.flatnonzero(buf == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    hashes = _word_hashes(buf, starts, ends)
    owner = np.repeat(np.arange(len(split)), counts)
    if len(hashes) <= WINDOW:
        return out
    last = len(hashes) - WINDOW + 1
    whole = owner[:last] == owner[WINDOW - 1 :]
    sums = owner[:last].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(WINDOW):
        sums = (sums + hashes[k : k + last]) * _MULT
    at = np.flatnonzero(whole)
    order = at[np.argsort(sums[at], kind="stable")]
    same = sums[order[1:]] == sums[order[:-1]]
    flagged = np.zeros(last, bool)
    flagged[order[1:][same]] = True
    flagged[order[:-1][same]] = True
    found = np.flatnonzero(flagged)
    first = np.concatenate([[0], np.cumsum(counts)])
    for doc in np.unique(owner[found]):
        own = found[np.searchsorted(found, first[doc]) : np.searchsorted(found, first[doc + 1])]
        out[doc] = _repeated(split[doc], own - first[doc])
    return out


def _repeat_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def _grams(joined: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The 4-gram that ends at each byte of the texts, each text padded by three spaces in front and ended by
    one, and the first and last of each text's own."""
    pad = b" " * (ORDER - 1)
    buf = np.frombuffer(pad + (b" " + pad).join(joined) + b" ", np.uint8).astype(np.uint32)
    grams = (buf[:-3] << 24) | (buf[1:-2] << 16) | (buf[2:-1] << 8) | buf[3:]
    lengths = np.array([len(x) + 1 for x in joined])
    starts = np.concatenate([[0], np.cumsum(lengths + ORDER - 1)[:-1]])
    return grams, starts, starts + lengths


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.diff(np.append(first, len(grams)))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _count_partition(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The 4-gram counts of one partition, by language and whether the texts are prose."""
    held: dict[tuple[str | None, bool], list] = {}
    for frame in frames:
        for lang, texts in frame.groupby("lang", dropna=False)["text"]:
            lang = lang if isinstance(lang, str) else None
            items = texts.tolist()
            for a, b in slices(items, _PIECE):
                kinds: dict[bool, list[bytes]] = {}
                for words in (t.split() for t in items[a:b]):
                    if words:
                        line = b" ".join(words)
                        symbols = len(line) - len(line.translate(None, SYMBOLS))
                        kinds.setdefault(PROSE * symbols <= len(words), []).append(line)
                for prose, joined in kinds.items():
                    grams, starts, ends = _grams(joined)
                    own = np.ones(len(grams), bool)
                    for k in range(ORDER - 1):
                        own[starts[1:] - 1 - k] = False
                    parts = held.setdefault((lang, prose), [])
                    parts.append(_counted(grams[own]))
                    if len(parts) > 16:
                        held[lang, prose] = [_merged(parts)]
    for (lang, prose), parts in held.items():
        keys, counts = _merged(parts)
        for i in range(0, len(keys), 100_000):
            own = slice(i, i + 100_000)
            yield pd.DataFrame({
                "lang": lang, "prose": prose, "gram": keys[own].astype(np.int64), "c": counts[own].astype(np.int64)
            })


def count_grams(docs: DataFrame) -> DataFrame:
    """How often each 4-gram occurs in each language: lang, gram, c. Over all its prose, or over all its texts where
    prose is less than half of them."""
    source = docs.select(column(docs, "lang").alias("lang"), text_bytes().alias("text"))
    counts = cut(
        source.mapInPandas(_count_partition, "lang string, prose boolean, gram long, c long")
        .groupBy("lang", "gram").agg(F.sum("c").alias("c"), F.sum(F.when(F.col("prose"), F.col("c"))).alias("own"))
    )
    shares = cut(counts.groupBy(F.col("lang").alias("_lang")).agg((2 * F.sum("own") >= F.sum("c")).alias("_prose")))
    return (
        counts.join(shares, F.col("lang").eqNullSafe(F.col("_lang")))
        .select("lang", "gram", F.when(F.col("_prose"), F.col("own")).otherwise(F.col("c")).alias("c"))
        .filter("c IS NOT NULL")
    )


def _of_contexts(grams: DataFrame, value: str) -> DataFrame:
    """For each context: what its n-grams add up to, and how often they were seen."""
    return grams.groupBy("lang", F.shiftright("gram", 8).alias("gram")).agg(
        F.sum(value).alias("total"), F.sum("raw").alias("raw"),
    )


def _of_lower(grams: DataFrame, order: int) -> DataFrame:
    """The next lower order: adjusted counts are the distinct bytes seen in front."""
    mask = (1 << (8 * (order - 1))) - 1
    return grams.groupBy("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(
        F.count("*").alias("c"), F.sum("raw").alias("raw"),
    )


def _discounts(n: dict[int, float]) -> np.ndarray:
    """Modified Kneser-Ney discounts of n-grams seen once, twice, and more often."""
    one, two, three, four = (float(n.get(k, 0)) for k in (1, 2, 3, 4))
    if not (one and two and three):
        return np.array([0.0, 0.5, 0.75, 0.75])
    y = one / (one + 2 * two)
    found = [1 - 2 * y * two / one, 2 - 3 * y * three / two, 3 - 4 * y * four / three]
    return np.array([0.0] + [min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1)])


class Model:
    """The model of one language, in sorted hash arrays."""

    def __init__(self, grams: dict, contexts: dict, counts: dict) -> None:
        """grams and contexts: by order, sorted codes and counts; counts: by order, n-grams by how often seen."""
        self.two_left = np.ones(1 << 16)
        self.two = np.zeros(1 << 16)
        one = np.full(256, 1 / 256)
        self.three = (np.zeros(0, np.uint32), np.zeros(0))
        self.left = (np.zeros(0, np.uint32), np.zeros(0))
        self.four = (np.zeros(0, np.uint32), np.zeros(0))
        for order in range(1, ORDER + 1):
            codes, seen = grams.get(order, (np.zeros(0, np.int64), np.zeros(0)))
            above, total = contexts.get(order, (np.zeros(0, np.int64), np.zeros(0)))
            cuts = _discounts(counts.get(order, {}))
            at, there = lookup(above, codes >> 8)
            codes, seen, at = codes[there], seen[there], at[there]
            share = (seen - cuts[np.minimum(seen, 3).astype(int)]) / total[at] if len(codes) else np.zeros(0)
            left = 1 - np.bincount(at, share, len(above)) if len(above) else np.zeros(0)
            if order == 1:
                one = one * (left[0] if len(left) else 1)
                one[codes] += share
            elif order == 2:
                given = np.ones(256)
                given[above] = left
                self.two = (given[:, None] * one[None, :]).ravel()
                self.two[codes] += share
            elif order == 3:
                self.two_left[above] = left
                self.three = _hashed(codes, share + self.two_left[codes >> 8] * self.two[codes & 0xFFFF])
            else:
                self.left = _hashed(above, left)
                self.four = _hashed(codes, share + self._backed_off(codes.astype(np.uint32)))
        self.four = (self.four[0], np.log(self.four[1]))

    @classmethod
    def restored(cls, arrays: dict) -> Model:
        """A model from the arrays of another."""
        model = cls.__new__(cls)
        vars(model).update(arrays)
        return model

    def _backed_off(self, grams: np.ndarray) -> np.ndarray:
        lower = grams & np.uint32(0xFFFFFF)
        chance = self.two_left[lower >> 8] * self.two[lower & np.uint32(0xFFFF)]
        at, there = lookup(self.three[0], lower * _ODD)
        chance[there] = self.three[1][at[there]]
        at, there = lookup(self.left[0], (grams >> 8) * _ODD)
        chance[there] *= self.left[1][at[there]]
        return chance

    def log_chance(self, grams: np.ndarray) -> np.ndarray:
        """The natural logarithm of each 4-gram's last byte's probability after the three before it."""
        at, there = lookup(self.four[0], grams * _ODD)
        out = self.four[1][at] if len(self.four[1]) else np.zeros(len(grams))
        rest = np.flatnonzero(~there)
        out[rest] = np.log(self._backed_off(grams[rest]))
        return out


def _hashed(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes by a one-to-one 32-bit hash, sorted, with their values."""
    keys = codes.astype(np.uint32) * _ODD
    order = np.argsort(keys)
    return keys[order], np.asarray(values, float)[order]


def _tables(docs: DataFrame, fewest: int) -> tuple[DataFrame, DataFrame]:
    """What models are made of: n-grams and contexts, and how many n-grams were seen how often."""
    grams = cut(count_grams(docs).withColumn("raw", F.col("c")))
    tables, spectra = [], []
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            grams = _of_lower(grams, order + 1)
        tag = [F.lit(order).alias("order"), "lang", "gram"]
        tables.append(grams.filter(F.col("raw") >= fewest).select(*tag, F.lit(False).alias("above"), "c"))
        tables.append(
            _of_contexts(grams, "c").filter(F.col("raw") >= fewest)
            .select(*tag, F.lit(True).alias("above"), F.col("total").alias("c"))
        )
        spectra.append(
            grams.filter("c <= 4").groupBy("lang", "c").agg(F.count("*").alias("n"))
            .select(F.lit(order).alias("order"), "lang", "c", "n")
        )
    return cut(reduce(DataFrame.unionAll, tables)), cut(reduce(DataFrame.unionAll, spectra))


def _ranges(found: DataFrame, held: int) -> list[Column]:
    """Conditions on ``lang`` that part all languages into ranges of up to ``held`` entries, or of one language."""
    sizes = found.filter("lang IS NOT NULL").groupBy("lang").count().collect()
    starts, full = [], found.filter("lang IS NULL").count()
    for r in sorted(sizes, key=lambda r: r["lang"].encode()):
        if full and full + r["count"] > held:
            starts.append(r["lang"])
            full = 0
        full += r["count"]
    out = []
    for low, high in zip([None, *starts], [*starts, None], strict=True):
        own = F.col("lang").isNull() if low is None else F.col("lang") >= low
        if low is None:
            own = F.lit(True) if high is None else own | (F.col("lang") < high)
        elif high is not None:
            own &= F.col("lang") < high
        out.append(own)
    return out


def fit(docs: DataFrame, fewest: int = FEWEST) -> dict[str | None, Model]:
    """A model of each language."""
    return _models(*_tables(docs, fewest))


def _models(tables: DataFrame, spectra: DataFrame) -> dict[str | None, Model]:
    found = tables.toPandas()
    counts: dict = {}
    for r in spectra.collect():
        counts.setdefault(r["lang"], {}).setdefault(r["order"], {})[r["c"]] = r["n"]
    models = {}
    for lang, own in found.groupby("lang", dropna=False):
        lang = lang if isinstance(lang, str) else None
        parts: tuple[dict, dict] = ({}, {})
        for (order, above), rows in own.groupby(["order", "above"]):
            rows = rows.sort_values("gram")
            parts[int(above)][order] = rows["gram"].to_numpy(np.int64), rows["c"].to_numpy(float)
        models[lang] = Model(*parts, counts.get(lang, {}))
    return models


def _features(texts: list[bytes], langs: list, models: dict[str | None, Model]) -> pd.DataFrame:
    """The counts and the log-perplexity of each text."""
    n = len(texts)
    out = np.zeros((n, 5), np.int64)
    loss = np.full(n, np.nan)
    empty = Model({}, {}, {})
    for a, b in slices(texts, _PIECE):
        split = [t.split() for t in texts[a:b]]
        joined = [b" ".join(w) for w in split]
        out[a:b, 4] = _repeat_words(split, joined)
        for i, (text, words, line) in enumerate(zip(texts[a:b], split, joined, strict=True), a):
            codes = np.frombuffer(line, np.uint8)
            out[i, 0] = len(words)
            out[i, 1] = int(((codes & 0xC0) != 0x80).sum()) - max(len(words) - 1, 0)
            out[i, 2] = int(_IS_SYMBOL[codes].sum())
            out[i, 3] = _repeat_lines(text)
        by_lang: dict = {}
        for i, line in enumerate(joined):
            if line:
                by_lang.setdefault(langs[a + i], []).append(i)
        for lang, rows in by_lang.items():
            grams, starts, ends = _grams([joined[i] for i in rows])
            chance = models.get(lang, empty).log_chance(grams)
            edges = np.column_stack([starts, ends]).ravel()
            sums = np.add.reduceat(np.append(chance, 0.0), edges)[::2]
            loss[[a + i for i in rows]] = -sums / (ends - starts)
    names = [x.split()[0] for x in FEATURES.split(", ")]
    frame = pd.DataFrame(out, columns=names[:5])
    frame[names[5]] = pd.Series(loss).astype(object).where(~np.isnan(loss), None)
    return frame


def describe(docs: DataFrame, models: dict[str | None, Model], name: str) -> DataFrame:
    """``docs`` with a struct of the counts and the log-perplexity."""
    sent = docs.sparkSession.sparkContext.broadcast({lang: vars(m) for lang, m in models.items()})

    @F.pandas_udf(FEATURES)
    def features(text: pd.Series, lang: pd.Series) -> pd.DataFrame:
        langs = [x if isinstance(x, str) else None for x in lang]
        return _features(text.tolist(), langs, {k: Model.restored(v) for k, v in sent.value.items()})

    return docs.withColumn(name, features(text_bytes(), F.col("lang")))


def bands(described: DataFrame, loss: str, width: float = WIDTH) -> DataFrame:
    """For each language the median log-perplexity and the half-width of the band around it."""
    middle = described.filter(F.col(loss).isNotNull()).groupBy(F.col("lang").alias("_lang")).agg(
        F.percentile_approx(loss, [0.25, 0.5, 0.75], 10_000).alias("_q"),
    )
    robust = (F.col("_q")[2] - F.col("_q")[0]) / 1.349
    return middle.select(
        "_lang", F.col("_q")[1].alias("_mid"), F.greatest(width * robust, F.lit(LEAST_WIDTH)).alias("_half"),
    )


def _described(docs: DataFrame, name: str, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the counts and the log-perplexity, less the columns ``without``, written range by range of languages."""
    tables, spectra = _tables(docs, FEWEST)
    parts = [
        cut(describe(docs.filter(own), _models(tables.filter(own), spectra.filter(own)), name).drop(*without))
        for own in _ranges(tables, HELD)
    ]
    return reduce(DataFrame.unionAll, parts)


def judge(docs: DataFrame, width: float = WIDTH) -> DataFrame:
    """``docs`` with a struct column ``quality`` (or that name with underscores, the last column): the counts,
    the log-perplexity, its band, base_failed and kept."""
    name = fresh_name(docs, "quality")
    return _judged(_described(docs, name), name, width)


def judged_rows(docs: DataFrame, width: float = WIDTH) -> DataFrame:
    """As ``judge``, without the texts: they are not written on the way."""
    name = fresh_name(docs, "quality")
    return _judged(_described(docs, name, ("text",)), name, width)


def _judged(described: DataFrame, name: str, width: float) -> DataFrame:
    loss, words = F.col(f"{name}.log_perplexity"), F.col(f"{name}.n_words")
    lang, band = fresh_name(described, "band_lang"), fresh_name(described, "band")
    spread = F.col(f"{band}._half") * (1 + F.lit(SHORT) / F.greatest(words, F.lit(1)))
    low, high = F.col(f"{band}._mid") - spread, F.col(f"{band}._mid") + spread
    failed = (words < 10) | (100 * F.col(f"{name}.n_repeat_words") > 20 * words)
    inside = F.coalesce(loss.between(low, high), F.lit(True))
    # Written first, so that Spark knows the table's size: it is broadcast if small, else joined by language.
    limits = cut(bands(described.select("lang", loss.alias("loss")), "loss", width))
    limits = limits.select(F.col("_lang").alias(lang), F.struct("_mid", "_half").alias(band))
    own = F.struct(
        f"{name}.*", F.exp(low).alias("lower"), F.exp(high).alias("upper"),
        failed.alias("base_failed"), (~failed & inside).alias("kept"),
    )
    return (
        described.join(limits, F.col("lang").eqNullSafe(F.col(lang)), "left")
        .select(*[column(described, c) for c in described.columns if c != name], own.alias(name))
    )


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, columns as they came."""
    judged = judge(docs)
    return judged.filter(F.col(f"{judged.columns[-1]}.kept")).select(*[column(judged, c) for c in docs.columns])
