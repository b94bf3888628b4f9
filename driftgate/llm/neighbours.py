"""Approximate nearest neighbours by inner product: balanced posting lists.

Centroids are fitted on a sample of at most ``SAMPLE`` vectors, by k-means that charges crowded clusters; every
vector is then indexed. A vector near a boundary goes into several lists: all whose centroids are at most ``REPLICATE`` times
as far as the nearest one, ``COPIES`` at most. A query finds its lists by walking a graph of near centroids in memory,
and takes those within a ratio of the nearest centroid's distance. The ratio is fitted on the sample, such that
``RECALL`` of its true neighbours lie in lists that are taken. Near lists form cells of some thousand vectors, in which a
query scores the vectors of its own lists and keeps one short list of the best; cells with more vectors or queries than
a group holds are dealt out in parts. Candidates are scored exactly, component by component in double precision.

Inner products become distances by one more component, which brings every vector to the length of the longest.

Defined results: vectors that are null, zero, hold null or non-finite components, or have another length than most take
no part, nor do rows without vec_id; rows repeated as a whole count once, and rows of one vec_id are no candidates for
each other's queries; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

SAMPLE = 20_000
PER_LIST = 64
COPIES = 3
REPLICATE = 1.03
RECALL = 0.95
DEGREE = 16
#: Vectors and queries that meet in one group, about.
PART = 8_192
QUERIES = 2_048
SEED = 7


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the vectors that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite & some)
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    return rows.filter(F.size("embedding") == (sizes["d"] if sizes else -1))


def lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """One more component, which brings each vector to the length of the longest."""
    rest = np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))
    return np.column_stack([x, rest])


def as_queries(x: np.ndarray, longest: float) -> np.ndarray:
    """Queries at that length too, which leaves their order of inner products as it is."""
    return np.column_stack([x * (longest / np.linalg.norm(x, axis=1))[:, None], np.zeros(len(x))])


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1)[None, :] - 2 * x @ y.T, 0))


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means whose clusters grow dearer as they fill."""
    rng = np.random.default_rng(SEED)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    price = np.zeros(k)
    for _ in range(rounds):
        squares = _distances(x, centres) ** 2
        own = (squares + price).argmin(axis=1)
        sizes = np.bincount(own, minlength=k)
        price += 0.1 * squares.min(axis=1).mean() * (sizes - sizes.mean()) / max(sizes.mean(), 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        full = sizes > 0
        centres[full] = sums[full] / sizes[full, None]
    return centres


class Graph:
    """Centroids, each linked to its nearest ones and to the next by number, so that every one can be reached."""

    def __init__(self, centres: np.ndarray) -> None:
        self.centres = centres
        gaps = _distances(centres, centres)
        np.fill_diagonal(gaps, np.inf)
        near = np.argsort(gaps, axis=1, kind="stable")[:, : max(1, min(DEGREE, len(centres) - 1))]
        ring = (np.arange(len(centres)) + 1) % len(centres)
        self.links = np.column_stack([near, ring])

    def search(self, x: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """For each of ``x`` the centroids within ``ratio`` of the nearest distance, nearest first: centroids and
        distances, -1 and infinity where there are no more. Walks on from the nearest not yet left behind."""
        n, k = len(x), len(self.centres)
        known = np.full((n, k), np.inf)
        left = np.zeros((n, k), bool)
        rows = np.arange(n)
        for start in np.unique(np.linspace(0, k - 1, min(k, 4)).astype(int)):
            known[:, start] = np.linalg.norm(x - self.centres[start], axis=1)
        active = rows
        while len(active):
            open_ = np.where(left[active], np.inf, known[active])
            best = open_.argmin(axis=1)
            reach = open_[np.arange(len(active)), best]
            # A quarter beyond the ratio, as the way may lead over a somewhat farther one.
            go = reach <= known[active].min(axis=1) * max(ratio, 1.0) * 1.25
            active, best = active[go & np.isfinite(reach)], best[go & np.isfinite(reach)]
            left[active, best] = True
            for link in self.links[best].T:
                new = ~np.isfinite(known[active, link])
                at = active[new]
                known[at, link[new]] = np.linalg.norm(x[at] - self.centres[link[new]], axis=1)
        order = np.argsort(known, axis=1, kind="stable")
        sorted_ = np.take_along_axis(known, order, axis=1)
        inside = sorted_ <= sorted_[:, :1] * ratio
        return np.where(inside, order, -1), np.where(inside, sorted_, np.inf)


def lists_of(graph: Graph, x: np.ndarray) -> np.ndarray:
    """The lists of each vector, the nearest first, -1 where there are no more."""
    return graph.search(x, REPLICATE)[0][:, :COPIES]


def fitted_ratio(graph: Graph, sample: np.ndarray, longest: float, top: int) -> float:
    """The least ratio that reaches ``RECALL`` on the sample."""
    queries = np.random.default_rng(SEED).choice(len(sample), min(256, len(sample)), replace=False)
    lists = lists_of(graph, lengthened(sample, longest))
    q = as_queries(sample[queries], longest)
    near = _distances(q, graph.centres)
    scores = sample[queries] @ sample.T
    scores[np.arange(len(queries)), queries] = -np.inf
    top = min(top, len(sample) - 1)
    if top < 1:
        return 1.0
    hits = np.argpartition(-scores, top - 1, axis=1)[:, :top]
    reach = np.full(hits.shape, np.inf)
    for c in range(lists.shape[1]):
        own = lists[hits, c]
        way = np.take_along_axis(near, np.maximum(own, 0), axis=1)
        reach = np.minimum(reach, np.where(own >= 0, way, np.inf))
    return float(np.quantile(reach / near.min(axis=1)[:, None], RECALL)) + 1e-9


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The inner products of the rows of ``q`` and ``x``, added up in the order of the components."""
    out = np.zeros(len(x))
    for d in range(x.shape[1]):
        out = out + q[:, d] * x[:, d]
    return out


def cells_of(centres: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """The cell of each list: near lists share one of about ``most`` postings, halved along the widest direction."""
    cells = np.zeros(len(centres), int)
    open_, n = [np.arange(len(centres))], 0
    while open_:
        own = open_.pop()
        if len(own) < 2 or sizes[own].sum() <= most:
            cells[own] = n
            n += 1
            continue
        away = centres[own] - centres[own].mean(axis=0)
        own = own[np.argsort(away @ np.linalg.svd(away, full_matrices=False)[2][0], kind="stable")]
        half = np.searchsorted(np.cumsum(sizes[own]), sizes[own].sum() / 2)
        half = min(max(half, 1), len(own) - 1)
        open_ += [own[half:], own[:half]]
    return cells


def padded(lists: pd.Series) -> np.ndarray:
    """Short lists of numbers as one array, -1 where there are no more."""
    out = np.full((len(lists), max(map(len, lists))), -1)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def best(queries: pd.DataFrame, vectors: pd.DataFrame, top: int, k: int) -> pd.DataFrame:
    """For each query the ``top`` nearest, exactly, of those ``vectors`` that share one of its ``k`` lists."""
    if vectors["vec_id"].duplicated().any():  # rows repeated as a whole would push others out
        whole = vectors["embedding"].map(lambda x: x.tobytes())
        vectors = vectors[~pd.DataFrame({"v": vectors["vec_id"], "x": whole}).duplicated()]
    ids, names = vectors["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    x, q = (np.stack(f["embedding"].to_numpy()).astype(float) for f in (vectors, queries))
    taken = np.zeros((len(q), k + 1), bool)  # the last stands for no list
    for i, own in enumerate(queries["lists"]):
        taken[i, own] = True
    lists = padded(vectors["lists"])
    slack = 2e-12 * np.linalg.norm(x, axis=1).max()
    found = []
    step = max(1, 2_000_000 // len(x))
    for i in range(0, len(q), step):
        part, own, mine = q[i : i + step], names[i : i + step], taken[i : i + step]
        rough = part @ x.T
        rough[~np.logical_or.reduce([mine[:, c] for c in lists.T])] = -np.inf
        rough[own[:, None] == ids[None, :]] = -np.inf
        last = min(top, len(x)) - 1
        least = -np.partition(-rough, last, axis=1)[:, last]
        row, col = np.nonzero((rough >= (least - slack * np.linalg.norm(part, axis=1))[:, None]) & np.isfinite(rough))
        exact = scores(part[row], x[col])
        order = np.lexsort((ids[col], -exact, row))
        row, col, exact = row[order], col[order], exact[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < top
        row, col, exact = row[keep], col[keep], exact[keep]
        some, start = np.unique(row, return_index=True)
        found.append(pd.DataFrame({
            "query_id": own[some], "ids": np.split(ids[col], start[1:]) if len(some) else [],
            "scores": np.split(exact, start[1:]) if len(some) else [],
        }))
    return pd.concat(found)


def nearest(vectors: DataFrame, every: int = 20, top: int = 20, sample: int = SAMPLE) -> DataFrame:
    """For each vector whose vec_id is divisible by ``every`` its ``top`` nearest others: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = cut(usable(vectors))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    count, longest = rows.agg(F.count("*"), F.max(norm)).head()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not count:
        return empty
    drawn = rows.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(sample).toPandas()
    fit = np.array(drawn["embedding"].tolist(), float)
    k = int(max(1, min(len(fit) // PER_LIST, round(count**0.5))))
    graph = Graph(balanced_centroids(lengthened(fit, longest), k))
    ratio = fitted_ratio(graph, fit, longest, top)
    sent = spark.sparkContext.broadcast((graph.centres, graph.links, longest, ratio))

    def restored() -> tuple[Graph, float, float]:
        own = Graph.__new__(Graph)
        own.centres, own.links, length, reach = sent.value
        return own, length, reach

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, length, _ = restored()
        for frame in frames:
            if len(frame):
                x = np.array(frame["embedding"].tolist(), float)
                frame["lists"] = [[v for v in r if v >= 0] for r in lists_of(own, lengthened(x, length)).tolist()]
                yield frame

    indexed = cut(rows.mapInPandas(assign, "vec_id long, embedding array<double>, lists array<int>"))
    first = dict(indexed.groupBy(F.col("lists")[0].alias("l")).count().collect())
    filled = dict(indexed.select(F.explode("lists").alias("l")).groupBy("l").count().collect())
    members = np.array([first.get(i, 0) for i in range(k)])
    cells = cells_of(graph.centres, np.array([filled.get(i, 0) for i in range(k)]), PART)

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, length, reach = restored()
        for frame in frames:
            for i in range(0, len(frame), 512):
                part = frame.iloc[i : i + 512].copy()
                q = as_queries(np.array(part["embedding"].tolist(), float), length)
                found, _ = own.search(q, reach)
                lists = []
                for row, x in zip(found.tolist(), q, strict=True):
                    row = [v for v in row if v >= 0]
                    if members[row].sum() <= top:  # too few to choose from: the next lists, until there are enough
                        away = np.argsort(np.linalg.norm(own.centres - x, axis=1), kind="stable")
                        enough = np.searchsorted(np.cumsum(members[away]), top + 1)
                        row = sorted({*row, *away[: enough + 1].tolist()})
                    lists.append(row)
                part["lists"] = lists
                yield part

    def in_cells(listed: DataFrame) -> DataFrame:
        of = F.array(*[F.lit(int(c)) for c in cells])  # one per list, and those are bounded by the sample
        return listed.withColumn("cell", F.explode(F.array_distinct(F.transform("lists", lambda v: F.get(of, v)))))

    queries = indexed.filter(F.col("vec_id") % every == 0).select("vec_id", "embedding")
    probes = in_cells(cut(queries.mapInPandas(probe, "vec_id long, embedding array<double>, lists array<int>")))
    postings = in_cells(indexed)
    # Every part of a cell's queries meets every part of its vectors; both counts have a row per cell.
    asked, held = (dict(f.groupBy("cell").count().collect()) for f in (probes, postings))
    parts = [(c, -(-asked[c] // QUERIES), -(-held[c] // PART)) for c in sorted(asked) if c in held]
    dealt = F.broadcast(spark.createDataFrame(parts, "cell int, asking int, holding int"))
    blocks = int(sum(p[2] for p in parts) ** 0.5) + 1

    def part(of: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), of).cast("int")

    def each(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    left = probes.join(dealt, "cell").withColumn("a", part("asking")).withColumn("h", each("holding"))
    right = postings.join(dealt, "cell").withColumn("h", part("holding")).withColumn("a", each("asking"))
    key, kept = ["cell", "a", "h"], ["vec_id", "embedding", "lists"]

    def score(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "block": [], "ids": [], "scores": []})
        return best(left, right, top, k).assign(block=(key[0] + key[2]) % blocks)

    found = left.select(*key, *kept).groupBy(*key).cogroup(right.select(*key, *kept).groupBy(*key)).applyInPandas(
        score, "query_id long, block int, ids array<long>, scores array<double>"
    )
    # Negated scores sort with the ids: nearest first, ties to the smaller. Twice, so that no group holds all parts' lists.
    pairs = F.transform(F.arrays_zip("ids", "scores"), lambda p: F.struct((-p["scores"]).alias("s"), p["ids"].alias("v")))
    ranked = found.select("query_id", "block", pairs.alias("near"))
    for keys in (["query_id", "block"], ["query_id"]):
        near = F.sort_array(F.array_distinct(F.flatten(F.collect_list("near"))))
        ranked = ranked.groupBy(*keys).agg(F.slice(near, 1, top).alias("near"))
    return ranked.select("query_id", F.posexplode("near").alias("at", "n")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("n.v").alias("vec_id"), (-F.col("n.s")).alias("score"),
    )
