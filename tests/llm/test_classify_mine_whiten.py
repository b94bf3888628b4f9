"""The classifier, phrase mining and whitening against brute force, held-out accuracy, and odd inputs."""

from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from driftgate.llm import binpack, classifier, mixing, phrases, pii, quality, repeats, secrets, simhash, tokens, whitening
from driftgate.llm.queries import KEY, ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
BIG = 2**53 + 1


# -- phrases -------------------------------------------------------------------------


def pieces_of(text):
    plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in ".,;:!?\n\x0b\x0c\r":
        plain = plain.replace(c, "\n")
    return [[w for w in p.replace("\t", " ").split(" ") if w] for p in plain.split("\n")]


def mined(rows, least, longest=5, most=2000, share=100):
    """Brute force, straight from the definition."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    own = counts.setdefault(lang, Counter())
                    own[tuple(words[i : i + k])] += 1
    out = []
    for lang, own in counts.items():
        live = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in live.items():
            inside = any(
                len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in live.items()
            )
            if inside:
                continue
            score, _, left, right = min(
                (1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), left, right, totals[lang]))
        for rank, (score, a, p, left, right, n) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


WORDS = ["a", "b", "ß", "A", "über", "x\x00y", "漢", "\xa0", "c", "c"]


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        words = rng.choice(WORDS, rng.integers(0, 40))
        ends = rng.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\x0c "], len(words))
        rows.append(("".join(w + e for w, e in zip(words, ends, strict=True)), rng.choice(["en", "de"])))
    phrase = "over and over again it goes. "
    return [*rows, (phrase * 7, "en"), (phrase.upper(), None), (None, "en"), ("", "fr"), (" .\n", "fr"), ("a a a a a a", None)]


@pytest.mark.parametrize("shard_words", [1, 50, 1 << 22])
@pytest.mark.parametrize(("least", "longest", "most", "share"), [(4, 5, 2000, 100), (3, 3, 7, 60)])
def test_phrases_by_brute_force(spark, shard_words, least, longest, most, share):
    rows = corpus(least)
    docs = spark.createDataFrame([(t, l, "x") for t, l in rows], "text string, lang string, phrase string").repartition(3)
    found = phrases.mine(docs, least, longest, most, share, shard_words)
    assert sorted(map(tuple, found.collect())) == mined(rows, least, longest, most, share)


def test_phrases_of_long_texts_and_pieces(spark, monkeypatch):
    text = "one two three " * 3000 + "four. " + "five six " * 3000
    rows = [(text, "en"), (text[:30_000], "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    found = phrases.mine(docs, 100, shard_words=500)
    assert sorted(map(tuple, found.collect())) == mined(rows, 100)


def test_scores_beyond_64_bits(spark):
    """The arithmetic alone, on counts that no small corpus has."""
    a, n, left, right = 900_000_000_000, 8_000_000_000_000, 900_000_000_001, 1_000_000_000_007
    row = spark.sql(f"SELECT {a}L AS a, {n}L AS n, {left}L AS l, {right}L AS r").selectExpr(
        "(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0))) AS s"
    ).first()
    assert row["s"] == 1000 * a * n // (left * right)


def test_phrases_of_nothing(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert phrases.mine(docs).count() == 0
    assert phrases.mine(spark.createDataFrame([(None, None), ("", None)], "text string, lang string")).count() == 0


def test_phrases_in_sql(spark):
    found = QUERIES["op12_phrases"](spark, SMALL)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    wanted = db.sql(ORACLES["op12_phrases"])
    assert sorted(map(tuple, found.select(*wanted.columns).collect())) == sorted(wanted.fetchall())
    assert found.count() > 0


# -- whitening -----------------------------------------------------------------------


def vectors(spark, x, extra=()):
    rows = [(i, [float(v) for v in row], "w") for i, row in enumerate(x)]
    schema = "vec_id long, embedding array<double>, whitened string"
    return spark.createDataFrame([*rows, *extra], schema).repartition(5)


def check_whitening(found, x, count=8):
    """Against the eigenvectors of the whole covariance, by numpy."""
    whole = np.floor(1024 * x).astype(np.int64) + 100_000
    n, sums = len(whole), whole.sum(axis=0)
    centred = whole - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    rows = found.toPandas()
    got = rows.pivot(index="vec_id", columns="component", values="whitened").loc[range(n)].to_numpy()
    assert got.shape == (n, count) and (rows["n"] == n).all()
    wanted = centred @ axes / np.sqrt(values)
    wanted *= np.sign((wanted * got).sum(axis=0))
    gaps = np.abs(np.diff(values)).min() / values[0] if count > 1 else 1
    np.testing.assert_allclose(got, wanted, atol=1e-11 / min(gaps, 1) + 1e-10)
    trace = (centred**2).sum() / n
    explained = rows.groupby("component")["explained"].first().to_numpy()
    np.testing.assert_allclose(explained, values / trace, rtol=1e-10)
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"].iloc[0] < 1e-9
    spread = [int(v) for v in ((n * whole.astype(object) - sums.astype(object)) ** 2).sum(axis=1)]
    assert [int(v) for v in rows[rows["component"] == 1].set_index("vec_id")["deviation"].loc[range(n)]] == spread


@pytest.mark.parametrize(("n", "d"), [(300, 64), (500, 100), (40, 5), (1000, 33)])
def test_whitening_by_numpy(spark, n, d):
    x = np.random.default_rng(n).standard_normal((n, d)) * np.linspace(1, 2, d)
    check_whitening(whitening.whiten(vectors(spark, x)), x, min(d, 8))


def test_rows_that_take_no_part_and_repeats(spark):
    x = np.random.default_rng(1).standard_normal((200, 12)) * np.arange(1, 13)
    odd = [
        (900, None, "w"), (901, [], "w"), (902, [1.0] * 11 + [None], "w"), (903, [float("nan")] * 12, "w"),
        (904, [float("inf")] * 12, "w"), (905, [1.0] * 13, "w"), (906, [1e300] * 12, "w"),
    ]
    check_whitening(whitening.whiten(vectors(spark, x, odd)), x)
    twice = whitening.whiten(vectors(spark, np.vstack([x, x]), [(None, [0.5] * 12, "w")]))
    assert twice.count() == 401 * 8 and twice.filter("vec_id IS NULL").count() == 8


def test_fewer_components_than_asked_for(spark):
    flat = np.random.default_rng(2).standard_normal((100, 3)) @ np.random.default_rng(3).integers(-9, 9, (3, 20)) * 64
    flat = np.round(flat) / 16  # whole numbers once scaled, so that the rank is not blurred
    rank = np.linalg.matrix_rank(flat - flat.mean(axis=0))
    found = whitening.whiten(vectors(spark, flat))
    assert found.agg(F.max("component")).head()[0] == min(rank, 8)
    assert whitening.whiten(vectors(spark, np.ones((5, 4)))).count() == 0
    assert whitening.whiten(vectors(spark, np.ones((1, 4)))).count() == 0
    none = whitening.whiten(vectors(spark, np.zeros((0, 4))))
    assert none.count() == 0 and none.columns[:3] == ["vec_id", "component", "n"]


def test_large_entries_stay_exact(spark):
    x = np.random.default_rng(4).standard_normal((50, 6)) * 2.0**40
    x = np.clip(np.round(x), -(2.0**41), 2.0**41)
    check_whitening(whitening.whiten(vectors(spark, x)), x, 6)


@pytest.mark.parametrize("seed", range(4))
def test_components_without_spark(seed):
    """The iteration alone, on spectra with close, equal and far eigenvalues."""
    rng = np.random.default_rng(seed)
    d = 120
    values = [np.linspace(1, 2, d), np.geomspace(1e-8, 1, d), np.r_[np.ones(d - 20), np.linspace(1.05, 3, 20)],
              np.r_[np.linspace(0.5, 1, d - 4), 5, 5, 5, 9]][seed]
    axes = np.linalg.qr(rng.standard_normal((d, d)))[0]
    whole = axes * values @ axes.T
    got, found = whitening.leading(lambda q: whole @ q, d)
    np.testing.assert_allclose(got, np.sort(values)[::-1][:8], rtol=1e-11)
    assert np.abs(whole @ found - found * got).max() < 1e-11 * values.max()
    np.testing.assert_allclose(found.T @ found, np.eye(8), atol=1e-12)


def test_reruns_agree(spark):
    x = vectors(spark, np.random.default_rng(5).standard_normal((300, 40)))
    one, two = (sorted(whitening.whiten(x).collect()) for _ in range(2))
    assert one == two


# -- the classifier ------------------------------------------------------------------


def test_features_by_hand():
    texts = ["Ab ab Ab\tx1", "", " ", "ab"]
    at, weight, starts = classifier.features([t.encode() for t in texts], 16)
    sizes = np.diff(starts)
    # Words Ab, ab, x1 and three pairs; shapes Aa, a, a0 and their pairs: Aa-a, a-Aa, Aa-a0.
    assert sizes.tolist() == [12, 0, 0, 2]
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        assert b == a or abs((weight[a:b] ** 2).sum() - 1) < 1e-12
    alone = classifier.features([b"ab"], 16)
    assert at[starts[3] :].tolist() == alone[0].tolist()
    assert set(at[starts[3] :].tolist()) < set(at[: starts[1]].tolist())


def test_updates_by_the_textbook():
    """FTRL-proximal, coordinate by coordinate, in plain Python."""
    rng = np.random.default_rng(0)
    leader, z, n = classifier.Leader(4), [0.0] * 17, [0.0] * 17
    a, b, l1, l2 = classifier.ALPHA, classifier.BETA, classifier.L1, classifier.L2

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((b + n[i] ** 0.5) / a + l2)

    for _ in range(200):
        at = np.append(np.sort(rng.choice(16, 4, replace=False)), 16)
        x, y = np.append(rng.random(4), 1.0), float(rng.integers(2))
        leader.learn(at, x, y)
        w = [weight(i) for i in at]
        p = 1 / (1 + np.exp(-sum(wi * xi for wi, xi in zip(w, x, strict=True))))
        for i, wi, xi in zip(at, w, x, strict=True):
            g = (p - y) * xi
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / a * wi
            n[i] += g * g
    np.testing.assert_allclose(leader.weights(slice(None)), [weight(i) for i in range(17)], rtol=1e-9, atol=1e-12)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    scored = QUERIES["op11_classifier"](spark, sf)
    rows = scored.join(labels, "doc_id").collect()
    assert scored.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in scored.collect():
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"]]
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    assert min(len(good), len(bad)) >= 10
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([s >= 0.3 for s in good]) == 1 and np.mean([s < 0.3 for s in bad]) > 0.6


def test_labels_that_are_not_used(spark):
    rows = [(i, "good words here" if i % 2 else "### $$$ %%%", "q") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = [(i, i % 2) for i in range(40)]
    base = spark.createDataFrame(labels, "doc_id long, quality int")
    held = [i for i in range(40) if crc32(str(i).encode()) % 5 == 0]
    # Labels of the other fold, without an id, of other values and of unknown documents change nothing.
    more = [(i, 1 - q if i in held else q) for i, q in labels] + [(None, 1), (1, 7), (2, None), (999, 0)]
    noisy = spark.createDataFrame(more, "doc_id long, quality int")
    one, two = (
        {r["doc_id"]: r["score"] for r in classifier.judge(docs, x).collect()} for x in (base, noisy)
    )
    assert one == two and held and all((one[i] >= 0.3) == bool(i % 2) for i in one)


def test_odd_documents(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "other text"), (2, None), (3, ""), (None, "a b"), (BIG, "x " * 200_000), (5, "y" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (BIG, 1), (5, 0)], "doc_id long, quality int")
    found = classifier.judge(docs, labels).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    by = {r["doc_id"]: r for r in found}
    assert by[2]["score"] == by[3]["score"] and by[None]["held_out"] is False
    none = classifier.judge(docs, labels.filter("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert classifier.judge(docs.filter("false"), labels).count() == 0
    assert classifier.labelled(docs, labels, 2).count() <= 2


# -- ids beyond 2**53 ----------------------------------------------------------------


def test_whole_ids_beside_nulls(spark):
    text = "a text of some words that says nothing at all, at least twelve of them"
    docs = spark.createDataFrame(
        [(BIG, text, "en", "s", 70), (None, "another " + text, "en", "s", 78)],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).coalesce(1)
    wanted = Counter([BIG, None])

    def ids(df, name="doc_id"):
        return Counter(r[name] for r in df.select(name).distinct().collect())

    assert ids(binpack.pack(docs)) == wanted
    packed = tokens.pack_tokens(docs, tokens.read_ranks(spark)).collect()
    assert Counter(d for r in packed for d in r["doc_ids"]) == wanted
    for found in (
        secrets.scan(docs), pii.pseudonymise(docs, KEY), quality.judge(docs), simhash.near_duplicates(docs),
        repeats.remove_repeats(docs), mixing.taken(docs),
    ):
        assert ids(found) == wanted
