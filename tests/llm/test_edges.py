"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from driftgate.llm import binpack, mixing, neighbours, pii, quality, repeats, secrets, simhash, tokens, urls
from driftgate.llm.queries import KEY, RULES

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, quality string, fp string, pii string, "
    "`a.b` int, k1 int, Text_ string"
)
LONG = "word " * 30_000 + "end"


def document(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text) if text is not None else None, "q", "f", "p", 1, 2, "t")


ROWS = [
    document(1, "the first of many words that make up a plain text of some length, twelve"),
    document(1, "the first of many words that make up a plain text of some length, twelve"),
    document(2, None),
    document(3, ""),
    document(4, " \t\n "),
    document(5, "one"),
    document(6, LONG, source=None),
    document(7, "x" * 100_000, lang=None, source=None),
    document(None, "a text whose document has no id at all but still some words in it", source="r"),
    document(None, None, lang=None, source=None),
    document(8, "Grüße \x0b\x0c\r und \x85 \xa0 Wörter 漢字 🙂 mail me: a.b@example.com or 4111 1111 1111 1111", lang="de"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


def test_quality(docs, none):
    rows = quality.judge(docs).select("doc_id", "quality_.*", "quality", "`a.b`").collect()
    assert ids(rows) == ids(docs.collect())
    by = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert [by[i]["n_words"] for i in (2, 3, 4, 5, 6, 7)] == [0, 0, 0, 1, 30_001, 1]
    assert by[6]["n_repeat_words"] == 30_000 and by[6]["base_failed"]
    assert by[2]["log_perplexity"] is None and not by[2]["kept"]
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns and all(r["text"] for r in kept.collect())
    assert quality.judge(none).count() == quality.filter_documents(none).count() == 0


def test_simhash(docs, none):
    rows = simhash.near_duplicates(docs).collect()
    assert ids(rows) == ids(docs.collect())
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in zero} == {2, 3, 4, None} and {r["component_id"] for r in zero} == {2}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert ids(kept.collect()) == Counter([1, 2, 5, 6, 7, 8, None])
    assert simhash.near_duplicates(none).count() == simhash.keep_first(none).count() == 0


def test_pii(docs, none):
    out = pii.pseudonymise(docs, KEY)
    assert out.columns == [*docs.columns, "pii_"]
    rows = out.collect()
    assert ids(rows) == ids(docs.collect())
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        if r["doc_id"] not in (8, None):
            assert r["text"] == before[r["doc_id"]]
    (eight,) = [r for r in rows if r["doc_id"] == 8]
    assert eight["pii_"]["n_email"] == eight["pii_"]["n_card"] == 1 and "4111 1111" not in eight["text"]
    assert len(eight["text"]) == len(before[8])
    assert pii.pseudonymise(none, KEY).count() == 0


def test_mixing(docs, none):
    rows = mixing.taken(docs).collect()
    assert ids(rows) == ids(docs.collect())
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r["doc_id"]] += len(r["text"].encode().split())
        assert r["n_chars"] == len(r["text"])
    want = Counter()
    for r in rows:
        want[r["doc_id"]] += r["taken"]
    assert words == +want
    assert mixing.taken(none).count() == mixing.mixed_documents(none).count() == 0


def test_packing(docs, none):
    rows = binpack.pack(docs).collect()
    pieces = {}
    for r in sorted(rows, key=lambda r: r["piece"]):
        pieces[r["doc_id"]] = pieces.get(r["doc_id"], "") + r["text"]
    assert pieces[6] == LONG and 3 not in pieces and 2 not in pieces
    assert pieces[1] == 2 * ROWS[0][1]
    used = Counter()
    for r in rows:
        used[r["group"], r["bin"], r["length"]] += r["n_words"]
    assert all(n <= length for (_, _, length), n in used.items())
    assert binpack.pack(none).count() == 0


def test_tokens(spark, docs, none):
    ranks = tokens.read_ranks(spark)
    rows = tokens.pack_tokens(docs, ranks).collect()
    assert all(len(r["ids"]) == 2 * tokens.WIDTH and r["cu_lengths"][-1] == r["n_ids"] for r in rows)
    assert tokens.pack_tokens(none, ranks).count() == 0


def test_repeats(docs, none):
    rows = repeats.remove_repeats(docs).select("doc_id", "repeats.*").collect()
    assert ids(rows) == ids(docs.collect())
    assert all(r["n_removed"] == 0 for r in rows)
    assert repeats.remove_repeats(none).count() == 0


def test_secrets(docs, none):
    rows = secrets.digest(secrets.scan(docs)).collect()
    assert ids(rows) == ids(docs.collect())
    assert secrets.scan(none).count() == 0


def test_columns_named_as_inside(docs):
    names = ("_lang", "_mid", "_half", "_at", "_class", "_doc", "_a", "_b", "_mark", "winner", "band", "spans", "row", "base")
    wide = docs.withColumns({c: F.lit(f"own {c}") for c in names})
    for out in (
        quality.filter_documents(wide), simhash.keep_first(wide), repeats.remove_repeats(wide), secrets.scan(wide),
        pii.pseudonymise(wide, KEY), mixing.mixed_documents(wide),
    ):
        rows = out.select(*names).collect()
        assert rows and all(r[c] == f"own {c}" for r in rows for c in names)


def test_urls(spark):
    pages = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.Example.COM"), (5, "HTTP://A.Example.COM"),
        (6, "http://x.com/"), (7, "http://com/a?b#c"), (8, "http://xcom/"), (9, "ftp://www.example.com/en/1://2"),
        (10, "http://a.net/es/" + "p/" * 2_000), (None, "http://a.net/es"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumn("_host", F.lit("clash"))
    got = {r["page_id"]: r for r in urls.judge(frame, RULES).collect()}
    assert urls.judge(frame, RULES).count() == len(pages)
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("", "", None, "allow")
    assert (got[5]["host"], got[5]["path"], got[5]["rule"]) == ("a.example.com", "", None)
    assert [got[i]["rule"] for i in (6, 7, 8, 9, 10)] == ["com/", "com/", None, "www.example.com/en/", "net/es/"]
    assert got[10]["verdict"] == "block" and got[None]["rule"] is None and got[9]["path"] == "/en/1://2"
    assert urls.judge(frame.limit(0), RULES).count() == 0


def test_neighbours(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]),
        (5, [inf, 1.0]), (6, [nan, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, []), (10, [3.0, 4.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit(1))
    got = [tuple(r) for r in neighbours.nearest(frame).orderBy("query_id", "rank").collect()]
    assert got == [
        (0, 1, 10, 3.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0), (0, 4, 20, 0.0),
        (20, 1, 10, 4.0), (20, 2, 0, 0.0), (20, 3, 1, 0.0), (20, 4, 2, 0.0),
    ]
    assert neighbours.nearest(frame.limit(0)).count() == 0


def test_pipeline_stages(spark, docs, none):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, none, "").count() == 0
