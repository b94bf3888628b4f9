"""The registered queries of this package, each applying one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binpack, classifier, mixing, neighbours, phrases, pii, quality, repeats, secrets, simhash, tokens, urls, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def in_sql(sql: str) -> Callable[[Callable], Callable]:
    """The SQL that gives the same rows as the query below."""

    def register(fn: Callable) -> Callable:
        ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The queries' pseudonyms are for test data; a real key comes from a secret store.
KEY = b"key of the registered queries"


@query
def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, packed into rows of 2,048."""
    return tokens.pack_tokens(table(spark, sf_dir, "documents"), tokens.read_ranks(spark))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: 3-word shingles, 2 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a mix with weights 3, 1, 2 in turn takes of each document."""
    found = mixing.taken(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for its personal data, and what was found."""
    found = pii.pseudonymise(table(spark, sf_dir, "documents"), KEY)
    return found.select("doc_id", "text", "lang", "source", "n_chars", "pii.*")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and perplexity bands, one row per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judged_rows(docs).select("doc_id", "quality.*")


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 512 to 8,192 words."""
    return binpack.pack(table(spark, sf_dir, "documents"))


@query
def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without passages of 50 bytes that a smaller doc_id has too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = repeats.remove_repeats(docs)
    return found.select("doc_id", *[f"repeats.{c}" for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")])


RULES = {
    "com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block",
}


@query
def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rule or else by its path template."""
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES)


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in every document."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest others of every vector whose id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@in_sql(r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w
    FROM (SELECT lang, unnest(regexp_split_to_array(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (
    SELECT lang, words, array_to_string(w[i:i + words - 1], ' ') AS phrase
    FROM (SELECT lang, w, words, unnest(range(1, len(w) - words + 2)) AS i
        FROM pieces CROSS JOIN (VALUES (1), (2), (3), (4), (5)) t(words))),
counts AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
longer AS (
    SELECT lang, part, max(f) AS f
    FROM (SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[2:], ' '),
            array_to_string(string_split(phrase, ' ')[:-2], ' ')]) AS part
        FROM counts WHERE words > 1)
    GROUP BY lang, part),
cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, n, k,
        (1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT *, unnest(range(1, words)) AS k FROM counts WHERE words > 1) c
    JOIN totals USING (lang)
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(string_split(c.phrase, ' ')[:k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ')),
lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score::BIGINT AS score
FROM lowest
WHERE NOT EXISTS (SELECT 1 FROM longer o WHERE o.lang = lowest.lang AND o.part = phrase AND 100 * o.f >= 100 * a)
QUALIFY rank <= 2000
""")
@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of each language that stand out most."""
    return phrases.mine(table(spark, sf_dir, "documents").select("text", "lang"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight leading components, whitened."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op11_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, learnt from the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classifier.judge(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
