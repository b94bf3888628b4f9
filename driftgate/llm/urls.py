"""URL filters: rules on hosts and paths, and a tree of path templates for what no rule fits.

Every host has a tree of path segments. Segments that are plainly variable (numbers, hashes, dates, with or without an
ending) become wildcards of their shape, and so does a node with many different children. Then branches under one
node that are statistically alike are merged: those whose pages go on in the same shapes and carry the same share of
labels, both shrunk towards the node's own shares and taken in steps. What follows a branch is counted in ``SIGNATURE`` classes
of next segments, so that no row grows with a node. Segments that all paths of a node share are taken at once, so
there are as many rounds as the paths of one host branch, however long they are. Counts move from the pages to a
table of distinct templates first; all else works on that.

Paths are judged by smoothed purity, from the widest to the narrowest: the share of hosts that are bad, of those with
a path of the same shape, of those in the host's own domain, and last the share of bad among the labelled pages of the
host's template. Each share is shrunk by ``PRIOR`` towards the one before. A host is bad if most of its labels for the shape
are; hosts without labels count as not bad, so that rules which only block give no verdict on the rest of the web. A path
is rejected if its purity reaches ``PURITY`` and a bad label is on its shape somewhere, or on its template.

Everything is DataFrame functions. Defined results: a null url, or one without ``://``, has empty host and path, no rule, and
is allowed; repeated rows each give a row; paths that no bad label bears on are allowed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: A node with more children than this, most of them met once or twice, is variable.
CHILDREN = 12
REPEATS = 3.0
#: Pages' worth of the node's own shares that each branch is shrunk by.
SHRINK = 4.0
PRIOR = 4.0
PURITY = 0.9
#: Classes of next segments by which branches are compared.
SIGNATURE = 256
_STEPS = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (
        F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of ``rules`` (a host, a slash and a path, to allow or block) that fits, or null."""
    found = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        own, _, rest = rule.partition("/")
        fits = (host == own) | host.endswith("." + own)
        found.append(F.when(fits & path.startswith("/" + rest), F.lit(rule)))
    return F.coalesce(*found, F.lit(None).cast("string")) if found else F.lit(None).cast("string")


def _shaped(pattern: str, shape: str) -> Callable[[Column], Column]:
    return lambda segment: F.regexp_replace(segment, pattern, shape)


def shapes(path: Column) -> Column:
    """The segments of a path, variable ones as wildcards."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    for pattern, shape in (
        (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?=\.[a-z]+$|$)", "{date}"),
        (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?=\.[a-z]+$|$)", "{uuid}"),
        (r"^[0-9]+(?=\.[a-z]+$|$)", "{n}"),
        (r"^(?=[a-f]*[0-9])[0-9a-f]{8,}(?=\.[a-z]+$|$)", "{hex}"),
    ):
        segments = F.transform(segments, _shaped(pattern, shape))
    return segments


def _named(node: Column, segments: Column) -> Column:
    """A node's name with these segments after it."""
    return F.when(F.size(segments) == 0, node).otherwise(F.concat(node, F.lit("/"), F.array_join(segments, "/")))


def _shared(tree: DataFrame) -> DataFrame:
    """``tree`` with the segments that all paths of a node share moved from ``rest`` into the node, and whether the node
    is ``done``: has no other paths. What all share, the least and the greatest do."""
    ends = tree.groupBy("host", "node").agg(F.min("rest").alias("low"), F.max("rest").alias("high"))
    apart = F.filter(
        F.sequence(F.lit(0), F.size("low")), lambda i: ~F.get("low", i).eqNullSafe(F.get("high", i)) | F.get("low", i).isNull()
    )
    ends = ends.select("host", "node", F.array_min(apart).alias("same"), (F.col("low") == F.col("high")).alias("done"))
    tree = tree.join(ends, ["host", "node"])
    node = _named(F.col("node"), F.slice("rest", F.lit(1), F.col("same")))
    rest = F.slice("rest", F.col("same") + 1, F.size("rest"))
    return tree.withColumns({"node": node, "rest": rest}).drop("same")


def _level(tree: DataFrame) -> DataFrame:
    """``tree`` (host, shape, node, rest, n, bad, good) with the next segment of ``rest`` moved to the node, generalised."""
    keys = ["host", "node"]
    after = F.pmod(F.xxhash64(F.get("rest", F.lit(1))), F.lit(SIGNATURE)).cast("int")
    tree = tree.withColumn("child", F.coalesce(F.get("rest", F.lit(0)), F.lit("")))
    grown = tree.withColumn("next", after).groupBy(*keys, "child", "next").agg(
        *[F.sum(c).alias(c) for c in ("n", "bad", "good")]
    )
    branches = grown.groupBy(*keys, "child").agg(
        *[F.sum(c).alias(c) for c in ("n", "bad", "good")],
        F.collect_list(F.struct("next", F.col("n").alias("m"))).alias("nexts"),
    )
    nodes = branches.groupBy(*keys).agg(
        *[F.sum(c).alias(f"all_{c}") for c in ("n", "bad", "good")], F.count("*").alias("children"),
    )
    shares = grown.groupBy(*keys, "next").agg(F.sum("n").alias("m"))
    shares = shares.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("next", "m"))).alias("all_next"))
    known = branches.join(nodes.join(shares, keys), keys)

    def shrunk(own: Column, whole: Column) -> Column:
        share = (own + SHRINK * whole / F.col("all_n")) / (F.col("n") + SHRINK)
        return F.round(share * _STEPS).cast("int")

    own = F.map_from_entries("nexts")
    steps = F.array_sort(F.transform(
        F.map_keys("all_next"),
        lambda s: F.struct(s, shrunk(F.coalesce(F.try_element_at(own, s), F.lit(0)), F.col("all_next")[s])),
    ))
    alike = F.struct(
        F.filter(steps, lambda s: s["col2"] > 0),
        shrunk(F.col("bad"), F.col("all_bad")), shrunk(F.col("good"), F.col("all_good")), F.col("child") == "",
    )
    variable = (F.col("children") > CHILDREN) & (F.col("all_n") < REPEATS * F.col("children")) & (F.col("child") != "")
    named = known.withColumn("alike", F.when(variable, F.xxhash64(F.lit("*"))).otherwise(F.xxhash64(F.to_json(alike))))
    merged = named.groupBy(*keys, "alike").agg(
        F.min("child").alias("low"), F.max("child").alias("high"), F.count("*").alias("k"), F.max(variable).alias("v"),
    )
    label = F.when(F.col("v"), "*").when(F.col("k") == 1, F.col("low")).otherwise(
        F.concat_ws("", F.lit("{"), "low", F.lit(".."), "high", F.lit("}"))
    )
    labels = named.join(merged, [*keys, "alike"]).select(*keys, "child", label.alias("name"))
    joined = tree.join(labels, [*keys, "child"])
    name = F.when(F.col("name") == "", F.col("node")).otherwise(F.concat("node", F.lit("/"), "name"))
    return joined.withColumns({"node": name, "rest": F.slice("rest", 2, F.greatest(F.size("rest"), F.lit(1)))}).drop("child", "name")


def templates(pages: DataFrame) -> DataFrame:
    """The template of each distinct (host, shape), with its counts: host, shape, template, n, bad, good.

    ``pages``: host, shape, bad (a label: true, false or null)."""
    count = [F.count("*").alias("n"), F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")]
    tree = pages.groupBy("host", "shape").agg(*count).withColumns({"node": F.lit(""), "rest": F.col("shape")})
    found, columns = [], ["host", "shape", F.col("node").alias("template"), "n", "bad", "good"]
    while True:
        tree = cut(_shared(tree))
        found.append(tree.filter("done").select(*columns))
        tree = tree.filter("not done").drop("done")
        if tree.isEmpty():
            return reduce(DataFrame.unionByName, found)
        tree = _level(tree)


def purities(tree: DataFrame) -> DataFrame:
    """``templates`` with the smoothed purity of each path, and whether a bad label bears on it: host, shape, template, purity,
    known."""
    own = tree.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum(F.col("bad") + F.col("good")).alias("labels"))
    domain = F.when(F.col("host").contains("."), F.regexp_replace("host", r"^[^.]*\.", "")).otherwise(F.col("host"))
    hosts = tree.select("host", "shape", "template", domain.alias("domain"), (F.col("bad") > F.col("good")).cast("int").alias("is_bad"))

    def shrunk(bad: str, all_: str, back: str) -> Column:
        return (F.col(bad) + PRIOR * F.col(back)) / (F.col(all_) + PRIOR)

    near = hosts.groupBy("shape", "domain").agg(F.sum("is_bad").alias("near_bad"), F.count("*").alias("near"))
    wide = near.groupBy("shape").agg(F.sum("near_bad").alias("wide_bad"), F.sum("near").alias("wide"))
    base = wide.agg(F.sum("wide_bad"), F.sum("wide")).head()
    back = near.join(wide, "shape").withColumn("base", F.lit((base[0] or 0) / max(base[1] or 0, 1)))
    back = back.withColumn("p", shrunk("wide_bad", "wide", "base")).withColumn("p", shrunk("near_bad", "near", "p"))
    joined = hosts.join(back.select("shape", "domain", "p", "wide_bad"), ["shape", "domain"]).join(own, ["host", "template"])
    return joined.select(
        "host", "shape", "template", shrunk("bad", "labels", "p").alias("purity"),
        ((F.col("wide_bad") > 0) | (F.col("bad") > 0)).alias("known"),
    )


def judge(pages: DataFrame, rules: dict[str, str], bad: Column | None = None) -> DataFrame:
    """``pages`` (page_id, url, …) judged: page_id, host, path, rule, verdict, template, purity.

    Labels are ``bad`` (a boolean column of ``pages``, null where unknown) or, without it, what the rules say."""
    host, path = host_and_path(F.col("url"))
    rows = pages.withColumns({"_host": host, "_path": path})
    rows = rows.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"), rules))
    ruled = reduce(
        lambda c, r: c.when(F.col("_rule") == r, rules[r]), rules, F.when(F.lit(False), F.lit(None).cast("string"))
    )
    rows = rows.select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
        ruled.alias("ruled"), shapes(F.col("_path")).alias("shape"),
        (bad if bad is not None else ruled == "block").alias("bad"),
    )
    tree = templates(rows.select("host", "shape", "bad"))
    known = purities(tree)
    bad_template = F.col("known") & (F.col("purity") >= PURITY)
    verdict = F.coalesce("ruled", F.when(bad_template, "block").otherwise("allow"))
    return rows.join(known, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity",
    )
