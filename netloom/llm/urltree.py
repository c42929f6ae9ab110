"""Path-template trees of URLs, from built-in functions only.

Rules judge the urls they fit. The others are judged by a tree of path
templates per host. Digits and hex strings in a path become wildcards, and so
does a rare child of a node with many children. Siblings whose labels don't
differ by a two-sample test are merged into one branch; siblings with too few
labels are merged if neither what follows them nor the labels that their shapes
have on all hosts differ. Labelled pages are those that a rule judges. The
purity of a template is the share of allowed pages among its labelled ones,
smoothed through the tree: towards the template above it, up to the host's
root, then towards the template's shapes on all hosts, again from the leaf up,
and at last towards all labelled pages. A template of too low a purity is blocked.

Only counts by (host, template) go through the tree, level by level.

Edge cases: a null url, or one without ``://``, has an empty host and path and
is judged like any other without a rule, by all labelled pages; without any
labelled page everything is allowed; ties at the threshold are allowed;
repeated rows count each; an empty table gives an empty result. Other columns
than page_id and url are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netloom.session import materialize


@dataclass(frozen=True)
class Rule:
    """``site`` is a host, a slash and the start of a path; it fits the host
    and its subdomains."""

    site: str
    verdict: str

    @property
    def host(self) -> str:
        return self.site[: self.site.index("/")]

    @property
    def path(self) -> str:
        return self.site[self.site.index("/") :]


#: Fixed values.
RULES = (
    Rule("org/", "allow"),
    Rule("example.org/es/", "block"),
    Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"),
    Rule("com/de/", "block"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.site)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.site).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def shape(path: Column) -> Column:
    """The path with hex strings, then digits, as wildcards."""
    hexed = F.regexp_replace(path, r"(?<![0-9a-zA-Z])(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{8,}(?![0-9a-zA-Z])", "{h}")
    return F.regexp_replace(hexed, r"[0-9]+", "{n}")


def template_tree(
    shapes: DataFrame,
    max_depth: int = 6,
    fanout: int = 20,
    least_share: float = 0.01,
    least_labels: int = 5,
    z: float = 1.96,
) -> DataFrame:
    """(host, shape, n, good, bad, all_good, all_bad, template, path) from the
    first five. ``all_good`` and ``all_bad`` are the shape's labels on all
    hosts, ``path`` the templates from the host's root down to ``template``.

    A level of the tree is worked on for all hosts at once. At a node with
    more than ``fanout`` children, those with less than ``least_share`` of its
    pages become ``*``. Children with ``least_labels`` labels or more are put
    in order of purity, and neighbours whose purity differs by less than ``z``
    standard errors are merged. The others are put in order of their shapes'
    purity on all hosts; neighbours of ``least_labels`` pages or more, both
    with pages below, are merged unless that purity or the shares of their own
    children (chi-square) differ. Segments beyond ``max_depth`` stay one
    segment, so no path is left out.
    """
    cut = F.split(F.col("shape"), "/", max_depth + 1)  # the first is what precedes the first slash
    everywhere = shapes.groupBy("shape").agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"))
    tree = shapes.join(everywhere, "shape").withColumn("_segments", cut).withColumn("template", F.get("_segments", F.lit(0)))
    tree = materialize(tree.withColumn("path", F.array("template")), "url_tree")
    depth = tree.agg(F.max(F.size("_segments"))).first()[0] or 1
    node = Window.partitionBy("host", "template")
    keys = ["host", "template", "_child"]
    for level in range(1, depth):
        child = F.get("_segments", F.lit(level))
        named = tree.withColumn("_child", child)
        children = (
            named.where("_child is not null")
            .groupBy(*keys)
            .agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad", "all_good", "all_bad")])
        )
        rare = (F.count("*").over(node) > fanout) & (F.col("n") < least_share * F.sum("n").over(node))
        children = (
            children.withColumn("_name", F.when(rare, F.lit("*")).otherwise(F.col("_child")))
            .withColumn("_labels", F.col("good") + F.col("bad"))
            .withColumn("_by", F.when(F.col("_name") == "*", "*").when(F.col("_labels") >= least_labels, "labels").otherwise("pages"))
        )
        # the labels that siblings are told apart by: their own, or those of their shapes on all hosts
        own = F.col("_by") == "labels"
        children = children.withColumn("_g", F.when(own, F.col("good")).otherwise(F.col("all_good")))
        children = children.withColumn("_l", F.when(own, F.col("_labels")).otherwise(F.col("all_good") + F.col("all_bad")))
        in_order = Window.partitionBy("host", "template", "_by").orderBy(F.coalesce(F.try_divide("_g", "_l"), F.lit(0.5)), "_child")
        last_g, last_l, last_n = F.lag("_g").over(in_order), F.lag("_l").over(in_order), F.lag("n").over(in_order)
        pooled = F.try_divide(F.col("_g") + last_g, F.col("_l") + last_l)
        error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), "_l") + F.try_divide(F.lit(1), last_l)))
        gap = F.abs(F.try_divide("_g", "_l") - F.try_divide(last_g, last_l))
        few = F.least("_l", last_l) < least_labels
        children = children.withColumn("_next", F.lead("_child").over(in_order)).withColumn("_apart", ~few & (gap > z * error))
        children = children.withColumn("_first", last_n.isNull()).withColumn("_pages", F.least("n", last_n))
        alike = _alike_below(named, children.where("_by = 'pages'").select(*keys, "_next"), level, z)
        children = children.join(alike, keys, "left")
        unlike = (F.col("_pages") < least_labels) | ~F.coalesce("_alike", F.lit(False))
        differs = F.col("_first") | (F.col("_by") == "*") | F.col("_apart") | (~own & unlike)
        children = children.withColumn("_differs", differs.cast("int"))
        children = children.withColumn("_branch", F.sum("_differs").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        branch = Window.partitionBy("host", "template", "_by", "_branch")
        merged = F.array_join(F.sort_array(F.collect_set("_name").over(branch)), "|")
        children = children.select(*keys, F.when(F.col("_by") == "*", F.col("_name")).otherwise(merged).alias("_label"))
        named = named.join(children, keys, "left")
        below = F.concat_ws("/", "template", "_label")
        named = named.withColumn("path", F.when(F.col("_child").isNull(), F.col("path")).otherwise(F.concat("path", F.array(below))))
        named = named.withColumn("template", F.element_at("path", -1))
        tree = materialize(named.select(*tree.columns), "url_tree")
    return tree.drop("_segments")


def _alike_below(named: DataFrame, siblings: DataFrame, level: int, z: float) -> DataFrame:
    """(host, template, _child, _alike): whether a child and the sibling before
    it (whose ``_next`` it is) both have pages below, in shares by next segment
    that don't differ by a chi-square test."""
    keys = ["host", "template", "_child"]
    below = named.where("_child is not null").groupBy(*keys, F.get("_segments", F.lit(level + 1)).alias("_segment")).agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("_child").alias("pair"), F.col("n").alias("a"), zero.alias("b")),
        F.struct(F.col("_next").alias("pair"), zero.alias("a"), F.col("n").alias("b")),
    )
    rows = below.join(siblings, keys).select("host", "template", "_segment", F.explode(sides).alias("s")).where("s.pair is not null")
    rows = rows.groupBy("host", "template", F.col("s.pair").alias("_child"), "_segment").agg(F.sum("s.a").alias("a"), F.sum("s.b").alias("b"))
    both, goes_on = F.col("a") + F.col("b"), F.col("_segment").isNotNull()
    sums = rows.groupBy(*keys).agg(
        F.sum("a").alias("A"), F.sum("b").alias("B"), (F.count("*") - 1).alias("df"),
        F.sum(F.col("a") * F.col("a") / both).alias("aa"), F.sum(F.col("b") * F.col("b") / both).alias("bb"),
        F.sum(F.col("a") * F.col("b") / both).alias("ab"),
        F.count_if(goes_on & (F.col("a") > 0)).alias("a_on"), F.count_if(goes_on & (F.col("b") > 0)).alias("b_on"),
    )
    square = F.try_divide("B", "A") * F.col("aa") + F.try_divide("A", "B") * F.col("bb") - 2 * F.col("ab")
    part = F.try_divide(F.lit(2.0), 9 * F.col("df"))
    most = F.coalesce(F.col("df") * F.pow(1 - part + z * F.sqrt(part), F.lit(3.0)), F.lit(1e-9))  # Wilson and Hilferty
    return sums.select(*keys, ((F.col("a_on") > 0) & (F.col("b_on") > 0) & (square <= most)).alias("_alike"))


def purities(tree: DataFrame, weight: float = 4.0) -> DataFrame:
    """(host, shape, template, purity): the share of allowed pages under the
    host's template. Each share is smoothed by ``weight`` pages of the level
    above: the templates above it in the host, then the shapes under the
    template and under those above it on all hosts, then all labelled pages."""
    good, bad = tree.agg(F.sum("good"), F.sum("bad")).first()
    overall = (good or 0) / (good + bad) if good or bad else 1.0
    levels = tree.select("*", F.posexplode("path").alias("_level", "_at"))
    counts = levels.groupBy("host", "_level", "_at").agg(*[F.sum(c).alias(c) for c in ("good", "bad", "all_good", "all_bad")])
    chains = tree.select("host", "template", "path").distinct().select("host", "template", F.posexplode("path").alias("_level", "_at"))
    chains = chains.join(counts, ["host", "_level", "_at"]).groupBy("host", "template").agg(
        F.sort_array(F.collect_list(F.struct("_level", "good", "bad", "all_good", "all_bad"))).alias("_chain")
    )

    def down(above: Column, g: str, b: str) -> Column:
        """From the root to the leaf, each level smoothed by what came before."""
        return F.aggregate("_chain", above, lambda p, x: (x[g] + weight * p) / (x[g] + x[b] + weight))

    purity = down(down(F.lit(float(overall)), "all_good", "all_bad"), "good", "bad")
    return tree.select("host", "shape", "template").join(chains.select("host", "template", purity.alias("purity")), ["host", "template"])


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every page."""
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("shape", shape(F.col("path")))
    is_good = F.col("_rule.verdict") == "allow"
    shapes = urls.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count_if(is_good).alias("good"), F.count_if(F.col("_rule").isNotNull() & ~is_good).alias("bad")
    )
    # small beside the pages; its size decides how Spark joins it
    known = materialize(purities(template_tree(shapes)), "url_purities")
    rows = urls.join(known, ["host", "shape"], "left")
    by_method = F.when(F.col("purity") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    return rows.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), by_method).alias("verdict"), "template", "purity",
    )
