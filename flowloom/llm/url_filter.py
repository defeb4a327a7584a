"""URL filter: rules, and a path-template tree for what no rule decides.

For each host the paths form a tree of segments. A level is generalised to a
wildcard where it varies: a segment of digits only, or any segment of a node with
`crowd` or more different children (file extensions are kept, `/en/12.html` is under
`/en/*.html`). Sibling branches are merged where they are statistically alike: the same
sub-templates below and the same leaning of their labels by a Wilson interval (mostly
blocked, mostly allowed, or undecided). Labels are the verdicts of the rules on the
urls they fit. A template's share of blocked urls is smoothed towards its host's,
and the host's towards the whole table's; from `reject` on the template is rejected.

Levels beyond `depth` form one last segment. Counts are taken over all urls, first
by (host, path), so a host or url with a third of all rows is pre-aggregated.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.session import settle

Rule = tuple[str, str, str]  # host, path, verdict
#: The production rules (fixed values).
RULES: tuple[Rule, ...] = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
Z = 1.96


def host_of(url: Column) -> Column:
    """What stands between the first :// and /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.when(F.locate("://", url) > 0, F.substring_index(url, "://", 1))
    start = F.length(rest) + 4
    host = F.regexp_extract(F.substr(url, start), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    start = F.length(F.when(F.locate("://", url) > 0, F.substring_index(url, "://", 1))) + 4
    return F.coalesce(F.regexp_extract(F.substr(url, start), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does."""
    fit = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        here = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        fit = F.when(here, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fit)
    return fit


def _leaning(allow: Column, block: Column) -> Column:
    n = allow + block
    share = block / n
    middle = (share + Z * Z / (2 * n)) / (1 + Z * Z / n)
    half = Z / (1 + Z * Z / n) * F.sqrt(share * (1 - share) / n + Z * Z / (4 * n * n))
    return F.when(n == 0, "open").when(middle - half > 0.5, "block").when(middle + half < 0.5, "allow").otherwise("open")


def template_tree(paths: DataFrame, depth: int = 4, crowd: int = 16) -> DataFrame:
    """(host, path, template) for a table with one row per (host, path)."""
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    tail = F.concat(F.slice(parts, 1, depth - 1), F.array(F.array_join(F.slice(parts, depth, F.greatest(F.size(parts), F.lit(1))), "/")))
    tree = paths.select("host", "path", F.when(F.size(parts) <= depth, parts).otherwise(tail).alias("parts"),
                        F.array().cast("array<string>").alias("kept"))
    for level in range(depth):
        part = F.get("parts", F.lit(level))
        suffix = F.regexp_extract(part, r"(\.[A-Za-z]{1,5})$", 1)
        number = F.substr(part, F.lit(1), F.length(part) - F.length(suffix)).rlike("^[0-9]+$")
        crowded = settle(
            tree.filter(part.isNotNull() & ~number).groupBy("host", "kept", part.alias("part")).agg(F.lit(1).alias("one"))
            .groupBy("host", "kept").agg(F.count("*").alias("children")).filter(F.col("children") >= crowd)
            .select("host", "kept", F.lit(True).alias("crowded")), "url-crowded")
        step = F.when(number | F.col("crowded"), F.concat(F.lit("*"), suffix)).otherwise(part)
        tree = tree.join(crowded, ["host", "kept"], "left").select(
            "host", "path", "parts", F.when(part.isNotNull(), F.concat("kept", F.array(step))).otherwise(F.col("kept")).alias("kept"))
    return tree.select("host", "path", F.col("kept").alias("template"))


def merge_branches(templates: DataFrame, depth: int = 4) -> DataFrame:
    """(host, template, merged): sibling branches that are statistically alike get one name.

    `templates` has one row per (host, template) with the counts allow and block. Works
    from the leaves up; a node has fewer than `crowd` children that are no wildcards.
    """
    now = templates.withColumn("merged", F.col("template"))
    for level in range(depth, 0, -1):
        above, here = F.slice("merged", 1, level - 1), F.get("merged", F.lit(level - 1))
        below = F.array_join(F.slice("merged", level + 1, depth), "/")
        deep = now.filter(F.size("merged") >= level)
        branch = deep.groupBy("host", above.alias("above"), here.alias("here")).agg(
            F.sum("allow").alias("a"), F.sum("block").alias("b"), F.array_sort(F.collect_set(below)).alias("below"))
        alike = branch.groupBy("host", "above", "below", _leaning(F.col("a"), F.col("b")).alias("leaning")).agg(
            F.array_sort(F.collect_set("here")).alias("names"))
        renamed = settle(alike.select("host", "above", F.explode("names").alias("here"), F.array_join("names", "|").alias("name")), "url-branches")
        now = (now.withColumn("above", above).withColumn("here", here)
               .join(renamed, ["host", "above", "here"], "left")
               .withColumn("merged", F.when(F.col("name").isNull(), F.col("merged")).otherwise(
                   F.concat("above", F.array("name"), F.slice("merged", level + 1, depth))))
               .select(*templates.columns, "merged"))
    return now.select("host", "template", "merged", "allow", "block")


def template_verdicts(paths: DataFrame, depth: int = 4, crowd: int = 16, weight: float = 4.0, reject: float = 0.5) -> DataFrame:
    """(host, path, template, block_share, template_verdict) for a table (host, path, allow, block), one row per (host, path)."""
    tree = settle(template_tree(paths, depth, crowd), "url-tree")
    counted = settle(tree.join(paths, ["host", "path"]).groupBy("host", "template").agg(
        F.sum("allow").alias("allow"), F.sum("block").alias("block")), "url-templates")
    total = counted.agg(F.sum("allow"), F.sum("block")).first()
    allow, block = total[0] or 0, total[1] or 0
    overall = (block + 0.5 * weight) / (allow + block + weight)
    merged = settle(merge_branches(counted, depth), "url-merged")
    by_host = merged.groupBy("host").agg(
        ((F.sum("block") + weight * overall) / (F.sum("allow") + F.sum("block") + weight)).alias("host_share"))
    by_template = merged.groupBy("host", "merged").agg(F.sum("allow").alias("a"), F.sum("block").alias("b")).join(by_host, "host")
    share = (F.col("b") + weight * F.col("host_share")) / (F.col("a") + F.col("b") + weight)
    judged = settle(merged.select("host", "template", "merged").join(by_template.select("host", "merged", share.alias("block_share")), ["host", "merged"])
                    .select("host", "template", F.array_join("merged", "/").alias("name"), "block_share"), "url-judged")
    return tree.join(judged, ["host", "template"]).select(
        "host", "path", F.concat(F.lit("/"), "name").alias("template"), "block_share",
        F.when(F.col("block_share") >= reject, "block").otherwise("allow").alias("template_verdict"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url", **tree: float) -> DataFrame:
    """One row per row of `pages`: id, host, path, rule, verdict, template, block_share.

    The verdict is that of the longest fitting rule, else that of the url's template. A
    null url, or one without ://, has empty host and path and is judged like any other
    path of the empty host. Repeated rows stay; other columns are not read.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    labels = rows.groupBy("host", "path").agg(
        F.count(F.when(F.col("fit.verdict") == "allow", 1)).alias("allow"),
        F.count(F.when(F.col("fit.verdict") == "block", 1)).alias("block"))
    judged = template_verdicts(settle(labels, "url-labels"), **tree)
    return rows.join(judged, ["host", "path"]).select(
        F.col("id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "template_verdict").alias("verdict"), "template", "block_share")


