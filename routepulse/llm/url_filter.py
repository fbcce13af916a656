"""Verdicts for URLs: rules first, then a path-template tree learned per host.

Everything here is DataFrame operations.

The tree. It is as deep as the paths are. A path's segments become template segments: numbers, dates, hashes and
segments that hold digits are wildcards by shape ("{n}", "{x}"), and a literal segment that
is one of very many different ones under its parent becomes "{w}". Under each node,
sibling branches with the same sub-tree shape are merged into one ("{m}") when their labelled
block rates do not differ significantly. Every template and its ancestors carry the
labelled pages below them; a template is rejected when its blocked share, smoothed
towards the share of all labelled pages, reaches the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routepulse.llm.common import only
from routepulse.session import stage

#: More different literal segments than this under one parent, each of them rare, are a variable.
FANOUT = 50
#: A literal segment with at least this share of its parent's pages stays literal even so.
LITERAL_SHARE = 0.02
#: Weight, in pages, of the overall block rate in a template's purity.
PRIOR_WEIGHT = 4.0
#: A template with at least this purity is rejected.
THRESHOLD = 0.8
#: Standard errors by which the block rates of merged siblings may differ.
DEVIATIONS = 1.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; NULL or without "://": both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The rule (host and path in one) and verdict of the longest rule that fits, else NULL.

    ``rules`` are (rule, "allow" or "block"), e.g. ("net/es/", "block"). A rule fits its
    host and all subdomains, and paths that start with its path.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        site, slash, start = text.partition("/")
        fits = ((host == site) | F.endswith(host, F.lit("." + site))) & F.startswith(path, F.lit(slash + start))
        name = F.when(fits, F.lit(text)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def segments(path: Column) -> Column:
    """The template segments of a path, by shape; at least one."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    shaped = F.transform(
        parts,
        lambda s: F.when(s.rlike(r"^[0-9]+(\.[A-Za-z0-9]+)?$"), "{n}").when(s.rlike(r"[0-9]"), "{x}").otherwise(s),
    )
    return F.when(F.size(shaped) == 0, F.array(F.lit(""))).otherwise(shaped)


def learn_templates(pages: DataFrame, prior_weight: float = PRIOR_WEIGHT) -> DataFrame:
    """Template nodes per host: host, template (array), blocked, labelled, purity.

    ``pages`` has host, path, blocked (1, 0 or NULL where a page has no label). Pages
    are summed per host and shaped path first, so a host with very many pages is summed
    on the map side; all further work is on templates.
    """
    counted = (
        only(pages, "host", "path", "blocked")
        .select("host", segments(F.col("path")).alias("template"), "blocked")
        .groupBy("host", "template")
        .agg(F.count("*").alias("pages"), F.count("blocked").alias("labelled"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked"))
    )
    # staged: the tree is much smaller than the pages, and every step reads it several times
    counted = stage(counted, "url-templates")
    tree, ended = counted.withColumn("shape", F.col("template")), []
    for level in range(counted.agg(F.max(F.size("template"))).first()[0] or 0):
        tree = stage(_merge(stage(_generalise(tree, level), "url-general"), level), "url-merged")
        # templates that end here are not read again
        ended.append(tree.where(F.size("shape") == level + 1))
        tree = tree.where(F.size("shape") > level + 1)
    for more in ended:
        tree = tree.unionByName(more)
    nodes = tree.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size("shape")), lambda n: F.slice("shape", F.lit(1), n))).alias("shape"), "labelled", "blocked")
    overall = counted.agg((F.sum("blocked") / F.sum("labelled")).alias("overall"))
    purity = (F.col("blocked") + prior_weight * F.coalesce("overall", F.lit(0.0))) / (F.col("labelled") + prior_weight)
    found = nodes.groupBy("host", "shape").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")).where(F.col("labelled") > 0)
    found = found.join(F.broadcast(overall)).withColumn("purity", purity).drop("overall")  # one row
    shapes = tree.select("host", "template", "shape")
    # a template's verdict is that of its deepest node with labelled pages
    reach = shapes.select("host", "template", F.explode(F.transform(F.sequence(F.lit(1), F.size("shape")), lambda n: F.slice("shape", F.lit(1), n))).alias("shape"))
    ranked = reach.join(found, ["host", "shape"])
    deepest = F.max_by(F.struct("shape", "labelled", "blocked", "purity"), F.size("shape"))
    return ranked.groupBy("host", "template").agg(deepest.alias("node")).select("host", "template", "node.*")


def _generalise(tree: DataFrame, level: int) -> DataFrame:
    """Make literal segments a wildcard where a parent has very many rare ones."""
    parent = F.slice("shape", 1, level) if level else F.array().cast("array<string>")
    keyed = tree.withColumns({"parent": parent, "segment": F.when(F.size("shape") > level, F.try_element_at("shape", F.lit(level + 1)))})
    children = keyed.where(F.col("segment").isNotNull()).groupBy("host", "parent", "segment").agg(F.sum("pages").alias("n"))
    totals = children.groupBy("host", "parent").agg(F.count("*").alias("fanout"), F.sum("n").alias("all"))
    rare = (
        children.join(totals.where(F.col("fanout") > FANOUT), ["host", "parent"])
        .where((F.col("n") < LITERAL_SHARE * F.col("all")) & ~F.startswith("segment", F.lit("{")))
        .select("host", "parent", "segment", F.lit("{w}").alias("to"))
    )
    return _rename(keyed, rare, level)


def _merge(tree: DataFrame, level: int) -> DataFrame:
    """Merge sibling branches of like shape whose block rates are alike."""
    parent = F.slice("shape", 1, level) if level else F.array().cast("array<string>")
    keyed = tree.withColumns({"parent": parent, "segment": F.when(F.size("shape") > level, F.try_element_at("shape", F.lit(level + 1)))})
    below = F.array_join(F.slice("shape", level + 2, F.size("shape")), "/")
    branches = (
        keyed.where(F.col("segment").isNotNull())
        .groupBy("host", "parent", "segment")
        .agg(F.array_join(F.sort_array(F.collect_set(F.when(below.rlike(r"^(\{[a-z]\}/?)*$"), below).otherwise("literal"))), " ").alias("under"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    )
    # only branches with rates in one quarter, or without labels, may become one
    rate = F.least(F.floor(4 * F.col("blocked") / F.col("labelled")), F.lit(3))
    branches = branches.withColumn("quarter", F.coalesce(F.when(F.col("labelled") > 0, rate), F.lit(-1)))
    like = branches.groupBy("host", "parent", "under", "quarter").agg(
        F.count("*").alias("siblings"), F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked")
    )
    mean = F.col("all_blocked") / F.col("all_labelled")
    error = F.sqrt(mean * (1 - mean) / F.greatest(F.col("labelled"), F.lit(1)))
    alike = F.when(F.col("all_labelled") == 0, True).otherwise((F.col("labelled") > 0) & (F.abs(F.col("blocked") / F.col("labelled") - mean) <= DEVIATIONS * error))
    merged = (
        branches.join(like.where(F.col("siblings") > 1), ["host", "parent", "under", "quarter"])
        .where(F.coalesce(alike, F.lit(False)))
        .select("host", "parent", "segment", F.concat(F.lit("{m"), F.substr(F.sha2("under", 256), F.lit(1), F.lit(8)), (F.col("quarter") + 1).cast("string"), F.lit("}")).alias("to"))
    )
    return _rename(keyed, merged, level)


def _rename(keyed: DataFrame, names: DataFrame, level: int) -> DataFrame:
    renamed = F.concat(F.slice("shape", 1, level), F.array("to"), F.slice("shape", level + 2, F.size("shape"))) if level else F.concat(F.array("to"), F.slice("shape", 2, F.size("shape")))
    out = keyed.join(names, ["host", "parent", "segment"], "left")
    return out.withColumn("shape", F.when(F.col("to").isNotNull(), renamed).otherwise(F.col("shape"))).drop("parent", "segment", "to")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], labels: DataFrame | None = None, threshold: float = THRESHOLD, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, template, purity.

    The verdict is that of the longest fitting rule, else the template tree's: "block"
    where the template's purity is at least ``threshold``, "allow" elsewhere (also for
    templates without any labelled page). The tree learns from ``labels`` (id, blocked 0
    or 1) if given, else from the pages that a rule decides. NULL urls and urls without
    "://" have empty host and path and are judged like others; repeated rows are judged
    each; an empty table gives an empty table; other columns are not read.
    """
    host, path = host_and_path(F.col(url_column))
    split = only(pages, id_column, url_column).select(F.col(id_column), host.alias("host"), path.alias("path"))
    name, decided = rule_for(F.col("host"), F.col("path"), rules)
    split = split.select("*", name.alias("rule"), decided.alias("decided"))
    if labels is None:
        labelled = split.withColumn("blocked", F.when(F.col("decided") == "block", 1).when(F.col("decided") == "allow", 0))
    else:
        known = only(labels, id_column, "blocked").where(F.col(id_column).isNotNull()).groupBy(id_column).agg(F.max("blocked").alias("blocked"))
        labelled = split.join(known, id_column, "left")
    templates = learn_templates(labelled).select("host", "template", "purity")
    out = split.withColumn("template", segments(F.col("path"))).join(templates, ["host", "template"], "left")
    judged = F.when(F.col("purity") >= threshold, "block").otherwise("allow")
    return out.select(id_column, "host", "path", "rule", F.coalesce("decided", judged).alias("verdict"), F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity")
