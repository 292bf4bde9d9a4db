"""URL filter: a path-template tree per host, rejected where labelled pages of a template are mostly bad."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmament.llm.common import ascii_lower, materialised, table

def host_of(url: Column) -> Column:
    """Host behind the first ``://``, A-Z lower-cased; empty if there is none."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """Path up to ``?`` or ``#``; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does.

    A rule ``host/path`` fits its host and all subdomains where the page's path starts with the rule's. Of rules of one
    length that both fit, the one with the longer host wins. The list is a policy of bounded length that is part of the plan.
    """
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    parts = [(rule.partition("/")[0], "/" + rule.partition("/")[2], rule, verdict) for rule, verdict in rules]
    known = F.array(*[
        F.struct(F.lit(len(r)).alias("length"), F.lit(len(h)).alias("host_length"), F.lit(r).alias("rule"),
                 F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for h, p, r, v in parts])
    fits = F.filter(known, lambda r: (host.eqNullSafe(r["host"]) | host.endswith(F.concat(F.lit("."), r["host"])))
                    & path.startswith(r["path"]))
    best = F.array_max(fits)
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def shape_of(segment: Column) -> Column:
    """The segment with its variable parts as wildcards: runs of digits, and hexadecimal or other ids of 16 and more."""
    ids = F.regexp_replace(segment, "[0-9A-Fa-f]{8}(-?[0-9A-Fa-f]{4}){2,}[0-9A-Fa-f-]*|[0-9A-Za-z_-]*[0-9][0-9A-Za-z_-]{15,}", "{id}")
    return F.regexp_replace(ids, "[0-9]+", "{n}")


def branch_tree(
    forms: DataFrame, min_share: float = 0.01, weight: float = 10.0, most_bad: float = 0.5, similar: float = 1.96,
) -> DataFrame:
    """Verdict of each form of path: ``host, form, template, bad_share, verdict``.

    ``forms`` has one row per host and form (``host, form, pages, labelled, bad``; a form is its segments joined by ``/``). From
    the host down, node by node as long as a node has several forms:

    1. Segments that all forms of a node have in common are passed in one step: where there is one child, nothing is told apart.
    2. Below each node a segment with less than ``min_share`` of the node's pages becomes the wildcard ``*``.
    3. Children of a node are ordered by bad share; a child is one branch with the one before it unless their shares
       differ by more than ``similar`` standard errors. A branch is one node for the levels below it.
    4. A branch's bad share is smoothed towards its parent's by ``weight`` pages, down from the share of all labelled
       pages (0 where nothing is labelled). A branch with all the labels of its parent has its parent's share, so that they count once.

    A form is judged at the node of its last segment; above ``most_bad`` it is blocked. ``template`` names the form's own segments.
    Each round is written to the shared folder; there are as many as branchings on one path at most, whatever its length.
    """
    total = forms.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("k")).first()
    overall = total.k / total.n if total.n else 0.0
    host = Window.partitionBy("host")
    smoothed = (F.sum("bad").over(host) + weight * overall) / (F.sum("labelled").over(host) + weight)
    rest = F.when(F.col("form") == "", F.array().cast("array<string>")).otherwise(F.split("form", "/"))
    level = forms.select(
        "host", "form", "pages", "labelled", "bad", rest.alias("rest"), F.array("host").alias("template"), F.lit("").alias("node"), smoothed.alias("share"),
        F.sum("labelled").over(host).alias("known"))
    names, done = ["host", "node"], []
    while True:
        node = Window.partitionBy(*names)
        # In the order of arrays, what the first and the last have in common all between them have.
        level = level.withColumns({"first": F.min("rest").over(node), "last": F.max("rest").over(node), "node_pages": F.sum("pages").over(node)})
        differs = F.array_position(F.transform(F.arrays_zip("first", "last"), lambda x: ~x["first"].eqNullSafe(x["last"])), True)
        common = F.when(differs > 0, differs - 1).otherwise(F.size("first")).cast("int")
        level = level.withColumn("common", common).withColumns({
            "template": F.concat("template", F.slice("rest", F.lit(1), F.col("common"))),
            "rest": F.slice("rest", F.col("common") + 1, F.size("rest"))}).drop("first", "last", "common")
        level = materialised(level, "url-level")
        done.append(level.where(F.size("rest") == 0).select("host", "form", F.array_join("template", "/").alias("template"), "share"))
        going = level.where(F.size("rest") > 0)
        if going.isEmpty():
            break
        step = F.element_at("rest", 1)
        pages = F.sum("pages").over(Window.partitionBy(*names, step))
        going = going.withColumn("step", F.when(pages < min_share * F.col("node_pages"), F.lit("*")).otherwise(step))
        children = going.groupBy(*names, "step").agg(
            F.sum("labelled").alias("n"), F.sum("bad").alias("k"), F.first("share").alias("above"), F.first("known").alias("known"))
        own = lambda k, n: F.when(n == F.col("known"), F.col("above")).otherwise((k + weight * F.col("above")) / (n + weight))
        children = children.withColumn("own", own(F.col("k"), F.col("n")))
        children = children.withColumn("variance", F.col("own") * (1 - F.col("own")) / (F.col("n") + weight))
        order = Window.partitionBy(*names).orderBy("own", "step")
        apart = F.col("own") - F.lag("own").over(order) > similar * F.sqrt(F.col("variance") + F.lag("variance").over(order))
        children = children.withColumn("apart", F.coalesce(apart.cast("int"), F.lit(0)))
        children = children.withColumn("branch", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        branch = Window.partitionBy(*names, "branch")
        n, k = F.sum("n").over(branch), F.sum("k").over(branch)
        children = children.select(*names, "step", "branch", own(k, n).alias("share"), n.alias("known"))
        level = going.drop("share", "known", "node_pages").join(children, [*names, "step"])
        level = level.withColumns({"template": F.concat("template", F.array("step")), "node": F.concat_ws(".", "node", "branch"),
                                   "rest": F.slice("rest", F.lit(2), F.size("rest"))}).drop("step", "branch")
    return reduce(DataFrame.unionByName, done).select("host", "form", "template", F.col("share").alias("bad_share"), F.when(
        F.col("share") > most_bad, "block").otherwise("allow").alias("verdict"))


def url_filter(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]] = (), id_col: str = "page_id",
               url_col: str = "url", **settings) -> DataFrame:
    """Judge every url: ``id_col, host, path, rule, verdict, template, bad_share``.

    The longest fitting rule decides; a page that no rule fits gets the verdict of its path's template (``settings``: see
    ``branch_tree``). ``labelled`` (``id_col, bad``) marks pages as bad (1) or good (0); null marks and ids are no label,
    and of several marks of one page the worst counts. A null url, or one without ``://``, has an empty host and path,
    which is a node like any other. Rows that repeat an id each get a row; an empty table gives none.

    The tree is built on distinct forms of paths, which partial counts make small before anything is shuffled; the pages
    themselves are joined with their marks and with their form's verdict.
    """
    url = F.col(url_col)
    split = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    form = F.array_join(F.transform(segments, shape_of), "/")
    split = materialised(split.select("id", "host", "path", form.alias("form")), "url-forms")
    marks = labelled.where(F.col("bad").isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max("bad").alias("bad"))
    forms = split.join(marks, "id", "left").groupBy("host", "form").agg(
        F.count(F.lit(1)).alias("pages"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    verdicts = materialised(branch_tree(materialised(forms, "url-counts"), **settings).withColumnRenamed("verdict", "by_template"), "url-verdicts")
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    return split.join(verdicts, ["host", "form"]).withColumn("fit", rule).select(
        F.col("id").alias(id_col), "host", "path", F.col("fit")["rule"].alias("rule"),
        F.coalesce(F.col("fit")["verdict"], F.col("by_template")).alias("verdict"), "template", "bad_share")


#: The rules of the query.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def op4_url_filter(spark, folder: str) -> DataFrame:
    """A page shows the document whose number ends its path; the document's quality label marks the page."""
    pages, labels = table(spark, folder, "pages"), table(spark, folder, "labels")
    number = F.regexp_extract(path_of(F.col("url")), "/([0-9]{1,18})(\\.html)?/?$", 1)
    shown = pages.select("page_id", F.when(number != "", number).cast("long").alias("doc_id"))
    bad = labels.select("doc_id", (F.col("quality") == 0).cast("int").alias("bad"))
    return url_filter(pages.select("page_id", "url"), shown.join(bad, "doc_id").select("page_id", "bad"), RULES)
