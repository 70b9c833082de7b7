"""URL filter by a path-template tree (DataFrame operations only).

Per host the paths form a tree.  Going down level by level, a segment keeps
its own branch only while its pages are labelled differently from its
siblings' to a significant degree; all other segments of that parent are
merged into one wildcard branch.  What is left is a list of templates, and a
template is rejected when its labelled purity, smoothed towards its host's
and the corpus's, is low.

Pages are first reduced to distinct (host, generalised path) rows with label
counts, so a hot host is pre-aggregated before anything is shuffled by it,
and only segments with labelled evidence can stay literal, so the tables
joined back are no larger than the labelled part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stage_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_and_path(df: DataFrame, url: Column) -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    df = df.withColumn("_url", url).withColumn("_rest", F.coalesce(rest, F.lit("")))
    df = df.withColumn("_host", F.regexp_extract("_rest", "^[^/?#]*", 0))
    df = df.withColumn("path", F.regexp_extract(F.expr("substring(_rest, length(_host) + 1)"), "^[^?#]*", 0))
    return df.withColumn("host", F.translate("_host", UPPER, LOWER)).drop("_url", "_rest", "_host")


def rule_columns(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits.

    ``rules``: (verdict, ``host/path``); a rule fits its host and all its
    subdomains if the path starts with the rule's.  Of two equally long
    rules the first listed wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        at = text.index("/")
        host, path = text[:at], text[at:]
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _segments(path: Column, max_depth: int) -> Column:
    """Path segments, digits generalised; what lies deeper is one ``**``."""
    segs = F.transform(F.filter(F.split(path, "/", -1), lambda s: s != ""),
                       lambda s: F.regexp_replace(s, "[0-9]+", "#"))
    return F.when(F.size(segs) > max_depth,
                  F.concat(F.slice(segs, 1, max_depth), F.array(F.lit("**")))).otherwise(segs)


def filter_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = (),
                id_col: str = "page_id", url_col: str = "url", z: float = 1.96,
                min_labelled: int = 5, smoothing: float = 10.0, min_purity: float = 0.5,
                max_depth: int = 8) -> DataFrame:
    """Judge every page's url: a rule's verdict, else its template's.

    ``labels``: ``page_id`` and ``bad`` (boolean), one row per page; repeated
    rows of a page are reduced to "any is bad".  Returns one row per page
    row: ``page_id, host, path, rule, verdict`` (``allow`` or ``block``),
    ``template, purity``.

    A segment stays literal if at least ``min_labelled`` of its pages are
    labelled and its share of bad ones differs from its siblings' by ``z``
    standard errors; else it becomes ``*``.  Segments below ``max_depth``
    are generalised to one ``**``.  Purity of a host is smoothed towards the
    corpus's by ``smoothing`` rows, a template's towards its host's; below
    ``min_purity`` the template is rejected.  Without any label the purity
    is 1.  Null urls, and urls without ``://``, have an empty host and path
    and are judged as one template.  Null ids are judged but have no label.
    Repeated rows stay repeated; an empty table gives an empty result.
    """
    lab = labels.select(F.col("page_id").alias("_lid"), F.col("bad").cast("int").alias("_bad"))
    lab = lab.where("_lid is not null and _bad is not null").groupBy("_lid").agg(F.max("_bad").alias("bad"))
    urls = with_host_and_path(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_u")), F.col("_u"))
    urls = urls.drop("_u").withColumn("segs", _segments(F.col("path"), max_depth))
    judged = urls.join(lab, F.col("page_id") == F.col("_lid"), "left").drop("_lid")
    judged = stage_table(judged, "urls")

    paths = judged.groupBy("host", "segs").agg(
        F.count("bad").alias("n"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad"))
    paths = stage_table(paths.withColumn("tpl", F.array().cast("array<string>")), "paths")
    depth = paths.agg(F.max(F.size("segs"))).first()[0] or 0
    for d in range(depth):
        seg = F.get("segs", F.lit(d))
        child = paths.where(F.size("segs") > d).groupBy("host", "tpl", seg.alias("seg")).agg(
            F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        parent = child.groupBy("host", "tpl").agg(F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"))
        known = child.where(F.col("n") >= min_labelled).join(parent, ["host", "tpl"])
        rest_n = F.col("all_n") - F.col("n")
        rest_bad = F.col("all_bad") - F.col("bad")
        pooled = F.col("all_bad") / F.col("all_n")
        se = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n") + 1 / F.col("rest_n")))
        gap = F.abs(F.col("bad") / F.col("n") - F.col("rest_bad") / F.col("rest_n"))
        literal = (known.withColumn("rest_n", rest_n).withColumn("rest_bad", rest_bad)
                   .where("rest_n > 0").where((gap > 0) & (gap >= z * se))
                   .select("host", "tpl", "seg", F.lit(True).alias("own")))
        # Paths that end above this level are complete already.
        paths = (paths.withColumn("seg", seg).join(literal, ["host", "tpl", "seg"], "left")
                 .withColumn("tpl", F.when(F.size("segs") <= d, F.col("tpl"))
                             .otherwise(F.concat("tpl", F.array(F.when(F.col("own"), F.col("seg")).otherwise(
                                 F.when(F.col("seg") == "**", F.lit("**")).otherwise(F.lit("*")))))))
                 .drop("own", "seg"))
        paths = stage_table(paths, f"level{d}")

    def purity(n: Column, bad: Column, prior: Column) -> Column:
        return (n - bad + smoothing * prior) / (n + smoothing)

    total = paths.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    corpus = (total["n"] - total["bad"]) / total["n"] if total["n"] else 1.0
    templates = paths.groupBy("host", "tpl").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    hosts = templates.groupBy("host").agg(purity(F.sum("n"), F.sum("bad"), F.lit(corpus)).alias("prior"))
    scored = templates.join(hosts, "host").select(
        "host", "tpl", purity(F.col("n"), F.col("bad"), F.col("prior")).alias("purity"))
    by_path = paths.select("host", "segs", "tpl").join(scored, ["host", "tpl"]).select(
        "host", "segs", F.concat(F.col("host"), F.lit("/"), F.array_join("tpl", "/")).alias("template"), "purity")
    rule, verdict = rule_columns(list(rules))
    own = F.when(F.col("purity") < min_purity, "block").otherwise("allow")
    return judged.drop("bad").join(by_path, ["host", "segs"]).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        "template", "purity")
