"""URL filtering with explicit rules and a per-host path-template tree (DataFrame functions only).

Rules decide first. Every other URL is judged by the template its path falls under. A host's paths form a tree of
segments; segments that look variable (numbers, hex ids, long mixed tokens) and levels with too many distinct children
become wildcards; sibling branches whose bad shares do not differ significantly are merged. A template is rejected when
its smoothed labelled purity, ``(bad + strength * prior) / (labelled + strength)``, reaches the threshold.

The tree is built from one row per host and generalised path, so a host holding a third of all rows is folded before
anything is grouped by host.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed. Repeated
rows are judged alike. Templates without labelled pages have the prior as purity and are allowed. Paths of any depth are read
whole. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.session import materialise

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without a scheme separator."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _rule_table(rules: Sequence[tuple[str, str, str]]) -> Column:
    """Rules as one constant array; their number is a parameter, so its size is bounded by the caller."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    return F.array(*[
        F.struct(F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(action).alias("action"))
        for action, host, path in ordered
    ])


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule ``(action, host, path)`` that covers the URL as a struct, null if none does."""
    if not rules:
        return F.lit(None).cast("struct<host:string,path:string,action:string>")
    fits = F.filter(
        _rule_table(rules),
        lambda r: path.startswith(r["path"])
        & ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))),
    )
    return F.when(F.size(fits) > 0, F.get(fits, F.lit(0)))


def _segment_shape(segment: Column) -> Column:
    """Segments that are variable by their look become wildcards; an extension is kept."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    suffix = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    variable = (
        stem.rlike(r"^\d+$")
        | stem.rlike(r"^[0-9A-Fa-f-]{8,}$")
        | ((F.length(stem) >= 12) & stem.rlike(r"\d"))
        | (F.length(stem) >= 40)
    )
    return F.when(segment.isNull() | (segment == ""), F.lit("")).when(variable, F.concat(F.lit("{}"), suffix)).otherwise(
        segment
    )


def path_segments(path: Column) -> Column:
    """All segments of a path by their shape, however many; slashes at the end add none."""
    inner = F.regexp_replace(F.regexp_replace(path, "^/", ""), "/+$", "")
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(inner, "/"), _segment_shape))


def _literal(segments: Column) -> Column:
    """Segments as the end of a template; empty ones leave no trace."""
    return F.concat_ws("", F.transform(F.filter(segments, lambda s: s != ""), lambda s: F.concat(F.lit("/"), s)))


def template_verdicts(
    labelled: DataFrame,
    max_children: int = 16,
    min_novelty: float = 0.5,
    z_limit: float = 1.96,
    strength: float = 4.0,
    threshold: float = 0.8,
) -> DataFrame:
    """Template and purity per ``(host, raw)`` of ``labelled``: columns host, raw (array of segments), bad (0/1 or null).

    A level is a wildcard when its node has more than ``max_children`` children and these are at least ``min_novelty`` of the
    distinct paths below it; repeated visits of a path count once. The tree grows level by level. A node whose paths go on
    alike cannot branch any more: its templates end in those segments and it leaves the loop, so the number of levels is that of
    the deepest branching, not of the longest path, and later levels read open paths alone. Templates without labelled pages
    are never rejected.
    """
    leaves = labelled.groupBy("host", "raw").agg(F.count("bad").alias("labelled"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad"))
    tree = materialise(leaves, "templates").withColumn("template", F.lit(""))
    branch, level, ended = ["host", "template"], 0, []
    while True:
        tail = F.slice("raw", level + 1, F.greatest(F.size("raw") - level, F.lit(0)))
        here = tree.withColumn("_tail", tail).withColumn("_child", F.coalesce(F.get("raw", F.lit(level)), F.lit("")))
        # One row per branch below each node, with its share of bad pages.
        children = here.groupBy(*branch, "_child").agg(
            F.count(F.lit(1)).alias("c_n"), F.sum("labelled").alias("c_lab"), F.sum("bad").alias("c_bad"),
            F.min("_tail").alias("_low"), F.max("_tail").alias("_high"),
        )
        nodes = children.groupBy(*branch).agg(
            F.count(F.lit(1)).alias("n_children"),
            F.sum("c_n").alias("p_n"),
            F.sum("c_lab").alias("p_lab"),
            F.sum("c_bad").alias("p_bad"),
            (F.min("_low") == F.max("_high")).alias("_alike"),
        )
        both = children.join(nodes, branch)
        wild = (F.col("n_children") > max_children) & (F.col("n_children") >= F.col("p_n") * min_novelty)
        # Branch against its siblings: two proportions, pooled variance.
        o_lab, o_bad = F.col("p_lab") - F.col("c_lab"), F.col("p_bad") - F.col("c_bad")
        pooled = F.col("p_bad") / F.col("p_lab")
        spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("c_lab") + 1 / o_lab))
        difference = F.abs(F.col("c_bad") / F.col("c_lab") - o_bad / o_lab)
        similar = (F.col("c_lab") > 0) & (o_lab > 0) & (difference <= z_limit * spread)
        step = (
            F.when(F.col("_child") == "", F.lit(""))
            .when(wild | similar, F.lit("/*"))
            .otherwise(F.concat(F.lit("/"), F.col("_child")))
        )
        steps = both.select(*branch, "_child", step.alias("_step"), "_alike")
        grown = here.join(steps, [*branch, "_child"])
        over = F.col("_alike") | (F.size("raw") <= level)
        grown = grown.withColumn(
            "template", F.concat("template", F.when(F.col("_alike"), _literal(F.col("_tail"))).otherwise(F.col("_step")))
        ).select(*tree.columns, over.alias("_over"))
        grown = materialise(grown, "templates")  # every level reads the one before several times
        ended.append(grown.filter("_over").drop("_over"))
        tree = grown.filter("not _over").drop("_over")
        if not tree.limit(1).count():
            break
        level += 1
    tree = reduce(DataFrame.unionByName, ended)
    prior = tree.agg((F.sum("bad") + 1.0).alias("b"), (F.sum("labelled") + 2.0).alias("l")).select(
        (F.col("b") / F.col("l")).alias("prior")
    )
    templates = tree.groupBy("host", "template").agg(F.sum("labelled").alias("t_lab"), F.sum("bad").alias("t_bad"))
    scored = templates.crossJoin(F.broadcast(prior)).select(  # prior is one row
        "host",
        "template",
        ((F.col("t_bad") + strength * F.coalesce("prior", F.lit(0.5))) / (F.col("t_lab") + strength)).alias("purity"),
        (F.col("t_lab") > 0).alias("known"),
    )
    rejected = F.col("known") & (F.col("purity") >= threshold)
    return tree.join(scored, ["host", "template"]).select("host", "raw", "template", "purity", rejected.alias("rejected"))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    url: str = "url",
    key: str = "page_id",
    **tree: float,
) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, template, purity.

    Pages decided by a rule are the labelled examples (block is bad) from which templates of the other pages are judged.
    """
    host, path = url_parts(F.col(url))
    parsed = pages.select(F.col(key), host.alias("host"), path.alias("path")).withColumn(
        "_rule", fitting_rule(F.col("host"), F.col("path"), rules)
    )
    shaped = parsed.withColumn("raw", path_segments(F.col("path")))
    bad = F.when(F.col("_rule.action") == BLOCK, 1).when(F.col("_rule").isNotNull(), 0).cast("int")
    verdicts = materialise(template_verdicts(shaped.select("host", "raw", bad.alias("bad")), **tree), "verdicts")
    same = (shaped["host"] == verdicts["host"]) & (shaped["raw"] == verdicts["raw"])
    judged = shaped.join(verdicts.hint("shuffle_merge"), same, "left").select(
        key, shaped["host"], "path", "_rule", "template", "purity", "rejected"
    )
    return judged.select(
        key,
        "host",
        "path",
        F.concat("_rule.host", "_rule.path").alias("rule"),
        F.coalesce("_rule.action", F.when(F.col("rejected"), BLOCK).otherwise(ALLOW)).alias("verdict"),
        "template",
        "purity",
    )
