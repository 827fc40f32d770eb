"""URL filter by rules and by a tree of path templates with labelled purity.

Every host has a tree over the segments of its paths. A segment value stays
literal where it is frequent and its share of bad labels differs from that of
its parent; all other values are variable or alike and merge into ``*``, so a
branch below goes on with the merged parent. Levels go on while some branch has
enough rows with labels of both kinds; what lies deeper is one tail. The leaves
are templates. A template with labels is rejected when its share of bad ones,
smoothed towards that of its host, which is smoothed towards the whole, reaches
``reject``; without a label there is no evidence, and it is allowed. Labels come
from the rules: a url that a rule decides is a labelled example for its host's tree.

Only DataFrame functions run here; each level is one aggregation with map-side
combine and one salted join, so a host with a third of all urls is no single task.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolpulse.llm.common import LOWER, UPPER, lower_ascii, salted_join
from toolpulse.sources.durable import materialise


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TreeParams:
    min_rows: int = 5
    chi2: float = 3.84
    weight: float = 4.0  # pseudo-labels of the smoothing
    reject: float = 0.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
    return host & F.startswith(F.col("path"), F.lit(rule.path))


def apply_rules(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest rule that fits, else null.

    The rules are a short list given by hand; they are part of the plan.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        text = F.when(_fits(rule), F.lit(rule.text)).otherwise(text)
        verdict = F.when(_fits(rule), F.lit(rule.verdict)).otherwise(verdict)
    return urls.withColumns({"rule": text, "rule_verdict": verdict})


def judge_urls(pages: DataFrame, rules: list[Rule], params: TreeParams = TreeParams()) -> DataFrame:
    """page_id, host, path, rule, verdict, template and labels of the template, one row per input row.

    A null url and one without ``://`` has an empty host and path, which are
    judged like any other host. Repeated rows each count and each return. A null
    page_id stays null. No labels at all: nothing is rejected. Other columns are ignored.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = apply_rules(urls, rules).withColumns(
        {
            "bad": F.coalesce((F.col("rule_verdict") == "block").cast("int"), F.lit(0)),
            "labelled": F.col("rule_verdict").isNotNull().cast("int"),
            "parts": F.split("path", "/"),
            "prefix": F.lit(""),
        }
    )
    spread = F.struct("page_id", "path")
    level = 0
    while True:
        urls = materialise(urls.withColumn("part", F.get("parts", F.lit(level + 1))), "url-tree")
        children, parents = _branches(urls)
        if parents.where(_mixed(params)).isEmpty():
            break
        level += 1
        urls = salted_join(urls, _literals(children, parents, params), ["host", "prefix", "part"], spread).withColumn(
            "prefix",
            F.when(F.col("part").isNull(), F.col("prefix")).otherwise(
                F.concat("prefix", F.lit("/"), F.when(F.col("literal"), F.col("part")).otherwise("*"))
            ),
        ).drop("part", "literal")
    urls = urls.withColumn("template", F.concat("prefix", F.when(F.col("part").isNotNull(), "/**").otherwise(""))).drop("part")
    urls = materialise(urls.drop("parts", "prefix"), "url-templates")
    judged = salted_join(urls, _template_verdicts(urls, params), ["host", "template"], spread)
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        "template",
        "template_labels",
        "template_bad",
    )


def _branches(urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and labels by value of the level's segment, and of the branches that these values split."""
    columns = ("n", "labelled", "bad")
    filled = urls.where(F.col("part").isNotNull()).withColumn("n", F.lit(1))
    children = filled.groupBy("host", "prefix", "part").agg(*[F.sum(c).alias(c) for c in columns])
    children = materialise(children, "url-branches")
    return children, children.groupBy("host", "prefix").agg(*[F.sum(c).alias(f"all_{c}") for c in columns])


def _mixed(params: TreeParams) -> Column:
    """Branches that can be split: enough rows, and labels of both kinds."""
    return (F.col("all_n") >= params.min_rows) & (F.col("all_bad") > 0) & (F.col("all_bad") < F.col("all_labelled"))


def _literals(children: DataFrame, parents: DataFrame, params: TreeParams) -> DataFrame:
    """(host, prefix, part) of the values that keep a branch of their own."""
    # Values without labels or with few rows are out before the join.
    kept = children.where((F.col("n") >= params.min_rows) & (F.col("labelled") > 0))
    kept = kept.join(parents.where(_mixed(params)), ["host", "prefix"])
    rate, mean = F.col("bad") / F.col("labelled"), F.col("all_bad") / F.col("all_labelled")
    noise = mean * (1 - mean) * (1 / F.col("labelled") + 1 / F.col("all_labelled"))
    differs = (rate - mean) * (rate - mean) > params.chi2 * noise
    return kept.where(differs).select("host", "prefix", "part", F.lit(True).alias("literal"))


def _template_verdicts(urls: DataFrame, params: TreeParams) -> DataFrame:
    sums = [F.sum("labelled").alias("template_labels"), F.sum("bad").alias("template_bad")]
    templates = urls.groupBy("host", "template").agg(*sums)
    hosts = urls.groupBy("host").agg(F.sum("labelled").alias("host_labels"), F.sum("bad").alias("host_bad"))
    whole = urls.agg(F.sum("labelled").alias("labels"), F.sum("bad").alias("bad")).select(
        F.when(F.col("labels") > 0, F.col("bad") / F.col("labels")).otherwise(0.0).alias("prior")
    )  # one row
    w = F.lit(params.weight)
    hosts = hosts.join(F.broadcast(whole), how="cross").select(
        "host", ((F.col("host_bad") + w * F.col("prior")) / (F.col("host_labels") + w)).alias("host_rate")
    )
    rate = (F.col("template_bad") + w * F.col("host_rate")) / (F.col("template_labels") + w)
    judged = templates.join(hosts, "host").withColumn("rejected", (F.col("template_labels") > 0) & (rate >= params.reject))
    return judged.select("host", "template", "template_labels", "template_bad", "rejected")


def judge_sql(rules: list[Rule], params: TreeParams = TreeParams(), levels: int = 6) -> str:
    """The same in DuckDB SQL over the view ``pages``, for trees of at most ``levels`` levels."""
    rest = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN "
        for r in ordered
    ]
    texts = " ".join(f"{f}'{r.text}'" for f, r in zip(fits, ordered))
    verdicts = " ".join(f"{f}'{r.verdict}'" for f, r in zip(fits, ordered))
    steps = [
        f"""raw AS (SELECT page_id, {rest} AS rest FROM pages),
        cut AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM raw),
        ruled AS (SELECT *, CASE {texts} END AS rule, CASE {verdicts} END AS rule_verdict FROM cut),
        lab AS (SELECT *, coalesce((rule_verdict = 'block')::INT, 0) AS bad, (rule_verdict IS NOT NULL)::INT AS labelled,
          string_split(path, '/') AS parts FROM ruled),
        t0 AS (SELECT *, '' AS prefix, [''] AS prefixes FROM lab)"""
    ]
    for level in range(1, levels + 1):
        steps.append(
            f"""c{level} AS (SELECT host, prefix, parts[{level + 1}] AS part, count(*) AS n, sum(labelled) AS labelled,
              sum(bad) AS bad FROM t{level - 1} WHERE len(parts) > {level} GROUP BY ALL),
            p{level} AS (SELECT host, prefix, sum(n) AS all_n, sum(labelled) AS all_labelled, sum(bad) AS all_bad
              FROM c{level} GROUP BY ALL),
            l{level} AS (SELECT c.host, c.prefix, c.part FROM c{level} c JOIN p{level} p USING (host, prefix)
              WHERE c.n >= {params.min_rows} AND c.labelled > 0 AND all_bad > 0 AND all_bad < all_labelled
              AND (c.bad / c.labelled::DOUBLE - all_bad / all_labelled::DOUBLE) ** 2 > {params.chi2}::DOUBLE *
                ((all_bad / all_labelled::DOUBLE) * (1 - all_bad / all_labelled::DOUBLE)
                 * (1 / c.labelled::DOUBLE + 1 / all_labelled::DOUBLE))),
            n{level} AS (SELECT t.* EXCLUDE (prefix), CASE WHEN len(parts) <= {level} THEN t.prefix
              ELSE t.prefix || '/' || CASE WHEN l.part IS NULL THEN '*' ELSE l.part END END AS prefix
              FROM t{level - 1} t LEFT JOIN l{level} l
              ON t.host = l.host AND t.prefix = l.prefix AND t.parts[{level + 1}] = l.part),
            t{level} AS (SELECT * REPLACE (list_append(prefixes, prefix) AS prefixes) FROM n{level}),
            m{level} AS (SELECT count(*) > 0 AS mixed FROM p{level}
              WHERE all_n >= {params.min_rows} AND all_bad > 0 AND all_bad < all_labelled)"""
        )
    depth = "CASE " + " ".join(f"WHEN NOT (SELECT mixed FROM m{k}) THEN {k - 1}" for k in range(1, levels + 1)) + f" ELSE {levels} END"
    w = f"{params.weight}::DOUBLE"
    steps.append(
        f"""depth AS (SELECT {depth} AS d),
        leaf AS (SELECT *, prefixes[d + 1] || CASE WHEN len(parts) > d + 1 THEN '/**' ELSE '' END AS template
          FROM t{levels}, depth),
        prior AS (SELECT coalesce(sum(bad) / nullif(sum(labelled), 0)::DOUBLE, 0) AS p FROM leaf),
        hosts AS (SELECT host, (sum(bad) + {w} * any_value(p)) / (sum(labelled) + {w}) AS host_rate
          FROM leaf, prior GROUP BY host),
        temps AS (SELECT host, template, sum(labelled) AS template_labels, sum(bad) AS template_bad
          FROM leaf GROUP BY ALL)"""
    )
    return f"""WITH {", ".join(steps)}
      SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN template_labels > 0 AND (template_bad + {w} * host_rate)
        / (template_labels + {w}) >= {params.reject}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict, template,
        template_labels::BIGINT AS template_labels, template_bad::BIGINT AS template_bad
      FROM leaf JOIN temps USING (host, template) JOIN hosts USING (host)"""
