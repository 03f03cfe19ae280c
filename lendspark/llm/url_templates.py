"""URL verdicts by rules and, beyond them, by a tree of path templates per host.

The pages that a rule decides are the labelled ones. The tree grows a level of path
segments at a time. In every branch, segments lose their digits, those that few pages
share become wildcards, and branches whose share of blocked pages does not differ from that
of their siblings merge into the wildcard too. A template's purity is its share of blocked
labelled pages, drawn towards its branch's, which is drawn towards its host's and that
towards all pages'; a template of high purity is rejected.

Everything is SQL functions. Pages fold to one row per host and shape of path first, so that
the tree costs what the hosts have of different shapes, not of pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm.common import table, written

RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
"""Fixed values: host, path and verdict of each rule of the contract."""

LEVELS = 4
"""Segments with a level of their own; what follows is one wildcard."""
LEAST_SHARE = 0.05
LEAST_PAGES = 3
"""A segment stays itself if it holds this share of its branch's pages, and so many at least."""
APART = 6.635
"""Squared standard score from which a branch differs from its siblings (1 % level)."""
WEIGHT = 5.0
"""Labelled pages that the purity of the branch above counts as."""
PURE = 0.8
"""Purity from which a template is rejected."""


def _lower(host: Column) -> Column:
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null or a URL without ``://``."""
    place = F.locate("://", url)
    rest = F.when(place > 0, F.substr(url, place + 3)).otherwise(F.lit(""))
    rest = F.regexp_replace(F.coalesce(rest, F.lit("")), r"(?s)[?#].*", "")
    return _lower(F.substring_index(rest, "/", 1)), F.regexp_replace(rest, r"(?s)^[^/]*", "")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path in one text, and its verdict; null if none does.

    Of rules of equal length the one with the longer host wins. The rules become part of
    the plan, so their number is one of a configuration.
    """
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, decision in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def _segments(path: Column) -> list[Column]:
    """Shape of each level, with the slash before it, and the wildcard for what follows; empty where the path ends."""
    shape = F.regexp_replace(path, "[0-9]+", "{n}")
    parts = F.split(shape, "/")
    levels = [F.coalesce(F.concat(F.lit("/"), F.get(parts, F.lit(d))), F.lit("")) for d in range(1, LEVELS + 1)]
    return [*levels, F.when(F.size(parts) > LEVELS + 1, "/**").otherwise("")]


def judged(pages: DataFrame, rules=RULES, label: Column | None = None) -> DataFrame:
    """Each page with its URL's parts, rule and label (1 blocked, 0 allowed, null unknown).

    ``label`` may tell more pages apart; a rule goes before it.
    """
    parts = pages.select(
        "page_id", "url", (F.lit(None) if label is None else label).cast("int").alias("known")
    )
    host, path = split_url(F.col("url"))
    parts = parts.select("page_id", host.alias("host"), path.alias("path"), "known")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    blocked = F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0).otherwise(F.col("known"))
    shapes = _segments(F.col("path"))
    return parts.withColumns({"rule": rule, "ruled": verdict}).select(
        "page_id", "host", "path", "rule", "ruled", blocked.alias("blocked"),
        *(s.alias(f"s{d}") for d, s in enumerate(shapes, 1)),
    )


SHAPE = [f"s{d}" for d in range(1, LEVELS + 2)]


def _sums(n: str = "n") -> list[Column]:
    return [F.sum(c).alias(c) for c in (n, "labelled", "bad")]


def _purity(above: Column) -> Column:
    return (F.col("bad") + WEIGHT * above) / (F.col("labelled") + WEIGHT)


def templates(leaves: DataFrame) -> DataFrame:
    """Template and purity of each host and shape of path.

    ``leaves`` counts pages (``n``), labelled and ``bad`` ones per host and shape.
    """
    everywhere = leaves.agg(
        F.coalesce((F.sum("bad") + 0.5) / (F.sum("labelled") + 1.0), F.lit(0.5)).alias("above")
    ).scalar()
    hosts = leaves.groupBy("host").agg(*_sums()).select(
        "host", F.lit("").alias("template"), _purity(everywhere).alias("purity")
    )
    tree = leaves.join(hosts, "host")
    for d in range(1, LEVELS + 1):
        segment = f"s{d}"
        children = tree.groupBy("host", "template", segment).agg(*_sums(), F.first("purity").alias("above"))
        branch = children.groupBy("host", "template").agg(
            F.sum("n").alias("all_n"), F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad")
        )
        # Squared standard score of the difference between a branch and its siblings together,
        # multiplied out: without labels on either side nothing differs.
        n, labelled, bad = (F.col(c) for c in ("n", "labelled", "bad"))
        all_labelled, all_bad = F.col("all_labelled").cast("double"), F.col("all_bad").cast("double")
        others, others_bad = all_labelled - labelled, all_bad - bad
        gap = bad * others - others_bad * labelled
        apart = gap * gap * all_labelled > APART * (all_bad * (all_labelled - all_bad) * labelled * others)
        common = (n >= LEAST_PAGES) & (n >= LEAST_SHARE * F.col("all_n"))
        # Where nothing is labelled there is nothing to compare, and common segments stay.
        stays = (F.col(segment) == "") | (common & (apart | (all_labelled == 0)))
        token = F.when(stays, F.col(segment)).otherwise("/*")
        # A wildcard that takes in one shape only says more as that shape.
        named = children.join(branch, ["host", "template"]).select(
            "host", "template", segment, token.alias("token"), "n", "labelled", "bad", "above", common.alias("common")
        )
        merged = named.groupBy("host", "template", "token").agg(
            *_sums(), F.first("above").alias("above"), F.count(F.lit(1)).alias("shapes"),
            F.min(segment).alias("only"), F.min("common").alias("sure"),
        )
        merged = merged.select(
            "host", "template", "token", _purity(F.col("above")).alias("below"),
            F.when((F.col("shapes") == 1) & F.col("sure"), F.col("only")).otherwise(F.col("token")).alias("shown"),
        )
        steps = named.select("host", "template", segment, "token").join(merged, ["host", "template", "token"])
        steps = steps.select("host", "template", segment, "shown", "below")
        tree = tree.join(steps, ["host", "template", segment]).select(
            "host", *SHAPE, "n", "labelled", "bad", F.concat("template", "shown").alias("template"),
            # A path that ended higher up has no level here.
            F.when(F.col(segment) == "", F.col("purity")).otherwise(F.col("below")).alias("purity"),
        )
        tree = written(tree, "templates")
    return tree.select("host", *SHAPE, F.concat("template", f"s{LEVELS + 1}").alias("template"), "purity")


def judge_urls(pages: DataFrame, rules=RULES, label: Column | None = None) -> DataFrame:
    """Host, path, rule, verdict, template and purity of every page.

    A rule fits its host and the host's subdomains where the path starts with the rule's; the
    longest decides. Other pages are blocked if their template's purity is ``PURE`` or more.
    A null URL, or one without ``://``, has an empty host and path and is judged like any
    other host. One row per input row, null and repeated ids included; an empty table
    gives none. Columns other than ``page_id`` and ``url`` are only seen by ``label``.
    """
    parts = judged(pages, rules, label)
    leaves = parts.groupBy("host", *SHAPE).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("blocked").alias("labelled"),
        F.coalesce(F.sum("blocked"), F.lit(0)).alias("bad"),
    )
    tree = templates(written(leaves, "shapes"))
    verdict = F.coalesce("ruled", F.when(F.col("purity") >= PURE, "block").otherwise("allow"))
    return parts.join(tree, ["host", *SHAPE], "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity"
    )


def op13_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by the contract's rules and the templates learnt from what they decide."""
    return judge_urls(table(spark, sf_dir, "pages")).drop("purity")


def _level_sql(d: int) -> str:
    s, before = f"s{d}", f"t{d - 1}"
    key, counts = "host, template", "sum(n) AS n, sum(labelled) AS labelled, sum(bad) AS bad"
    return f"""
    c{d} AS (SELECT {key}, {s}, {counts}, min(purity) AS above FROM {before} GROUP BY ALL),
    b{d} AS (SELECT {key}, sum(n) AS all_n, sum(labelled) AS all_labelled, sum(bad) AS all_bad FROM c{d} GROUP BY ALL),
    g{d} AS (SELECT c{d}.*, all_labelled::DOUBLE AS al, all_bad::DOUBLE AS ab,
                    n >= {LEAST_PAGES} AND n >= {LEAST_SHARE}::DOUBLE * all_n AS common
             FROM c{d} JOIN b{d} USING ({key})),
    h{d} AS (SELECT *, bad * (al - labelled) - (ab - bad) * labelled AS gap FROM g{d}),
    n{d} AS (SELECT *, CASE WHEN {s} = '' OR (common AND (al = 0 OR
                            gap * gap * al > {APART}::DOUBLE * (ab * (al - ab) * labelled * (al - labelled))))
                            THEN {s} ELSE '/*' END AS token FROM h{d}),
    m{d} AS (SELECT {key}, token, (sum(bad) + {WEIGHT}::DOUBLE * min(above)) / (sum(labelled) + {WEIGHT}::DOUBLE) AS below,
                    CASE WHEN count(*) = 1 AND bool_and(common) THEN min({s}) ELSE token END AS shown
             FROM n{d} GROUP BY {key}, token),
    t{d} AS (SELECT t.host, {", ".join("t." + x for x in SHAPE)}, t.n, t.labelled, t.bad,
                    t.template || m.shown AS template,
                    CASE WHEN t.{s} = '' THEN t.purity ELSE m.below END AS purity
             FROM {before} t JOIN n{d} x ON t.host = x.host AND t.template = x.template AND t.{s} = x.{s}
             JOIN m{d} m ON x.host = m.host AND x.template = m.template AND x.token = m.token),"""


def _rules_sql(value) -> str:
    ordered = sorted(RULES, key=lambda r: (len(r[0] + r[1]), len(r[0]), r), reverse=True)
    fits = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    return "CASE " + " ".join(f"WHEN {fits.format(*r)} THEN '{value(r)}'" for r in ordered) + " END"


_DEEPER = ", ".join(
    f"CASE WHEN len(parts) > {d} THEN '/' || parts[{d + 1}] ELSE '' END AS s{d}" for d in range(1, LEVELS + 1)
)
OP13_SQL = f"""
    WITH cut AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_replace(
                   substr(url, strpos(url, '://') + 3), '[?#].*', '', 's') ELSE '' END AS rest
        FROM pages),
    parts AS (
        SELECT page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host, regexp_replace(rest, '^[^/]*', '', 's') AS path
        FROM cut),
    ruled AS (
        SELECT *, {_rules_sql(lambda r: r[0] + r[1])} AS rule, {_rules_sql(lambda r: r[2])} AS ruled,
               string_split(regexp_replace(path, '[0-9]+', '{{n}}', 'g'), '/') AS parts
        FROM parts),
    shaped AS (
        SELECT *, {_DEEPER}, CASE WHEN len(parts) > {LEVELS + 1} THEN '/**' ELSE '' END AS s{LEVELS + 1} FROM ruled),
    leaves AS (
        SELECT host, {", ".join(SHAPE)}, count(*) AS n, count(ruled) AS labelled,
               count(*) FILTER (ruled = 'block') AS bad
        FROM shaped GROUP BY ALL),
    hosts AS (
        SELECT host, (sum(bad) + {WEIGHT}::DOUBLE * (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(labelled) + 1.0::DOUBLE)
                      FROM leaves)) / (sum(labelled) + {WEIGHT}::DOUBLE) AS purity
        FROM leaves GROUP BY host),
    t0 AS (SELECT leaves.*, '' AS template, purity FROM leaves JOIN hosts USING (host)),
    {"".join(_level_sql(d) for d in range(1, LEVELS + 1))}
    done AS (SELECT * EXCLUDE (template), template || s{LEVELS + 1} AS template FROM t{LEVELS})
    SELECT page_id, host, path, rule,
           coalesce(ruled, CASE WHEN purity >= {PURE} THEN 'block' ELSE 'allow' END) AS verdict, template
    FROM shaped JOIN done USING (host, {", ".join(SHAPE)})"""
