"""URL rules, and trust and distrust spread over the links between hosts.

Hosts are judged by personalised PageRank: trust starts at hosts with pages that a rule
allows and follows links; distrust starts at hosts with pages that a rule blocks and goes
against the links, to who links there. Pages that no rule fits get their host's verdict:
blocked if the host has more distrust than trust, each counted per page of the host.

Edges are hyperlinks of the pages to other hosts, and between a host and its parent host
if that has pages too. Everything is joins and sums by host; a host's links are
counted, partially in each task, before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewinnow.llm.common import materialise, measured, read

RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
DAMPING = 0.85
ROUNDS = 10  # of the oracle, whose fixture has no long paths
TOLERANCE = 1e-6  # change of a rank by a round, as a share of it, that is no change
_CUT = 5  # rounds between checkpoints
# A link with a host of its own, in an attribute of any quoting. Blanks are taken possessively: as
# many as there are, and never fewer, so that a page of blanks takes time linear in its length.
LINK = r"""(?i)href\s*+=\s*+["']?+\s*+(?:https?:)?+//([^/?#"'\s<>]++)"""
TIE = 1e-9  # share of trust by which distrust must be more: sums of doubles have no fixed order
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without one."""
    found = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(found), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls without one."""

    def first(value: int) -> Column:
        found = []
        for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
            name, _, rest = rule.partition("/")
            fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
            found.append(F.when(fits, F.lit((verdict, rule)[value])))
        return F.coalesce(*found, F.lit(None).cast("string"))

    return first(1), first(0)


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """src, dst, weight (share of what leaves src) between ``hosts`` (host)."""
    targets = F.array_distinct(
        F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lower_ascii)
    )
    linked = pages.select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
    linked = linked.groupBy("src", "dst").agg(F.count("*").alias("n"))
    parent = F.regexp_extract("host", r"^[^.]+\.(.+)$", 1)
    family = hosts.select(F.col("host").alias("src"), parent.alias("dst"))
    family = family.union(family.select("dst", "src")).withColumn("n", F.lit(1).cast("long"))
    known = measured(hosts.select(F.col("host").alias("of")), F.octet_length("of") + 32)
    edges = linked.union(family).where((F.col("src") != F.col("dst")) & (F.col("dst") != ""))
    edges = (
        edges.join(known, F.col("src") == F.col("of"), "left_semi")
        .join(known, F.col("dst") == F.col("of"), "left_semi")
        .groupBy("src", "dst")
        .agg(F.sum("n").alias("n"))
    )
    return materialise(edges)


def shares(edges: DataFrame, start: str, end: str) -> DataFrame:
    """start, end, share: what an edge carries of its start."""
    total = edges.groupBy(F.col(start).alias("of")).agg(F.sum("n").alias("all"))
    return edges.join(total, F.col(start) == F.col("of")).select(
        F.col(start).alias("start"), F.col(end).alias("end"), (F.col("n") / F.col("all")).alias("share")
    )


def propagate(seeds: DataFrame, carried: DataFrame) -> DataFrame:
    """kind, host, rank: personalised PageRank of each kind. ``seeds`` (kind, host, seed) has
    every host; what a host without edges holds goes nowhere, so ranks need not add up to one.

    Rounds go on until none changes any host's rank by more than ``TOLERANCE`` of it; a host
    that is newly reached changes by all of its rank, so however long the paths are, ranks
    come to the end of them. Each round takes up to 0.85 of the change before it."""
    ranks = seeds.select("kind", "host", F.col("seed").alias("rank"), "seed")
    source = carried.withColumnRenamed("kind", "of")
    while True:
        for _ in range(_CUT):
            given = ranks.select(F.col("kind").alias("by"), F.col("host").alias("from"), "rank")
            flow = (
                source.join(given, (F.col("of") == F.col("by")) & (F.col("start") == F.col("from")))
                .groupBy(F.col("of").alias("to_kind"), F.col("end").alias("to"))
                .agg(F.sum(F.col("rank") * F.col("share")).alias("flow"))
            )
            arrived = F.coalesce("flow", F.lit(0.0)) * DAMPING
            joined = (F.col("kind") == F.col("to_kind")) & (F.col("host") == F.col("to"))
            ranks = ranks.join(flow, joined, "left").select(
                "kind", "host", (F.col("seed") * (1 - DAMPING) + arrived).alias("rank"), "seed",
                F.col("rank").alias("before"),
            )
        ranks = materialise(ranks)
        changed = F.abs(F.col("rank") - F.col("before")) > TOLERANCE * F.col("rank")
        if ranks.where(changed).isEmpty():
            return ranks.select("kind", "host", "rank")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for each row of ``pages``
    (page_id, url, html).

    A url that is null or has no ``://`` has an empty host and path, fits no rule, has no
    links and is allowed, as is a host that neither trust nor distrust reaches, and one where
    both are equal but for ``TIE``. Null or
    empty html has no links; a page counts a host it links to once. Repeated page_ids are
    pages of their own. An empty table gives no rows. Other columns are not read.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumn("rule", rule).withColumn("of_rule", verdict)
    counted = materialise(
        ruled.where(F.col("host") != "")
        .groupBy("host")
        .agg(
            F.count("*").alias("pages"),
            F.count(F.when(F.col("of_rule") == "allow", 1)).alias("allowed"),
            F.count(F.when(F.col("of_rule") == "block", 1)).alias("blocked"),
        )
    )
    edges = host_edges(pages.select(host.alias("host"), "html").where(F.col("host") != ""), counted)
    sums = counted.agg(F.sum("allowed"), F.sum("blocked")).first()

    def seeded(kind: str, count: str, total: int | None) -> DataFrame:
        seed = F.col(count) / F.lit(float(total or 1))
        return counted.select(F.lit(kind).alias("kind"), "host", seed.alias("seed"))

    seeds = seeded("trust", "allowed", sums[0]).union(seeded("distrust", "blocked", sums[1]))
    forth = shares(edges, "src", "dst").withColumn("kind", F.lit("trust"))
    back = shares(edges, "dst", "src").withColumn("kind", F.lit("distrust"))
    ranks = propagate(seeds, materialise(forth.union(back)))

    def rank_of(kind: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col("rank"))).alias(kind)

    judged = materialise(
        ranks.groupBy(F.col("host").alias("of")).agg(rank_of("trust"), rank_of("distrust"))
    )
    small = measured(judged, F.octet_length("of") + 48)
    blocked = F.coalesce(F.col("distrust") > F.col("trust") * (1 + TIE), F.lit(False))
    of_host = F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.join(small, F.col("host") == F.col("of"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("of_rule", of_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op9_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def oracle() -> str:
    """The same by self-contained SQL, each round of propagation a common table expression."""
    ordered = sorted(RULES, key=lambda r: -len(r[1]))

    def case(value: int) -> str:
        whens = []
        for item in ordered:
            name, _, rest = item[1].partition("/")
            whens.append(
                f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) "
                f"AND starts_with(path, '/{rest}') THEN '{item[value]}'"
            )
        return f"CASE {' '.join(whens)} END"

    link = r"""(?i)href\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s<>]+)"""
    upper, lower = _UPPER, _LOWER
    steps = [
        f"""parts AS (SELECT page_id, html,
  translate(COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{upper}', '{lower}') AS host,
  COALESCE(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)""",
        f"ruled AS (SELECT page_id, host, path, {case(1)} AS rule, {case(0)} AS of_rule FROM parts)",
        """counted AS (SELECT host, COUNT(*) FILTER (WHERE of_rule = 'allow') AS allowed,
  COUNT(*) FILTER (WHERE of_rule = 'block') AS blocked FROM ruled WHERE host <> '' GROUP BY host)""",
        f"""links AS (SELECT DISTINCT page_id, host AS src, translate(target, '{upper}', '{lower}') AS dst
  FROM (SELECT page_id, host, unnest(regexp_extract_all(html, '{link}', 1)) AS target
        FROM parts WHERE host <> '') x)""",
        r"""family AS (SELECT host AS src, regexp_extract(host, '^[^.]+\.(.+)$', 1) AS dst FROM counted)""",
        """edges AS (SELECT src, dst, SUM(n) AS n FROM (
  SELECT src, dst, 1 AS n FROM links UNION ALL SELECT src, dst, 1 FROM family
  UNION ALL SELECT dst, src, 1 FROM family) x
  WHERE src <> dst AND src IN (SELECT host FROM counted) AND dst IN (SELECT host FROM counted)
  GROUP BY src, dst)""",
        """forth AS (SELECT src AS a, dst AS b, CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY src) AS share
  FROM edges)""",
        """back AS (SELECT dst AS a, src AS b, CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY dst) AS share
  FROM edges)""",
    ]
    for name, column, edges in (("t", "allowed", "forth"), ("d", "blocked", "back")):
        steps.append(
            f"{name}0 AS (SELECT host, CAST({column} AS DOUBLE) / "
            f"greatest(1, SUM({column}) OVER ()) AS seed, CAST({column} AS DOUBLE) / "
            f"greatest(1, SUM({column}) OVER ()) AS rnk FROM counted)"
        )
        for i in range(ROUNDS):
            steps.append(
                f"{name}{i + 1} AS (SELECT r.host, r.seed, r.seed * {1 - DAMPING} + "
                f"{DAMPING} * COALESCE(f.flow, 0) AS rnk FROM {name}{i} r LEFT JOIN "
                f"(SELECT e.b, SUM(x.rnk * e.share) AS flow FROM {edges} e JOIN {name}{i} x "
                f"ON x.host = e.a GROUP BY e.b) f ON f.b = r.host)"
            )
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT page_id, r.host, r.path, r.rule, "
        "COALESCE(of_rule, CASE WHEN d.rnk > t.rnk "
        f"* (1 + {TIE}) THEN 'block' ELSE 'allow' END) AS verdict "
        f"FROM ruled r LEFT JOIN t{ROUNDS} t ON t.host = r.host "
        f"LEFT JOIN d{ROUNDS} d ON d.host = r.host"
    )
