"""Operator 10: URL rules, and trust and distrust over the host graph for the rest.

* A url's host and path are cut by expressions.  The longest rule that fits
  (its host or a subdomain of it, and a path that starts with the rule's) decides.
* Rules seed the host graph: a host's trusted seed is its number of pages an
  allow rule takes, its distrusted seed that of block rules.  Host edges are
  the links of the pages' html to other hosts, weighted by their number and
  summed before the shuffle.
* Personalised PageRank: trust flows along the links, distrust against them
  (who links to bad hosts is suspect), each with ``DAMPING``; one join and one
  aggregate a round, cut into a table in the shared folder every ``CUT_EVERY`` rounds.
* A mass is a mantissa and a power of two, so however thin it gets on long ways through
  hosts with many links, it is no zero.  As long as all masses are above 2^``LEAST`` they are summed as plain
  doubles; below, as partial sums per host and span of ``SPAN`` powers (a hot host is a row per task
  and span), of which the two highest are the host's mass.
* Rounds go on until no host's mass grew by more than ``SETTLED`` of itself in the
  last one.  A host that is reached for the first time grew by all of its mass,
  so every host that trust or distrust can reach has it, however far away; the
  largest such share never rises from one round to the next.  That takes at most as many rounds as there are
  hosts to reach the last of them, and then some 160 for the damping to make all growth small.
* A host is blocked if its distrust exceeds ``THRESHOLD`` times its trust; a host
  that nothing reaches is allowed.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule
and the verdict allow.  Null html has no links.  Repeated rows each count and
each get a row.  No pages: no rows.  Rules of equal length: the longer host, then
the earlier rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.exact_dedup import normalise
from tessera.llm.shared import drop_table, materialize

#: (verdict, host, path): fixed values of the job.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ROUNDS = 200  # of the SQL, which does not stop by itself: damping leaves less than SETTLED after 160
SETTLED = 1e-11
SPAN = 512
LEAST = -900
CUT_EVERY = 5
DAMPING = 0.85
THRESHOLD = 1.0 + 1e-9

#: Absolute and protocol-relative link targets.
LINK = r"""(?i)href[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?[\x20\x09-\x0D]*((?:[a-z][a-z0-9+.-]*:)?//[^"'>\x20\x09-\x0D]+)"""


def host_of(url: Column) -> Column:
    return normalise(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    listed = F.array(*[F.struct(
        F.lit(len(h + p)).alias("len"), F.lit(len(h)).alias("host_len"), F.lit(-i).alias("late"), F.lit(h).alias("host"),
        F.lit("." + h).alias("tail"), F.lit(p).alias("path"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))
        for i, (v, h, p) in enumerate(rules)])
    fits = F.filter(listed, lambda r: ((host == r["host"]) | F.endswith(host, r["tail"])) & F.startswith(path, r["path"]))
    best = F.array_max(fits)
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def judge_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, by_rule (verdict or null)."""
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    got = matching_rule(F.col("host"), F.col("path"), rules)
    return cut.withColumn("m", got).select("page_id", "host", "path", F.col("m.rule").alias("rule"), F.col("m.verdict").alias("by_rule"))


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, links: links between different hosts."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("link"))
    return (links.select("src", normalise(F.regexp_extract("link", r"//([^/?#]*)", 1)).alias("dst"))
            .where("src <> '' and dst <> '' and src <> dst")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links")))


def _scaled(m: Column, by: Column) -> Column:
    """m * 2^by, where by is kept in the range of a double (beyond it the rest is nothing, or everything)."""
    return m * F.pow(F.lit(2.0), F.greatest(F.least(by, F.lit(1000)), F.lit(-1000)).cast("double"))


def _normal(df: DataFrame, x: Column, e: Column, *keep: Column | str) -> DataFrame:
    """x * 2^e -> columns m (about 1 to 2) and e."""
    up = F.floor(F.log2("_x")).cast("long")
    wide = df.select(*keep, x.alias("_x"), e.cast("long").alias("_e"))
    return wide.select(*wide.columns[:-2], _scaled(F.col("_x"), -up).alias("m"), (F.col("_e") + up).alias("e"))


def _summed(rows: DataFrame, thin: bool) -> DataFrame:
    """Rows host, kind, m, e -> one per host and kind.  Not ``thin``: all masses are well inside a double's range."""
    if not thin:
        plain = rows.groupBy("host", "kind").agg(F.sum(_scaled(F.col("m"), F.col("e"))).alias("m"))
        return plain.withColumn("e", F.lit(0).cast("long"))
    span = F.floor(F.col("e") / SPAN)
    parts = (rows.select("host", "kind", span.alias("span"), _scaled(F.col("m"), F.col("e") - span * SPAN).alias("x"))
             .groupBy("host", "kind", "span").agg(F.sum("x").alias("x")))
    top = parts.groupBy("host", "kind").agg(F.sort_array(F.collect_list(F.struct("span", "x")), asc=False).alias("s"))   # one per span
    next_ = F.when(F.try_element_at("s", F.lit(2))["span"] == F.col("s")[0]["span"] - 1, F.try_element_at("s", F.lit(2))["x"]).otherwise(0.0)
    total = F.col("s")[0]["x"] + next_ * F.lit(2.0 ** -SPAN)
    return _normal(top, total, F.col("s")[0]["span"] * SPAN, "host", "kind")


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int | None = None, damping: float = DAMPING) -> DataFrame:
    """seeds(host, kind, mass), edges(src, dst, links) -> host, kind, m, e (mass m * 2^e); kind 0 trust, 1 distrust.

    ``rounds`` None: until the masses have settled.
    """
    edges = materialize(edges, "host-edges")
    seeds = materialize(seeds, "seeds")
    base = _normal(seeds, F.col("mass") * (1 - damping), F.lit(0), "host", "kind")
    if edges.isEmpty():
        return base

    def flow(a: str, b: str, kind: int) -> DataFrame:
        out = edges.groupBy(a).agg(F.sum("links").alias("all"))
        return edges.join(out, a).select(F.col(a).alias("host"), F.lit(kind).alias("kind"), F.col(b).alias("to"),
                                         (F.col("links") * damping / F.col("all")).alias("part"))
    flows = materialize(flow("src", "dst", 0).unionByName(flow("dst", "src", 1)), "flows")
    step = flows.agg(F.min(F.log2("part"))).first()[0]                       # powers of two that one round may take away
    least = base.agg(F.min(F.log2("m") + F.col("e"))).first()[0] or 0.0
    state, old, i = base, None, 0
    while rounds is None or i < rounds:
        thin = least + CUT_EVERY * step < LEAST
        i += 1
        before = state
        moved = state.join(flows, ["host", "kind"])
        x, to = F.col("m") * F.col("part"), F.col("to").alias("host")
        moved = _normal(moved, x, F.col("e"), to, "kind") if thin else moved.select(to, "kind", x.alias("m"), "e")
        state = _summed(base.unionByName(moved), thin)
        if i % CUT_EVERY == 0 or i == rounds:
            last = before.select("host", "kind", F.col("m").alias("wm"), F.col("e").alias("we"))
            table = materialize(state.join(last, ["host", "kind"], "left"), "trust")
            if old is not None:
                drop_table(old)
            state, old = table.drop("wm", "we"), table
            grew, least = _grown(table)
            if rounds is None and grew <= SETTLED:
                return state
    return state


def _grown(state: DataFrame) -> tuple[float, float]:
    """state(host, kind, m, e, wm, we) -> the largest share of itself by which a mass grew in the last round, and the least mass's power of two."""
    was = F.coalesce(_scaled(F.col("wm") / F.col("m"), F.col("we") - F.col("e")), F.lit(0.0))
    got = state.agg(F.max(1 - was), F.min(F.log2("m") + F.col("e"))).first()
    return got[0] or 0.0, got[1] or 0.0


def host_verdicts(pages: DataFrame, judged: DataFrame, rounds: int | None = None) -> DataFrame:
    """host, blocked for every host that trust or distrust reaches (in ``rounds``; None: in the end)."""
    kind = F.when(F.col("by_rule") == "allow", 0).when(F.col("by_rule") == "block", 1)
    seeds = (judged.where("by_rule is not null and host <> ''").groupBy("host", kind.alias("kind"))
             .agg(F.count(F.lit(1)).cast("double").alias("mass")))
    mass = propagate(seeds, host_edges(pages), rounds)
    side = lambda k, c: F.max(F.when(F.col("kind") == k, F.col(c)))  # noqa: E731 - one row per host and kind
    both = mass.groupBy("host").agg(side(0, "m").alias("tm"), side(0, "e").alias("te"), side(1, "m").alias("dm"), side(1, "e").alias("de"))
    more = _scaled(F.col("dm") / F.col("tm"), F.col("de") - F.col("te")) > THRESHOLD
    return both.withColumn("blocked", F.col("dm").isNotNull() & (F.col("tm").isNull() | F.coalesce(more, F.lit(False))))


def judge_urls(pages: DataFrame, rules=RULES, rounds: int | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    judged = judge_by_rules(pages, rules)
    blocked = host_verdicts(pages, judged, rounds).where("blocked").select("host", "blocked")
    return judged.join(blocked, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
