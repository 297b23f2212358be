"""URL filters: rules by host and path, and link-graph propagation for the pages that no rule judges. Native throughout.

A url's host is what stands between the first "://" and the next "/", "?", "#" or the end, with A-Z in lower case; its path
goes on to "?", "#" or the end. A rule fits its host and all hosts below it, if the path starts with the rule's;
of those that fit, the longest (host and path together, then the greater text) wins.

For the others, three scores spread over the links between hosts. Each host starts with mass one, in the shares of its
pages that rules allow (trust), block (distrust) and leave open (neutral). Trust and neutral mass are personalised
PageRanks along the links; distrust is one against the links, since who links to blocked hosts is suspect. A
distrusted host hands one share to each of its linkers, so these three rank hosts and judge none: the more linkers, the less each.

The verdict comes from a fourth score, suspicion, from 0 to 1: the share of a host's pages that rules block, and for
the share left open `damping` times the mean suspicion of the hosts that it links to, weighted by linking pages. It does not
depend on how many others link there. A host is blocked beyond `limit`, so a host with a few blocked pages, or few links
to blocked hosts among others, is not lost as a whole. A linked host without pages has only what reaches it.

Scale: pages are brought down to hosts and to host pairs before any join, with partial sums, so a hot host is one row.
Each step of the propagation is one join on hosts and one sum, written to the shared folder. Pages meet their
host's verdict in one join, salted if the hosts do not fit a broadcast.

Defined results: a null url, or one without "://", has an empty host and path, which no rule fits and no link
reaches: allowed. A null html has no links. Links of a host to itself do not count. Each page row is judged by itself,
repeated ids too; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postroad.llm.shared import lookup, written

DAMPING = 0.85
#: Only a guard: propagation that has not settled by then is an error.
STEPS = 1000
ENOUGH = 1e-4
LIMIT = 0.5
UPPER, LOWER = (("".join(map(chr, range(a, a + 26)))) for a in (65, 97))
LINK = "(?i)href\\s*=\\s*[\"']?(?:https?:)?//([^\"'\\s>/?#]+)"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): for each host, the rules of its own and of all hosts above it."""
    labels = F.split("host", "\\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    rule = F.struct(F.length(F.concat("of", "path")).alias("length"), F.concat("of", "path").alias("rule"), "path", "verdict")
    by_host = rules.select(F.col("host").alias("of"), F.col("path"), F.col("verdict")).distinct().select("of", rule.alias("rule"))
    fitting = hosts.select("host", F.explode(above).alias("of")).join(by_host, "of")
    return fitting.groupBy("host").agg(F.collect_list("rule").alias("rules"))


def edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): how many pages of a host link to another one. `pages` has host and html."""
    linked = F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), lambda h: F.translate(h, UPPER, LOWER))
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(F.array_distinct(linked)).alias("dst"))
    return links.where("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, steps: int = STEPS, enough: float = ENOUGH) -> DataFrame:
    """(kind, host, score): PageRanks from `seeds` (kind, host, mass), along the links, or against them for distrust; and suspicion.

    It ends when a step's change, summed up over all steps to come at this damping, is for no host more than `enough` of its score,
    or of what a host of mass one keeps of it if that is more (for suspicion, of 1). If `steps` steps are not enough, it is an error.
    """
    share = lambda end: links.groupBy(end).agg(F.sum("n").alias("of"))
    along = links.join(share("src"), "src").select(F.explode(F.array(F.lit("trust"), F.lit("neutral"))).alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), (F.col("n") / F.col("of")).alias("share"))
    against = links.join(share("dst"), "dst").select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), (F.col("n") / F.col("of")).alias("share"))
    # Each linker has the mean of its targets, for its pages that are left open.
    left_open = seeds.where("kind = 'neutral'").select(F.col("host").alias("src"), F.col("mass").alias("open"))
    suspect = links.join(share("src"), "src").join(left_open, "src").select(F.lit("suspicion").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), (F.col("open") * F.col("n") / F.col("of")).alias("share"))
    ways = written(along.union(against).union(suspect), "ways")
    total = seeds.agg(F.sum("mass").alias("all"))  # one row
    ranked = seeds.crossJoin(F.broadcast(total)).where("all > 0").select("kind", "host", (F.col("mass") / F.col("all")).alias("score"), ((1 - damping) * F.col("mass") / F.col("all")).alias("given"))
    blocked = seeds.where("kind = 'distrust'").select(F.lit("suspicion").alias("kind"), "host", F.col("mass").cast("double").alias("score"), F.col("mass").cast("double").alias("given"))
    start = written(ranked.union(blocked), "seeds")
    state = start.select("kind", "host", "score")
    if ways.isEmpty():
        return state
    own = (1 - damping) / (total.first()[0] or 1)
    for _ in range(steps):
        moved = ways.join(state, ["kind", "host"]).select("kind", F.col("to").alias("host"), (damping * F.col("share") * F.col("score")).alias("score"), F.lit(0.0).alias("old"))
        given = start.select("kind", "host", F.col("given").alias("score"), F.lit(0.0).alias("old"))
        before = state.select("kind", "host", F.lit(0.0).alias("score"), F.col("score").alias("old"))
        state = written(moved.union(given).union(before).groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("old").alias("old")), "ranks")
        floor = F.when(F.col("kind") == "suspicion", F.lit(1.0)).otherwise(F.lit(own))
        most = state.agg(F.max(F.abs(F.col("score") - F.col("old")) / F.greatest("score", floor))).first()[0] or 0.0
        state = state.select("kind", "host", "score")
        if most * damping <= enough * (1 - damping):
            return state
    raise RuntimeError(f"link scores have not settled after {steps} steps")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = ("page_id",), damping: float = DAMPING, steps: int = STEPS, limit: float = LIMIT) -> DataFrame:
    """The kept columns, host, path, rule (or null), verdict, and the host's trust, neutral, distrust and suspicion."""
    host, path = url_parts(F.col(url))
    parts = pages.select(F.struct(*keep).alias("kept"), host.alias("host"), path.alias("path"))
    by_host = parts.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    known = written(fitting_rules(by_host.select("host"), rules), "rules")
    best = F.array_max(F.filter(F.coalesce("rules", F.array()), lambda r: F.startswith(F.col("path"), r["path"])))
    ruled = lookup(parts, known, ["host"]).withColumn("best", best)
    verdict = F.col("best.verdict")
    kind = F.when(verdict == "allow", "trust").when(verdict == "block", "distrust").otherwise("neutral")
    judged = ruled.groupBy("host", kind.alias("kind")).agg(F.count(F.lit(1)).alias("some")).where("host <> ''")
    seeds = judged.join(by_host, "host").select("kind", "host", (F.col("some") / F.col("pages")).alias("mass"))
    links = written(edges(pages.select(host.alias("host"), F.col(html).alias("html"))), "links")
    ranks = propagate(links, seeds, damping, steps)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    hosts = ranks.groupBy("host").agg(of("trust"), of("neutral"), of("distrust"), of("suspicion"))
    table = written(hosts.join(known, "host", "full"), "hosts")
    rows = lookup(parts, table, ["host"]).withColumn("best", best)
    # Rounded, as sums of doubles depend on their order in the last digits.
    trust, neutral, distrust, suspicion = (F.coalesce(F.round(c, 9) if c == "suspicion" else F.col(c), F.lit(0.0)) for c in ("trust", "neutral", "distrust", "suspicion"))
    own = F.when(suspicion > limit, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("kept.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", own).alias("verdict"), trust.alias("trust"), neutral.alias("neutral"), distrust.alias("distrust"), suspicion.alias("suspicion"))
