"""URL filters: rules by host and path, and for the rest trust and distrust carried along links between hosts.

DataFrame functions only. Trust flows from hosts with allowed pages along links, distrust from hosts with blocked pages
against them (who links to a bad host is suspect), both as personalised PageRank. Mass is counted in whole units, so
results do not depend on the order of additions.
"""

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import Rounds, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: All the mass of each kind, in units: so many that what whole-number division loses is far below the mean of a host, for
#: up to 10^9 hosts.
MASS = 10**17
#: Per cent of a host's mass that goes on along its links; the rest starts anew at the seeds.
FOLLOWED = 85

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'<>\s]+)"""


def host(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, A-Z in lower case; empty without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ? or #."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule(own_host: Column, own_path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does.

    A rule's text is a host and a path from its first slash on. It fits the host and all its subdomains where the path
    starts with the rule's.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, text in sorted(rules, key=lambda one: (len(one[1]), one[1])):
        name, slash, rest = text.partition("/")
        fits = ((own_host == name) | own_host.endswith(f".{name}")) & own_path.startswith(slash + rest)
        chosen = F.when(fits, F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target): each pair of different hosts once, if a page of the one has an absolute link to the other."""
    found = F.when(F.col(html).contains("//"), F.regexp_extract_all(html, F.lit(_LINK), 1))
    links = pages.select(host(F.col(url)).alias("source"), F.explode(F.array_distinct(found)).alias("target"))
    links = links.select("source", F.translate("target", UPPER, LOWER).alias("target"))
    return links.filter("source <> target AND source <> '' AND target <> ''").distinct()


def _seeded(hosts: DataFrame, kind: str) -> Column:
    """The start mass of each host: its share of all pages of a kind."""
    total = hosts.agg(F.sum(kind)).first()[0] or 0
    return F.floor(F.col(kind) * F.lit(MASS // max(total, 1))).cast("long")


def _threshold(n_hosts: int, share: float) -> int:
    """`share` per cent of the mean mass of a host."""
    return int(Fraction(share) * MASS / (100 * max(n_hosts, 1)))


def spread(hosts: DataFrame, links: DataFrame, share: float = 10, rounds: int = 400) -> DataFrame:
    """(host, trust, distrust, trust_seed, distrust_seed) of every host that is in `hosts` or has links.

    `hosts` has host, allowed and blocked (numbers of pages). A host's mass is shared evenly among the hosts it links
    to, distrust among those that link to it; what a host without such links would pass on is dropped.

    Each round 85% of what has changed goes on, so what can still come to any host is at most 85/15 of all change. Rounds end
    when that is under a hundredth of `share` per cent of the mean mass of a host: however many hosts there are, nothing
    that comes later can matter by that measure. The number of rounds grows with the logarithm of the number of hosts (about
    60 for a hundred, 140 for 10^7); mass that has not settled after `rounds` is an error. Each round is written to the
    shared folder, and removed after the next.
    """
    out = links.groupBy("source").agg(F.count(F.lit(1)).alias("out"))
    into = links.groupBy("target").agg(F.count(F.lit(1)).alias("into"))
    edges = written(links.join(out, "source").join(into, "target"), "host-links")
    named = edges.select(F.col("source").alias("host")).union(edges.select("target")).distinct()
    every = named.join(hosts, "host", "full").na.fill(0, ["allowed", "blocked"])
    every = every.select("host", _seeded(hosts, "allowed").alias("trust_seed"), _seeded(hosts, "blocked").alias("distrust_seed"))
    tables = Rounds(hosts.sparkSession, "host-mass")
    state = tables.written(every.withColumns({"trust": F.col("trust_seed"), "distrust": F.col("distrust_seed")}))
    n_hosts = state.count()
    for _ in range(rounds):
        trust = edges.join(state, edges["source"] == state["host"]).select(
            F.col("target").alias("host"), F.expr("trust DIV out").alias("trust"), F.lit(0).cast("long").alias("distrust")
        )
        distrust = edges.join(state, edges["target"] == state["host"]).select(
            F.col("source").alias("host"), F.lit(0).cast("long").alias("trust"), F.expr("distrust DIV into").alias("distrust")
        )
        moved = trust.union(distrust).groupBy("host").agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d"))
        # A host may hold nearly all mass: the factors come after the division, the rest of which counts too.
        new = {
            name: F.expr(
                f"{100 - FOLLOWED} * {name}_seed DIV 100 + "
                f"{FOLLOWED} * (coalesce({short}, 0) DIV 100) + {FOLLOWED} * (coalesce({short}, 0) % 100) DIV 100"
            )
            for name, short in (("trust", "t"), ("distrust", "d"))
        }
        change = F.abs(new["trust"] - F.col("trust")) + F.abs(new["distrust"] - F.col("distrust"))
        state = tables.written(state.join(moved, "host", "left").withColumns(new | {"change": change}).drop("t", "d"))
        tables.keep()
        changed = int(state.agg(F.sum(F.col("change").cast("decimal(38,0)"))).first()[0] or 0)
        state = state.drop("change")
        if 100 * changed * FOLLOWED <= max(_threshold(n_hosts, share), 100) * (100 - FOLLOWED):
            break
    else:
        raise RuntimeError(f"mass still moves after {rounds} rounds")
    return state


def judged(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    rounds: int = 400,
    share: float = 10,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page; verdict is allow or block.

    A rule decides where one fits. Other pages are judged by their host: it is blocked if the distrust that has come to
    it over links (what it holds beyond its own seed) is more than the trust that has, and more than `share` per cent of
    the mean over all hosts. A host without links keeps its pages: nothing is known against it.

    Mass goes round until no more than a hundredth of that threshold can come to any host; if it still does after `rounds`,
    that is an error.

    A null url, or one without ://, has an empty host and path, fits no rule and is allowed. Null and very long html
    just has no or many links; relative links stay on their host and count for nothing. Repeated pages come back each;
    an empty table gives no rows; other columns are ignored.
    """
    own = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    own = own.withColumn("found", rule(F.col("host"), F.col("path"), rules))
    hosts = written(
        own.filter("host <> ''").groupBy("host").agg(
            F.count_if(F.col("found.verdict") == "allow").alias("allowed"),
            F.count_if(F.col("found.verdict") == "block").alias("blocked"),
        ),
        "hosts",
    )
    masses = spread(hosts, host_links(pages, url, html), share, rounds)
    threshold = _threshold(masses.count(), share)
    came = {name: F.col(name) - F.expr(f"{100 - FOLLOWED} * {name}_seed DIV 100") for name in ("trust", "distrust")}
    # Before the first round has moved anything a host holds its whole seed, which is no mass from links either.
    linked = {name: F.greatest(value, F.lit(0)) for name, value in came.items()}
    suspect = (linked["distrust"] > linked["trust"]) & (linked["distrust"] > threshold)
    named = masses.select("host", "trust", "distrust", suspect.alias("suspect"))
    verdict = F.coalesce("found.verdict", F.when(F.col("suspect"), "block").otherwise("allow"))
    return own.join(named, "host", "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), "trust", "distrust"
    )
