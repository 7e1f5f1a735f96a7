"""URL filter rules indexed by their rarest literal token.

A rule is a pattern in the usual filter-list form: literal text in which
``*`` is any run of characters, ``^`` a separator or the end, a leading ``||``
the start of the host or of one of its labels, a single ``|`` at an end the
end itself. Its literal tokens are the letter-digit runs that the pattern
bounds on both sides; every url that the rule matches holds them as whole
tokens. The rule is filed under the one that the fewest urls hold. A url's
tokens fetch the rules filed under them, and only those run as regular
expressions; rules without such a token are tried on every url.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from dimforge.llm.common import literal_rows, row_key

# A rule list of up to this many entries is sent to every task; a longer one
# is joined by shuffle.
BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    name: str
    pattern: str
    action: str
    priority: int = 0


def site_rule(name: str, action: str) -> Rule:
    """A rule ``host/path``: the host and its subdomains, paths that start so.
    Longer rules go first."""
    return Rule(name, "||" + name, action, len(name))


def rule_regex(pattern: str) -> str:
    """The regular expression of a rule pattern, for host + path + rest."""
    head, body, tail = "", pattern, ""
    if body.startswith("||"):
        head, body = r"^(?:[^/?#]*\.)?", body[2:]
    elif body.startswith("|"):
        head, body = "^", body[1:]
    if body.endswith("|"):
        tail, body = r"\z", body[:-1]
    special = {"*": r"[\s\S]*", "^": r"(?:[^A-Za-z0-9_.%-]|\z)"}
    return head + "".join(special.get(c) or re.sub(r"([^A-Za-z0-9_])", r"\\\1", c) for c in body) + tail


def rule_tokens(pattern: str) -> list[str]:
    """Letter-digit runs that are whole tokens of every matching url."""
    body = re.sub(r"^\|\|?", " ", pattern)
    body = re.sub(r"\|$", " ", body)
    return sorted({m.group(1) for m in re.finditer(r"(?<=[^A-Za-z0-9*])([A-Za-z0-9]+)(?=[^A-Za-z0-9*])", body)})


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and rest of a url; all empty for null or
    without ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    tail = F.substr(after, F.length(host) + 1)
    path = F.regexp_extract(tail, r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path, F.substr(tail, F.length(path) + 1)


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.split(target, "[^A-Za-z0-9]+"))


def apply_url_rules(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id, host, path`` and, of the winning rule, ``rule, action, priority``
    (null if none matches) for every row of ``pages``.

    The highest priority wins, then the name that sorts first. Null urls and
    urls without ``://`` have empty host and path and match no token rule;
    null ids and repeated rows are judged like any other. Other columns are
    not read. An empty table, or an empty rule list, gives no matches.
    """
    spark = pages.sparkSession
    host, path, rest = url_parts(F.col(url_col))
    k1, k2 = row_key(F.col(id_col), F.col(url_col))
    rows = (pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), rest.alias("rest"),
                         k1.alias("k1"), k2.alias("k2"))
            .withColumn("target", F.concat("host", "path", "rest")))
    order = {n: -i for i, n in enumerate(sorted({r.name for r in rules}))}
    listed = literal_rows(
        spark, [{"rule": r.name, "action": r.action, "priority": r.priority, "order": order[r.name],
                 "regex": rule_regex(r.pattern), "tokens": rule_tokens(r.pattern)} for r in rules],
        "rule: string, action: string, priority: int, order: int, regex: string, tokens: array<string>")
    small = F.broadcast if len(rules) <= BROADCAST_RULES else (lambda t: t)
    named = listed.select("rule", "action", "priority", "order", "regex", F.explode_outer("tokens").alias("token"))
    held = rows.select("k1", "k2", "target", F.explode(_tokens(F.col("target"))).alias("token")).filter("token <> ''")
    counts = (held.join(small(named.select("token").distinct()), "token", "left_semi")
              .groupBy("token").agg(F.count("*").alias("n")))
    # One row per rule: the token with the fewest urls, ties by name.
    index = (named.join(counts, "token", "left")
             .groupBy("rule", "action", "priority", "order", "regex")
             .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")))
    wins = F.struct("priority", "order", "rule", "action")
    hits = held.join(small(index.filter("token is not null")), "token").filter("target rlike regex")
    hits = hits.select("k1", "k2", wins.alias("win"))
    loose = [r for r in rules if not rule_tokens(r.pattern)]
    for r in loose:
        win = F.struct(F.lit(r.priority).alias("priority"), F.lit(order[r.name]).alias("order"),
                       F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"))
        hits = hits.unionByName(rows.filter(F.col("target").rlike(rule_regex(r.pattern)))
                                .select("k1", "k2", win.alias("win")))
    best = hits.groupBy("k1", "k2").agg(F.max("win").alias("win"))
    return (rows.join(best, ["k1", "k2"], "left")
            .select(F.col("id").alias(id_col), "host", "path", F.col("win.rule").alias("rule"),
                    F.col("win.action").alias("action"), F.col("win.priority").alias("priority")))
