"""URL filters: pattern rules indexed by their rarest literal token, with DataFrame functions only.

A rule is a text with ``*`` for any run of characters. It may begin with ``||`` (a host or any of its subdomains).
Each rule is filed under the one of its literal tokens that the fewest URLs have. A URL's tokens fetch the rules filed
under them, and only those rules' regular expressions run.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.llm.frames import free_prefix

#: Rules up to this number are broadcast (a few hundred bytes each); more rules are joined by shuffle.
BROADCAST_RULES = 20_000
RULES_AT_ONCE = 1000
#: Parts of all addresses for rules without a whole token, where rules are joined by shuffle.
SALTS = 64
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``listed`` rules are host and path prefix and rank before all patterns; among equals the longest wins."""

    text: str
    verdict: str
    listed: bool = False

    @property
    def name(self) -> str:
        return self.text.removeprefix("||")

    @property
    def regex(self) -> str:
        body = self.name
        anchored = self.text.startswith("||")
        escaped = ".*".join(re.sub(r"([^A-Za-z0-9_/])", r"\\\1", x) for x in body.split("*"))
        return ("(?s)^([^/]*\\.)?" if anchored else "(?s)") + escaped

    @property
    def tokens(self) -> list[str]:
        """Alphanumeric runs that every fitting URL has as a whole: bounded by other signs of the rule or the host's start."""
        out = []
        for m in re.finditer(r"[A-Za-z0-9]+", self.text):
            left = self.text[m.start() - 1] if m.start() else ""
            right = self.text[m.end()] if m.end() < len(self.text) else ""
            if left not in ("", "*") and right not in ("", "*"):
                out.append(m[0])
        return sorted(set(out))


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host with its subdomains and the paths that begin with ``path``."""
    return Rule(f"||{host}{path}", verdict, listed=True)


_RULE = "array<struct<rule_id:int,rule:string,rule_verdict:string,listed:boolean,regex:string,tokens:array<string>>>"


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """A row for each rule. Rules travel as texts of ``RULES_AT_ONCE`` rules each, as a plan with a literal for each is slow."""
    names = ("rule_id", "rule", "rule_verdict", "listed", "regex", "tokens")
    rows = [dict(zip(names, (i, r.name, r.verdict, r.listed, r.regex, r.tokens or [""]))) for i, r in enumerate(rules)]
    texts = [json.dumps(rows[at : at + RULES_AT_ONCE]) for at in range(0, len(rows), RULES_AT_ONCE)]
    given = spark.range(1).select(F.explode(F.array(*map(F.lit, texts)).cast("array<string>")).alias("rules"))
    return given.select(F.inline(F.from_json("rules", _RULE)))


def split_url(pages: DataFrame, url: str = "url") -> DataFrame:
    """``host`` and ``path``: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; then up to
    ``?``, ``#`` or the end. Both are empty for null or without ``://``. Columns with these names are replaced.
    """
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.drop("host", "path").withColumns({"host": lower, "path": path})


def filter_urls(pages: DataFrame, rules: list[Rule], default: str = ALLOW, url: str = "url") -> DataFrame:
    """All rows and columns of ``pages`` with host, path, ``rule`` (the fitting listed rule, else null), ``pattern`` (the
    fitting pattern, if no listed rule fits, else null) and ``verdict`` (theirs, else ``default``).

    Distinct addresses are judged once, so a hot URL costs one row. Patterns see host and path, not the query. A rule
    without a whole token is run on every address. Ties in length go to the rule given first. A null url is judged like
    an address with neither host nor path. Columns of ``pages`` with the names of added ones are replaced.
    """
    spark = pages.sparkSession
    split = split_url(pages.drop("rule", "pattern", "verdict"), url)
    addresses = split.select("host", "path").distinct()
    shown = F.concat("host", "path")
    tokens = F.array_distinct(F.concat(F.array(F.lit("")), F.split(shown, "[^A-Za-z0-9]+")))
    by_token = addresses.select("host", "path", F.explode(tokens).alias("token"))

    table = rule_table(spark, rules)
    literals = table.select("rule_id", F.explode("tokens").alias("token"))
    wanted = literals.select("token").distinct()
    small = len(rules) <= BROADCAST_RULES
    bounded = F.broadcast if small else (lambda x: x)
    frequency = by_token.join(bounded(wanted), "token").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = literals.join(bounded(frequency), "token", "left").groupBy("rule_id").agg(
        F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), "token")).alias("token")
    )
    # Every address asks for the rules without a token: they are there once for each part of the addresses.
    salts = 1 if small else SALTS
    parts = F.explode(F.sequence(F.lit(0), F.when(F.col("token") == "", salts - 1).otherwise(0)))
    index = rarest.join(table.drop("tokens"), "rule_id").withColumn("salt", parts)
    salt = F.when(F.col("token") == "", F.pmod(F.xxhash64("host", "path"), F.lit(salts)).cast("int")).otherwise(0)
    candidates = by_token.withColumn("salt", salt).join(bounded(index), ["token", "salt"])
    fits = candidates.where(F.expr("rlike(concat(host, path), regex)"))
    order = F.struct(F.col("listed"), F.length("rule"), -F.col("rule_id"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "rule_verdict", "listed"), order).alias("best"))
    own = {c: free_prefix(split) + c for c in ("host", "path", "best")}
    best = best.select(*[F.col(c).alias(name) for c, name in own.items()])
    judged = split.join(best, (F.col("host") == F.col(own["host"])) & (F.col("path") == F.col(own["path"])), "left")
    found = F.col(own["best"])
    return judged.withColumns({
        "rule": F.when(found["listed"], found["rule"]),
        "pattern": F.when(~found["listed"], found["rule"]),
        "verdict": F.coalesce(found["rule_verdict"], F.lit(default)),
    }).drop(*own.values())
