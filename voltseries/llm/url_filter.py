r"""URL filter by pattern rules that are indexed by their rarest literal token.

A rule is a regular expression over host + path, a verdict and a priority. Its literal
tokens are the runs of letters and digits that stand whole in every matching URL. The
tokens of all URLs are counted; every rule is filed under the token of its own that the
URLs hold least often. A URL fetches the rules filed under its tokens, and only those
run. The largest priority wins, then the smaller rule name.

Base rules (host, path) fit the host and its subdomains where the path starts with the
rule's; their priority is the length of their name, above all other patterns. Where no
base rule fits, the pattern rules decide, and where none does, the URL is allowed.

Defined cases: a null URL, or one without ``://``, has empty host and path and is
allowed; rows that repeat a page stay; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Verdict, host, path of the base rules.
BASE_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Verdict, name, pattern, literal tokens of the pattern rules. A token with
# several forms (a|b) stands in one of them; the rule is filed once for each form.
PATTERN_RULES = (
    ("block", "pills", r"^[^/]*(^|[.-])pills[.-]", ("pills",)),
    ("block", "bets", r"^[^/]*(^|[.-])bets[.-]", ("bets",)),
    ("block", "casino", r"^[^/]*(^|[.-])casino[.-]", ("casino",)),
    ("block", "cheap", r"^[^/]*(^|[.-])cheap-[a-z0-9]+[.-]", ("cheap",)),
    ("block", "free", r"^[^/]*(^|[.-])free-[a-z0-9]+[.-]", ("free",)),
    ("block", "adserver", r"^ads?\.", ("ad",)),
    ("block", "adserver", r"^ads\.", ("ads",)),
    ("block", "tracker", r"/track(ing|er)?/", ("track|tracking|tracker",)),
    ("block", "login", r"/(wp-)?login/?$", ("login",)),
)
_RUN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    priority: int
    is_base: bool


def base_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host with its subdomains and a start of the path."""
    # The last run of the path is only a start unless something closes it.
    closed = re.findall(_RUN + r"(?=[^a-z0-9])", path.lower())
    tokens = tuple(sorted({*re.findall(_RUN, host), *closed}))
    pattern = rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(host + path, verdict, pattern, tokens, 1_000_000 + len(host + path), True)


def default_rules() -> list[Rule]:
    named = [
        Rule(n, v, p, forms, len(p), False)
        for v, n, p, tokens in PATTERN_RULES
        for forms in product(*(t.split("|") for t in tokens))
    ]
    return [base_rule(*r) for r in BASE_RULES] + named


def _host(url: Column) -> Column:
    return F.translate(
        F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(target), F.lit(f"({_RUN})"), 1))


def _rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = [(i, r.name, r.verdict, r.pattern, list(r.tokens), r.priority, r.is_base) for i, r in enumerate(rules)]
    return spark.createDataFrame(
        rows,
        "rule_no int, name string, rule_verdict string, pattern string, tokens array<string>, "
        "priority int, is_base boolean",
    )


def judge_urls(pages: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern_rule; one row per row of ``pages``."""
    spark = pages.sparkSession
    table = _rule_table(spark, default_rules() if rules is None else rules)
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    parsed = pages.select("page_id", url.alias("url")).select(
        "page_id", _host(F.col("url")).alias("host"), _path(F.col("url")).alias("path")
    )
    # Rows of equal page, host and path are judged once and given back as often.
    parsed = parsed.groupBy("page_id", "host", "path").agg(F.count(F.lit(1)).cast("int").alias("copies"))

    # How many URLs hold each literal token of the rules, over all pages.
    literals = table.select("rule_no", F.explode("tokens").alias("token"))
    seen = parsed.select(F.explode(_tokens(F.concat("host", "path"))).alias("token"), "copies")
    counts = seen.groupBy("token").agg(F.sum("copies").alias("n"))
    filed = (
        literals.join(counts, "token", "left")
        .groupBy("rule_no")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest"))
        .select("rule_no", F.col("rarest.token").alias("token"))
        .join(table.drop("tokens"), "rule_no")
    )

    # The empty token fetches no rule and keeps the URL.
    fetched = parsed.withColumn(
        "token", F.explode(F.concat(F.array(F.lit("")), _tokens(F.concat("host", "path"))))
    ).join(filed, "token", "left")
    fits = F.expr("rlike(concat(host, path), pattern)")
    hit = F.when(
        fits, F.struct("priority", (-F.col("rule_no")).alias("order"), "name", "rule_verdict", "is_base")
    )
    best = fetched.groupBy("page_id", "host", "path").agg(F.max("copies").alias("copies"), F.max(hit).alias("best"))
    return best.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(
        "page_id",
        "host",
        "path",
        F.when(F.col("best.is_base"), F.col("best.name")).alias("rule"),
        F.coalesce("best.rule_verdict", F.lit("allow")).alias("verdict"),
        F.when(~F.col("best.is_base"), F.col("best.name")).alias("pattern_rule"),
    )
