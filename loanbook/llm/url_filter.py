"""URL filters: pattern rules found through their rarest literal token.

Rules are written in the usual filter-list notation. A host rule is ``host/path``: it fits
the host and its subdomains if the path starts with the rule's, and the longest wins. A
pattern rule is text with ``*`` for anything and ``^`` for one separator (no letter or digit
of ASCII) or an end of the address; it blocks or allows an address that no host rule fits.

A rule's literal tokens are its runs of letters and digits that end at separators on both
sides, so that a fitting address must have them among its own tokens. The rule waits under
the one of them that the fewest addresses have. An address fetches the rules that wait
under its tokens and only those run their regular expressions. Rules without such a token
run on every address; they are few by nature, and none is lost.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import UPPER, LOWER, one_row_each

SEPARATOR = "[^0-9a-z]"


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str  # allow or block
    is_host: bool = False

    @property
    def pattern(self) -> str:
        """A regular expression over host and path (host rules) or the lower-case address."""
        if self.is_host:
            host, _, path = self.text.partition("/")
            # quoted by hand: re.escape knows Python, not the JVM
            return "(?s)^([^/]*\\.)?" + _quoted(host) + _quoted("/" + path)
        parts = {"*": ".*", "^": f"(^|{SEPARATOR}|$)"}
        return "(?s)" + "".join(parts.get(c, _quoted(c)) for c in self.text.lower())

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that every fitting address has."""
        text = self.text.lower()
        if self.is_host:
            # a path is a prefix: its last token may go on in the address
            return re.findall(rf"(?<![0-9a-z])[0-9a-z]+(?={SEPARATOR})", text)
        return re.findall(r"(?<=[^0-9a-z*])[0-9a-z]+(?=[^0-9a-z*])", text)


def _quoted(text: str) -> str:
    return re.sub(r"([^0-9A-Za-z/_ ])", r"\\\1", text)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without an address or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def url_tokens(address: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(address, f"{SEPARATOR}+")), "")


def url_verdicts(
    pages: DataFrame, rules: Sequence[Rule], *, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per row: the key, host, path, the winning host rule's text or NULL, and the verdict.

    ``verdict`` is the host rule's; else ``allow`` if an allowing pattern rule fits; else
    ``block`` if a blocking one does; else ``allow``. NULL and empty addresses fit no rule
    and are allowed. Repeated rows (key and address) are judged once and returned as often;
    an empty table gives an empty result; other columns are left out.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("_url"))
    told = (
        pages.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{url}`").alias("_url"))
        .withColumns({"_host": host, "_path": path})
        .withColumn("_address", F.translate(F.coalesce("_url", F.lit("")), UPPER, LOWER))
    )
    schema = "rule string, verdict string, is_host boolean, pattern string, tokens array<string>"
    table = spark.createDataFrame(
        [(r.text, r.verdict, r.is_host, r.pattern, r.tokens) for r in rules], schema
    )

    # How many addresses have each literal token; tokens no rule has are dropped at once.
    with_tokens = told.withColumn("token", F.explode(url_tokens(F.col("_address"))))
    literals = table.select(F.explode("tokens").alias("token")).distinct()
    had = with_tokens.select("token").join(literals, "token", "left_semi").groupBy("token").count()
    waits = (
        table.withColumn("token", F.explode("tokens"))
        .join(had, "token", "left")
        .na.fill(0, ["count"])
        .groupBy("rule", "verdict", "is_host", "pattern")
        .agg(F.min_by("token", F.struct("count", "token")).alias("token"))
    )
    fetched = with_tokens.join(waits, "token")
    fits = F.expr(
        "IF(is_host, instr(_url, '://') > 0 AND concat(_host, _path) rlike pattern, _address rlike pattern)"
    )
    found = fetched.where(fits).select("_key", "_url", "rule", "verdict", "is_host")
    without = [_as_struct(rule) for rule in rules if not rule.tokens]
    if without:
        everywhere = told.withColumn("_r", F.explode(F.array(*without))).select("*", "_r.*")
        found = found.unionByName(everywhere.where(fits).select(*found.columns))

    # One reduction per address: its copies, and the best rule of either kind.
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("rule", "string"), ("verdict", "string"), ("is_host", "boolean"))]
    both = told.select("_key", "_url", *nothing, F.lit(1).alias("_row")).unionByName(
        found.withColumn("_row", F.lit(0))
    )
    longest = F.max(F.when(F.col("is_host"), F.struct(F.length("rule"), "rule", "verdict")))
    by_pattern = F.min(F.when(~F.col("is_host"), F.col("verdict")))
    judged = both.groupBy("_key", "_url").agg(
        F.sum("_row").alias("_copies"), longest.alias("_best"), by_pattern.alias("_other")
    )
    host, path = url_parts(F.col("_url"))
    return one_row_each(
        judged.select(
            F.col("_key").alias(key),
            host.alias("host"),
            path.alias("path"),
            F.col("_best.rule").alias("rule"),
            F.coalesce("_best.verdict", "_other", F.lit("allow")).alias("verdict"),
            "_copies",
        ),
        "_copies",
    )


def _as_struct(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.text).alias("rule"),
        F.lit(rule.verdict).alias("verdict"),
        F.lit(rule.is_host).alias("is_host"),
        F.lit(rule.pattern).alias("pattern"),
    )
