"""Robots rules from tables of robots.txt lines, and the gate they put on URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions import urls
from rankloom.functions.text import jvm_trim
from rankloom.operators.scan import running_last

# Line pattern, found anywhere in a trimmed line, one space after the colon. "Allow: "
# also ends "Disallow: ", but a search from the left finds the longer word first.
ANY_LINE = r"(?i)(User-agent|Allow|Disallow): ([^#]*)"


def agent_pattern(agent: Column) -> Column:
    """Regular expression of an agent name where * and ? are wildcards."""
    escaped = F.regexp_replace(agent, r"([()\[\]$^.{}|\\])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(F.replace(escaped, F.lit("?"), F.lit(".")), F.lit("*"), F.lit(".*")),
                    F.lit("$"))


def robots_rules(lines: DataFrame, agent: str) -> DataFrame:
    """(host, ordinal, path_prefix, allow) for ``agent`` from lines (host, line_no, line).

    Every agent line replaces the current match state. A repeated path keeps its first place
    and takes its last value.
    """
    line = jvm_trim(F.col("line"))
    kind = F.lower(F.regexp_extract(line, ANY_LINE, 1))
    parsed = lines.select("host", "line_no", kind.alias("kind"),
                          F.regexp_extract(line, ANY_LINE, 2).alias("value")).filter(F.col("kind") != "")
    # Undecodable escapes end the reading of a file; here they only void their own line.
    named = running_last(parsed, "host", "line_no",
                         F.when(F.col("kind") == "user-agent", jvm_trim(F.col("value"))), "agent")
    rules = named.filter(
        (F.col("kind") != "user-agent") & F.rlike(F.lit(agent), agent_pattern(F.col("agent")))
    ).select("host", "line_no", jvm_trim(F.try_url_decode("value")).alias("path_prefix"),
             (F.col("kind") == "allow").alias("allow"))
    return rules.filter(F.col("path_prefix").isNotNull()).groupBy("host", "path_prefix").agg(
        F.min("line_no").alias("ordinal"), F.max_by("allow", "line_no").alias("allow")
    ).select("host", "ordinal", "path_prefix", "allow")


def robots_gate(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add ``allowed``: the first rule of the host whose prefix starts the path and query.

    Prefix matching is an equi-join: each URL is looked up under the prefix lengths its host
    uses. Lookups per URL are bounded by the URL's length, however many rules a host has.
    """
    located = pages.withColumn("_host", urls.host(F.col(url))).withColumn("_file", urls.file(F.col(url)))
    lengths = rules.groupBy("host").agg(F.collect_set(F.length("path_prefix")).alias("lengths"))
    prefixes = located.select("_host", "_file").distinct().join(
        lengths, F.col("_host") == F.col("host")
    ).select("_host", "_file", F.explode("lengths").alias("n")).filter(
        F.col("n") <= F.length("_file")
    ).withColumn("prefix", F.substring(F.col("_file"), F.lit(1), F.col("n")))
    hits = prefixes.join(rules.select("host", "path_prefix", "ordinal", "allow"),
                         (F.col("_host") == F.col("host")) & (F.col("prefix") == F.col("path_prefix")))
    verdicts = hits.groupBy("_host", "_file").agg(F.min_by("allow", "ordinal").alias("_allow"))
    return (
        located.join(verdicts, ["_host", "_file"], "left")
        .withColumn("allowed", F.coalesce(F.col("_allow"), F.lit(True)))
        .drop("_host", "_file", "_allow")
    )
