"""URL filters by hash-prefix lookup.

Every URL is expanded into host-suffix and path-prefix expressions, and so is every rule
(its host and its path up to the last ``/``). Expressions meet in an equi-join on the first
bytes of their SHA-256; a candidate counts only if the full digest of the rule equals that of
the URL's own host suffix and path of the rule's length. The longest rule wins.

Only distinct (host, path) pairs are expanded, so a host with a third of all pages costs no
more than its distinct paths; the verdicts are joined back on (host, path), a join that the
adaptive planner splits where a pair is hot. The rules are joined as Spark sees fit by their size.

Null urls and urls without ``://`` have empty host and path, which no rule fits: no rule, default
verdict. Rules with a null or empty host are ignored. Repeated rows each get their row; input
columns other than the two named are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_HEX = 8

#: (host, path, action) of the contract.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]

_A, _Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules_frame(spark: SparkSession, rules) -> DataFrame:
    """Rules as a literal relation, whose size Spark knows exactly."""
    rows = ", ".join("(" + ", ".join("'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'" for x in r) + ")"
                     for r in rules)
    if not rows:
        return spark.sql("SELECT '' AS host, '' AS path, '' AS action WHERE false")
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(host, path, action)")


def split_url(url):
    """(host, path) columns of a URL column, by the contract."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, _A, _Z), path


def _prefix(expr):
    return F.substring(F.sha2(expr, 256), 1, PREFIX_HEX)


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``host, path`` rows to ``host, path, rule, action`` of the winning rule; unmatched rows go."""
    # a rule's path up to its last slash is one of the path prefixes of every URL that it fits
    r = (rules.filter(F.coalesce(F.col("host"), F.lit("")) != "")
         .select(F.translate("host", _A, _Z).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"),
                 F.col("action").alias("r_action"))
         .withColumn("r_dir", F.regexp_extract("r_path", r"(?s)^(.*/)", 1))
         .withColumn("r_key", _prefix(F.concat("r_host", F.lit("\n"), "r_dir")))
         .withColumn("r_digest", F.sha2(F.concat("r_host", F.lit("\n"), "r_path"), 256))
         .withColumn("r_length", F.length("r_path")))
    # no rule fits beyond its own length, so longer expressions need not be made
    most = rules.agg(F.max(F.length("path")), F.max(F.size(F.split("host", r"\.")))).first()
    longest, deepest = most[0] or 0, most[1] or 0
    labels = F.split("host", r"\.")
    u = (urls.select("host", "path", labels.alias("_l"), F.split(F.substring("path", 1, longest), "/", -1).alias("_p"))
         .select("host", "path", "_p", F.explode(F.expr(
             f"transform(sequence(greatest(1, size(_l) - {deepest} + 1), size(_l)),"
             " i -> array_join(slice(_l, i, size(_l)), '.'))")).alias("u_host"))
         .select("host", "path", "u_host", F.explode(F.expr(
             "transform(sequence(0, size(_p) - 1),"
             " i -> if(i = 0, '', concat(array_join(slice(_p, 1, i), '/'), '/')))")).alias("u_dir"))
         .withColumn("u_key", _prefix(F.concat("u_host", F.lit("\n"), "u_dir"))))
    hit = u.join(r, (F.col("u_key") == F.col("r_key"))
                 & (F.sha2(F.concat("u_host", F.lit("\n"), F.expr("substring(path, 1, r_length)")), 256)
                    == F.col("r_digest")))
    best = F.max(F.struct(F.length(F.concat("r_host", "r_path")).alias("n"),
                          (F.col("r_action") == "block").alias("block"),
                          F.concat("r_host", "r_path").alias("rule"), F.col("r_action").alias("action")))
    return hit.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.action")


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
                default: str = "allow") -> DataFrame:
    """``key, host, path, rule, verdict``: one row per input row."""
    host, path = split_url(F.col(url))
    split = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    found = match_rules(split.select("host", "path").filter(F.col("host") != "").distinct(), rules)
    out = split.join(found, ["host", "path"], "left")
    return out.select(F.col(key), "host", "path", "rule",
                      F.coalesce("action", F.lit(default)).alias("verdict"))
