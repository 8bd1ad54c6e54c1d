"""URL filter: given host rules first, association rules mined from them for the other URLs.

A URL is a set of tokens (scheme, host labels, path pieces, query keys).  The
URLs that a given rule decides are the labelled transactions, each with all its
tokens.  Their frequent combinations are counted level by level (Apriori): a
combination is grown from a frequent one by a later token.  Those that imply a
verdict with enough support and confidence are the mined rules.  A mined rule is
posted in an inverted index under its rarest token.  Distinct sets of rule
tokens (far fewer than URLs) are joined with the index, checked for the whole
rule, and take the verdict of their best rule; URLs get it by their set.

The levels end at the length of a rule, so the work grows with that power of a
URL's frequent tokens (FP-growth, which knows no such end, goes through all
subsets).  The number of mined rules is bounded by the support (a share of the
labelled URLs), the tokens of a URL and the length of a rule; it does not grow
with the table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICTS = ("allow", "block")
#: Tokens longer than this are replaced by their digest, so that a vocabulary has a bounded size.
LONG = 64


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (HostRule("block", "net", "/"), HostRule("allow", "example.net", "/en/"),
         HostRule("block", "example.com", "/de/"), HostRule("allow", "org", "/fr/"))

#: Share of the labelled URLs that must hold a combination, and of its URLs that must have the verdict.
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.8
#: A mined rule has at most this many tokens.
LENGTH = 3
#: The query's SQL counts combinations of a labelled URL's first so many frequent tokens; the operator counts those of all.
WIDTH = 16
#: The verdict of a URL that no rule of either kind fits.
DEFAULT = "allow"


def with_parts(df: DataFrame, url_col: str) -> DataFrame:
    """Adds ``_url`` (null: empty), ``_host``, ``_path`` and ``_tail`` (what follows the path)."""
    lower = F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), UPPER, LOWER)
    return (df.withColumn("_url", F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")))
            .withColumn("_rest", F.expr("CASE WHEN instr(_url, '://') > 0 THEN substring(_url, instr(_url, '://') + 3) ELSE '' END"))
            .withColumn("_host", lower)
            .withColumn("_path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1))
            .withColumn("_tail", F.expr("substring(_rest, length(_host) + length(_path) + 1)")))


def given_rule(rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest given rule that fits ``_host`` and ``_path`` (null: none)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name, r.verdict)):  # the longest is tested first
        fits = ((F.col("_host") == r.host) | F.endswith(F.col("_host"), F.lit("." + r.host))) & F.startswith(F.col("_path"), F.lit(r.path))
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def tokens() -> Column:
    """Distinct tokens in reading order: scheme, host labels, path pieces, query keys."""
    def pieces(kind: str, text: Column, pattern: str, change=lambda x: x) -> Column:
        cut = F.transform(F.filter(F.split(text, pattern), lambda x: x != ""), change)
        return F.transform(cut, lambda x: F.concat(F.lit(kind + ":"), F.when(F.length(x) <= LONG, x).otherwise(F.sha2(x, 256))))

    scheme = F.translate(F.expr("CASE WHEN instr(_url, '://') > 0 THEN substring(_url, 1, instr(_url, '://') - 1) ELSE '' END"), UPPER, LOWER)
    query = F.regexp_extract("_tail", r"^\?([^#]*)", 1)
    return F.array_distinct(F.concat(
        pieces("scheme", scheme, "://"), pieces("host", F.col("_host"), r"[.]"), pieces("path", F.col("_path"), r"[/.]"),
        pieces("key", query, "&", lambda x: F.split(x, "=")[0])))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         length: int = LENGTH) -> tuple[DataFrame, list[str]]:
    """Rules from ``labelled`` (``tokens``: array of string, ``verdict``): the staged inverted index, and its tokens.

    The index has ``token`` (the rule's rarest), ``need`` (the rule's sorted
    tokens), ``verdict``, ``confidence`` and ``support`` (URLs with the tokens
    and the verdict).  Without labelled rows it is empty.

    Left out are only rules that are never a URL's best, as a part of them fits
    wherever they do and goes first (see ``match``): those grown from tokens
    that already have one verdict alone, and those with a token that all URLs
    with the tokens before it have.
    """
    spark = labelled.sparkSession
    total = labelled.count()
    least = max(1, math.ceil(min_support * total))
    counted = (labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
               .where(F.col("n") >= least).collect() if total else [])
    seen = {r["token"]: r["n"] for r in counted}
    if not seen:
        return spark.createDataFrame([], "token string, need array<string>, verdict string, confidence double, support long"), []
    frequent = F.array_sort(F.filter("tokens", lambda t: t.isin(list(seen))))
    # each distinct set once, over all tasks: a few sets make many combinations
    bags = staged(labelled.groupBy(frequent.alias("rest"), "verdict").agg(F.count("*").alias("n"))
                  .repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), "url-bags")
    # need: the tokens so far, rest: the bag's later tokens, urls: how many have the tokens before the last
    grown = bags.select(F.array().cast("array<string>").alias("need"), F.lit(total + 1).cast("long").alias("urls"), "rest", "verdict", "n")
    votes = [F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in VERDICTS]
    levels = []
    for _ in range(length):
        grown = (grown.select("*", F.posexplode("rest").alias("i", "token"))
                 .select(F.concat("need", F.array("token")).alias("need"), "urls",
                         F.slice("rest", F.col("i") + 2, F.size("rest")).alias("rest"), "verdict", "n"))
        levels.append(staged(grown.groupBy("need", "urls").agg(F.sum("n").alias("n"), *votes)
                             .where((F.greatest(*VERDICTS) >= least) & (F.col("n") < F.col("urls"))).drop("urls"), "url-combinations"))
        mixed = levels[-1].where(F.greatest(*VERDICTS) < F.col("n"))
        grown = grown.drop("urls").join(mixed.select("need", F.col("n").alias("urls")), "need")
    either = F.explode(F.array(*[F.struct(F.lit(v).alias("verdict"), F.col(v).alias("support")) for v in VERDICTS]))
    found = (reduce(DataFrame.union, levels).select("need", "n", either.alias("of"))
             .select("need", "of.verdict", (F.col("of.support") / F.col("n")).alias("confidence"), "of.support")
             .where((F.col("support") >= least) & (F.col("confidence") >= min_confidence)))
    # a token's rank by count, as a map literal: the vocabulary's size is bounded by the support
    rank = F.create_map(*[F.lit(x) for i, t in enumerate(sorted(seen, key=lambda t: (seen[t], t))) for x in (t, i)])
    rarest = F.array_sort(F.transform("need", lambda t: F.struct(rank[t].alias("rank"), t.alias("token"))))[0]["token"]
    index = staged(found.select(rarest.alias("token"), "need", "verdict", "confidence", "support"), "url-rules")
    used = [r["token"] for r in index.select(F.explode("need").alias("token")).distinct().orderBy("token").collect()]
    return index, used


def match(sets: DataFrame, index: DataFrame) -> DataFrame:
    """Per distinct ``sig`` (sorted rule tokens) with a fitting mined rule: its best rule.

    Best is the highest confidence, then the highest support, the fewest
    tokens, and the first tokens in order.
    """
    better = F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.size("need").alias("k"), "need", "verdict")
    return (sets.select("sig", F.explode("sig").alias("token")).join(index, "token")
            .where(F.size(F.array_except("need", "sig")) == 0)
            .groupBy("sig").agg(F.min(better).alias("best"))
            .select(F.col("sig").alias("_sig"), F.col("best.verdict").alias("mined"), F.array_join("best.need", " ").alias("evidence"),
                    (-F.col("best.c")).alias("confidence")))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE, length: int = LENGTH, labels: DataFrame | None = None) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, evidence, confidence.

    The host is what stands between the first ``://`` and ``/``, ``?``, ``#``
    or the end, A-Z lower-cased; the path runs on to ``?``, ``#`` or the end.
    Both are empty for a null URL or one without ``://``.  A given rule fits
    its host and all subdomains if the path starts with the rule's path; the
    longest wins and names ``rule``.  Other URLs get the verdict of their best
    mined rule, with its tokens as ``evidence`` and its ``confidence``, or
    ``allow`` if none fits (both null).  The miner learns from the URLs that a
    given rule decides, or from ``labels`` (url, verdict) if handed over.
    Repeated rows and null ids are kept as they are; an empty table gives no
    rows; other columns are ignored.
    """
    name, verdict = given_rule(rules)
    judged = (with_parts(pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("_given")), "_given")
              .select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), name.alias("rule"), verdict.alias("given"),
                      tokens().alias("tokens")))
    if labels is None:
        labelled = judged.where("given is not null").select("tokens", F.col("given").alias("verdict"))
    else:
        labelled = with_parts(labels.where(F.col("verdict").isin(*VERDICTS)), "url").select(tokens().alias("tokens"), "verdict")
    index, used = mine(labelled, min_support, min_confidence, length)
    sig = F.array_sort(F.filter("tokens", lambda t: t.isin(used))) if used else F.array().cast("array<string>")
    signed = judged.withColumn("sig", F.when(F.col("rule").isNull(), sig))
    best = staged(match(signed.where("size(sig) > 0").select("sig").distinct(), index), "url-verdicts")
    return (signed.join(best, F.col("sig") == F.col("_sig"), "left")
            .select("page_id", "host", "path", "rule", F.coalesce("given", "mined", F.lit(DEFAULT)).alias("verdict"), "evidence", "confidence"))


def oracle(rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, width: int = WIDTH) -> str:
    """The same rows in SQL, if ``width`` is at least the frequent tokens of any labelled URL.

    Every combination of up to three of a URL's first ``width`` frequent tokens is counted.
    """
    def fits(r: HostRule) -> str:
        return f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"

    def cut(kind: str, text: str, pattern: str, value: str = "x") -> str:
        return (f"list_transform(list_filter(regexp_split_to_array({text}, '{pattern}'), lambda x: x <> ''), "
                f"lambda x: '{kind}:' || CASE WHEN length({value}) <= {LONG} THEN {value} ELSE sha256({value}) END)")

    longest = sorted(rules, key=lambda r: (-len(r.name), r.name))
    name = " ".join(f"WHEN {fits(r)} THEN '{r.name}'" for r in longest)
    given = " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in longest)
    return f"""WITH urls AS (
  SELECT row_number() OVER () AS rid, page_id, coalesce(url, '') AS u FROM pages),
rest AS (SELECT rid, page_id, u, CASE WHEN contains(u, '://') THEN substr(u, instr(u, '://') + 3) ELSE '' END AS r FROM urls),
parts AS (
  SELECT rid, page_id, u, r, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
judged AS MATERIALIZED (
  SELECT rid, page_id, host, path, CASE {name} END AS rule, CASE {given} END AS given,
    list_concat(list_concat({cut('scheme', f"CASE WHEN contains(u, '://') THEN translate(substr(u, 1, instr(u, '://') - 1), '{UPPER}', '{LOWER}') ELSE '' END", '://')},
      {cut('host', 'host', '[.]')}), list_concat({cut('path', 'path', '[/.]')},
      {cut('key', "regexp_extract(substr(r, length(host) + length(path) + 1), '^[?]([^#]*)', 1)", '&', "split_part(x, '=', 1)")})) AS toks
  FROM parts),
toks AS MATERIALIZED (
  SELECT rid, t, min(i) AS i FROM (SELECT rid, unnest(toks) AS t, generate_subscripts(toks, 1) AS i FROM judged) GROUP BY rid, t),
lim AS (SELECT greatest(1, CAST(ceil({min_support!r} * count(*)) AS BIGINT)) AS least FROM judged WHERE given IS NOT NULL),
bags AS MATERIALIZED (
  SELECT rid, t, given FROM (
    SELECT rid, t, given, row_number() OVER (PARTITION BY rid ORDER BY i) AS k FROM toks JOIN judged USING (rid)
    WHERE given IS NOT NULL AND t IN (SELECT t FROM toks JOIN judged USING (rid) WHERE given IS NOT NULL
                                      GROUP BY t HAVING count(*) >= (SELECT least FROM lim))) WHERE k <= {width}),
combos AS (
  SELECT [t] AS need, given FROM bags
  UNION ALL SELECT [a.t, b.t], a.given FROM bags a JOIN bags b ON a.rid = b.rid AND a.t < b.t
  UNION ALL SELECT [a.t, b.t, c.t], a.given FROM bags a JOIN bags b ON a.rid = b.rid AND a.t < b.t JOIN bags c ON a.rid = c.rid AND b.t < c.t),
mined AS MATERIALIZED (
  SELECT need, v AS verdict, CASE v WHEN 'allow' THEN allowed ELSE n - allowed END AS support, n FROM (
    SELECT need, count(*) AS n, count(*) FILTER (given = 'allow') AS allowed FROM combos GROUP BY need), (VALUES ('allow'), ('block')) AS t(v)),
strong AS MATERIALIZED (
  SELECT *, CAST(support AS DOUBLE) / n AS confidence FROM mined
  WHERE support >= (SELECT least FROM lim) AND CAST(support AS DOUBLE) / n >= {min_confidence!r}),
sets AS MATERIALIZED (SELECT rid, list(t) AS have FROM toks JOIN judged USING (rid) WHERE rule IS NULL GROUP BY rid),
best AS (
  SELECT rid, verdict, need, confidence FROM (
    SELECT rid, verdict, need, confidence, row_number() OVER (PARTITION BY rid ORDER BY confidence DESC, support DESC, len(need), need) AS k
    FROM sets JOIN strong ON list_has_all(have, need)) WHERE k = 1)
SELECT page_id, host, path, rule, coalesce(given, best.verdict, '{DEFAULT}') AS verdict, array_to_string(need, ' ') AS evidence, confidence
FROM judged LEFT JOIN best USING (rid)"""
