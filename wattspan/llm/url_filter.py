"""URL filter: pattern rules found through their rarest literal token.

Each rule is filed under that of its literal tokens which the fewest URLs of the table hold.
A URL's tokens fetch the rules filed under them, and only those run their regular
expression. Everything is DataFrame expressions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.llm.common import LOWER, UPPER, table

# Between tokens: ASCII apart from digits and a-z.
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Rules are the caller's list; up to this many are sent to all executors.
BROADCAST_RULES = 100_000
EVERY_URL = ""


@dataclass(frozen=True)
class Rule:
    """A verdict for the URLs, written as host and path, that ``pattern`` matches.

    ``tokens`` are whole tokens that each matching URL holds. The rule with the highest
    ``weight`` wins, then the first by name. ``listed`` rules are named in the result.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    weight: int
    listed: bool = True


def site_rule(text: str, verdict: str) -> Rule:
    """A rule for a host, its subdomains, and paths from ``text``'s first slash on.

    Longer rules weigh more. Tokens at the end of the path may go on in the URL, so they
    are not literal unless something ends them.
    """
    host, slash, path = text.partition("/")
    start = host + slash + path
    whole = start if re.search(f"{SPLIT}\\Z", start) else re.sub(r"[0-9a-z\x80-\U0010FFFF]+\Z", "", start)
    tokens = tuple(t for t in re.split(SPLIT, whole) if t)
    quoted = "".join(c if c.isalnum() else "\\" + c for c in start)
    return Rule(text, verdict, rf"(?s)\A(?:[^/]*\.)?{quoted}", tokens, 1000 + len(start))


def word_rule(word: str) -> Rule:
    """Block URLs that hold ``word`` as a whole token, unless a site rule decides."""
    quoted = "".join(c if c.isalnum() else "\\" + c for c in word)
    pattern = rf"(?s)(?:\A|{SPLIT}){quoted}(?:{SPLIT}|\z)"
    return Rule(f"word:{word}", "block", pattern, (word,), 1, listed=False)


SITES = (
    site_rule("net/", "block"),
    site_rule("example.net/en/", "allow"),
    site_rule("example.com/de/", "block"),
    site_rule("org/fr/", "allow"),
)
# The method's own patterns: addresses of advertisement, adult and gambling sites.
WORDS = tuple(
    word_rule(w)
    for w in ("ads", "adserver", "adult", "banner", "bet", "casino", "doubleclick", "porn", "tracker", "xxx")
)
RULES = SITES + WORDS


def host_of(url: Column) -> Column:
    """After the first ``://`` to the next ``/ ? #``, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host to the next ``? #``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(address: Column) -> Column:
    found = F.array_distinct(F.split(F.translate(address, UPPER, LOWER), SPLIT))
    return F.array_union(found, F.array(F.lit(EVERY_URL)))


def rule_index(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the literal token it is filed under.

    Tokens are counted over the URLs of ``pages``; those counted are the rules' own, so
    the counts are at most as many as the rules have tokens. A rule without a token is
    filed under the empty one, which every URL has.
    """
    spark = pages.sparkSession
    known = sorted({t for r in rules for t in r.tokens})
    counts: dict[str, int] = {}
    if known:
        wanted = spark.createDataFrame([(t,) for t in known], "token string")
        if len(known) <= BROADCAST_RULES:
            wanted = F.broadcast(wanted)
        address = F.concat(host_of(F.col("url")), path_of(F.col("url")))
        held = pages.select(F.explode(_tokens(address)).alias("token"))
        counts = {r[0]: r[1] for r in held.join(wanted, "token").groupBy("token").count().collect()}
    rows = [
        (min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=EVERY_URL),
         r.name, r.verdict, r.pattern, r.weight, r.listed)
        for r in rules
    ]
    schema = "token string, name string, rule_verdict string, pattern string, weight long, listed boolean"
    return spark.createDataFrame(rows, schema)


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule] = RULES, default: str = "allow"
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` for each row of ``pages``.

    Needs ``page_id`` and ``url``; other columns are ignored. A null URL or one without
    ``://`` has an empty host and path, which only rules without tokens can match.
    Repeated rows stay, and null ids too.
    """
    pages = pages.select("page_id", "url")
    index = rule_index(pages, rules)
    if len(rules) <= BROADCAST_RULES:
        index = F.broadcast(index)
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    )
    address = F.concat("host", "path")
    candidates = rows.withColumn("token", F.explode(_tokens(address))).join(index, "token", "left")
    fits = F.col("pattern").isNotNull() & F.expr("rlike(concat(host, path), pattern)")
    match = F.when(
        fits, F.struct("weight", F.col("name").alias("rule_name"), "rule_verdict", "listed")
    )
    first = F.struct("weight", F.col("name"))
    # All tokens of a row come from one task, so rows are reduced before the shuffle.
    best = candidates.groupBy("row", "page_id", "host", "path").agg(
        F.max(F.when(fits, F.col("weight"))).alias("top"),
        F.max_by(match, F.when(fits, first)).alias("match"),
    )
    return best.select(
        "page_id",
        "host",
        "path",
        F.when(F.col("match.listed"), F.col("match.rule_name")).alias("rule"),
        F.coalesce(F.col("match.rule_verdict"), F.lit(default)).alias("verdict"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every URL of ``pages``."""
    return judge_urls(table(spark, sf_dir, "pages"))


SQL = r"""
WITH split AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM pages),
rules(name, host, path, verdict) AS (VALUES
    ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
    ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fit AS (
    SELECT s.*, (SELECT max_by(struct_pack(name := r.name, verdict := r.verdict), length(r.name))
        FROM rules r WHERE (s.host = r.host OR ends_with(s.host, '.' || r.host))
            AND starts_with(s.path, r.path)) AS best
    FROM split s)
SELECT page_id, host, path, best.name AS rule,
    coalesce(best.verdict, CASE WHEN len(list_intersect(
        regexp_split_to_array(translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
        ['ads', 'adserver', 'adult', 'banner', 'bet', 'casino', 'doubleclick', 'porn',
         'tracker', 'xxx'])) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM fit
"""
