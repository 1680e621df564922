"""URL filter: pattern rules found through their rarest literal token.

A rule is a regular expression with the literal tokens that every matching URL must hold.
Each rule is filed under the one of its tokens that is rarest in the given URLs. The tokens
of a URL fetch the rules filed under them, and only those run their regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlens.llm.common import LOWER, UPPER, read_table

TOKEN = re.compile("[a-z0-9]+")
# Rules that are sent to the workers at once; longer lists are run block by block.
BLOCK = 50_000


@dataclass(frozen=True)
class Rule:
    """``rank`` decides among matching rules: the greatest wins, then the lesser name."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def path_rule(verdict: str, rule: str) -> Rule:
    """``host/path``: fits the host and its subdomains where the path starts alike.

    Labels of the host are whole tokens of any matching URL; so are the path's tokens, but for
    one that ends the rule, which may be the start of a longer token.
    """
    host, slash, path = rule.partition("/")
    path = slash + path
    whole = TOKEN.findall(host.lower()) + TOKEN.findall(re.sub(r"[a-z0-9]+\Z", "", path.lower()))
    pattern = rf"\A(?:[^/?#]*\.)?{re.escape(host)}(?-i:{re.escape(path)})"
    return Rule(rule, verdict, pattern, tuple(whole), 1_000_000 + len(rule))


def word_rule(verdict: str, word: str) -> Rule:
    """A word between characters that are no ASCII letters or digits, anywhere in the URL."""
    return Rule(f"*{word}*", verdict, rf"(?<![a-z0-9]){re.escape(word)}(?![a-z0-9])", (word,), len(word))


PATH_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
# What no path rule decides: URLs with one of these words are blocked, all others allowed.
BLOCKED_WORDS = ("ads", "adserver", "banner", "casino", "doubleclick", "porn", "tracker", "viagra", "xxx")


def default_rules() -> list[Rule]:
    return [path_rule(*r) for r in PATH_RULES] + [word_rule("block", w) for w in BLOCKED_WORDS]


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.expr("substring(url_, instr(url_, '://') + 3)")).otherwise("")


def with_host_and_path(df: DataFrame) -> DataFrame:
    """Add host_, path_ and rest_ (all after ``://``) to a table with url_."""
    url = F.col("url_")
    rest = F.coalesce(_rest(url), F.lit(""))
    return df.withColumn("rest_", rest).withColumns({
        "host_": F.translate(F.regexp_extract("rest_", r"^[^/?#]*", 0), UPPER, LOWER),
        "path_": F.regexp_extract("rest_", r"^[^/?#]*([^?#]*)", 1),
    })


def token_frequencies(urls: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """In how many of the URLs (column rest_) each of the given tokens occurs.

    The result has at most one row per given token, whatever the number of URLs.
    """
    asked = F.array(*[F.lit(t) for t in sorted(set(tokens))])
    of_url = F.array_distinct(F.regexp_extract_all(F.lower("rest_"), F.lit("[a-z0-9]+"), F.lit(0)))
    found = urls.select(F.explode(F.array_intersect(of_url, asked)).alias("token"))
    return {r["token"]: r["count"] for r in found.groupBy("token").count().collect()}


def build_index(rules: Sequence[Rule], frequency: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; rules without a token are filed under the empty one."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        token = min(rule.tokens, key=lambda t: (frequency.get(t, 0), t), default="")
        index.setdefault(token, []).append(rule)
    return index


def _judge(index: dict[str, list[Rule]], default: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = {
            token: [(r, re.compile(r.pattern, re.IGNORECASE | re.ASCII)) for r in rules]
            for token, rules in index.items()
        }
        for batch in batches:
            names, verdicts, ranks = [], [], []
            for rest, host, held in zip(batch["rest_"], batch["host_"], batch["rank"]):
                target = host + rest[len(host):]
                best, best_key = None, (-held, "")
                for token in ({""} | set(TOKEN.findall(target.lower()))) & compiled.keys():
                    for rule, pattern in compiled[token]:
                        key = (-rule.rank, rule.name)
                        if key < best_key and pattern.search(target):
                            best, best_key = rule, key
                names.append(best.name if best else None)
                verdicts.append(best.verdict if best else None)
                ranks.append(best.rank if best else held)
            out = batch.copy()
            won = pd.Series([n is not None for n in names], index=out.index)
            out.loc[won, "rule"] = pd.Series(names, index=out.index, dtype=object)[won]
            out.loc[won, "verdict"] = pd.Series(verdicts, index=out.index, dtype=object)[won]
            out["rank"] = ranks
            yield out

    return run


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict and rank of the winning rule.

    Null URLs and URLs without ``://`` have an empty host and path, match no rule and get the
    default. Repeated rows are judged alike, each in a row of its own; other columns of the
    input are not looked at. Rules beyond ``BLOCK`` are run in further passes over the rows.
    """
    rules = default_rules() if rules is None else list(rules)
    urls = with_host_and_path(pages.select(F.col(id_column).alias("id_"), F.col(url_column).alias("url_")))
    judged = urls.select(
        "id_", "rest_", "host_", "path_",
        F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"),
        F.lit(-1).cast("long").alias("rank"),
    )
    for at in range(0, len(rules), BLOCK):
        block = rules[at : at + BLOCK]
        frequency = token_frequencies(urls, [t for r in block for t in r.tokens]) if block else {}
        judged = judged.mapInPandas(_judge(build_index(block, frequency), default), judged.schema)
    return judged.select(
        F.col("id_").alias(id_column),
        F.col("host_").alias("host"),
        F.col("path_").alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
        "rank",
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL; ``rule`` names path rules only."""
    judged = judge_urls(read_table(spark, sf_dir, "pages"))
    rule = F.when(F.col("rank") >= 1_000_000, F.col("rule"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), "verdict")


def _op8_sql() -> str:
    fits = []
    for verdict, rule in sorted(PATH_RULES, key=lambda r: (-len(r[1]), r[1])):
        host, _, path = rule.partition("/")
        test = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"
        fits.append((test, rule, verdict))
    rules = " ".join(f"WHEN {t} THEN '{r}'" for t, r, _ in fits)
    verdicts = " ".join(f"WHEN {t} THEN '{v}'" for t, _, v in fits)
    words = "|".join(BLOCKED_WORDS)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, rest, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
)
SELECT page_id, host, path, CASE {rules} END AS rule,
       CASE {verdicts}
            WHEN regexp_matches(lower(rest), '(^|[^a-z0-9])({words})($|[^a-z0-9])') THEN 'block'
            ELSE 'allow' END AS verdict
FROM parts"""


QUERIES = {"op8_url_filter": op8_url_filter}
ORACLES = {"op8_url_filter": _op8_sql()}
