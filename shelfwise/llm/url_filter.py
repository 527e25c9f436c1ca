"""Weighted URL vocabulary with host and path rules.

An Aho-Corasick automaton finds the strict and soft terms of a URL in one pass;
a term counts where no letter or digit touches it. One strict term or several
distinct soft terms reject the URL. A rule that fits decides before the terms.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import literal, quoted
from shelfwise.llm.shipping import by_value

by_value(__name__)

#: Terms that reject a URL alone, and terms that reject it together.
STRICT = ("casino", "cheap-pills", "porn", "spam-farm", "viagra", "warez", "xxx")
SOFT = ("adult", "bet", "bonus", "cheap", "click", "free", "loan", "pills", "poker", "sex", "spam", "win")
#: Distinct soft terms that reject.
SOFT_LIMIT = 2


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path of a URL; empty where it is null or has no ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(url__, locate('://', url__) + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null. A rule fits its
    host and all subdomains if the path starts with its path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.expr(literal(rule.host + rule.path))).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def count_terms(strict: Sequence[str], soft: Sequence[str]):
    """Column function: ``strict`` hits and ``soft`` distinct soft terms of lower-cased text."""

    @F.pandas_udf("strict int, soft int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for heavy, terms in ((False, soft), (True, strict)):
            for term in terms:
                automaton.add_word(term, (term, heavy))
        automaton.make_automaton()

        def free(text: str, place: int) -> bool:
            return not (0 <= place < len(text)) or not (text[place].isascii() and text[place].isalnum())

        def hits(text: str | None) -> tuple[int, int]:
            heavy_hits, light = 0, set()
            for end, (term, heavy) in automaton.iter(text or ""):
                if free(text, end + 1) and free(text, end - len(term)):
                    if heavy:
                        heavy_hits += 1
                    else:
                        light.add(term)
            return heavy_hits, len(light)

        for texts in batches:
            yield pd.DataFrame([hits(t) for t in texts], columns=["strict", "soft"])

    return count


def judge_urls(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, strict_hits, soft_hits`` of each page.

    Null and empty URLs have neither host nor path, fit no rule and have no
    terms: they are allowed. Ids may be null or repeated; a row gives a row.
    """
    rows = pages.select(quoted(page_id).alias("page_id"), quoted(url).cast("string").alias("url__"))
    host, path = host_and_path(F.col("url__"))
    parsed = rows.select(
        "page_id", host.alias("host"), path.alias("path"),
        count_terms(tuple(strict), tuple(soft))(ascii_lower(F.col("url__"))).alias("terms"),
    )
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rejected = (F.col("terms.strict") > 0) | (F.col("terms.soft") >= soft_limit)
    return parsed.select(
        "page_id", "host", "path", name.alias("rule"),
        F.coalesce(verdict, F.when(rejected, "block").otherwise("allow")).alias("verdict"),
        F.col("terms.strict").alias("strict_hits"), F.col("terms.soft").alias("soft_hits"),
    )
