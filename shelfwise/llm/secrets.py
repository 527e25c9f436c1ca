"""Secret scan with corpus-wide ownership frequency.

Candidates are found in every text. Their hashes are counted over the corpus by
distinct repositories and owners: a value that many owners hold, or that many
repositories hold for the number of its owners, is a copied example; any other
that looks random is live-looking. Loose candidates become spans only if they are
live-looking.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import quoted
from shelfwise.llm.shipping import by_value
from shelfwise.llm.tables import numbered

by_value(__name__)

#: Kinds in the order of the listing; the last is the one that ownership decides.
KINDS = ("assign", "access", "hex", "owned")
OWNED = len(KINDS) - 1

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_NAMED = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Every run that can hold an access key, a hex string or a loose candidate.
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}")

#: Owners, or repositories per owner, from which on a value counts as a copied example; bits
#: per character of a random value.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES, LIVE_BITS = 3, 10, 3.0


def bits_per_character(value: str) -> float:
    counts, n = Counter(value), len(value)
    return -sum(c / n * math.log2(c / n) for c in counts.values())


def looks_live(value: str) -> bool:
    return any(map(str.isdigit, value)) and bits_per_character(value) >= LIVE_BITS


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """``kind, start, end, value`` of a whole text, places in code points.

    Access and hex matches lie inside a run, so they are searched only there. A
    loose candidate is a whole run with upper case, lower case and digits that
    touches no other candidate.
    """
    found = []
    lower = text.lower()
    if any(word in lower for word in _NAMED):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                found.append((0, m.start(), m.end(), m[2]))
    for run in RUN.finditer(text):
        start, value = run.start(), run[0]
        own = [(1, m) for m in ACCESS.finditer(value)] if "AKIA" in value else []
        own += [(2, m) for m in HEX.finditer(value)]
        found += [(kind, start + m.start(), start + m.end(), m[0]) for kind, m in own]
        if (
            not own
            and any(map(str.isdigit, value)) and any(map(str.isupper, value)) and any(map(str.islower, value))
            and not any(kind == 0 and s < run.end() and start < e for kind, s, e, _ in found)
        ):
            found.append((OWNED, start, run.end(), value))
    return found


FOUND = "kind array<int>, start array<int>, end array<int>, digest array<binary>, live array<boolean>"


def scan(texts: Column) -> Column:
    """Candidates of each text, as one array per field."""

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                found = candidates(text) if text else []
                rows.append((
                    [f[0] for f in found], [f[1] for f in found], [f[2] for f in found],
                    [xxhash.xxh3_128_digest(f[3].encode()) for f in found],
                    [looks_live(f[3]) for f in found],
                ))
            yield pd.DataFrame(rows, columns=["kind", "start", "end", "digest", "live"])

    return find(texts)


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(
        F.transform(
            ordered,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def holder_list(spans: Column) -> Column:
    """``repositories:owners`` of each span, in the order of ``span_list``."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"], s["n_repositories"], s["n_owners"]))
    )
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", s["n_repositories"].cast("string"), s["n_owners"].cast("string"))),
        ",",
    )


def ownership(found: DataFrame) -> DataFrame:
    """``digest, n_repositories, n_owners``: distinct holders of each candidate.

    Distinct pairs first, then counts per owner, then per candidate: each step
    combines before its shuffle, so a candidate may occur in any share of rows.
    """
    held = found.select("digest", "owner", "repository").distinct()
    by_owner = held.groupBy("digest", "owner").agg(F.count("repository").alias("n"))
    return by_owner.groupBy("digest").agg(
        F.sum("n").alias("n_repositories"), F.count("owner").alias("n_owners")
    )


def scan_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    repository: str = "doc_id",
    owner: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_examples, holders`` of each document.

    A value is an example if ``example_owners`` owners hold it, or at least
    ``example_repositories`` repositories for each owner (for one, if no owner is
    named). ``spans`` lists the base matches and the loose candidates that are
    live-looking and no examples. ``n_live`` and ``n_examples`` count its spans by
    that rule; ``holders`` gives ``repositories:owners`` of each of them. Null
    counts as an empty text, which has no spans. Null repositories and owners are
    holders that are not counted. A row of the input gives a row; repeated rows
    give equal rows.
    """
    rows = numbered(
        docs.select(
            quoted(doc_id).alias("doc_id"),
            quoted(repository).cast("string").alias("repository"),
            quoted(owner).cast("string").alias("owner"),
            scan(quoted(text).cast("string")).alias("f"),
        ).withColumn("found", F.arrays_zip("f.kind", "f.start", "f.end", "f.digest", "f.live")).drop("f"),
        "candidates",
    )
    base = F.filter("found", lambda s: s["kind"] != OWNED)
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    rows_out = rows.select(
        "row", "doc_id",
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_list(base), 256).alias("base_sha256"),
    )
    each = rows.select("row", "repository", "owner", F.explode("found").alias("s")).select(
        "row", "repository", "owner", "s.kind", "s.start", "s.end", "s.digest", "s.live"
    )
    widely = F.col("n_repositories") >= example_repositories * F.greatest(F.col("n_owners"), F.lit(1))
    judged = each.join(ownership(each), "digest").withColumn(
        "example", (F.col("n_owners") >= example_owners) | widely
    )
    kept = judged.where((F.col("kind") != OWNED) | (F.col("live") & ~F.col("example")))
    listed = F.collect_list(F.struct("kind", "start", "end", "n_repositories", "n_owners"))
    spans = kept.groupBy("row").agg(
        span_list(listed).alias("spans"),
        holder_list(listed).alias("holders"),
        F.count_if(F.col("live") & ~F.col("example")).alias("n_live"),
        F.count_if("example").alias("n_examples"),
    )
    return rows_out.join(spans, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("bigint").alias("n_live"),
        F.coalesce("n_examples", F.lit(0)).cast("bigint").alias("n_examples"),
        F.coalesce("holders", F.lit("")).alias("holders"),
    )
