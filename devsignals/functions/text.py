"""Text expressions: surrogate keys, link domains, repository mentions, labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from devsignals import params

# name, expression, needle of the expression or None
Patterns = Sequence[tuple[str, str, str | None]]


def surrogate_key(business_key: Column, salt: str) -> Column:
    """md5 of key, bar and salt; NULL for a NULL key (so `concat`, not `concat_ws`)."""
    return F.md5(F.concat(business_key.cast("string"), F.lit("|"), F.lit(salt)))


def has_text(column: Column) -> Column:
    return F.coalesce(column != "", F.lit(False))


def url_domain(url: Column) -> Column:
    """What stands between `http(s)://` and the first slash; NULL for NULL or empty links.

    Query, fragment, port and `www.` stay when no slash comes before them.
    """
    bare = F.regexp_replace(url, "^https?://", "")
    return F.when(has_text(url), F.regexp_replace(bare, "(?s)/.*$", ""))


def mention_regex(pattern: str) -> str:
    # (?d): as line end only \n counts, which the boundary class holds anyway
    return "(?d)" + params.MENTION_PREFIX + pattern + params.MENTION_SUFFIX


def mentions_any(title: Column, patterns: Patterns) -> Column:
    """True when at least one pattern occurs; one pass of one expression for all patterns.

    When every pattern has a needle, a text without any needle is ruled out by plain
    search, which is several times cheaper.
    """
    lowered = F.lower(title)
    found = lowered.rlike(mention_regex("(?:" + "|".join(p for _, p, _ in patterns) + ")"))
    needles = [needle for _, _, needle in patterns]
    if all(needles):
        found = reduce(lambda a, b: a | b, map(lowered.contains, needles)) & found
    return found


def mentioned_names(title: Column, patterns: Patterns) -> Column:
    """Array with, per pattern, the name it stands for or NULL when it does not occur."""
    lowered = F.lower(title)

    def occurs(pattern: str, needle: str | None) -> Column:
        exact = lowered.rlike(mention_regex(pattern))
        return lowered.contains(needle) & exact if needle else exact

    return F.array(*[F.when(occurs(pattern, needle), F.lit(name)) for name, pattern, needle in patterns])


def contribution_type(commits: Column, pr_events: Column) -> Column:
    """Judged by commits, not pushes: pushes without commits do not make a pusher."""
    return (
        F.when((commits > 0) & (pr_events == 0), "push_only")
        .when((commits == 0) & (pr_events > 0), "pr_only")
        .when((commits > 0) & (pr_events > 0), "both")
        .otherwise("unknown")
    )


def account_class(username: Column) -> Column:
    """Automation accounts carry the public `[bot]` suffix."""
    return F.when(username.isNull(), F.lit(None).cast("string")).when(username.like("%[bot]"), "Bot").otherwise("User")


def is_repository_name(name: Column) -> Column:
    return name.rlike(r"^[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+\z")


def relabel(column: Column, labels: dict[str, str]) -> Column:
    """Replace the given values, keep all others."""
    out = column
    for old, new in labels.items():
        out = F.when(column == old, F.lit(new)).otherwise(out)
    return out


def thousands(number: Column) -> Column:
    return F.format_number(number, 0)
