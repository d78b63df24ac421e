"""Parameters of the engine. Operators take these as arguments and never embed them."""

from __future__ import annotations

import datetime as dt

# ---------------------------------------------------------------------------
# Results depend on these exact texts and numbers.
# ---------------------------------------------------------------------------

# repository, main language, stars
TRACKED_REPOSITORIES = (
    ("facebook/react", "JavaScript", 225000),
    ("microsoft/vscode", "TypeScript", 165000),
    ("vercel/next.js", "JavaScript", 125000),
)

# repository, expression looked for in the lower-cased title, text that every match of the
# expression holds (or None): it spares most titles the expression
MENTION_PATTERNS = (
    ("facebook/react", r"(?:react(?:\.?js)?)", "react"),
    ("microsoft/vscode", r"(?:vscode|vs\s*code|visual\s+studio\s+code)", "code"),
    ("vercel/next.js", r"(?:next[\.\s]?js)", "js"),
)
MENTION_PREFIX = r"""(?:^|[\s\-\.,;:!?\(/"'])"""
MENTION_SUFFIX = r"""(?:$|[\s\-\.,;:!?\)/"'])"""

# salts of the surrogate keys
REPOSITORY_SALT = "2026-07-13"
CONTRIBUTOR_SALT = "2026-07-13"
STORY_SALT = "2026-07-18"

PUSH = "PushEvent"
PULL_REQUEST = "PullRequestEvent"
STORY = "story"

ACCEPTED_PR_ACTIONS = (
    "opened", "closed", "reopened", "synchronize", "assigned", "unassigned",
    "review_requested", "review_request_removed", "labeled", "unlabeled",
    "edited", "merged",
)
CONTRIBUTION_TYPES = ("push_only", "pr_only", "both", "unknown")

UNKNOWN_LANGUAGE = "Unknown"
UNKNOWN_TEXT = "Unknown"
STORY_SOURCE_LABEL = "Hacker News Top Stories"

HIGH_RISK = "High Risk - Bottleneck"
MEDIUM_RISK = "Medium Risk"
HEALTHY_SPREAD = "Healthy - Distributed"

# ---------------------------------------------------------------------------
# Tunable defaults
# ---------------------------------------------------------------------------

REPOSITORY_NAMES = tuple(name for name, _, _ in TRACKED_REPOSITORIES)

DEFAULT_WINDOW_DAYS = 30
FRESH_HOURS = 24
STALE_HOURS = 48
SOURCE_WARN_HOURS = 6
SOURCE_ERROR_HOURS = 12
MIN_TREND_POINTS = 4
TOP_STORY_CAP = 50
INGEST_FRESH_MINUTES = 60
TRENDING_HELD = 1000

# build time used wherever "now" is needed, so that a build can be repeated
AS_OF = dt.datetime(2024, 2, 1)
RANGE_START = dt.date(2024, 1, 1)
RANGE_END = dt.date(2024, 1, 30)
SAMPLE_REPOSITORY = "facebook/react"
SAMPLE_USER = "user_8"
