"""The datasets of the warehouse by name: bronze and silver as lazy views, gold (and the mentions found in
titles) as tables that are written once and then read by every report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from devsignals import params
from devsignals.functions import text
from devsignals.operators import activity, leaderboards, sketches, stories
from devsignals.plans import community
from devsignals.session import folder_exists, fresh_path, intermediates_dropped
from devsignals.sources import sinks


def repository_metadata(spark: SparkSession, repositories: Sequence[tuple[str, str, int]]) -> DataFrame:
    """The parameter list as a frame; its size is that of the list."""
    rows = [
        F.struct(F.lit(name).alias("repo_name"), F.lit(language).alias("language"), F.lit(stars).alias("stars"))
        for name, language, stars in repositories
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Layout:
    """How a gold table is stored: in folders, or in files that each hold a range of values."""

    partition_by: str | None = None
    sort_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()


LAYOUTS = {
    "activity_base": Layout(),
    "repository_totals": Layout(sort_by=("repo_name",)),
    "contributor_totals": Layout(sort_by=("username",)),
    "contributor_repository_totals": Layout(sort_by=("repo_name", "username")),
    "contributor_sketches": Layout(sort_by=("activity_date", "repo_name")),
    "contributor_ranks": Layout("scope", ("rank",)),
    "dim_repository": Layout(sort_by=("repo_name",)),
    "dim_contributor": Layout(sort_by=("username",)),
    "fct_github_daily_activity": Layout("activity_date", ("repo_name",)),
    "fct_contributor_daily_activity": Layout("activity_date", ("username", "repo_name")),
    "dim_hn_story": Layout(cluster_by=("published_at",)),
    "trending_stories": Layout(),
    "fct_hn_daily_activity": Layout(sort_by=("activity_date",)),
    "fct_hn_repo_mentions": Layout(sort_by=("mentioned_repo", "activity_date")),
    "int_hn_repo_mentions": Layout("mentioned_repo", ("published_at",)),
}

CODE_GOLD = ("dim_repository", "dim_contributor", "fct_github_daily_activity", "fct_contributor_daily_activity")
STORY_GOLD = ("dim_hn_story", "fct_hn_daily_activity", "fct_hn_repo_mentions")
GOLD = CODE_GOLD + STORY_GOLD
# what reports read besides, and the tables it is written with
SERVING = {"contributor_ranks": "dim_contributor", "contributor_sketches": "dim_contributor", "trending_stories": "dim_hn_story"}
VIEWS = ("stg_github_events", "int_push_events", "int_pull_requests", "stg_hn_stories", "int_hn_stories",
         "int_hn_repo_mentions")


# groups of tables that need no table of another group, only activity_base or dim_hn_story
INDEPENDENT = (
    ("fct_github_daily_activity", "dim_repository"),
    ("fct_contributor_daily_activity", "dim_contributor"),
    ("fct_hn_daily_activity",),
    ("fct_hn_repo_mentions",),
)


PACKED = "upto date"


def packed_upto(spark: SparkSession, path: str) -> dt.date | None:
    """The day before which a table's days are packed."""
    if not folder_exists(spark, f"{path}-packed-upto"):
        return None
    return spark.read.schema(PACKED).parquet(f"{path}-packed-upto").agg(F.max("upto")).first()[0]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table. Old days may be packed: few files, each a range of days, beside the folders of the other days. A filter on days
    skips row groups in the former and folders of the latter."""
    rows, upto = spark.read.parquet(path), packed_upto(spark, path)
    if upto is None:
        return rows
    packed = spark.read.parquet(f"{path}-packed/upto={upto}")
    return packed.unionByName(rows.filter(F.col("activity_date") >= F.lit(upto)).select(*packed.columns))


@dataclass
class Catalog:
    spark: SparkSession
    raw_events: DataFrame | None
    raw_stories: DataFrame | None
    as_of: dt.datetime = params.AS_OF
    repositories: Sequence[tuple[str, str, int]] = params.TRACKED_REPOSITORIES
    patterns: text.Patterns = params.MENTION_PATTERNS
    root: str | None = None
    read_only: bool = False
    _frames: dict[str, DataFrame] = field(default_factory=dict)

    @classmethod
    def open(cls, spark: SparkSession, root: str, as_of: dt.datetime = params.AS_OF, **options) -> Catalog:
        """The gold tables that a build has left in `root`, for reading: nothing is built or written."""
        return cls(spark, None, None, as_of, root=root.rstrip("/"), read_only=True, **options)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames and self.read_only and name in LAYOUTS:
            self._frames[name] = read_table(self.spark, self.path(name))
        if name not in self._frames:
            if name in LAYOUTS:
                self.path("")
                with intermediates_dropped(self.spark):
                    self._frames[name] = self._stored(name, BUILDERS[name](self))
            else:
                self._frames[name] = BUILDERS[name](self)
        return self._frames[name]

    def path(self, name: str) -> str:
        if self.root is None:
            self.root = fresh_path(self.spark, "gold")
        return f"{self.root}/{name}"

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        layout = LAYOUTS[name]
        sinks.write_table(df, self.path(name), layout.partition_by, layout.sort_by, cluster_by=layout.cluster_by)
        return self.spark.read.schema(df.schema).parquet(self.path(name)).select(*df.columns)

    def silver_of_gold(self) -> DataFrame:
        """Silver stories as the story dimension stores them, so that facts and mentions
        read the table instead of joining and parsing once more."""
        return self["dim_hn_story"].drop("hn_story_key", "created_at")

    def build(self, names: Sequence[str] = GOLD) -> dict[str, DataFrame]:
        """Write the named gold tables; writes that do not need each other run together."""
        if self.read_only:
            raise ValueError("this catalog was opened for reading")
        wanted = set(names)
        first = [base for base, users in (("activity_base", CODE_GOLD), ("dim_hn_story", STORY_GOLD)) if wanted & set(users)]
        chains = [[name for name in chain if name in wanted] for chain in INDEPENDENT]
        self.path("")
        with ThreadPoolExecutor(len(INDEPENDENT)) as pool:
            list(pool.map(self.__getitem__, first))
            list(pool.map(lambda chain: [self[name] for name in chain], chains))
            list(pool.map(self.__getitem__, [name for name, beside in SERVING.items() if beside in wanted]))
        return {name: self[name] for name in names}

    def register_views(self, names: Sequence[str] = VIEWS + GOLD) -> None:
        sinks.register_views({name: self[name] for name in names})


BUILDERS: dict[str, Callable[[Catalog], DataFrame]] = {
    "stg_github_events": lambda c: activity.stg_events(c.raw_events),
    "int_push_events": lambda c: activity.push_events(c["stg_github_events"]),
    "int_pull_requests": lambda c: activity.pull_requests(c["stg_github_events"]),
    "activity_base": lambda c: activity.activity_base(c["stg_github_events"]),
    "fct_github_daily_activity": lambda c: activity.repository_facts(c["activity_base"], c.as_of),
    "fct_contributor_daily_activity": lambda c: activity.contributor_facts(c["activity_base"], c.as_of),
    "repository_totals": lambda c: activity.totals(c["fct_github_daily_activity"], ["repo_name"], "commit_count"),
    "contributor_totals": lambda c: activity.totals(c["fct_contributor_daily_activity"], ["username"], "commits_in_pushes"),
    "contributor_repository_totals": lambda c: activity.totals(
        c["fct_contributor_daily_activity"], ["repo_name", "username"], "commits_in_pushes"),
    "dim_repository": lambda c: activity.repository_dimension_of(
        c["repository_totals"], repository_metadata(c.spark, c.repositories), c.as_of),
    "dim_contributor": lambda c: activity.contributor_dimension_of(c["contributor_totals"], c.as_of),
    "contributor_sketches": lambda c: sketches.daily_sketches(
        c["fct_contributor_daily_activity"], ("repo_name", "activity_date"), "username"),
    "contributor_ranks": lambda c: leaderboards.ranked_contributors(c["dim_contributor"], c["contributor_repository_totals"]),
    "stg_hn_stories": lambda c: stories.stg_stories(c.raw_stories),
    "int_hn_stories": lambda c: stories.silver_stories(c["stg_hn_stories"]),
    "int_hn_repo_mentions": lambda c: stories.mentions(c.silver_of_gold(), c.patterns),
    "dim_hn_story": lambda c: stories.story_dimension(c["int_hn_stories"], c.as_of),
    "trending_stories": lambda c: community.trending_stories(c["dim_hn_story"]),
    "fct_hn_daily_activity": lambda c: stories.story_facts(c.silver_of_gold(), c.as_of),
    "fct_hn_repo_mentions": lambda c: stories.mention_facts(c["int_hn_repo_mentions"], c.as_of),
}
