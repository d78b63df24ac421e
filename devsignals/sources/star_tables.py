"""Raw-shaped event and story tables derived from a star-schema data folder.

The folder holds no code-hosting or news data, so `events` becomes the raw event
table and `documents` with `pages` the raw story table, row by row and whole.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from devsignals import params
from devsignals.functions import times


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    first, second, third = params.REPOSITORY_NAMES
    base = read(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.col("event_type").alias("kind"),
        F.col("ts").cast("timestamp_ntz").alias("fetched_at"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.when(F.col("event_id") % 3 == 0, first)
        .when(F.col("event_id") % 3 == 1, second)
        .otherwise(third)
        .alias("repo_name"),
    )
    kind, user = F.col("kind"), F.col("user_id")
    typed = base.withColumn(
        "event_type",
        F.when(user % 7 == 2, params.PULL_REQUEST)
        .when(user % 7 == 3, params.PUSH)
        .when(kind.isin("click", "signup"), params.PUSH)
        .when(kind.isin("view", "purchase"), params.PULL_REQUEST)
        .otherwise("IssuesEvent"),
    ).withColumn("login", F.expr("if(k % 10 = 9, null, concat('user_', user_id))"))
    document = F.to_json(F.expr(f"""
        struct(
          cast(event_id as string) as id,
          event_type as type,
          struct(login) as actor,
          struct(repo_name as name) as repo,
          struct(
            if(event_type = '{params.PUSH}', event_id, null) as push_id,
            if(event_type = '{params.PUSH}', 'refs/heads/main', null) as ref,
            case
              when event_type <> '{params.PUSH}' then null
              when user_id % 5 = 1 then array()
              when k % 6 = 5 then null
              when k % 6 = 0 then array()
              else transform(sequence(1, k % 6), i -> struct(
                     concat(event_id, '-', i) as sha, concat('commit ', i) as message))
            end as commits,
            case
              when event_type <> '{params.PULL_REQUEST}' or k % 25 = 24 then null
              else element_at(array('opened', 'closed', 'merged', 'labeled', 'synchronize'), k % 5 + 1)
            end as action,
            if(event_type = '{params.PULL_REQUEST}', struct(
                event_id as id,
                if(k % 4 = 3, null, concat('PR ', event_id)) as title,
                struct(login) as user), null) as pull_request
          ) as payload,
          date_format(fetched_at - make_dt_interval(0, 0, k), "yyyy-MM-dd'T'HH:mm:ss'Z'") as created_at
        )"""))
    return typed.select(
        F.col("event_id").cast("string").alias("event_id"),
        "repo_name",
        "event_type",
        "fetched_at",
        document.alias("raw_payload"),
    )


STORY_FETCHED_AT = dt.datetime(2024, 2, 1)
_ITEM = "struct(story_id as id, title, author as `by`, url, score, time, descendants, type)"


def _with_raw_json(stories: DataFrame) -> DataFrame:
    return stories.withColumn("raw_json", F.to_json(F.expr(_ITEM)))


def raw_stories(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    pages = read(spark, folder, "pages").select("page_id", "url")
    stories = documents.join(pages, documents.doc_id == pages.page_id, "left").selectExpr(
        "doc_id as story_id",
        """concat(if(doc_id % 7 = 0, 'React vs Next.js: ', ''),
                  if(doc_id % 13 = 0, 'VS Code tips - ', ''),
                  if(doc_id % 17 = 0, 'Reactive programming ', ''),
                  text) as title""",
        "if(doc_id % 50 = 0, null, source) as author",
        "url",
        "cast(n_chars % 500 as int) as score",
        "1704067200 + (doc_id * 2592) % 2592000 as time",
        "if(doc_id % 11 = 0, null, cast(n_chars % 37 as int)) as descendants",
        "if(doc_id % 20 = 19, 'job', 'story') as type",
    )
    return _with_raw_json(stories).withColumn("fetched_at", times.moment(STORY_FETCHED_AT))


# --- two polls of each source: the second overlaps the first and adds the rest ---

FIRST_POLL_END = dt.datetime(2024, 1, 20)
SECOND_POLL_START = dt.datetime(2024, 1, 10)


def event_polls(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = raw.filter(F.col("fetched_at") < times.moment(FIRST_POLL_END))
    second = raw.filter(F.col("fetched_at") >= times.moment(SECOND_POLL_START)).withColumn(
        "fetched_at", F.col("fetched_at") + F.make_dt_interval(days=F.lit(1))
    )
    return first, second


def story_polls(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The second poll sees higher scores, no comment count and a changed title."""
    first = raw.filter(F.col("time") < times.to_epoch_seconds(FIRST_POLL_END))
    second = raw.filter(F.col("time") >= times.to_epoch_seconds(SECOND_POLL_START)).selectExpr(
        "story_id", "concat('Edited: ', title) as title", "author", "url", "score + 10 as score",
        "time", "cast(null as int) as descendants", "type",
        "fetched_at + make_dt_interval(1) as fetched_at",
    )
    return first, _with_raw_json(second).select(first.columns)


# --- the same data as the APIs would hand it out: text to be landed in files ---

PAGE_SIZE = 30


def event_pages(raw: DataFrame) -> DataFrame:
    """One text row per API answer of at most PAGE_SIZE events of one repository.

    Pages are cut from the row position within a task, so no group can be larger.
    """
    page = F.call_function("div", F.monotonically_increasing_id(), F.lit(PAGE_SIZE))
    return (
        raw.withColumn("page", page)
        .groupBy("repo_name", "page")
        .agg(F.concat_ws(",", F.collect_list("raw_payload")).alias("body"))
        .select(F.concat(F.lit('{"repo_name":"'), "repo_name", F.lit('","events":['), "body", F.lit("]}")).alias("value"))
    )


def mixed_answers(raw: DataFrame) -> DataFrame:
    """One answer per event, as a page or as a bare array; every 20th is cut off, and every 20th has an event without id."""
    n, body = F.col("event_id").cast("long"), F.col("raw_payload")
    page = F.concat(F.lit('{"repo_name":"'), "repo_name", F.lit('","events":['))
    return raw.select(
        F.when(n % 20 == 0, F.concat(page, F.substring(body, 1, 20)))
        .when(n % 20 == 1, F.lit('[{"type":"PushEvent"}]'))
        .when(n % 2 == 0, F.concat(page, body, F.lit("]}")))
        .otherwise(F.concat(F.lit("["), body, F.lit("]"))).alias("value"))


def story_items(raw: DataFrame) -> DataFrame:
    """One text row per story item, with the defects a poll may meet.

    By story number: no id, id 0, empty title, no title; absent or explicitly null
    `score` and `descendants`; absent `type`.
    """
    n = F.col("story_id")
    fields = raw.select(
        n,
        F.when(n % 29 == 1, F.lit(None)).when(n % 29 == 2, F.lit(0)).otherwise(n).alias("id"),
        F.when(n % 31 == 3, F.lit("")).when(n % 31 == 4, F.lit(None)).otherwise(F.col("title")).alias("title"),
        F.col("author").alias("by"),
        "url",
        F.when(n % 5 == 2, F.lit(None)).otherwise(F.col("score")).alias("score"),
        "time",
        "descendants",
        F.when(n % 3 == 1, F.lit(None)).otherwise(F.col("type")).alias("type"),
    )
    item = F.struct("id", "title", "by", "url", "score", "time", "descendants", "type")
    # even numbers drop absent fields, odd numbers spell out null
    return fields.select(
        F.when(n % 2 == 0, F.to_json(item)).otherwise(F.to_json(item, {"ignoreNullFields": "false"})).alias("value")
    )
