"""Schemas of the raw tables and of the JSON parts that are read."""

from pyspark.sql import types as T

EVENTS_RAW = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("repo_name", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("fetched_at", T.TimestampNTZType()),
    T.StructField("raw_payload", T.StringType()),
])

STORIES_RAW = T.StructType([
    T.StructField("story_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("time", T.LongType()),
    T.StructField("descendants", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("raw_json", T.StringType()),
    T.StructField("fetched_at", T.TimestampNTZType()),
])

# Only the parts of an event document that some dataset reads. Identifiers are
# strings, so long numbers keep their digits. `commits` stays text: only its
# length is used, and a value that is no array must not spoil the other fields.
EVENT_DOCUMENT = (
    "actor struct<login: string>,"
    "payload struct<"
    "  push_id: string, ref: string, commits: string, action: string,"
    "  pull_request: struct<id: string, title: string, user: struct<login: string>>>,"
    "created_at string"
)

# what the activity counts need of it
ACTIVITY_DOCUMENT = (
    "actor struct<login: string>,"
    "payload struct<"
    "  commits: string, action: string, pull_request: struct<user: struct<login: string>>>"
)

STORY_ITEM = (
    "id bigint, title string, `by` string, url string, score int, time bigint,"
    "descendants int, type string"
)

# One API answer: the repository asked for and its events, each kept as text.
EVENT_PAGE = "repo_name string, events array<string>"
