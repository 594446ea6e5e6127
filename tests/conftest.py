import sys

import pytest

from helpers import ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from rankforge.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, driver_memory="4g", app="rankforge-tests")
    yield s


@pytest.fixture(scope="session")
def hand(spark):
    """The hand set of FIXTURES.md §5: 4 users, 5 items, 2 categories, 12 rows.

    User 4 is below the cold threshold, user 9 is unknown to the users table,
    (1, 10) repeats, 'share' is an unknown type, one time is unparseable text,
    item 99 is missing from the catalog, item 50 has no tags, and items 30 / 40
    tie on popularity.
    """
    from pyspark.sql import functions as F
    rows = [
        (1, 10, "view", "2024-01-30 10:00:00"), (1, 10, "click", "2024-01-31 10:00:00"),
        (1, 20, "purchase", "2024-01-29 09:00:00"), (1, 30, "like", "2024-01-20 00:00:00"),
        (2, 10, "like", "2024-01-31 12:00:00"), (2, 20, "view", "2024-01-25 00:00:00"),
        (2, 40, "like", "2024-01-20 00:00:00"), (3, 20, "click", "2024-01-30 00:00:00"),
        (3, 50, "share", "not a time"), (3, 99, "view", "2024-01-28 00:00:00"),
        (4, 10, "view", "2024-01-31 23:00:00"), (9, 20, "purchase", "2024-01-31 00:00:00"),
    ]
    ints = spark.createDataFrame(rows, "user_id long, item_id long, interaction_type string, ts_text string")
    ints = ints.select("user_id", "item_id", "interaction_type",
                       F.try_to_timestamp("ts_text").cast("timestamp_ntz").alias("ts"),
                       F.lit(None).cast("int").alias("duration_seconds"), F.lit(None).cast("double").alias("rating"))
    items = spark.createDataFrame([
        (10, "Alpha", "A", ["x", "y"], 4.5), (20, "Beta", "A", ["y"], 3.0), (30, "Gamma", "B", ["z"], 5.0),
        (40, "Delta", "B", ["x"], 2.0), (50, "Eps", "B", [], 1.0)],
        "item_id long, title string, category string, tags array<string>, avg_rating double")
    users = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3"), (4, "u4")], "user_id long, username string")
    return {"interactions": ints, "items": items, "users": users, "as_of": "2024-02-01 00:00:00"}

