"""Queries over posts and triples on rows made here: their grain and repeated keys."""

from datetime import date
from types import SimpleNamespace

import pytest

from lodestar.plans import qa, relational


@pytest.fixture
def tables(spark):
    """Owner 1 has most upvotes of all; post 10 is repeated, post 11 has other text, post 90 is no link's."""
    old, new = date(2000, 1, 1), date(2001, 1, 1)

    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    return SimpleNamespace(
        spark=spark,
        users=table([(1, "one", 9000, new), (2, "two", 9000, new), (3, "three", 10, new)],
                    "id long, displayname string, upvotes long, creationdate date"),
        posts=table([(10, 1, old, 1, "t"), (10, 1, old, 1, "t"), (11, 1, old, 2, "u"), (12, 3, old, 2, "u"),
                     (13, 2, old, 3, None), (90, 1, old, 1, "t")],
                    "id long, owneruserid long, creationdate date, posttypeid int, tags string"),
        comments=table([(1, 10), (2, 10), (3, 11), (4, 12), (5, 13), (6, 90)], "id long, postid long"),
        postlinks=table([(1, 50)], "postid long, relatedpostid long"),
        badges=table([(1, 1, "signup"), (2, 1, "signup"), (3, 1, "error"), (4, 2, "signup"), (5, 3, "signup")],
                     "id long, userid long, name string"),
        votes=table([(1, 11, 3), (2, 11, 3), (3, 12, 1)], "id long, postid long, votetypeid long"),
        posthistory=table([(10, 1, 10, "one"), (11, 1, 11, "one"), (12, 3, 12, "three"), (13, 2, 13, "other")],
                          "id long, userid long, postid long, userdisplayname string"))


def test_rows_of_leading_posts_are_counted_post_by_post(tables, rows):
    found = qa.top_upvoter_post_rows(tables).select("id", "owneruserid", "n")
    # post 10 stands twice, with two comments and two badges
    assert rows(found) == [(10, 1, 8), (11, 1, 2), (13, 2, 1)]


def test_edited_posts_keep_all_columns_and_stand_once(tables, rows):
    found = qa.active_badge_posts(tables)
    old = date(2000, 1, 1)
    assert found.columns == ["id", "owneruserid", "creationdate", "posttypeid", "tags", "n_votes"]
    # the editor of post 13 goes by another name there
    assert rows(found) == [(10, 1, old, 1, "t", 0), (11, 1, old, 2, "u", 2), (12, 3, old, 2, "u", 0)]


def test_known_pairs_are_rows(spark, rows):
    def table(values, names):
        return spark.createDataFrame(values, ", ".join(f"{n} long" for n in names))

    t = SimpleNamespace(
        u=table([(1, 5, 9), (1, 5, 9), (1, 6, 9), (1, None, 9)], "abd"),
        t=table([(1, 9, 7), (1, 9, 7), (1, 9, 8)], "adc"),
        r=table([(1, 5, 7), (1, 5, 8), (1, 6, 8), (1, None, 7)], "abc"),
        s=table([(9, 5, 7), (9, 5, 7), (9, 6, 8), (9, None, 7)], "dbc"))
    found = relational.semi_join_in(t)
    assert found.columns == ["a", "b", "c", "d"]
    assert rows(found) == [(1, 5, 7, 9), (1, 6, 8, 9)]
