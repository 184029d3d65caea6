"""Queries over the question-and-answer tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational, skew, suffix
from .registry import query


def _owner_key(df):
    return df.withColumn("userid", F.col("owneruserid"))


@query("""with talk as (select postid, count(*) as n from comments group by postid),
    pointed_at as (select distinct relatedpostid as id from postlinks),
    trusted as (select id as owneruserid from users where reputation > 100)
    select posttypeid, count(*) as n_posts, sum(n)::bigint as n_comments, max(n) as most_comments
    from posts semi join trusted using (owneruserid) anti join pointed_at using (id) join talk on postid = posts.id
    group by posttypeid""")
def anti_join_count(t):
    """Discussed posts of owners above a reputation that no link points at, and their comments.

    Comments are counted per post before they meet the posts, so every post is one row.
    """
    linked = t.postlinks.select(F.col("relatedpostid").alias("id"))
    known = t.users.where("reputation > 100").select(F.col("id").alias("owneruserid"))
    counted = t.comments.groupBy(F.col("postid").alias("id")).agg(F.count("*").alias("n"))
    posts = skew.semi_join(t.posts.select("id", "owneruserid", "posttypeid"), known,
                           ["owneruserid"], spread_by=["id"])
    return (posts.join(skew.keys_of(linked, ["id"]), "id", "left_anti").join(counted, "id")
            .groupBy("posttypeid").agg(F.count("*").alias("n_posts"), F.sum("n").alias("n_comments"),
                                       F.max("n").alias("most_comments")))


@query("""with ages as (select tags, date_diff('year', u.creationdate, p.creationdate) as years
        from posts p join users u on u.id = p.owneruserid where u.creationdate <= p.creationdate)
    select tags, years, count(*) as n_posts from ages group by all""")
def comma_join_sql(t):
    """Posts by tag and the owner's years of membership, as SQL text with a comma join."""
    return t.spark.sql("""
        select tags, cast(year(written) - year(joined) as bigint) as years, count(*) as n_posts
        from (select owneruserid, tags, creationdate as written from {posts}) entry,
             (select id, creationdate as joined from {users}) member
        where member.id = entry.owneruserid and joined <= written
        group by tags, year(written) - year(joined)""", posts=t.posts, users=t.users)


@query("""select b.id, b.name, b.class, u.reputation from badges b join users u on u.id = b.userid
    where u.reputation < b.class * 20""")
def join_residual(t):
    users = t.users.select(F.col("id").alias("userid"), "reputation")
    return (t.badges.join(users, "userid").where(F.col("reputation") < F.col("class") * 20)
            .select("id", "name", "class", "reputation"))


@query("""select id, posttypeid from posts p
    where exists (select * from (select distinct relatedpostid from postlinks) l
                  where l.relatedpostid > p.id)""")
def exists_greater(t):
    return relational.exists_greater(t.posts, "id", t.postlinks, "relatedpostid").select(
        "id", "posttypeid")


def _with_later_users(t, posts):
    """Posts with the aggregates of the upvotes of all users created after them."""
    users = t.users.select(F.unix_date("creationdate").cast("long").alias("born"), "upvotes")
    keyed = posts.withColumn("written", F.unix_date("creationdate").cast("long"))
    return suffix.suffix_agg(keyed, "written", users, "born", "upvotes", spread_by=["id"])


@query("""select id, (select max(upvotes) from users u where u.creationdate > p.creationdate)::double
    as suffix_max from posts p""")
def suffix_max_join(t):
    return _with_later_users(t, t.posts.select("id", "creationdate")).select(
        "id", F.col("suffix_max").cast("double").alias("suffix_max"))


@query("""select id, round((select avg(upvotes) from users u where u.creationdate > p.creationdate), 6)
    as suffix_avg from posts p""")
def suffix_avg_join(t):
    return _with_later_users(t, t.posts.select("id", "creationdate")).select(
        "id", F.round("suffix_avg", 6).alias("suffix_avg"))


# the best and the mean of upvotes among users that joined after a post was written
_LATER = """days as (select creationdate as day, max(upvotes) as best, sum(upvotes) as total, count(*) as n
        from users group by creationdate),
    later as (select written, max(best) as best, sum(total)::double / sum(n) as mean
        from (select distinct creationdate as written from posts) join days on day > written group by written)"""
_LEADERS = f"""{_LATER},
    welcomed as (select userid, count(*) as n_badges from badges where name = 'signup' group by userid),
    talk as (select postid, count(*) as n_comments from comments group by postid),
    leaders as (
        select p.id, owneruserid, upvotes, n_badges, n_comments
        from posts p join later on written = p.creationdate join users u on u.id = owneruserid and upvotes = best
            join welcomed on userid = u.id join talk on postid = p.id
        where p.id < (select max(relatedpostid) from postlinks))"""


@query(f"with {_LEADERS} select id, owneruserid, upvotes from leaders")
def top_upvoter_posts(t):
    """Discussed posts whose owner matches the best of all later users in upvotes, with both."""
    return _top_upvoter_posts(t)


def _top_upvoter_posts(t):
    holders = t.badges.where(F.col("name").like("signup")).select(F.col("userid").alias("owneruserid"))
    owners = t.users.select(F.col("id").alias("owneruserid"), "upvotes")
    posts = relational.exists_greater(t.posts.select("id", "owneruserid", "creationdate"), "id",
                                      t.postlinks, "relatedpostid")
    posts = skew.salted_join(posts, skew.semi_join(owners, holders, ["owneruserid"]),
                             ["owneruserid"], spread_by=["id"])
    best = _with_later_users(t, posts).where("upvotes = suffix_max")
    commented = skew.keys_of(t.comments.select(F.col("postid").alias("id")), ["id"])
    return best.join(commented, "id", "left_semi").select("id", "owneruserid", "upvotes")


@query(f"""with {_LEADERS} select id, owneruserid, sum(n_badges * n_comments)::bigint as n
    from leaders group by id, owneruserid""")
def top_upvoter_post_rows(t):
    """The same posts, each with the pairs of one of its comments and one of its owner's badges.

    Comments and badges are counted per key and multiplied; no pair is formed.
    """
    badges = (t.badges.where(F.col("name").like("signup"))
              .groupBy(F.col("userid").alias("owneruserid")).agg(F.count("*").alias("n_badges")))
    comments = t.comments.groupBy(F.col("postid").alias("id")).agg(F.count("*").alias("n_comments"))
    held = skew.salted_join(_top_upvoter_posts(t), badges, ["owneruserid"], spread_by=["id"])
    return held.join(comments, "id").groupBy("id", "owneruserid").agg(
        F.sum(F.col("n_badges") * F.col("n_comments")).alias("n"))


@query("""select h.id, (select count(*) from votes v where v.votetypeid = 3 and v.postid = h.postid)
    as n_votes from posthistory h""")
def post_vote_gate(t):
    """Votes of type 3 per history entry; entries without such votes count 0."""
    counted = t.votes.where("votetypeid = 3").groupBy("postid").agg(F.count("*").alias("n_votes"))
    history = t.posthistory.select("id", "postid")
    return (skew.salted_join(history, counted, ["postid"], "left", spread_by=["id"])
            .select("id", F.coalesce("n_votes", F.lit(0)).alias("n_votes")))


@query(f"""with {_LATER},
    thirds as (select postid, count(*) as n_votes from votes where votetypeid = 3 group by postid),
    holders as (select distinct userid from badges where lower(name) in ('signup', 'error')),
    edited as (select distinct postid from posthistory h semi join holders using (userid)
               join users u on u.id = h.userid and u.displayname = h.userdisplayname)
    select distinct p.id, owneruserid, p.creationdate, posttypeid, tags, coalesce(n_votes, 0) as n_votes
    from posts p semi join edited on edited.postid = p.id left join thirds on thirds.postid = p.id
        join later on written = p.creationdate
    where mean >= 4000 + 400 * coalesce(n_votes, 0)""")
def active_badge_posts(t):
    """Distinct posts edited by a badge holder whose later users average more upvotes than their votes demand.

    Every join but that of the votes only tests for existence, so a post stays one row; a post that the
    table has twice is one row too.
    """
    holders = t.badges.where(F.lower("name").isin("signup", "error")).select("userid")
    users = t.users.select(F.col("id").alias("userid"), F.col("displayname").alias("userdisplayname"))
    active = skew.semi_join(users, holders, ["userid"])
    history = skew.semi_join(t.posthistory, active, ["userid", "userdisplayname"], spread_by=["id"])
    wanted = history.select(F.col("postid").alias("id"))
    counted = (t.votes.where("votetypeid = 3").groupBy(F.col("postid").alias("id"))
               .agg(F.count("*").alias("n_votes")))
    posts = (t.posts.join(skew.keys_of(wanted, ["id"]), "id", "left_semi").join(counted, "id", "left")
             .withColumn("n_votes", F.coalesce("n_votes", F.lit(0))))
    return (_with_later_users(t, posts).where(F.col("suffix_avg") >= 4000 + 400 * F.col("n_votes"))
            .select("id", "owneruserid", "creationdate", "posttypeid", "tags", "n_votes").distinct())
