"""Check side of the views: plain SQL over the driver's tables, used by ``oracle_sql()`` only."""

from __future__ import annotations

import re

SQL_VIEWS = {
    "reviews": """
        select doc_id as review_id, lang as category, text as review_text from documents
    """,
    "shop": """
        select event_id, ts as event_time, event_type, k as product_id, k % 5 as category_id,
        case when k % 10 = 0 then null else concat('brand', cast(k % 7 as string)) end as brand,
        value as price, user_id * 50 + event_id % 50 as buyer_id, user_id from (select *,
        cast(regexp_extract(props, '[0-9]+', 0) as bigint) as k from events) e
    """,
    "oct": """
        select * from shop where event_time < timestamp '2024-01-16 00:00:00'
    """,
    "nov": """
        select * from shop where event_time >= timestamp '2024-01-16 00:00:00'
    """,
    "users": """
        select c_custkey as id, c_name as displayname, cast(floor(c_acctbal) as bigint) as
        upvotes, c_custkey % 400 as reputation, cast('1995-01-01' as date) + cast((c_custkey *
        37) % 2400 as int) as creationdate from customer
    """,
    "posts": """
        select o_orderkey as id, o_custkey as owneruserid, cast(o_orderdate as date) as
        creationdate, cast(substr(o_orderpriority, 1, 1) as int) as posttypeid, o_orderpriority
        as tags from orders
    """,
    "comments": """
        select l_orderkey * 10 + l_linenumber as id, l_orderkey as postid, l_suppkey as userid
        from lineitem
    """,
    "postlinks": """
        select l_orderkey as postid, l_partkey * 8 as relatedpostid from lineitem where
        l_returnflag = 'R'
    """,
    "badges": """
        select event_id as id, user_id * 10 + event_id % 10 as userid, event_type as name,
        cast(regexp_extract(props, '[0-9]+', 0) as bigint) % 3 + 1 as class, cast(ts as date) as
        date_ from events
    """,
    "votes": """
        select l_orderkey * 10 + l_linenumber as id, l_orderkey as postid, l_linenumber as
        votetypeid from lineitem
    """,
    "posthistory": """
        select o.o_orderkey as id, o.o_custkey as userid, o.o_orderkey as postid, c.c_name as
        userdisplayname from orders o join customer c on c.c_custkey = o.o_custkey
    """,
    "r": """
        select l_suppkey % 51 as a, l_partkey % 51 as b, cast(l_quantity as bigint) as c from
        lineitem
    """,
    "s": """
        select l_suppkey % 21 as d, l_partkey % 51 as b, 
        cast(l_quantity as bigint) - cast(l_quantity as bigint) % 2 as c from lineitem
    """,
    "t": """
        select o_custkey % 51 as a, o_orderkey % 21 as d, (o_custkey + o_orderkey) % 51 as c
        from orders
    """,
    "u": """
        select c_custkey % 21 as a, c_custkey % 17 as b, cast(c_nationkey % 21 as bigint) as d
        from customer
    """,
    "libraries": """
        select s_suppkey as libid, s_name as info, s_nationkey as city from supplier
    """,
    "books": """
        select distinct l_partkey as bid, l_suppkey as home, l_partkey % 2 as available from
        lineitem
    """,
    "book_reviews": """
        select event_id as rid, cast(regexp_extract(props, '[0-9]+', 0) as bigint) * 30 as bid,
        event_type as body from events
    """,
    "book": """
        select p_partkey as id, p_name as name, concat(p_brand, ', ', p_type) as authors from
        part
    """,
    "edition": """
        select l_partkey as book, l_orderkey * 10 + l_linenumber as edition, year(l_shipdate) as
        year, cast(l_quantity as bigint) % 5 as owned from lineitem
    """,
    "person": """
        select c_custkey as pid, c_name as name, c_mktsegment as address from customer
    """,
    "borrowed": """
        select event_id as id, user_id as who, cast(regexp_extract(props, '[0-9]+', 0) as
        bigint) * 20 as book, cast(ts as date) as from_date from events where event_type =
        'click'
    """,
    "nodes": """
        select 1000000000 + n_nationkey as id, 'Address' as label, n_name as name, case when
        n_nationkey % 6 = 0 then null when n_nationkey % 7 = 0 then concat(r_name, ';OTHER')
        else r_name end as countries, cast(null as string) as country_codes, cast(null as
        string) as jurisdiction from nation join region on r_regionkey = n_regionkey
        union all select 2000000000 + c_custkey, 'Officer', c_name, null, null, null from
        customer
        union all select 3000000000 + s_suppkey, 'Intermediary', concat('I', cast(s_suppkey % 40
        as string)), null, null, null from supplier
        union all select 4000000000 + o_orderkey, 'Entity', null, concat('C', cast(o_orderkey %
        5 as string)), concat('K', cast(o_orderkey % 5 as string)), concat('K', cast(o_custkey %
        5 as string)) from orders
        union all select 5000000000 + p_partkey, 'Other', p_name, case when p_size % 9 = 0 then
        null when p_size % 9 = 1 then 'AFRICA;ASIA' else p_type end, null, null from part
    """,
    "edges": """
        select 2000000000 + c_custkey as src, 1000000000 + c_nationkey as dst,
        'REGISTERED_ADDRESS' as type from customer
        union all select 3000000000 + s_suppkey, 1000000000 + s_nationkey, 'REGISTERED_ADDRESS'
        from supplier
        union all select distinct 3000000000 + l_suppkey, 4000000000 + l_orderkey,
        'INTERMEDIARY_OF' from lineitem
        union all select 2000000000 + o_custkey, 4000000000 + o_orderkey, 'OFFICER_OF' from
        orders
        union all select distinct 3000000000 + l_suppkey, 4000000000 + l_orderkey, 'OFFICER_OF'
        from lineitem where l_linenumber = 7
        union all select 5000000000 + p_partkey, 5000000001 + p_partkey, 'LINKED' from part
        where p_partkey % 40 <> 39 and p_partkey + 1 < (select count(*) from part)
        union all select 5000000000 + p_partkey, 5000000007 + p_partkey, 'LINKED' from part
        where p_partkey % 110 = 0 and p_partkey + 7 < (select count(*) from part)
    """,
}


def with_views(sql: str) -> str:
    """Puts the views that ``sql`` names, and those they name, before it as CTEs."""
    body = sql.strip()
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, view in SQL_VIEWS.items():
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b|,\s*{name}\s+[a-z]\w?\b",
                                                text):
                visit(view)
                needed.append(name)

    visit(body)
    ctes = ", ".join(f"{name} as ({SQL_VIEWS[name].strip()})" for name in needed)
    if not ctes:
        return body
    if body.startswith("with recursive "):
        return f"with recursive {ctes}, {body.removeprefix('with recursive ')}"
    if body.startswith("with "):
        return f"with {ctes}, {body.removeprefix('with ')}"
    return f"with {ctes} {body}"
