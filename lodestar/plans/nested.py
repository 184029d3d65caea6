"""Books with embedded editions, borrowings with an embedded person."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import nested
from .registry import query


PAGE_IDS = 100_000  # ids of editions to a page, so no page of a book holds more children

_SHOWN = """count(e.edition) as n_editions, coalesce(string_agg(
        concat(e.edition, ':', e.year, ':', e.owned), ' ' order by e.edition, e.year, e.owned), '') as editions"""


def _documents(t, page=None):
    shown = F.transform("editions", lambda e: F.concat_ws(":", e["edition"], e["year"], e["owned"]))
    return nested.embed_children(t.book, t.edition, "id", "book", "editions", page).select(
        "id", "name", "authors", "chunk", F.size("editions").cast("long").alias("n_editions"),
        F.array_join(shown, " ").alias("editions"))


@query(f"""select b.id, b.name, b.authors, 0 as chunk, {_SHOWN}
    from book b left join edition e on e.book = b.id group by b.id, b.name, b.authors""")
def embed_children(t):
    """The documents, one of each book at every size; the list is shown as text."""
    return _documents(t)


@query(f"""select b.id, b.name, b.authors, coalesce(e.edition // {PAGE_IDS}, 0)::bigint as chunk, {_SHOWN}
    from book b left join edition e on e.book = b.id group by b.id, b.name, b.authors, e.edition // {PAGE_IDS}""")
def embed_children_paged(t):
    """A document for each book and page of edition ids, so that no list is larger than a page."""
    return _documents(t, F.floor(F.col("edition") / PAGE_IDS))


@query("select b.id, coalesce(sum(e.owned), 0)::bigint as owned from book b left join edition e on e.book = b.id group by b.id")
def sum_nested(t):
    return nested.sum_children(t.book, t.edition, "id", "book", "owned", "owned")


@query("select book as id, edition, year::int as year, owned from edition where book in (select id from book)")
def unnest_children(t):
    return nested.children_of(t.book, t.edition, "id", "book", spread_by=["edition"])


@query("""select b.id, b.who, b.book, b.from_date, p.name as who_name, p.address as who_address
    from borrowed b left join person p on p.pid = b.who""")
def embed_parent(t):
    return nested.embed_parent(t.borrowed, t.person, "who", "pid", "who_", spread_by=["id"])


@query("""with o as (select book, sum(owned) as owned from edition group by book),
    l as (select book, count(*) as lent from borrowed group by book)
    select id, coalesce(owned, 0)::bigint as owned, coalesce(lent, 0) as borrowed,
        (coalesce(owned, 0) - coalesce(lent, 0))::bigint as available
    from book left join o on o.book = id left join l on l.book = id""")
def copies_available(t):
    return nested.copies_available(t.book, t.edition, t.borrowed, "id", "book", "owned", "book")
