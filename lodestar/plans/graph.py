"""Queries over the property graph."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import graph, motif, paths
from ..operators.ordering import ordered_limit
from ..session import materialise, shuffle_width
from ..sources import versions
from .registry import query


@query("select distinct countries from nodes where label = 'Address'")
def graph_countries(t):
    return graph.label_scan(t.nodes, "Address").select("countries").distinct()


@query("select countries, count(countries) as n from nodes where label = 'Address' group by countries")
def graph_country_counts(t):
    return graph.label_scan(t.nodes, "Address").groupBy("countries").agg(
        F.count("countries").alias("n"))


@query("""select distinct o.id, o.name from nodes o join edges e on e.src = o.id
    join nodes a on a.id = e.dst where o.label = 'Officer' and e.type = 'REGISTERED_ADDRESS'
    and a.label = 'Address' and a.countries = 'ASIA'""")
def graph_one_hop(t):
    return graph.one_hop(t.nodes, t.edges, "Officer", "REGISTERED_ADDRESS", "Address",
                         countries="ASIA").select("id", "name")


@query("""select distinct o.id, o.name from nodes o join edges e on e.src = o.id
    join nodes a on a.id = e.dst where o.label = 'Officer' and e.type = 'REGISTERED_ADDRESS'
    and a.label = 'Address' and a.countries = 'ASIA' order by o.id limit 5""")
def graph_one_hop_first(t):
    return ordered_limit(graph_one_hop(t), [F.asc("id")], 5)


@query("""select src as id, count(*) as degree from edges where type = 'INTERMEDIARY_OF'
    group by src order by degree desc, id limit 20""")
def graph_top_intermediaries(t):
    return ordered_limit(graph.degree(t.edges, "INTERMEDIARY_OF"),
                         [F.desc("degree"), F.asc("id")], 20)


_DEGREES = """m as (select src, count(*) as n from edges where type = 'INTERMEDIARY_OF' group by src),
    o as (select src, count(*) as n from edges where type = 'OFFICER_OF' group by src),
    d as (select i.id, i.name, m.n * o.n as bindings from nodes i join m on m.src = i.id
          join o on o.src = i.id where i.label = 'Intermediary')"""


def _products(t, by):
    return graph.degree_product(t.nodes, t.edges, "Intermediary", "INTERMEDIARY_OF", "OFFICER_OF", by)


@query(f"with {_DEGREES} select name, sum(bindings)::bigint as n_bindings from d group by name")
def graph_degree_product(t):
    return _products(t, "name")


@query(f"""with {_DEGREES} select id, bindings::bigint as n_bindings from d
    order by n_bindings desc, id limit 20""")
def graph_degree_product_by_node(t):
    return ordered_limit(_products(t, "id"), [F.desc("n_bindings"), F.asc("id")], 20)


@query(f"""with {_DEGREES}, best as (select id from d order by bindings desc, id limit 1)
    select src, dst, type from edges where src = (select id from best)
    and type not in ('INTERMEDIARY_OF', 'OFFICER_OF')""")
def graph_top_expand(t):
    best = ordered_limit(_products(t, "id"), [F.desc("n_bindings"), F.asc("id")], 1)
    return graph.expand(t.edges, best, ["INTERMEDIARY_OF", "OFFICER_OF"])


_MOTIF = """with m as (select distinct i.id as i, e.id as e, o.id as o, e.countries as c,
            e.jurisdiction as j, e.country_codes as k
        from nodes i join edges x on x.src = i.id and x.type = 'INTERMEDIARY_OF'
        join nodes e on e.id = x.dst join edges y on y.dst = e.id and y.type = 'OFFICER_OF'
        join nodes o on o.id = y.src
        where i.label = 'Intermediary' and e.label = 'Entity' and o.label = 'Officer')
    select {} from m a join m b on a.i = b.i and a.o = b.o
    where a.c <> b.c and (a.j <> a.k or b.j <> b.k)"""
_MOTIF_OF = ("INTERMEDIARY_OF", "OFFICER_OF", "Intermediary", "Officer", "Entity")


@query(_MOTIF.format("a.i, a.o, count(*) as n_matches") + " group by a.i, a.o")
def graph_motif(t):
    return motif.shared_pair_motif(t.nodes, t.edges, *_MOTIF_OF)


@query(_MOTIF.format("a.i, a.o, a.e, b.e as e2") + " order by a.i, a.o, a.e, b.e limit 1")
def graph_motif_first(t):
    return motif.first_motif_match(t.nodes, t.edges, *_MOTIF_OF)


_START = 5000000000


def _linked(t, remainder):
    other = graph.label_scan(t.nodes, "Other")
    return other.where((F.col("id") - _START) % 40 == remainder).select("id")


_BOTH_WAYS = """links as (select src as a, dst as b from edges where type = 'LINKED'
        union select dst, src from edges where type = 'LINKED')"""


@query(f"""with recursive {_BOTH_WAYS},
    walk as (select id as source, id as node, 0 as hops from nodes
             where label = 'Other' and (id - {_START}) % 40 = 0
             union
             select source, b, hops + 1 from walk join links on a = node where hops < 30),
    best as (select source, node, min(hops) as hops from walk group by source, node)
    select source, node as target, hops::bigint as hops from best
    where (node - {_START}) % 40 = 20 and hops >= 16""")
def graph_shortest_paths(t):
    return paths.shortest_paths(graph.typed(t.edges, "LINKED"), _linked(t, 0), _linked(t, 20),
                                max_hops=30, min_hops=16).select(
        "source", "target", F.col("hops").cast("long").alias("hops"))


@query(f"""with recursive {_BOTH_WAYS},
    walk as (select id as source, id as node, 0 as hops, [id] as path from nodes
             where label = 'Other' and (id - {_START}) % 40 = 0
             union all
             select source, b, hops + 1, list_append(path, b) from walk join links on a = node
             where hops < 30 and not list_contains(path, b)),
    best as (select source, node, min(hops) as hops from walk
             where (node - {_START}) % 40 = 20 group by source, node having min(hops) >= 16
             order by source, node limit 1),
    hit as (select min(w.path) as path from walk w join best b
            on w.source = b.source and w.node = b.node and w.hops = b.hops)
    select source, node as target, hops::bigint as hops,
        array_to_string((select path from hit), '>') as path from best""")
def graph_shortest_path_first(t):
    """The first such pair with the nodes of its path."""
    found = paths.first_path(graph.typed(t.edges, "LINKED"), _linked(t, 0), _linked(t, 20),
                             max_hops=30, min_hops=16)
    shown = F.array_join(F.col("path").cast("array<string>"), ">")
    return found.select("source", "target", F.col("hops").cast("long").alias("hops"),
                        shown.alias("path"))


@query("""select name, count(*) as n from nodes where label = 'Intermediary' group by name
    having count(*) > 1""")
def graph_unique_check(t):
    return graph.duplicate_keys(graph.label_scan(t.nodes, "Intermediary"), ["name"])


@query("""select id, countries from nodes where label = 'Other' and countries is not null
    and countries not like '%;%'""")
def single_valued_countries(t):
    return graph.label_scan(t.nodes, "Other").where(graph.single_valued("countries")).select(
        "id", "countries")


@query("""select r_name as name from region union
    select countries from nodes where label = 'Other' and countries is not null
    and countries not like '%;%'""")
def graph_merge_nodes(t):
    """Country nodes after the upsert; the regions are there already."""
    incoming = single_valued_countries(t).select(F.col("countries").alias("name"))
    return graph.merge_keys(t.region.select(F.col("r_name").alias("name")), incoming, ["name"])


@query("select id, label, countries from nodes")
def graph_unique_write(t):
    """Nodes written under the rule that no id repeats: the write itself checks it."""
    return materialise(graph.enforced_unique(t.nodes.select("id", "label", "countries"), ["id"]), "unique-nodes")


_IN_COUNTRY = """select id as src, countries as country, 'IN_COUNTRY' as type, 'node' as origin from nodes
        where label = 'Other' and countries is not null and countries not like '%;%'"""


def _in_country(t):
    """Edges kept in storage: those of suppliers are there, then two upserts, the second of known edges."""
    kind = F.lit("IN_COUNTRY").alias("type")
    nations = F.broadcast(t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"))  # 25 rows
    known = t.supplier.join(nations, "s_nationkey").select(
        (-F.col("s_suppkey")).alias("src"), F.col("n_name").alias("country"), kind, F.lit("supplier").alias("origin"))
    found = single_valued_countries(t).select(
        F.col("id").alias("src"), F.col("countries").alias("country"), kind, F.lit("node").alias("origin"))
    table = versions.VersionedTable.create(
        known, f"in_country_{uuid.uuid4().hex}", ["src", "country", "type"], shuffle_width(t.spark))
    table.upsert(found)
    table.upsert(known.where("src % 2 = 0").withColumn("origin", F.lit("supplier, checked")))
    return table.read()


@query(f"""{_IN_COUNTRY} union all
    select -s_suppkey, n_name, 'IN_COUNTRY',
        case when s_suppkey % 2 = 0 then 'supplier, checked' else 'supplier' end
    from supplier join nation on n_nationkey = s_nationkey""")
def graph_merge_edges(t):
    """Country edges after two upserts to storage."""
    return _in_country(t)


@query("""select id, name from nodes where label = 'Other' and countries = 'ECONOMY'""")
def graph_in_country(t):
    """Nodes around one country node."""
    edges = _in_country(t).select("src", F.col("country").alias("dst"), "type")
    into = graph.typed(edges, "IN_COUNTRY").where(F.col("dst") == "ECONOMY")
    return graph.semi_join(t.nodes, into.select(F.col("src").alias("id")), ["id"]).select("id", "name")
