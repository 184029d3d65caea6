"""The registered queries of this package, each a thin use of its operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bitsliced_simhash, byte_cnn, external_shuffle, filter_audit, hard_negatives, kneser_ney, pii_boosting,
    positional_index, quality_rules, residual_packing, url_automaton, warc_writer, window_packing,
)

QUERIES, ORACLE = {}, {}


def byte_bpe() -> str:
    """Where the public byte-level vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function under its own name."""
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function
    return add


@query()
def op8_simhash_components(spark, sf_dir):
    found = bitsliced_simhash.fingerprint_components(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


_RULE_SQL = " union all ".join(
    f"select doc_id, stratum, good, '{r}' as rule, 1000 * {a} // greatest({b}, 1) as score from labelled"
    for r, (a, b) in quality_rules.RULES.items())
_RATE = quality_rules.ALPHA / len(quality_rules.RULES)
_LEVEL = quality_rules.DELTA / (len(quality_rules.RULES) * (len(quality_rules.STRATA) + 1))
_FIRST_RULE = "case " + " ".join(
    f"when bool_or(rule = '{r}') then '{r}'" for r in quality_rules.RULES) + " end"


@query(f"""
with base as (
    select doc_id, coalesce(text, '') as text,
        case when lang in {quality_rules.STRATA} then lang else 'other' end as stratum,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
        [x for x in string_split(coalesce(text, ''), chr(10))
         if regexp_matches(x, '[^\x20\x09-\x0D]')] as l
    from documents),
runs as (
    select doc_id, unnest(range(1, len(w) - 1)) as i, unnest([w[j] || ' ' || w[j + 1] || ' ' || w[j + 2]
        for j in range(1, len(w) - 1)]) as run from base where len(w) >= 3),
twice as (select doc_id, i, count(*) over (partition by doc_id, run) as c from runs),
covered as (
    select doc_id, count(distinct p) as n_repeat_words
    from (select doc_id, unnest([i, i + 1, i + 2]) as p from twice where c > 1) group by doc_id),
counts as (
    select b.doc_id, stratum, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
        len(l) - len(list_distinct(l)) as n_dup_lines, len(l) as n_lines,
        coalesce(n_repeat_words, 0) as n_repeat_words,
        length(regexp_replace(text, '[^!?]+', '', 'g')) as n_marks,
        length(regexp_replace(text, '[^\\p{{Lu}}]+', '', 'g')) as n_upper
    from base b left join covered c on b.doc_id = c.doc_id),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts),
labelled as (
    select j.*, g.good from judged j
    join (select doc_id, min(quality) as good from labels where quality is not null group by doc_id) g
        on j.doc_id = g.doc_id where not base_failed),
scores as ({_RULE_SQL}),
sizes as (select stratum, rule, count(*) filter (good = 1) as n from scores group by all),
cuts as (select unnest({list(quality_rules.CUTOFFS)}) as cut),
tests as (
    select stratum, rule, cut, count(*) filter (good = 1) as k, count(*) filter (good <> 1) as bad
    from scores, cuts where score > cut group by all),
tails as (
    select t.*, list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RATE})
        + (n - i) * ln(1 - {_RATE})) for i in range(0, k + 1)]) as p
    from tests t join sizes s on t.stratum = s.stratum and t.rule = s.rule where k < n * {_RATE}),
chosen as (
    select stratum, rule, arg_max(cut, (bad - {quality_rules.WORTH} * k) * 10000 + cut) as cutoff
    from tails where p <= {_LEVEL} and bad > {quality_rules.WORTH} * k group by stratum, rule),
over as (
    select doc_id, {_FIRST_RULE} as rejected_by from (
        select s.doc_id, s.rule from ({_RULE_SQL.replace("good, ", "").replace("from labelled", "from judged")}) s
        join chosen c on s.stratum = c.stratum and s.rule = c.rule and s.score > c.cutoff)
    group by doc_id)
select j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, stratum,
    rejected_by, not base_failed and rejected_by is null as kept
from judged j left join over o on j.doc_id = o.doc_id
""")
def op1_risk_controlled_rules(spark, sf_dir):
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "stratum", "rejected_by", "kept")


@query("""
with words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
    select distinct item_id, least(len(w), 10) as n,
        unnest([array_to_string(w[i : i + 9], ' ') for i in range(1, greatest(len(w) - 9, 1) + 1)]) as phrase
    from items where len(w) > 0),
sizes as (select distinct n from windows),
runs as (
    select doc_id, n, unnest(range(1, len(w) - n + 2)) as i,
        unnest([array_to_string(w[j : j + n - 1], ' ') for j in range(1, len(w) - n + 2)]) as phrase
    from words, sizes where len(w) >= n),
hits as (
    select r.doc_id, r.n, r.i, r.phrase, v.item_id from runs r join windows v on r.phrase = v.phrase and r.n = v.n),
covered as (
    select doc_id, count(distinct p) as n_hit
    from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from hits))
    group by doc_id),
named as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
    from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id),
offsets as (
    select phrase, term, min(o) as o
    from (select phrase, unnest(string_split(phrase, ' ')) as term, unnest(range(0, n)) as o from windows)
    group by phrase, term),
places as (
    select doc_id, term, pos from (
        select doc_id, unnest(w) as term, unnest(range(0, len(w))) as pos from words)
    where term in (select term from offsets)),
ranked as (
    select phrase, term, o, c, row_number() over (partition by phrase order by c nulls last, term) as r
    from offsets left join (select term, count(*) as c from places group by term) using (term)),
looks as (
    select phrase, max(term) filter (r = 1 and c > 0) as t1, max(o) filter (r = 1) as o1,
        max(term) filter (r = 2 and c > 0) as t2, max(o) filter (r = 2) as o2,
        max(term) filter (r = 3 and c > 0) as t3, max(o) filter (r = 3) as o3
    from ranked group by phrase having count(c) = count(*) or count(c) >= 3),
first_at as (
    select doc_id, phrase, pos - o1 as start, t2, o2, t3, o3
    from looks join places on term = t1 where pos >= o1),
second_at as (
    select distinct f.* from first_at f left join places p
        on f.doc_id = p.doc_id and t2 = term and pos between start + o2 - 2 and start + o2 + 2
    where t2 is null or pos is not null),
third_at as (
    select distinct f.doc_id, phrase, start from second_at f left join places p
        on f.doc_id = p.doc_id and t3 = term and pos between start + o3 - 2 and start + o3 + 2
    where t3 is null or pos is not null),
near as (
    select t.doc_id, count(*) as n_near from third_at t
    where not exists (select 1 from hits h where h.doc_id = t.doc_id and h.phrase = t.phrase and h.i = t.start + 1)
    group by t.doc_id)
select w.doc_id, len(w.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated,
    coalesce(n_near, 0) as n_near
from words w left join covered c on w.doc_id = c.doc_id left join named m on w.doc_id = m.doc_id
    left join near r on w.doc_id = r.doc_id
""")
def op9_positional_index(spark, sf_dir):
    return positional_index.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query()
def op4_boosted_pii(spark, sf_dir):
    return pii_boosting.spans_by_document(_table(spark, sf_dir, "documents"))


@query()
def op7_residual_packing(spark, sf_dir):
    return residual_packing.packed_sequences(_table(spark, sf_dir, "documents"), byte_bpe())


@query()
def op2_byte_cnn(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    scored = byte_cnn.scored(docs, byte_cnn.learn(docs, _table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


@query("""
with sized as (
    select page_id, coalesce(html, '') as html, sha256(coalesce(html, '')) as payload_digest,
        strlen(coalesce(html, '')) as payload_bytes from pages),
firsts as (
    select payload_digest, min(page_id) as first from sized where payload_bytes >= 100 group by payload_digest)
select page_id, payload_bytes, s.payload_digest,
    case when first <> page_id then 'revisit' else 'response' end as record_type,
    case when first <> page_id then first end as refers_to
from sized s left join firsts f on s.payload_digest = f.payload_digest and payload_bytes >= 100
""")
def op3_warc_writer(spark, sf_dir):
    folder, manifest = warc_writer.write_warc(_table(spark, sf_dir, "pages"))
    return warc_writer.read_warc(folder, manifest).drop("url")


@query()
def op5_external_shuffle(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return external_shuffle.write_shuffled(docs, 24).select(
        "doc_id", external_shuffle.row_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


URL_RULES = [
    url_automaton.host_rule("com", "/", False),
    url_automaton.host_rule("example.com", "/en/", True),
    url_automaton.host_rule("www.example.com", "/en/", False),
    url_automaton.host_rule("net", "/es/", True),
    url_automaton.host_rule("net", "/fr/", True),
    # what no host rule decides: advertising hosts, log-in pages and program files go
    url_automaton.Rule("*.ads-*", True),
    url_automaton.Rule("*.ads-*/**", True),
    url_automaton.Rule("**/wp-login.php", True),
    url_automaton.Rule("**/*.exe", True),
]


@query("""
with rests as (
    select page_id, case when contains(coalesce(url, ''), '://') then substr(url, strpos(url, '://') + 3)
        else '' end as rest from pages),
parts as (
    select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
    from rests),
rules(h, p, verdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits as (
    select page_id, arg_max(h || p, length(h || p)) as rule, arg_max(verdict, length(h || p)) as verdict
    from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id)
select s.page_id, host, path, rule, coalesce(verdict, case when
    regexp_full_match('.' || host || path, '[^/]*\\.ads-[^/]*') or
    regexp_full_match('.' || host || path, '(?s)[^/]*\\.ads-[^/]*/.*') or
    regexp_full_match('.' || host || path, '(?s).*/wp-login\\.php') or
    regexp_full_match('.' || host || path, '(?s).*/[^/]*\\.exe') then 'block' else 'allow' end) as verdict
from parts s left join fits f on s.page_id = f.page_id
""")
def op6_url_automaton(spark, sf_dir):
    judged = url_automaton.judge(_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.withColumnRenamed("id", "page_id")


@query()
def op10_kneser_ney(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return kneser_ney.scored(docs, kneser_ney.learn(docs.where(kneser_ney.in_training())))


@query()
def op11_window_packing(spark, sf_dir):
    return window_packing.packed_windows(_table(spark, sf_dir, "documents"), byte_bpe())


@query("""
with base as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
marks as (
    select doc_id, max((quality = 1)::int) as is_good, max((toxic = 1)::int) as is_toxic
    from labels group by doc_id),
judged as (
    select part, is_good, is_toxic, [
        len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
        100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
        coalesce(b.doc_id > min(b.doc_id) over (partition by t), false)] as fails
    from base b left join marks m on b.doc_id = m.doc_id),
cells as (
    select part, fails, count(*) as n, coalesce(sum(is_good), 0) as good, coalesce(sum(is_toxic), 0) as toxic
    from judged group by part, fails),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
    select a.x || b.x || c.x || d.x || e.x as filter_order
    from letters a, letters b, letters c, letters d, letters e
    where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (
    select filter_order, step, substr(filter_order, step, 1) as letter,
        [ascii(substr(filter_order, k, 1)) - 64 for k in range(1, step)] as earlier
    from orders, (select unnest(range(1, 6)) as step)),
walked as (
    select *, fails[ascii(letter) - 64] as failed, list_contains([fails[k] for k in earlier], true) as gone
    from cells, steps),
summed as (
    select part, filter_order, step, letter,
        sum(case when not gone and not failed then n else 0 end)::bigint as kept,
        sum(case when not gone and failed then n else 0 end)::bigint as removed,
        sum(case when gone and failed then n else 0 end)::bigint as redundant,
        sum(case when failed and len([f for f in fails if f]) = 1 then n else 0 end)::bigint as unique_fails,
        sum(case when not gone and failed then good else 0 end)::bigint as good_lost,
        sum(case when not gone and failed then toxic else 0 end)::bigint as toxic_lost
    from walked group by all)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) over (partition by part, letter))::bigint as shapley
from summed
""")
def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query("""
with usable as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        [floor(256 * x::double) for x in embedding] as v
    from embeddings where vec_id is not null and label is not null and embedding is not null
        and not list_contains([coalesce(isfinite(x), false) for x in embedding], false)),
scored as (
    select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same,
        list_inner_product(a.v, r.v)::bigint as score
    from usable a join usable r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
positives as (
    select anchor_id, other_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, positive_id,
    (row_number() over (partition by p.anchor_id, positive_id order by score desc, other_id))::int as rank,
    other_id as negative_id, positive_score, score as negative_score
from positives p join scored s on p.anchor_id = s.anchor_id and not same
    and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5
""")
def op13_threshold_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(_table(spark, sf_dir, "embeddings"), label)
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)
