"""Term selection, term weights and classification over the review texts."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from ..functions.text import STOPWORDS
from ..operators import classification, features, terms
from ..session import path_bytes, scratch_path, spread
from ..sources.readers import TERM_SCHEMA, decode_terms, read_reviews
from .registry import query

TOP_K = 200

# Fixed value: the delimiters once more, as alternatives, for the SQL side
_SPLIT = r"""\s|\d|\.|!|\?|,|;|:|\(|\)|\[|]|\{|}|-|_|"|`|~|#|&|\*|%|\$|\|/"""

_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)

# all tokens of every review, then the set of terms per review
_RAW = f"""raw as (
    select review_id, category, unnest(string_split_regex(lower(review_text), '{_SPLIT}')) as term
    from reviews)"""
_TOKENS = f"""{_RAW}, toks as (
    select distinct review_id, category, term from raw
    where term <> '' and term not in ({_STOP}))"""
_TF = f"""{_RAW}, tfs as (
    select review_id, category, term, count(*) as tf from raw
    where term <> '' and term not in ({_STOP}) group by all)"""
_CELLS = f"""{_TOKENS},
    ct as (select category, term, count(*) as a from toks group by all),
    dt as (select term, count(*) as e from toks group by all),
    gc as (select category, count(*) as g from reviews group by all),
    cells as (select category, term, a, e - a as b, g - a as c,
                     (select count(*) from reviews) - e - g + a as d
              from ct join dt using (term) join gc using (category))"""
_SCORES = f"""{_CELLS}, nums as (
    select category, term, a::double as a, b::double as b, c::double as c, d::double as d from cells),
    scores as (select category, term,
        (a * d - b * c) * (a * d - b * c) / nullif((a + b) * (a + c) * (b + d) * (c + d), 0) as chi2
        from nums)"""
_TOP = f"""{_SCORES}, top as (
    select * from (select category, term, chi2,
        row_number() over (partition by category order by chi2 desc, term) as "rank"
        from scores where chi2 is not null) where "rank" <= {TOP_K})"""


def _texts(t):
    return spread(t.reviews, "review_id", path_bytes(t.spark, f"{t.path}/documents.parquet"))


def _terms(t):
    return terms.tokenize_terms(_texts(t), "review_text", STOPWORDS)


def _docs(t):
    return t.reviews.select("review_id", "category")


def _counts(t):
    return terms.term_counts(_texts(t), "review_text", STOPWORDS)


def _top(t):
    return terms.chi2_top_terms(terms.chi2_scores(_terms(t), _docs(t)), TOP_K)


@query("select review_id, category, review_text as \"reviewText\" from reviews")
def scan_reviews(t):
    path = scratch_path(t.spark, "reviews-json")
    t.reviews.withColumnRenamed("review_text", "reviewText").write.json(path)
    schema = "review_id long, category string, reviewText string"
    return read_reviews(t.spark, path, schema)


@query(f"with {_TOKENS} select review_id, category, term from toks")
def tokenize_terms(t):
    return _terms(t)


@query(f"""with {_RAW.replace("lower(review_text)", "review_text")}
    select distinct review_id, category, lower(term) as term from raw
    where term <> '' and term not in ({_STOP})""")
def tokenize_terms_stop_first(t):
    return terms.tokenize_terms(_texts(t), "review_text", STOPWORDS, stop_before_fold=True)


@query("select category, count(*) as n_docs from reviews group by category")
def category_doc_counts(t):
    return terms.category_freq(_docs(t))


@query(f"with {_TOKENS} select term, count(*) as n_docs from toks group by term")
def term_doc_counts(t):
    return terms.doc_freq(_terms(t))


@query(f"with {_TOKENS} select category, term, count(*) as n_docs from toks group by all")
def category_term_counts(t):
    return terms.category_term_freq(_terms(t))


@query(f"with {_CELLS} select category, term, a, b, c, d from cells")
def chi2_contingency(t):
    return terms.chi2_contingency(_terms(t), _docs(t))


@query(f"with {_SCORES} select category, term, chi2 from scores")
def chi2_scores(t):
    return terms.chi2_scores(_terms(t), _docs(t))


@query(f"with {_TOP} select category, term, chi2, \"rank\"::int as \"rank\" from top")
def chi2_top_terms(t):
    return _top(t)


@query(f"""with {_TOP} select concat(category, chr(9),
        string_agg(concat(term, ':', printf('%.6f', chi2)), ' ' order by "rank")) as line
    from top group by category""")
def chi2_report_lines(t):
    return terms.chi2_report_lines(_top(t))


_ONE = "4503599627370496"  # 2 ** 52
_OVERALL = f"""{_TF},
    n as (select count(*) as n, count(distinct category) as k from reviews),
    gc as (select category, count(*) as g from reviews group by all),
    pos as (select term, tf as lvl, category, count(*) as o from tfs group by all),
    dfs as (select term, sum(o) as df, n - sum(o) as n0 from pos, n group by term, n),
    seen as (
        select term, sum(floor((o::double * o) / (n_v::double * g) * {_ONE}::double)::bigint) as places,
            count(distinct lvl) as levels
        from (select *, sum(o) over (partition by term, lvl) as n_v from pos) join gc using (category)
        group by term),
    zero as (
        select term, sum(floor(case when met = 0 then 0 else share end * {_ONE}::double)::bigint) as places
        from (
            select term, 1 as met, (g - s)::double * (g - s) / (n0::double * g) as share
            from (select term, category, sum(o) as s from pos group by all)
                join gc using (category) join dfs using (term) where n0 > 0
            union all
            select term, 1, (n - sum(g))::double / n0 as share
            from (select distinct term, category from pos) join gc using (category) join dfs using (term), n
            where n0 > 0 group by term, n, n0)
        group by term),
    scored as (
        select term, df::bigint as df,
            n::double * (seen.places + coalesce(zero.places, 0) - {_ONE})::double / {_ONE}::double as chi2,
            ((levels + (n0 > 0)::int - 1) * (k - 1))::bigint as dof
        from seen join dfs using (term) left join zero using (term), n)"""


@query(f"""with {_OVERALL} select term, df, chi2, dof from scored where dof > 0
    order by chi2 desc, term limit 4000""")
def chi2_top_terms_overall(t):
    return terms.chi2_top_terms_overall(terms.chi2_overall(_counts(t), _docs(t)), 4000)


# the p-value once more: its continued fraction above the mean, else one less the lower series
_LOG_P = """case when x <= 0 then 0 when x > a + 1 then
        a * ln(x) - x - lgamma(a) - ln(list_reduce(
            [x + 2 * (80 + floor(12 * sqrt(a))) + 1 - a] || [i::double for i in range((80 + floor(12 * sqrt(a)))::bigint, 0, -1)],
            lambda f, i: x + 2 * i - 1 - a - i * (i - a) / f))
    else ln(1 - list_sum([exp(-x + (a + i) * ln(x) - lgamma(a + i + 1)) for i in range(0, 400)])) end"""


@query(f"""with {_OVERALL}, halved as (select *, dof / 2.0::double as a, chi2 / 2 as x from scored where dof > 0)
    select term, df, chi2, dof, round({_LOG_P}, 6) as log_p from halved order by {_LOG_P}, term limit 4000""")
def chi2_top_terms_by_p(t):
    best = terms.chi2_top_terms_overall(terms.chi2_overall(_counts(t), _docs(t)), 4000, by="p")
    return best.withColumn("log_p", F.round("log_p", 6))


@query(f"""with {_CELLS}, scores as materialized (
        select *, (a::double * d - b::double * c) * (a::double * d - b::double * c)
            / nullif((a + b)::double * (a + c) * (b + d) * (c + d), 0) as chi2 from cells)
    select category, term as value, a as num_docs_in_category, c as num_docs_in_category_without,
        a + b as num_docs, c + d as num_docs_without
    from scores where chi2 is not null
    qualify row_number() over (partition by category order by chi2 desc, term) <= {TOP_K}""")
def term_records_json(t):
    """Term records stored as JSON text and decoded with their fixed schema."""
    top = terms.chi2_top_terms(terms.chi2_scores(_terms(t), _docs(t), with_cells=True), TOP_K)
    record = F.struct(F.col("term").alias("value"), F.col("a").alias("num_docs_in_category"),
                      F.col("c").alias("num_docs_in_category_without"),
                      (F.col("a") + F.col("b")).alias("num_docs"),
                      (F.col("c") + F.col("d")).alias("num_docs_without"))
    stored = top.select("category", F.to_json(record).alias("json"))
    return stored.select("category", decode_terms(F.col("json")).alias("r")).select(
        "category", *[F.col(f"r.{f.name}") for f in TERM_SCHEMA.fields])


@query(f"""with pos as (select review_id,
        unnest(string_split_regex(lower(review_text), '{_SPLIT}')) as term,
        generate_subscripts(string_split_regex(lower(review_text), '{_SPLIT}'), 1) as i
        from reviews)
    select review_id, count(term) filter (term <> '' and term not in ({_STOP})) as n_tokens,
        coalesce(string_agg(term, ' ' order by i) filter (term <> '' and term not in ({_STOP})), '') as tokens
    from pos group by review_id""")
def ml_tokens(t):
    stages = PipelineModel(classification.tokenising_stages("review_text", STOPWORDS))
    tokens = F.col("filteredTerms")
    return (stages.transform(_texts(t))
            .select("review_id", F.size(tokens).cast("long").alias("n_tokens"),
                    F.array_join(tokens, " ").alias("tokens")))


@query("""select category, (row_number() over (order by n desc, category) - 1)::double as category_index, n
    from (select category, count(*) as n from reviews group by category)""")
def label_index(t):
    indexer = StringIndexer(inputCol="category", outputCol="category_index",
                            stringOrderType="frequencyDesc")
    labels = _docs(t)
    return (indexer.fit(labels).transform(labels).groupBy("category", "category_index")
            .agg(F.count("*").alias("n")))


@query(f"with {_TF} select review_id, category, term, tf from tfs")
def term_frequencies(t):
    return _counts(t)


@query(f"""with {_TF} select term, sum(tf)::bigint as n_occurrences, count(*) as n_docs
    from tfs group by term order by n_occurrences desc, term limit 1000""")
def vocabulary_topk(t):
    return features.vocabulary_topk(_counts(t), 1000)


_WEIGHTS = f"""{_TF}, dfs as (select term, count(*) as df from tfs group by term),
    w as (select review_id, term, tf,
                 tf * ln(((select count(*) from reviews) + 1) / (df + 1)) as weight
          from tfs join dfs using (term))"""


@query(f"with {_WEIGHTS} select review_id, term, tf, round(weight, 6) as weight from w")
def tfidf_weights(t):
    return features.tfidf_weights(_counts(t), _docs(t)).select(
        "review_id", "term", "tf", F.round("weight", 6).alias("weight"))


@query(f"""with {_WEIGHTS}, norms as (
        select review_id, sqrt(sum(weight * weight)) as norm from w group by review_id)
    select review_id, term, round(case when norm > 0 then weight / norm else weight end, 6) as weight
    from w join norms using (review_id)""")
def l2_normalized_tfidf(t):
    weights = features.tfidf_weights(_counts(t).drop("category"), _docs(t))
    return features.l2_normalised(weights, "review_id").select(
        "review_id", "term", F.round("weight", 6).alias("weight"))


@query("""select review_id, category,
        ('0x' || substr(md5(concat('42:', review_id)), 1, 8))::bigint % 100 < 80 as is_train
    from reviews""")
def hash_split(t):
    return features.hash_split(_docs(t), "review_id")


_GUESS = """case when review_text like '% der %' then 'de' when review_text like '% el %' then 'es'
    when review_text like '% le %' then 'fr' else 'en' end"""


@query(f"""with p as (select category, {_GUESS} as pred from reviews),
    labels as (select distinct category from p),
    f as (select l.category,
            (select count(*) from p where p.category = l.category) as n,
            (select count(*) from p where p.pred = l.category) as np,
            (select count(*) from p where p.category = l.category and p.pred = l.category) as tp
          from labels l)
    select round(sum(n * 2.0::double * tp / (n + np)) / sum(n), 9) as f1 from f""")
def f1_weighted(t):
    guessed = t.reviews.select("category", F.expr(_GUESS).alias("pred"))
    return features.weighted_f1(guessed, "category", "pred").select(F.round("f1", 9).alias("f1"))


def _predictions(t, kind):
    flagged = features.hash_split(_texts(t), "review_id")
    return classification.class_predictions(flagged, "review_id", "review_text", "category", kind)


@query()
def classify_decision_tree(t):
    return _predictions(t, "decision_tree")


@query()
def classify_linear_svm(t):
    return _predictions(t, "svm")


@query()
def tuned_decision_tree(t):
    """The published grid of 32 trees with the F1 of each on rows that its training left out."""
    flagged = features.hash_split(_texts(t), "review_id")
    return classification.grid_search(flagged, "review_id", "review_text", "category", "decision_tree")
