"""Features and exact parts of models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import tokens
from millrace.operators.features import (
    assemble,
    center_and_scale,
    index_strings,
    strings_of_index,
    term_counts,
    tf_idf,
    value_index,
)
from millrace.operators.models import (
    assign_to_nearest,
    class_priors,
    feature_likelihoods,
    fit_linear,
    linear_terms,
    mean_vectors,
    term_likelihoods,
)
from millrace.operators.nearest import assign_by_cells
from millrace.plans.registry import Tables, query
from millrace.plans.rows import DOCUMENT_TOKENS_SQL

_TYPE_INDEX_SQL = """SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS type_index
                     FROM events WHERE event_type IS NOT NULL GROUP BY event_type"""
_TERMS_SQL = f"""SELECT doc_id, term, count(*) AS tf
                 FROM (SELECT doc_id, unnest({DOCUMENT_TOKENS_SQL}) AS term FROM documents) GROUP BY doc_id, term"""


@query(
    "assemble_vector",
    """SELECT c_custkey, c_acctbal AS f0, CAST(c_nationkey AS DOUBLE) AS f1,
              CAST(c_mktsegment = 'BUILDING' AS DOUBLE) AS f2 FROM customer""",
)
def assemble_vector(t: Tables) -> DataFrame:
    customers = t.customer.withColumn("building", (F.col("c_mktsegment") == "BUILDING").cast("double"))
    values = vector_to_array("features")
    return assemble(customers, ["c_acctbal", "c_nationkey", "building"]).select(
        "c_custkey", *[values[i].alias(f"f{i}") for i in range(3)]
    )


@query(
    "reattach_by_id",
    "SELECT c_custkey, c_name, c_acctbal AS f0, CAST(c_nationkey AS DOUBLE) AS f1 FROM customer",
)
def reattach_by_id(t: Tables) -> DataFrame:
    vectors = assemble(t.customer, ["c_acctbal", "c_nationkey"]).select("c_custkey", "features")
    values = vector_to_array("features")
    return t.customer.select("c_custkey", "c_name").join(vectors, "c_custkey").select(
        "c_custkey", "c_name", values[0].alias("f0"), values[1].alias("f1")
    )


@query(
    "center_scale",
    """SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER (), 6) AS balance,
              round((c_nationkey - avg(c_nationkey) OVER ()) / stddev_samp(c_nationkey) OVER (), 6) AS nation
       FROM customer""",
)
def center_scale(t: Tables) -> DataFrame:
    scaled = center_and_scale(t.customer.select("c_custkey", "c_acctbal", "c_nationkey"), ["c_acctbal", "c_nationkey"])
    return scaled.select(
        "c_custkey", F.round("c_acctbal", 6).alias("balance"), F.round("c_nationkey", 6).alias("nation")
    )


@query(
    "string_index",
    f"SELECT event_id, event_type, type_index FROM events LEFT JOIN ({_TYPE_INDEX_SQL}) USING (event_type)",
)
def string_index(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "event_type")
    return index_strings(events, value_index(events, "event_type"), "event_type", ["event_id"], "type_index")


@query(
    "index_to_string",
    f"SELECT event_id, type_index, event_type AS original FROM events LEFT JOIN ({_TYPE_INDEX_SQL}) USING (event_type)",
)
def index_to_string(t: Tables) -> DataFrame:
    events = t.events.select("event_id", "event_type")
    index = value_index(events, "event_type")
    indexed = index_strings(events, index, "event_type", ["event_id"], "type_index").drop("event_type")
    return strings_of_index(indexed, index, "event_type", "type_index", ["event_id"], "original")


@query("tokenize", f"SELECT doc_id, array_to_string({DOCUMENT_TOKENS_SQL}, '|') AS tokens FROM documents")
def tokenize(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.array_join(tokens(F.col("text")), "|").alias("tokens"))


@query("term_freq", _TERMS_SQL)
def term_freq(t: Tables) -> DataFrame:
    return term_counts(t.documents, "doc_id", "text", one_row_per_doc=True)


@query(
    "tf_idf",
    f"""WITH terms AS ({_TERMS_SQL}), frequency AS (SELECT term, count(*) AS df FROM terms GROUP BY term)
        SELECT doc_id, term, tf, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS tf_idf
        FROM terms JOIN frequency USING (term)""",
)
def weighted_terms(t: Tables) -> DataFrame:
    return tf_idf(t.documents, "doc_id", "text", one_row_per_doc=True, digits=6)


@query(
    "linear_regression",
    """SELECT 'intercept' AS name, round(regr_intercept(l_extendedprice, l_quantity), 4) AS coefficient FROM lineitem
       UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem""",
)
def linear_regression(t: Tables) -> DataFrame:
    model = fit_linear(t.lineitem, ["l_quantity"], "l_extendedprice")
    return linear_terms(model, ["l_quantity"], t.lineitem).withColumn("coefficient", F.round("coefficient", 4))


# least squares in three variables: the covariances, and Cramer's rule
_THREE_VARIABLES_SQL = """
    WITH moments AS (
        SELECT avg(q) AS mq, avg(d) AS md, avg(t) AS mt, avg(y) AS my, covar_samp(q, q) AS qq, covar_samp(q, d) AS qd,
               covar_samp(q, t) AS qt, covar_samp(d, d) AS dd, covar_samp(d, t) AS dt, covar_samp(t, t) AS tt,
               covar_samp(q, y) AS qy, covar_samp(d, y) AS dy, covar_samp(t, y) AS ty
        FROM (SELECT l_quantity AS q, l_discount AS d, l_tax AS t, l_extendedprice AS y FROM lineitem)),
    solved AS (
        SELECT *, qq * (dd * tt - dt * dt) - qd * (qd * tt - qt * dt) + qt * (qd * dt - qt * dd) AS det FROM moments),
    terms AS (
        SELECT *, (qy * (dd * tt - dt * dt) - qd * (dy * tt - dt * ty) + qt * (dy * dt - dd * ty)) / det AS bq,
               (qq * (dy * tt - dt * ty) - qy * (qd * tt - qt * dt) + qt * (qd * ty - qt * dy)) / det AS bd,
               (qq * (dd * ty - dy * dt) - qd * (qd * ty - qt * dy) + qy * (qd * dt - qt * dd)) / det AS bt FROM solved)
    SELECT 'intercept' AS name, round(my - bq * mq - bd * md - bt * mt, 4) AS coefficient FROM terms
    UNION ALL SELECT 'l_quantity', round(bq, 4) FROM terms UNION ALL SELECT 'l_discount', round(bd, 4) FROM terms
    UNION ALL SELECT 'l_tax', round(bt, 4) FROM terms"""


@query("linear_regression_multi", _THREE_VARIABLES_SQL)
def linear_regression_multi(t: Tables) -> DataFrame:
    features = ["l_quantity", "l_discount", "l_tax"]
    model = fit_linear(t.lineitem, features, "l_extendedprice")
    return linear_terms(model, features, t.lineitem).withColumn("coefficient", F.round("coefficient", 4))


_LABELLED_SQL = f"""SELECT quality, unnest({DOCUMENT_TOKENS_SQL}) AS term FROM labels JOIN documents USING (doc_id)"""


@query(
    "nb_model_sql",
    f"""WITH words AS ({_LABELLED_SQL}),
             terms AS (SELECT term, count(*) FILTER (quality = 0) AS n0, count(*) FILTER (quality = 1) AS n1
                       FROM words GROUP BY term),
             totals AS (SELECT sum(n0) AS s0, sum(n1) AS s1, count(*) AS v FROM terms)
        SELECT 0 AS class, term, round(ln((n0 + 1) / (s0 + v)), 6) AS log_likelihood FROM terms, totals
        UNION ALL SELECT 1, term, round(ln((n1 + 1) / (s1 + v)), 6) FROM terms, totals""",
)
def nb_terms(t: Tables) -> DataFrame:
    labelled = t.labels.join(t.documents.select("doc_id", "text"), "doc_id")
    return term_likelihoods(labelled, "text", "quality").withColumn("log_likelihood", F.round("log_likelihood", 6))


@query(
    "nb_languages",
    f"""WITH words AS (SELECT lang, unnest({DOCUMENT_TOKENS_SQL}) AS term FROM documents WHERE lang IS NOT NULL),
             pairs AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL),
             totals AS (SELECT lang, sum(n) AS s FROM pairs GROUP BY lang),
             terms AS (SELECT DISTINCT term FROM words), v AS (SELECT count(*) AS v FROM terms)
        SELECT t.lang AS class, terms.term, round(ln((coalesce(n, 0) + 1) / (s + v)), 6) AS log_likelihood
        FROM terms CROSS JOIN totals t CROSS JOIN v LEFT JOIN pairs p ON p.term = terms.term AND p.lang = t.lang""",
)
def nb_languages(t: Tables) -> DataFrame:
    likelihoods = term_likelihoods(t.documents.select("lang", "text"), "text", "lang")
    return likelihoods.withColumn("log_likelihood", F.round("log_likelihood", 6))


_LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


@query(
    "nb_numeric",
    """WITH totals AS (SELECT l_returnflag AS class, sum(l_quantity) AS a, sum(l_discount) AS b, sum(l_tax) AS c
                       FROM lineitem GROUP BY 1)
       SELECT class, unnest(['l_quantity', 'l_discount', 'l_tax']) AS feature,
              round(ln((unnest([a, b, c]) + 1) / (a + b + c + 3)), 6) AS log_likelihood FROM totals""",
)
def nb_numeric(t: Tables) -> DataFrame:
    likelihoods = feature_likelihoods(t.lineitem, _LINE_FEATURES, "l_returnflag")
    return likelihoods.withColumn("log_likelihood", F.round("log_likelihood", 6))


@query(
    "nb_priors_sql",
    """SELECT quality AS class, round(ln((count(*) + 1) / (sum(count(*)) OVER () + count(*) OVER ())), 6) AS log_prior
       FROM labels GROUP BY quality""",
)
def nb_priors(t: Tables) -> DataFrame:
    return class_priors(t.labels, "quality").withColumn("log_prior", F.round("log_prior", 6))


@query(
    "kmeans_assign",
    """WITH points AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i
                       FROM embeddings),
            centres AS (SELECT label, i, avg(x) AS c FROM points GROUP BY label, i),
            distances AS (SELECT p.vec_id, c.label AS cluster, sum((x - c) * (x - c)) AS d
                          FROM points p JOIN centres c USING (i) GROUP BY p.vec_id, c.label)
       SELECT vec_id, arg_min(cluster, d) AS cluster, round(sqrt(min(d)), 6) AS distance
       FROM distances GROUP BY vec_id""",
)
def kmeans_assign(t: Tables) -> DataFrame:
    centres = mean_vectors(t.embeddings, "label", "embedding")
    nearest = assign_to_nearest(t.embeddings.select("vec_id", "embedding"), "embedding", centres, "label")
    return nearest.select("vec_id", "cluster", F.round("distance", 6).alias("distance"))


@query(
    "nearest_supplier",
    """WITH pairs AS (SELECT c_custkey, s_suppkey,
                             (c_acctbal - s_acctbal) * (c_acctbal - s_acctbal)
                             + (100.0::DOUBLE * c_nationkey - 100.0::DOUBLE * s_nationkey) * (100.0::DOUBLE * c_nationkey - 100.0::DOUBLE * s_nationkey) AS d
                      FROM customer, supplier WHERE c_acctbal IS NOT NULL AND s_acctbal IS NOT NULL),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS place FROM pairs)
       SELECT c_custkey, s_suppkey AS cluster, round(sqrt(d), 6) AS distance FROM ranked WHERE place = 1""",
)
def nearest_supplier(t: Tables) -> DataFrame:
    """For every customer the supplier that is nearest by balance and nation, out of any number of suppliers."""

    def place(prefix: str) -> Column:
        return F.array(F.col(f"{prefix}_acctbal"), F.col(f"{prefix}_nationkey").cast("double") * 100.0)

    suppliers = t.supplier.select("s_suppkey", place("s").alias("centre"))
    found = assign_by_cells(t.customer.select("c_custkey", place("c").alias("at")), "at", suppliers, "s_suppkey")
    return found.select("c_custkey", "cluster", F.round("distance", 6).alias("distance"))
