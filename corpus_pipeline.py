"""A corpus pipeline: five stages over ``documents``, each on all that the one before it kept.

toxicity      texts that the classifiers, learned from ``labels``, call toxic go
jaccard       of each group of near copies (five-word shingles, similarity 0.8) the smallest id stays
substrings    words covered by a 20-word stretch that stands earlier are cut out of the texts
benchmark     texts with a passage of a ``benchmark`` item go
mixing        how many words the mix takes from each text; texts it takes nothing from go

All stages but the last return the columns of ``documents``. Columns keep their names and types; ``n_chars`` follows
the text. The first two and the fourth keep or drop rows; a text that loses all its words stays as an empty text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontamination, jaccard, mixing, repeats, substring_dedup, toxicity
from millrace.sources import table
from millrace.workspace import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Train on all labels whose text is still there, score whole texts, and drop scores of 0.5 and more."""
    models = toxicity.train(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    return docs.where(toxicity.score(F.col("text"), models) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest document of each group; rows that repeat a document whole stay once."""
    found = jaccard.similar_components(docs, "doc_id", "text")
    first = found.where((F.col("doc") == F.col("root_doc")) & (F.col("tie") == F.col("root_tie"))).select("doc", "tie")
    given = repeats.numbered(docs)
    at = dict(zip(docs.columns, given.columns, strict=True))
    keyed = repeats.keyed(given, at["doc_id"], at["text"])
    kept = keyed.join(first, (keyed[repeats.DOC] == first["doc"]) & (keyed[repeats.TIE] == first["tie"]), "left_semi")
    return kept.dropDuplicates([repeats.DOC, repeats.TIE]).select(*given.columns).toDF(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated stretches; a text that loses nothing stays as it is."""
    given = repeats.numbered(docs)
    at = dict(zip(docs.columns, given.columns, strict=True))
    cut = substring_dedup.remove_repeats(given, at["doc_id"], at["text"])
    less = F.col("n_removed") > 0
    new = {at["text"]: F.when(less, F.col("kept_text")).otherwise(F.col(at["text"]))}
    if "n_chars" in at:
        kind = docs.schema["n_chars"].dataType
        new[at["n_chars"]] = F.when(less, F.length("kept_text").cast(kind)).otherwise(F.col(at["n_chars"]))
    return cut.withColumns(new).select(*given.columns).toDF(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    hits = decontamination.contaminated(docs, items, "doc_id", "text", "item_id", "text")
    found = hits.select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_found"]), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` words of the texts that the mix uses."""
    return mixing.mix(docs, "doc_id", "text", "source").where("taken > 0")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("jaccard", drop_near_copies),
    ("substrings", cut_repeats),
    ("benchmark", drop_contaminated),
    ("mixing", mix_sources),
]

# learned scores, and hashes that decide, have no SQL
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
