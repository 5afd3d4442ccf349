"""Corpus pipeline: five stages over ``documents``, each one operator of ``versus.llm``.

``STAGES`` is a list of (name, function); each function takes
``(spark, docs, sf_dir)``, where ``docs`` has the columns of ``documents``, and
returns a DataFrame that is stored as Parquet and read again as the next one's
``docs``.  ``run`` applies them to ``documents``.  Further columns of ``docs`` pass
through all stages but the last; a column whose name begins with ``__`` may not be there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from versus.llm import langid, mixing, pieces, simhash, toxicity
from versus.llm.common import cut_lineage, read, shared_folder, small_batches


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which no language can be found: null texts and texts without a
    letter (predicted ``und``), also if no labelled row is there to learn from."""
    small_batches(spark)
    model = langid.fit(langid.training_rows(docs))
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = docs.withColumn("__lang", langid.predict_column(spark, model, F.col("text")))
    return found.filter(F.col("__lang.lang_pred") != langid.UND).drop("__lang")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score is a half or more."""
    model = toxicity.fit(toxicity.training_rows(docs), read(spark, sf_dir, "labels"))
    found = docs.withColumn("__tox", toxicity.score_column(spark, model, F.col("text")))
    return found.filter(F.col("__tox.score") < 0.5).drop("__tox")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates (four-word shingles, four bits): that of
    the smallest id, rows without an id last.  Groups come from the texts alone."""
    small_batches(spark)
    kept = simhash.representatives(docs, shingle=4, max_bits=4)
    kept = cut_lineage(kept.withColumnsRenamed({"doc_id": "__id", "h": "__h", "c": "__c", "rows": "__rows"}))
    h, c = simhash.text_keys(F.col("text"))
    named = docs.join(kept, [F.col("doc_id").eqNullSafe(F.col("__id")), h == F.col("__h"), c == F.col("__c")])
    once = named.filter("__rows = 1").select(*docs.columns)
    if kept.filter("__rows > 1").isEmpty():
        return once
    # rows equal in id and text
    more = named.filter("__rows > 1").dropDuplicates(["__id", "__h", "__c"]).select(*docs.columns)
    return once.unionByName(more)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it; documents not taken go.  Documents
    without words count nothing and go.  Rows that share an id and source share its copies
    as evenly as possible."""
    labels = mixing.quality_weights(read(spark, sf_dir, "labels"))
    taken = mixing.mix(docs, labels).groupBy("doc_id", "source", "size").agg(F.count("*").alias("__rows"), F.sum("copies").alias("__copies"))
    taken = cut_lineage(taken.filter("__copies > 0").withColumnsRenamed({"doc_id": "__id", "source": "__source", "size": "__size"}))
    same = [F.col("doc_id").eqNullSafe(F.col("__id")), F.col("source").eqNullSafe(F.col("__source")), mixing.word_count(F.col("text")) == F.col("__size")]
    found = docs.join(taken, same).drop("__id", "__source", "__size")
    single = found.filter("__rows = 1").withColumn("__times", F.col("__copies"))
    every = F.explode(F.sequence(F.lit(1), F.col("__times").cast("int"))).alias("__copy")
    if taken.filter("__rows > 1").isEmpty():
        return single.select(*docs.columns, every).drop("__copy")
    # rows told apart by place only: each takes its share, the first ones one more
    place = F.row_number().over(Window.partitionBy("doc_id", "source", "__rows", "__copies").orderBy(F.xxhash64("text")))
    shared = found.filter("__rows > 1").withColumn("__place", place)
    times = F.floor(F.col("__copies") / F.col("__rows")) + F.when(F.col("__place") <= F.col("__copies") % F.col("__rows"), 1).otherwise(0)
    shared = shared.withColumn("__times", times).filter("__times > 0").drop("__place")
    return single.unionByName(shared).select(*docs.columns, every).drop("__copy")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, a row for each part, with the checksum of what they decode to."""
    small_batches(spark)
    parts = pieces.encode(docs, verify=True)
    return parts.select("doc_id", "part", "ids", F.size("ids").alias("n_tokens"), "decoded_crc32")


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("near_dedup", near_dedup),
    ("mixing", mix),
    ("sentencepiece", tokenize),
]

#: Stages that learn a model or tokenize are beyond SQL; ``tests/llm`` holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents``, each stored in the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    root = f"{shared_folder(spark)}/corpus_pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
