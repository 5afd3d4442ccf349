"""Queries ``opN_<name>`` over the given tables, each a thin use of one operator.

``ORACLE`` has DuckDB SQL for those that SQL can express; the others are held
against brute force, held-out labels or an exact round trip in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, dialogue, extract, langid, lcp, licenses, merkle, mixing, pieces, sharding, simhash, toxicity, urlfilter
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from labelled rows that are not held out, scores every document."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.training_rows(docs), read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model)


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, links at four or fewer differing bits."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, max_bits=4).drop("fp")


@query
def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no path of their own: source and language are taken as directories."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licenses.scan(read(spark, sf_dir, "documents"), path)


@query
def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text against its edited text and the next document."""
    return lcp.edit_likeness(read(spark, sf_dir, "documents"))


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards under the law ``bytes``."""
    placed = sharding.shard(read(spark, sf_dir, "documents"), 40)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(read(spark, sf_dir, "pages"))


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 of largest inner product for every 20th vector."""
    return ann.nearest(read(spark, sf_dir, "embeddings"), every=20, k=20)


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weighed 5, 2, 1; documents by the quality labels."""
    return mixing.mix(read(spark, sf_dir, "documents"), mixing.quality_weights(read(spark, sf_dir, "labels")))


ORACLE["op8_mixing"] = mixing.ORACLE


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the rows that are not held out, predicted for every document."""
    docs = read(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(langid.training_rows(docs)))


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, one row a part, and length and checksum of what they decode to."""
    return pieces.encode(read(spark, sf_dir, "documents"), verify=True).withColumn("n_tokens", F.size("ids"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree for each source; texts of even checksum lose their line feeds before they are verified."""
    return merkle.verified(read(spark, sf_dir, "documents"))


ORACLE["op11_merkle_manifest"] = merkle.ORACLE


@query
def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rules; a url that none fits is allowed."""
    return urlfilter.judge(read(spark, sf_dir, "pages"), urlfilter.RULES)


ORACLE["op12_url_filters"] = urlfilter.ORACLE


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, repaired."""
    return dialogue.Repair(dialogue.damage(read(spark, sf_dir, "conversations")), present="here").conversations


ORACLE["op13_conversation_repair"] = dialogue.ORACLE
