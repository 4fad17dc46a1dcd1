"""From documents to packed training sequences: quality classifier, language
labels, near-duplicates, source mix, best-fit packing. Every stage works on
all rows that its predecessor kept; the first four return the columns of
documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import langid, mixing, neardup, packing, quality
from pulsegrid.llm.common import doc_remainder, spare_name, stage_table
from pulsegrid.llm.queries import tokenizer_path

MIN_QUALITY, MIN_SHARE = 0.5, 0.4


def _told_apart(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the hash of the text under a name of its own: with the
    doc_id it tells rows apart, whatever their doc_id."""
    name = spare_name(docs, "__text_hash")
    return docs.withColumn(name, F.xxhash64("text")), name


def _by_row(docs: DataFrame, hashed: str, side: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` joined with ``side`` (doc_id, text_hash, ...) on both, nulls
    alike, with the columns ``names`` of ``side`` added. The texts are shuffled
    once, at every size alike."""
    same = docs["doc_id"].eqNullSafe(side["doc_id"]) & (docs[hashed] == side["text_hash"])
    return docs.join(side, same).select(*[docs[c] for c in docs.columns], *[side[n] for n in names])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores at MIN_QUALITY or more. Null
    texts score as empty ones; repeated rows alike; an empty table stays empty."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = spare_name(docs, "__quality")
    return quality.score_quality(docs, model, name=score).where(F.col(score) >= MIN_QUALITY).select(*docs.columns)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that holds MIN_SHARE of the letters or more;
    texts without letters (null and empty ones, too) go; an empty table stays
    empty."""
    model = langid.fit_languages(docs.where(doc_remainder(F.col("doc_id"), 3) != 1))
    lang, share = spare_name(docs, "__lang"), spare_name(docs, "__share")
    labelled = langid.label_languages(docs, model, keep=docs.columns, spans=False, names=(lang, share))
    return labelled.where((F.col(lang) != "und") & (F.col(share) >= MIN_SHARE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, the one of the smallest doc_id (of its
    texts the one of the smallest hash), and the first of its rows without a
    doc_id. Rows go by doc_id and text, so rows that share a doc_id but are no
    near-duplicates all stay; of rows that repeat both one stays."""
    verdict = stage_table(neardup.near_duplicates(docs, inner=True), "verdict")
    nameless = F.col("doc_id").isNull()
    first = verdict.where("component is not null").groupBy("component", nameless.alias("nameless")).agg(F.min(F.struct("doc_id", "text_hash")).alias("r"))
    stay = first.select("r.doc_id", "r.text_hash").union(verdict.where("component is null").select("doc_id", "text_hash").distinct())
    hashed, name = _told_apart(docs)
    return _by_row(hashed.dropDuplicates(["doc_id", name]), name, stay, []).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (rows that repeat doc_id and
    text: their mean number of copies, rounded up). Null texts have no words
    and are not taken; an empty table stays empty."""
    copies = mixing.mix_sources(docs).groupBy("doc_id", "text_hash").agg(F.ceil(F.avg("copies")).cast("int").alias("copies"))
    hashed, name = _told_apart(docs)
    times = spare_name(docs, "__times")
    taken = _by_row(hashed, name, copies.where("copies > 0").withColumnRenamed("copies", times), [times])
    return taken.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place in it; a
    null text is empty; repeated rows are packed each."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality", keep_quality), ("language", keep_language), ("near_duplicates", drop_near_duplicates), ("mix", mix), ("pack", pack)]

# Learned models and near-duplicate links have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
