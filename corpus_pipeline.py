"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows of `docs` and returns the
columns of documents; the last returns digests of the written tokens.  Empty tables,
null and very long texts, ties and repeated rows pass as the operators' docstrings say.
Other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passledger.llm import decontam, mixing, neardup, tokenfile, toxicity
from passledger.llm.common import stored
from passledger.llm.queries import table, tokenizer_path

#: SQL cannot express the stages; tests/llm holds them against brute-force versions.
ORACLE_SQL = None


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """`docs` with columns named like a result (in any case of letters) renamed, and what brings all names back."""
    own = {c: f"own {i}" if c.lower() in names else c for i, c in enumerate(docs.columns)}
    return docs.select(*[docs[f"`{c}`"].alias(n) for c, n in own.items()]), [F.col(f"`{n}`").alias(c) for c, n in own.items()]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 stay; the model learns from the labelled ones among `docs`."""
    model = toxicity.fit(toxicity.training_sample(docs, table(spark, sf_dir, "labels")))
    docs, back = aside(docs, "_score", "_spans")
    return toxicity.score_toxicity(docs, model).where(F.col("_score") < 0.5).select(*back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group by five-word shingles at 0.8, the document with the smallest id stays, once.

    Rows that repeat id and text are one document.  Texts that share an id are documents of
    their own, which come after all others in their group; none goes for another's text.
    Rows without an id stay.
    """
    docs, back = aside(docs, "near key", "near many")
    rows = docs.withColumn("near key", F.col("doc_id").cast("long"))
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.limit(1).count():
        once = docs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
        several = once.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("near many"))
        # A key of its own above all ids, from id and text.
        own = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
        once = once.join(several, "doc_id", "left").select(*docs.columns, F.when(F.col("near many"), own).otherwise(F.col("doc_id").cast("long")).alias("near key"))
        rows = rows.join(again, "doc_id", "left_anti").select(*rows.columns).unionByName(once)
    groups = neardup.near_duplicates(rows, id_col="near key", k=5, percent=80)
    dropped = groups.where(~F.col("kept")).select(F.col("doc_id").alias("near key")).distinct()
    return rows.join(dropped, "near key", "left_anti").select(*back)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a hit of 13 words that covers a twentieth of them go."""
    docs, back = aside(docs, "_n_words", "_spans", "_items")
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontam.is_contaminated()).select(*back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    docs, back = aside(docs, *mixing.ADDED)
    return mixing.repeated(mixing.mix(docs)).select(*back)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the documents' tokens, from the files they were written to."""
    return tokenfile.round_trip(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each stage's rows are written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
