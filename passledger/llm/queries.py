"""Queries over the training-text tables: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passledger.llm import decontam, htmltext, langid, mixing, neardup, secrets, tokencount, tokenfile, topk, toxicity
from passledger.llm.common import stored, word_count


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the public tokenizers' files lie on this machine; the driver alone reads them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    """The split of the public byte-level tokenizers."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def fold_of(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32(id as text) modulo `folds` is `fold`."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        decontam.n_hit().alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        decontam.items_digest(F.col("_items")).alias("items_sha256"),
        decontam.is_contaminated().alias("contaminated"),
    )


def op3_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokencount.count_sections(documents, tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_pattern())
    return counted.select("doc_id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), secrets.fit())
    of_kind = lambda kind: F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("_spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", of_kind("assign"), of_kind("access"), of_kind("hex"), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans"))


def op5_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmltext.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), htmltext.fit())
    return found.select("page_id", "url", F.col("_text").alias("text"), F.col("_n_chars").alias("n_chars"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    network = langid.fit(langid.training_sample(documents))
    found = langid.predict_language(documents.select("doc_id", "text"), network)
    return found.select("doc_id", fold_of("doc_id", 3, 1).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    slim = stored(slim, "mix-sizes")  # words are counted once, not in each pass over sizes
    mixed = mixing.mix(slim, size_col="size")
    return mixed.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.training_sample(documents, table(spark, sf_dir, "labels")))
    scored = toxicity.score_toxicity(documents, model)
    spans = F.array_join(F.transform("_spans", lambda s: F.concat(s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
    return scored.select("doc_id", fold_of("doc_id", 5, 0).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"), spans.alias("spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_topk": op1_topk,
        "op2_decontaminate": op2_decontaminate,
        "op3_tokencount": op3_tokencount,
        "op4_secrets": op4_secrets,
        "op5_tokenfile": op5_tokenfile,
        "op6_htmltext": op6_htmltext,
        "op7_langid": op7_langid,
        "op8_neardup": op8_neardup,
        "op9_mix": op9_mix,
        "op10_toxicity": op10_toxicity,
    }


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP2_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)
),
grams AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
),
m AS (SELECT doc_id, i, n, item_id FROM grams JOIN win USING (n, g)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM m)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM m) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP8_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) LEFT JOIN n USING (doc_id)
"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
p AS (SELECT max(greatest(0, ceil(log2(greatest(n_docs, 1) / 512.0))))::BIGINT AS e FROM s),
c AS (SELECT *, sum(source_size) OVER () AS total,
  coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS smaller,
  sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavier,
  row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS nth FROM s),
f AS (SELECT *, (total - 3 * smaller)::DOUBLE / heavier AS share FROM c),
l AS (SELECT arg_min(share, nth) AS level FROM f WHERE source_size * 3 >= share * weight),
t AS (SELECT source, source_size, least(source_size * 3.0::DOUBLE, coalesce(level * weight, source_size * 3.0::DOUBLE)) AS target FROM f CROSS JOIN l),
h AS (SELECT d.*, md5('7|' || coalesce(doc_id::VARCHAR, 'null')) AS digest, len(CASE WHEN size = 0 THEN '0' ELSE bin(size) END) AS grade FROM d),
r AS (SELECT doc_id, size, source, row_number() OVER (PARTITION BY source ORDER BY grade, ('0x' || digest[1:8])::BIGINT % (1 << (SELECT e FROM p)::INTEGER), size, digest, doc_id::VARCHAR) AS place FROM h),
x AS (SELECT doc_id, size, source_size, target, place, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
  ('0x' || md5('7|' || coalesce(t.source, 'null'))[1:8])::BIGINT / 4294967296.0::DOUBLE AS shift
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (floor(place * rate + shift) - floor((place - 1) * rate + shift))::BIGINT * size AS taken FROM x
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": OP1_SQL, "op2_decontaminate": OP2_SQL, "op8_neardup": OP8_SQL, "op9_mix": OP9_SQL}
