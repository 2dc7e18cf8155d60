"""The corpus operators applied to their whole tables, under the names the driver knows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.llm import jaccard, mixing, neighbours, packing, page_text, pseudonyms, quality, rotation, tokens, toxicity
from quire.llm.common import table

TOKENIZER = "word_bpe_49k.json"
WINDOW = 2048
#: The setting that names the secret key of pseudonyms, and what stands for it where the session has none, as in tests.
KEY_SETTING, TEST_KEY = "spark.quire.pseudonym.key", "only for tests"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark, sf_dir):
    return pseudonymised(table(spark, sf_dir, "documents"))


def pseudonymised(docs):
    key = docs.sparkSession.conf.get(KEY_SETTING, TEST_KEY)
    return pseudonyms.pseudonymise(docs, key).withColumn("n_chars", F.length("text").cast("long"))


def op2_rotation(spark, sf_dir):
    views = rotation.rotate(table(spark, sf_dir, "conversations"))
    return views.withColumn("spans", F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ","))


def op3_token_counts(spark, sf_dir):
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), WINDOW)


def op4_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), WINDOW)


def op5_neighbours(spark, sf_dir):
    return neighbours.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("spans")


def op7_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"), k=4, percent=85)


def op9_quality(spark, sf_dir):
    return quality.score(table(spark, sf_dir, "documents")).drop("failed_rules")


def op10_page_text(spark, sf_dir):
    return page_text.main_text(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_rotation, op3_token_counts, op4_packing, op5_neighbours, op6_toxicity, op7_mixing, op8_ngram_jaccard, op9_quality, op10_page_text)}
ORACLES = {"op2_rotation": rotation.ORACLE, "op7_mixing": mixing.ORACLE, "op8_ngram_jaccard": jaccard.ORACLE, "op9_quality": quality.ORACLE}
