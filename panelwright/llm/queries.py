"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import alignment, ann, bpe, chat, credentials, idfiles, language, lm, mixing, periodic, quality, simhash, token_counts
from panelwright.llm.common import id_bucket, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_chat_formatting(spark, folder):
    """All conversations and one whose texts are control strings."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql(
        "SELECT * FROM VALUES (-7L, 0L, 'user', :said), (-7L, 1L, 'assistant', :said) AS t(conv_id, turn, role, text)",
        args={"said": said},
    )
    blocks = chat.format_conversations(turns.unionByName(planted), path)
    return chat.conversation_digests(blocks, path)


@query
def op2_source_mixing(spark, folder):
    """Words that the mix takes of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_lm_scoring(spark, folder):
    """Scores of every document, learned from those whose bucket of seven is not 2."""
    docs = table(spark, folder, "documents").select("doc_id", "text", (id_bucket("doc_id", 7) == 2).alias("held_out"))
    return lm.score_texts(docs, "held_out")


@query
def op4_language_id(spark, folder):
    """Language of every document, learned from those whose bucket of three is not 1."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", (id_bucket("doc_id", 3) == 1).alias("held_out"))
    names, prototypes = language.learn(docs.where("NOT held_out"))
    return language.predict(docs.drop("lang"), names, prototypes, ["doc_id", "held_out"])


@query
def op5_simhash_near_dedup(spark, folder):
    """Fingerprint and component of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, shingle=4, distance=4)
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


@query
def op6_bpe_encoding(spark, folder):
    """Encode and decode every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])


@query
def op7_secret_scans(spark, folder):
    """Secrets of every document."""
    return credentials.scan(table(spark, folder, "documents").select("doc_id", "text"), ["doc_id"])


@query
def op8_token_counts(spark, folder):
    """Token counts of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])


@query
def op9_quality_rules(spark, folder):
    """Counts and verdict of every document, trees learned from labels."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    trees = quality.fit_quality(docs, table(spark, folder, "labels"))
    return quality.judge(docs, trees, ["doc_id"])


@query
def op10_nearest_neighbours(spark, folder):
    """The ten nearest vectors of every hundredth vector."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, lambda v: F.pmod(v, F.lit(100)) == 0)


@query
def op11_id_files(spark, folder):
    """Ids of every document, written to files in order and read back."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return idfiles.write_and_read(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query
def op13_tokenizer_alignment(spark, folder):
    """Tokens of two vocabularies aligned in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_periodic_runs(spark, folder):
    """Periodic runs of words in every document, a tenth of which repeat a pattern by rule."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return periodic.collapse_runs(docs, ["doc_id"], respell=periodic.periodic_copy)
