"""The training-corpus pipeline: five stages, each the work of one operator of ``rankforge.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each result as a table
in the folder of ``spark.checkpoint.dir`` and reads it back as the next stage's
documents.

1. ``toxicity``: documents predicted toxic go.
2. ``exact_dedup``: of equal texts one stays.
3. ``jaccard_join``: of each component of near duplicates (five-word shingles,
   similarity 0.8 or more) one stays.
4. ``decontaminate``: documents that hold a passage of ``benchmark`` go.
5. ``sentencepiece``: per document its number of tokens, ids and decoded text.

Stages that learn (toxicity) do so from ``documents`` and ``labels`` as given.
Defined results: null texts are empty texts and are kept once by the
deduplication; empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankforge.llm import decontaminate as contamination
from rankforge.llm import exact_dedup as copies
from rankforge.llm import jaccard_join as near
from rankforge.llm import toxicity as toxic
from rankforge.llm.common import stable, table
from rankforge.llm.sentencepiece_codec import encode_decode

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80
PIECES = "piece_bpe_32k.model"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxic.fit(docs, table(spark, sf_dir, "labels"))
    return toxic.keep_clean(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return copies.keep_one(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.keep_one(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encode_decode(docs, public_tokenizers.path(PIECES)).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("jaccard_join", jaccard_join),
          ("decontaminate", decontaminate), ("sentencepiece", sentencepiece)]

# toxicity, the near-duplicate join, decontamination and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
