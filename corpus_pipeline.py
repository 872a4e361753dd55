"""From raw documents to token ids: toxicity, near duplicates, repeated passages, mixing, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read back as the next stage's docs. All stages but the last return the columns of ``documents``:

1. toxicity: documents with a score of 0.5 or more go;
2. ngram_jaccard_join: of documents linked by 5-word shingles (Jaccard 0.75 or more), the smallest doc_id stays;
3. suffix_array_dedup: passages of 50 or more words that are also in a document of a smaller doc_id are cut out;
   n_chars follows the text, and documents of which nothing is left go;
4. pfair_mix: all documents, sorted so that sources interleave by their target weights;
5. bpe_encode_decode: ids of each document, with hashes of the ids and of the text decoded from them, and its slot and
   in_block in the mix. A table read back has no order, and the schedule depends on doc_id and source alone, so this
   stage works it out again and writes its rows in that order; readers sort by (slot, in_block).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeingest.llm.exchange import stage
from lakeingest.session import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from lakeingest.llm.samples import remainder
    from lakeingest.llm.toxicity import drop_toxic, train_toxicity
    ship_package(spark)
    weights, bias = train_toxicity(docs, _table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return drop_toxic(docs, weights, bias)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from lakeingest.llm.ngram_join import keep_one_of_each_group
    ship_package(spark)
    return keep_one_of_each_group(docs, k=5, similarity=75)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from lakeingest.llm.suffix_dedup import drop_later_passages
    ship_package(spark)
    return drop_later_passages(docs, min_words=50)


def pfair_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from lakeingest.llm.pfair_mix import mix_documents
    return mix_documents(docs)


def bpe_encode_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from lakeingest.llm.bpe import encode_texts
    from lakeingest.llm.pfair_mix import in_slots
    from lakeingest.llm.queries import tokenizer_path
    ship_package(spark)
    mixed = in_slots(docs.select("doc_id", "source", "text"))
    return encode_texts(mixed, tokenizer_path(), places=("slot", "in_block"))


STAGES = [("toxicity", toxicity), ("ngram_jaccard_join", ngram_jaccard_join), ("suffix_array_dedup", suffix_array_dedup),
          ("pfair_mix", pfair_mix), ("bpe_encode_decode", bpe_encode_decode)]

#: Trained scores and 64-bit shingle hashes are not SQL; tests compare run() with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
