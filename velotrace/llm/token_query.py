"""The query for binary token files. SQL cannot encode texts; a test compares it with plain encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velotrace.llm import token_files
from velotrace.llm.common import table

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = token_files.new_token_folder(spark)
    documents = table(spark, sf_dir, "documents")
    token_files.write_tokens(documents, path, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.read_tokens(spark, path)
