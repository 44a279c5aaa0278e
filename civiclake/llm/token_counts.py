"""Token counts through a digest cache.

A count depends on the content and on the tokenizer only. The cache is a Parquet table keyed by
both digests: SHA-256 of the normalised content (null becomes the empty text; anything more could
change the count) and of the tokenizer file, which is the folder level of the cache. Contents
without a stored count are the misses: each distinct one is encoded once, wherever and however
often it occurs, and appended.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm.chunks import RunValues, byte_values, text_of

COUNTS = "digest binary, n_tokens long"


@lru_cache(maxsize=2)
def _encoder(path: str) -> RunValues:
    """Counts per run; the tokenizer has no added begin, end or special tokens here, but special
    strings inside a text are found as the library finds them by default."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return RunValues(lambda run: len(tokenizer.encode(run, add_special_tokens=False).ids))


def _count(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            counts = [sum(encoder.of(text_of(data))) for data in byte_values(batch.column("content"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest").cast(pa.binary()), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    return count


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """The cached counts of one tokenizer; an empty frame if nothing was ever stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(folder)


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, *, key: str = "doc_id", text: str = "text", limit: int = 1024
) -> DataFrame:
    """`key`, `n_bytes`, `n_tokens`, `over_limit` for every row of `docs`.

    `tokenizer` is the path of a byte-level BPE file of the `tokenizers` library whose pre-tokens
    start at blanks (see `chunks`); `cache` is a folder all executors share. A cache has one
    writer at a time, so that a content is never stored twice.

    Null and empty texts count 0 bytes and 0 tokens. Texts of any length are encoded whole.
    Repeated rows come back as often as they came; a null key stays null. An empty table gives an
    empty result. Other columns, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    folder = f"{cache}/tokenizer={tokenizer_digest(tokenizer)}"
    content = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(content, 256))
    # Copies meet inside each task first, then once per digest; the anti join reuses that layout.
    distinct = docs.select(digest.alias("digest"), content.alias("content")).dropDuplicates(["digest"])
    misses = distinct.join(_stored(spark, folder), "digest", "left_anti")
    misses.mapInArrow(_count(tokenizer), COUNTS).write.mode("append").parquet(folder)
    rows = docs.select(F.col(key), F.octet_length(content).cast("long").alias("n_bytes"), digest.alias("digest"))
    return rows.join(_stored(spark, folder), "digest").select(
        key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
