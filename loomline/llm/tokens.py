"""Token counts with the public tokenizers."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder with the public vocabularies; a byte-level vocabulary of merge ranks.
FOLDER, VOCABULARY = "/opt/tokenizers", "byte_bpe_multi_50k.tiktoken"
# Fixed value: the public pattern that cuts text before byte-level merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(documents: DataFrame, keep: list[str], text_column: str = "text", path: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """``keep`` and ``n_tokens`` (bigint); NULL and empty texts have 0. Texts are counted whole."""
    schema = T.StructType([*(documents.schema[c] for c in keep), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(counts, pa.int64())], [*keep, "n_tokens"])

    return documents.select(*keep, F.col(text_column)).mapInArrow(run, schema)
