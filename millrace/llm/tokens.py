"""Token counts of a public tokenizer (a rank file), per document."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.sources.tables import columns_or_null

#: Place of the rank file; a parameter of every operator that counts tokens.
RANK_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_made: dict = {}


def encoding(path: str):
    """The encoder of a rank file, made once in each Python worker."""
    if path not in _made:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _made[path] = tiktoken.Encoding(path.rpartition("/")[2], pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _made[path]


def token_counts(documents: DataFrame, path: str = RANK_FILE) -> DataFrame:
    """(doc_id, source, n_tokens) per row; null and empty texts have 0 tokens. One narrow pass."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], names=["doc_id", "source", "n_tokens"])

    df = columns_or_null(documents, {"doc_id": "long", "source": "string", "text": "string"})
    return df.mapInArrow(count, "doc_id long, source string, n_tokens long")
