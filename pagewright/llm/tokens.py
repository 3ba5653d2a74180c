"""Token counts by a public tokenizer's vocabulary file."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import spread

#: A vocabulary as ranks; a path is a parameter everywhere, the files stay where they are installed.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def encoder(vocabulary: str = VOCABULARY):
    import tiktoken

    lines = Path(vocabulary).read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(texts: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``texts`` without the text column, with ``n_tokens``; a NULL text has none.

    The text ends in the Python worker that counts it: only its count goes on.
    """
    kept = texts.drop(text)
    ordered = spread(texts.select(*kept.columns, text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        for batch in batches:
            *rest, column = batch.columns
            n = pa.array([len(encode(t)) if t else 0 for t in column.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*rest, n], [*batch.schema.names[:-1], "n_tokens"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return ordered.mapInArrow(count, f"{schema}, n_tokens bigint" if schema else "n_tokens bigint")
