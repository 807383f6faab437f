"""Packing by power-of-two decomposition.

Each document's token count is written in binary, and the document is cut into pieces of those lengths (pieces above the
limit are cut into pieces of the limit). Every piece is a sequence of its own, so no sequence crosses documents and none
is padded; ``bucket`` is the base-2 logarithm of the length, and a loader draws batches from one bucket at a time.

Edge cases: a null or empty text has the end id alone; repeated rows are packed once each; an empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, map_texts

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int"
_CODERS: dict[str, object] = {}


def coder(path: str):
    """An encoder with the vocabulary of a byte-level BPE file of the tokenizers library: the same ids, several times faster."""
    if path not in _CODERS:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        # the printable stand-ins of bytes in such files: printable bytes stand for themselves, the others follow from 256 on
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        back = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
        special = {x["content"]: x["id"] for x in said.get("added_tokens", [])}
        ranks = {bytes(back[c] for c in t): i for t, i in said["model"]["vocab"].items() if t not in special}
        _CODERS[path] = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _CODERS[path]


def lengths(n: int, limit: int = 1024) -> list[int]:
    """The pieces of n tokens, longest first: as many of the limit as fit, then the binary digits of the rest."""
    full, rest = divmod(n, limit)
    return [limit] * full + [1 << k for k in range(limit.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, tokenizer: str, limit: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document. limit: a power of two. with_ids adds the ids themselves.

    sequence_id is unique; it numbers the rows of the scan's partitions and needs no shuffle.
    """
    if limit & (limit - 1) or limit < 1:
        raise ValueError("limit must be a power of two")

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def make():
        enc = coder(tokenizer)

        def pieces(block: dict) -> Iterator[dict]:
            out: dict[str, list] = {k: [] for k in names}
            for doc_id, text in zip(block["doc_id"], block["text"], strict=True):
                ids = np.array([*enc.encode(text, allowed_special="all"), end_id], "<u4")
                start = 0
                for n in lengths(len(ids), limit):
                    piece = ids[start : start + n]
                    for k, v in zip(names, (doc_id, start, n, zlib.crc32(piece.tobytes()), len(ids), n.bit_length() - 1, piece.astype("i4")), strict=False):
                        out[k].append(v)
                    start += n
            yield out

        return pieces

    out = map_texts(documents(docs), make, schema)
    return out.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store packed pieces with one folder per length, the layout that length-bucketed loaders read."""
    pieces.write.partitionBy("bucket").mode("overwrite").parquet(path)


def padding(pieces: DataFrame) -> Column | DataFrame:
    """Rows and tokens per bucket; padded tokens are zero by construction."""
    return pieces.groupBy("bucket").agg(F.count("*").alias("n_sequences"), F.sum("length").alias("n_tokens"))
