"""Token ids of texts with the public byte-level vocabulary.

The ids are those of ``tokenizers`` with the JSON file. They are made by
``tiktoken`` from the same vocabulary as ranks, which gives equal ids at several
times the speed; a text it refuses (very long runs without a split) goes through
``tokenizers`` itself. Both libraries are loaded once per Python worker.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JSON_FILE = "byte_bpe_50k.json"
RANK_FILE = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
END_ID = 0
# Ids that one Arrow batch of pieces carries.
BATCH_IDS = 2_000_000


@lru_cache(maxsize=4)
def _rank_encoder(path: str, special: tuple):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(special))


@lru_cache(maxsize=2)
def _json_encoder(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def _split():
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def encode(text: str, rank_path: str, json_path: str) -> list[int]:
    """Ids of ``tokenizers`` with ``json_path`` and add_special_tokens=False."""
    try:
        return _rank_encoder(rank_path, tuple(SPECIAL.items())).encode(text, allowed_special="all")
    except BaseException as error:  # the Rust library panics on such texts, which is no Exception
        if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
            raise
        return _json_encoder(json_path).encode(text, add_special_tokens=False).ids


def count_ordinary(text: str, rank_path: str) -> int:
    """Number of ids of a text, special tokens read as ordinary text."""
    encoder = _rank_encoder(rank_path, ())
    try:
        return len(encoder.encode_ordinary(text))
    except BaseException as error:  # as in ``encode``
        if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
            raise
        return sum(len(encoder._encode_single_piece(piece.encode())) for piece in _split().findall(text))


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 2048,
    rank_path: str | None = None, json_path: str | None = None,
) -> DataFrame:
    """Pieces of at most ``most`` ids of each document: ``id_col``, ``piece``, ``start``, ``length``, ``ids``.

    A document's ids end with id 0. Only longer documents are cut; all pieces
    but the first are full. ``ids`` are little-endian unsigned 32-bit numbers.
    Null or empty text: the single id 0. Null ids and repeated rows are kept as
    they are; other columns are not read. An empty table gives no rows.
    """
    rank_path = rank_path or public_tokenizers.path(RANK_FILE)
    json_path = json_path or public_tokenizers.path(JSON_FILE)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("id", "piece", "start", "length", "ids")
        schema = pa.schema([(id_col, pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            out, held = {n: [] for n in names}, 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or "", rank_path, json_path), END_ID], dtype="<u4")
                start, end = 0, len(ids) % most or min(most, len(ids))
                piece = 0
                while start < len(ids):
                    for n, v in zip(names, (key, piece, start, end - start, ids[start:end].tobytes())):
                        out[n].append(v)
                    piece, start, end = piece + 1, end, end + most
                held += len(ids)
                if held > BATCH_IDS:
                    yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, schema.types)], schema=schema)
                    out, held = {n: [] for n in names}, 0
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, schema.types)], schema=schema)

    rows = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(cut, f"`{id_col}` long, piece int, start long, length long, ids binary")
