"""Byte-level BPE: texts to token ids with offsets, and back."""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.llm.common import BATCH_ROWS, arrow_schema, map_texts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Distinct pieces that a task remembers, and the longest of them; beyond the number the memory starts anew.
REMEMBERED, REMEMBERED_CHARS = 200_000, 64
#: Code points of the texts that are taken apart before their new pieces go to the tokenizer.
TOGETHER_CHARS = 1 << 19


@functools.cache
def byte_table() -> dict[str, int]:
    """The byte for each character of the vocabulary: printable Latin-1 stands for itself, the other bytes follow from
    U+0100 on in their order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Codec:
    """The tokenizer of one vocabulary file, with the bytes of each token."""

    def __init__(self, path: str = VOCABULARY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark hands out the cores
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Each piece is one match of the pattern already.
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        table = byte_table()
        size = self.tokenizer.get_vocab_size(with_added_tokens=False)
        self.token_bytes = [bytes(map(table.__getitem__, self.tokenizer.id_to_token(i))) for i in range(size)]
        self.token_sizes = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        self._known: dict[str, bytes] = {}

    def encode_together(self, texts: Sequence[str | None]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers; null and empty texts have none. Pieces that
        aren't known yet go to the tokenizer in one call."""
        parted = [self.pattern.findall(text or "") for text in texts]
        if len(self._known) > REMEMBERED:
            self._known.clear()
        known = self._known
        new = list(set().union(*parted).difference(known))
        if new:
            for piece, found in zip(new, self.tokenizer.encode_batch(new, add_special_tokens=False), strict=True):
                known[piece] = np.array(found.ids, dtype="<u4").tobytes()
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in parted]
        for piece in new:
            if len(piece) > REMEMBERED_CHARS:
                del known[piece]
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_together([text])[0]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the tokens in a row; characters split over tokens come together again."""
        tokens = self.token_bytes
        return b"".join([tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])

    def offsets(self, text: str | None, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in code points. A token with part of a character covers the whole character."""
        raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
        ends = np.cumsum(self.token_sizes[np.frombuffer(ids, dtype="<u4").astype(np.int64)])
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        character = np.cumsum((raw & 0xC0) != 0x80) - 1          # of each byte
        return character[starts], character[ends - 1] + 1


def offsets_digest(starts: np.ndarray, ends: np.ndarray) -> str:
    """Lower-case hex SHA-256 of start and end of each token in turn, as little-endian unsigned 32-bit integers."""
    return hashlib.sha256(np.column_stack((starts, ends)).astype("<u4").tobytes()).hexdigest()


def _groups(texts: Sequence[str | None]) -> Iterator[Sequence[str | None]]:
    """Neighbours of TOGETHER_CHARS code points at most, or one longer text."""
    first = held = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if held and held + size > TOGETHER_CHARS:
            yield texts[first:i]
            first, held = i, 0
        held += size
    yield texts[first:]


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


ENCODED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
OFFSETS = T.StructType([T.StructField("starts", T.ArrayType(T.IntegerType())),
                        T.StructField("ends", T.ArrayType(T.IntegerType()))])
OFFSETS_DIGEST = T.StructType([T.StructField("offsets_sha256", T.StringType())])
DECODED = T.StructType([T.StructField("decoded", T.BinaryType())])


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str = VOCABULARY,
           offsets: bool = True, decoded: bool = False, digest_offsets: bool = False) -> DataFrame:
    """(id, n_tokens, ids, starts, ends), one row for each row of `docs`.

    `ids` holds little-endian unsigned 32-bit integers; starts and ends count code points. `offsets=False` leaves out the
    offsets; `digest_offsets=True` adds their digest and `decoded=True` the bytes that the ids decode to, made in the
    same pass. Null texts count as empty and have no tokens.
    """
    made = list(ENCODED) + list(OFFSETS) * offsets + list(OFFSETS_DIGEST) * digest_offsets + list(DECODED) * decoded

    def start():
        own = codec(path)

        def row(text: str | None, ids: bytes) -> tuple:
            places = own.offsets(text, ids) if offsets or digest_offsets else ()
            return (len(ids) // 4, ids, *(places if offsets else ()),
                    *([offsets_digest(*places)] if digest_offsets else ()), *([own.decode(ids)] if decoded else ()))

        return lambda texts: (row(t, ids) for group in _groups(texts)
                              for t, ids in zip(group, own.encode_together(group), strict=True))

    return map_texts(docs, [id_column], text_column, T.StructType(made), start)


def decode(encoded: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """(id, decoded): the bytes that the ids of each row stand for; null ids give no bytes."""
    schema = T.StructType([encoded.select(id_column).schema[0], *DECODED])
    kinds = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                made = pa.array([own.decode(i or b"") for i in batch.column(1).to_pylist()], type=kinds.field(1).type)
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(kinds.field(0).type), made], schema=kinds)

    return encoded.select(encoded[id_column], encoded[ids_column]).mapInArrow(run, schema)


def digest(column: str) -> Column:
    """Lower-case hex SHA-256 of a binary column."""
    return F.sha2(F.col(column), 256)
