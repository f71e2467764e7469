"""Encoding and decoding of a corpus with a public byte-level vocabulary."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.transducer import MOST_VOCABULARY_BYTES, Transducer, decode, read_ranks
from tidemark.session import spread

#: Where the rank file lies; a parameter of every operator.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

_made: dict[str, Transducer] = {}


def transducer(content: bytes) -> Transducer:
    """The transducer of a rank file, made once in each Python process."""
    digest = hashlib.sha256(content).hexdigest()
    if digest not in _made:
        _made[digest] = Transducer(read_ranks(content))
    return _made[digest]


def send_vocabulary(spark: SparkSession, path: str = VOCABULARY):
    """The rank file as a broadcast: its size doesn't depend on the corpus, and is checked."""
    with open(path, "rb") as file:
        content = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(content) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MOST_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(content)


def _rows(column: pa.Array, size: int = 64) -> Iterator[tuple[int, list[str | None]]]:
    """A column in short stretches, so that few long texts are Python objects at a time."""
    for start in range(0, len(column), size):
        yield start, column[start : start + size].to_pylist()


def encode_corpus(documents: DataFrame, vocabulary: str = VOCABULARY, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """``identity`` and ``ids``, the token ids of each text, one row for each row.

    Null and empty texts have an empty list. The strings of special tokens are ordinary text. Texts are
    encoded whole, however long, in time linear in their length. No shuffle; other columns aren't read.
    """
    content = send_vocabulary(documents.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = transducer(content.value).encode
        for batch in batches:
            for start, texts in _rows(batch.column(1)):
                ids = pa.array([encode(t) for t in texts], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), ids], names=[identity, "ids"])

    rows = spread(documents.select(identity, text))
    kind = dict(rows.dtypes)[identity]
    return rows.mapInArrow(run, f"`{identity}` {kind}, ids array<int>")


def count_tokens(documents: DataFrame, vocabulary: str = VOCABULARY, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """``identity`` and ``n_tokens`` of each text; 0 for null and empty texts."""
    content = send_vocabulary(documents.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = transducer(content.value).encode
        for batch in batches:
            for start, texts in _rows(batch.column(1)):
                sizes = pa.array([len(encode(t)) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), sizes], names=[identity, "n_tokens"])

    rows = spread(documents.select(identity, text))
    kind = dict(rows.dtypes)[identity]
    return rows.mapInArrow(run, f"`{identity}` {kind}, n_tokens long")


def decode_corpus(encoded: DataFrame, vocabulary: str = VOCABULARY, identity: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``identity`` and the ``text`` of each list of ids, by the streaming decoder; a null list has a null text."""
    content = send_vocabulary(encoded.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in transducer(content.value).ranks.items()}
        for batch in batches:
            for start, lists in _rows(batch.column(1)):
                texts = pa.array([None if x is None else "".join(decode(x, tokens)) for x in lists], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(lists)), texts], names=[identity, "text"])

    rows = encoded.select(identity, ids)
    kind = dict(rows.dtypes)[identity]
    return rows.mapInArrow(run, f"`{identity}` {kind}, text string")
