"""Text to vectors: batched model calls, one call per distinct text, dimension checks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlattice.functions.scalars import as_column, strip
from adlattice.functions.vectors import list_array, packed_array

# Turns a batch of texts into a matrix, one row per text.
Encoder = Callable[[list[str]], np.ndarray]

# Rows with vectors that leave a task together.
ROWS_TOGETHER = 1_024


class HashingEncoder:
    """Stand-in for a sentence model: signed token counts hashed into ``dims`` buckets.

    Bucket and sign of a token come from the first 32 bits of its MD5, so the encoder is
    deterministic and needs no model. Vectors are left unscaled, so they hold exact small integers;
    cosine does not depend on their length.
    """

    def __init__(self, dims: int = 384):
        self.dims = dims
        self.name = f"token-hash-{dims}"
        self._slots = TokenSlots(2 * dims)

    def __call__(self, texts: list[str]) -> np.ndarray:
        tokens = [text.lower().split() for text in texts]
        counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
        slots = np.fromiter(map(self._slots.__getitem__, chain.from_iterable(tokens)), np.int64, int(counts.sum()))
        width = 2 * self.dims
        cells = np.repeat(np.arange(len(tokens)) * width, counts) + slots
        found = np.bincount(cells, minlength=len(tokens) * width).reshape(len(tokens), width)
        return (found[:, : self.dims] - found[:, self.dims :]).astype(np.float64)


class TokenSlots(dict):
    """Column of a token among ``width``, by its MD5; a bounded number of tokens is remembered."""

    def __init__(self, width: int):
        super().__init__()
        self.width = width

    def __missing__(self, token: str) -> int:
        slot = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % self.width
        if len(self) < 1 << 18:
            self[token] = slot
        return slot


def encode_safely(encode: Encoder, texts: list[str]) -> Iterator[tuple[list[float] | None, str | None]]:
    """Encode one batch; if the call fails, try its texts one by one and report those that fail."""
    try:
        for vector in encode(texts):
            yield np.asarray(vector, dtype=np.float32).tolist(), None
        return
    except Exception as failure:  # a model may raise anything
        if len(texts) == 1:
            yield None, str(failure)
            return
    for text in texts:
        yield from encode_safely(encode, [text])


def vectors_of(encode: Encoder, texts: list[str], packed: bool = False) -> tuple[pa.Array, list[str | None]]:
    """One batch as an Arrow column of vectors (``packed``: binary), and the errors; a batch that the model reads has no Python object per number."""
    try:
        matrix = np.asarray(encode(texts), dtype=np.float32)
    except Exception:  # a model may raise anything
        results = list(encode_safely(encode, texts))
        vectors, errors = [v for v, _ in results], [e for _, e in results]
        if packed:
            return pa.array([None if v is None else np.asarray(v, "<f4").tobytes() for v in vectors], pa.binary()), errors
        return pa.array(vectors, pa.list_(pa.float32())), errors
    return (packed_array if packed else list_array)(matrix), [None] * len(texts)


def embed_texts(df: DataFrame, text: str, make_encoder: Callable[[], Encoder], batch_size: int = 32, packed: bool = False) -> DataFrame:
    """Add ``embedding`` and ``error`` to every row; blank texts get the error 'empty text'.

    ``packed`` vectors are binary, 4 bytes a number, so that moving and storing one costs a single value.

    ``make_encoder`` runs once per task, so a model is loaded once and then fed batch by batch. Rows leave a task in batches of about
    ``ROWS_TOGETHER``, so a task holds the vectors of so many.
    """
    kind, arrow_kind = (T.BinaryType(), pa.binary()) if packed else (T.ArrayType(T.FloatType()), pa.list_(pa.float32()))
    schema = T.StructType([*df.schema.fields, T.StructField("embedding", kind), T.StructField("error", T.StringType())])
    names = [*df.columns, "embedding", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for batch in batches:
            encode = encode or make_encoder()
            texts = batch.column(text).to_pylist()
            blank = np.asarray([t is None or not t.strip() for t in texts], dtype=bool)
            empty = batch.filter(pa.array(blank))
            if empty.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*empty.columns, pa.nulls(empty.num_rows, arrow_kind),
                     pa.array(["empty text"] * empty.num_rows, pa.string())], names=names)
            usable = batch.filter(pa.array(~blank)) if empty.num_rows else batch
            together = batch_size * max(1, ROWS_TOGETHER // batch_size)
            for start in range(0, usable.num_rows, together):
                part = usable.slice(start, together)
                texts = part.column(text).to_pylist()
                read = [vectors_of(encode, texts[i : i + batch_size], packed) for i in range(0, len(texts), batch_size)]
                vectors, errors = pa.concat_arrays([v for v, _ in read]), [e for _, es in read for e in es]
                yield pa.RecordBatch.from_arrays([*part.columns, vectors, pa.array(errors, pa.string())], names=names)

    return df.mapInArrow(run, schema)


def text_key(text: Column | str, model: str) -> Column:
    """Key of a text in the embedding store: model name and MD5 of the text."""
    return F.concat(F.lit(f"{model}_"), F.md5(as_column(text)))


def missing_embeddings(df: DataFrame, text: str, model: str, store: DataFrame | None) -> DataFrame:
    """Distinct non-blank texts that the store lacks, as (text_key, text)."""
    # Grouped by the text alone: a smallest text per key would be a string in an aggregate, which sorts all rows.
    texts = df.where(F.length(strip(text)) > 0).select(F.col(text).alias("text")).distinct()
    distinct = texts.select(text_key("text", model).alias("text_key"), "text")
    return distinct if store is None else distinct.join(store.select("text_key"), "text_key", "left_anti")


def embed_missing(df: DataFrame, text: str, make_encoder: Callable[[], Encoder], model: str,
                  store: DataFrame | None = None, batch_size: int = 32, packed: bool = False) -> DataFrame:
    """New store rows (text_key, text, embedding, error): every distinct unseen text embedded once."""
    return embed_texts(missing_embeddings(df, text, model, store), "text", make_encoder, batch_size, packed)


def attach_embeddings(df: DataFrame, text: str, model: str, store: DataFrame, columns: tuple[str, ...] = ("embedding",)) -> DataFrame:
    """Join stored vectors, or other ``columns`` of the store, back to the rows by text; a text the store lacks gets NULL.

    A boilerplate text may be shared by a large part of the rows: the left side of a left join can be
    split, so the adaptive skew join spreads such a text over many tasks.
    """
    keyed = df.withColumn("text_key", text_key(text, model))
    return keyed.join(store.select("text_key", *columns), "text_key", "left").drop("text_key")


def with_dimension(df: DataFrame, dims: int, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has exactly ``dims`` numbers, none of them NULL."""
    return df.where((F.size(vector) == dims) & ~F.exists(vector, lambda x: x.isNull()))


def wrong_dimension(df: DataFrame, dims: int, vector: str = "embedding") -> DataFrame:
    """The quarantined rest of :func:`with_dimension`, with the length found."""
    good = F.coalesce((F.size(vector) == dims) & ~F.exists(vector, lambda x: x.isNull()), F.lit(False))
    return df.where(~good).withColumn("found_dimension", F.size(vector))


def centroids(vectors: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """Element-wise mean vector per group, as array<double>; every task forwards one partial vector per group.

    Missing vectors count nowhere, and a group without any has no row; the others are equally long.
    """
    known = vectors.where(F.col(vector).isNotNull()).select(group, F.col(vector).cast("array<double>").alias("__v"))
    mean = Summarizer.mean(array_to_vector(F.col("__v")))
    return known.groupBy(group).agg(vector_to_array(mean).alias("centroid"))
