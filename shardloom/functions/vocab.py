"""Vocabularies: how a document's text becomes token ids.

A tokenized corpus is a DataFrame ``(pos, id, n, body)``: ``n`` tokens whose compact form
is ``body``. The codec beside it cuts token ranges out of a body and turns a cut into the
packed payload the sink takes, both as built-in expressions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.tokens import unpack

# End-of-text ids and pre-split patterns of the two published vocabularies.
GPT2_EOT = 50256
GPT2_PATTERN = (
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
)
GPT4_EOT = 100257
GPT4_PATTERN = (
    r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}++|\p{N}{1,3}+|"""
    r""" ?[^\s\p{L}\p{N}]++[\r\n]*+|\s++$|\s*[\r\n]|\s+(?!\S)|\s"""
)

# A vocabulary is collected and broadcast; published ones have 50 to 200 thousand entries.
MAX_RANKS = 1 << 20


@dataclass(frozen=True)
class RawBytes:
    """Body = the text's bytes, one per token; the end-of-text id is implied at index 0."""

    eot_id: int | None
    width: int = 2

    def cut(self, body: Column, lo: Column, hi: Column) -> Column:
        lead = 0 if self.eot_id is None else 1
        start = F.greatest(lo - lead, F.lit(0))
        return F.substring(body, (start + 1).cast("int"), (hi - lead - start).cast("int"))

    def payload(self, cut: Column, lo: Column) -> Column:
        # ISO-8859-1 maps each byte to the code point of the same value, and UTF-16BE writes
        # that as two bytes: every byte becomes a big-endian uint16 without leaving the JVM.
        ids = F.encode(F.decode(cut, "ISO-8859-1"), "UTF-16BE")
        if self.eot_id is None:
            return ids
        eot = F.lit(bytearray(self.eot_id.to_bytes(2, "big")))
        return F.when(lo == 0, F.concat(eot, ids)).otherwise(ids)


@dataclass(frozen=True)
class Packed:
    """Body = big-endian unsigned ids of ``width`` bytes, end-of-text id included."""

    width: int

    def cut(self, body: Column, lo: Column, hi: Column) -> Column:
        return F.substring(
            body, (lo * self.width + 1).cast("int"), ((hi - lo) * self.width).cast("int")
        )

    def payload(self, cut: Column, lo: Column) -> Column:
        return cut


def required(text: Column, name: Column) -> Column:
    """``text``, or an error naming the document when there is none."""
    message = F.concat(F.lit("document without text: "), name.cast("string"))
    return F.when(text.isNull(), F.raise_error(message)).otherwise(text)


class ByteVocab:
    """Ids 0..255 are the UTF-8 bytes, 256 is end-of-text: a BPE vocabulary without merges.

    Everything is a built-in expression, so planning needs only the text's length.
    """

    eot_id = 256
    fingerprint = "bytes"
    staged = False

    def codec(self, eot: bool = True) -> RawBytes:
        return RawBytes(self.eot_id if eot else None)

    def tokenized(self, corpus: DataFrame, eot: bool = True) -> DataFrame:
        text = required(F.col("text"), F.col("id"))
        return corpus.select(
            "pos",
            "id",
            (F.octet_length(text) + F.lit(1 if eot else 0)).cast("bigint").alias("n"),
            text.cast("binary").alias("body"),
        )


class RankVocab:
    """A byte-pair vocabulary given by its rank table, a pre-split pattern and an EOT id.

    The table is broadcast and each Python worker builds its encoder once. Special-token
    text inside documents is ordinary text: the encoder knows no special tokens.
    """

    staged = True

    def __init__(
        self, spark: SparkSession, ranks: dict[bytes, int], pattern: str, eot_id: int
    ) -> None:
        digest = hashlib.sha256(f"{pattern}\0{eot_id}".encode())
        for piece, rank in sorted(ranks.items(), key=lambda item: item[1]):
            digest.update(piece + b"\0%d\0" % rank)
        self.eot_id, self.pattern = eot_id, pattern
        self.fingerprint = digest.hexdigest()
        self.width = 2 if max(eot_id, *ranks.values()) < 1 << 16 else 4
        self._ranks = spark.sparkContext.broadcast(ranks)

    @classmethod
    def from_ranks(cls, spark: SparkSession, path: str, pattern: str, eot_id: int) -> RankVocab:
        """Read lines of ``base64(piece) rank``."""
        fields = F.split("value", " ")
        table = (
            spark.read.text(path)
            .filter(F.length(F.trim("value")) > 0)
            .select(F.unbase64(fields[0]).alias("piece"), fields[1].cast("bigint").alias("rank"))
        )
        rows = table.limit(MAX_RANKS + 1).collect()
        if len(rows) > MAX_RANKS:
            raise ValueError(f"more than {MAX_RANKS} ranks in {path}")
        return cls(spark, {bytes(row.piece): row.rank for row in rows}, pattern, eot_id)

    def codec(self, eot: bool = True) -> Packed:
        return Packed(self.width)

    def tokenized(self, corpus: DataFrame, eot: bool = True) -> DataFrame:
        body = self.payload(required(F.col("text"), F.col("id")), eot)
        return corpus.select("pos", "id", body.alias("body")).select(
            "pos",
            "id",
            F.expr(f"cast(octet_length(body) div {self.width} as bigint)").alias("n"),
            "body",
        )

    def payload(self, text: Column, eot: bool = True) -> Column:
        ranks, pattern, fingerprint = self._ranks, self.pattern, self.fingerprint
        dtype = f">u{self.width}"
        lead = np.array([self.eot_id] if eot else [], dtype).tobytes()

        @F.arrow_udf("binary")
        def encode(texts: pa.Array) -> pa.Array:
            encoder = _encoder(fingerprint, pattern, ranks)
            return pa.array(
                [
                    lead + np.asarray(encoder.encode_ordinary(text), dtype).tobytes()
                    for text in texts.to_pylist()
                ],
                pa.binary(),
            )

        return encode(text)


_ENCODERS: dict = {}


def _encoder(fingerprint: str, pattern: str, ranks):
    if fingerprint not in _ENCODERS:
        import tiktoken

        _ENCODERS[fingerprint] = tiktoken.Encoding(
            fingerprint[:12], pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={}
        )
    return _ENCODERS[fingerprint]


def tokenize(corpus: DataFrame, vocab, eot: bool = True) -> DataFrame:
    """``(pos, id, tokens)`` with ``tokens ARRAY<BIGINT>``, led by the EOT id when ``eot``."""
    codec, zero = vocab.codec(eot), F.lit(0).cast("bigint")
    packed = codec.payload(codec.cut(F.col("body"), zero, F.col("n")), zero)
    return vocab.tokenized(corpus, eot).select(
        "pos", "id", unpack(packed, codec.width).alias("tokens")
    )


def piece_dictionary(corpus: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """Distinct pre-split pieces with how often each occurs, partial counts before the shuffle."""
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))
    return corpus.select(F.explode(pieces).alias("piece")).groupBy("piece").count()


def top_pieces(dictionary: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent pieces; equal counts are ordered by the piece itself."""
    return dictionary.orderBy(F.desc("count"), F.asc("piece")).limit(n)
