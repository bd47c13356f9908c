"""Byte-level BPE over Arrow batches: encoding with character offsets, decoding with split characters."""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct matches whose ids a worker remembers beyond a batch.
REMEMBERED = 120_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = itertools.count(256)
    return [chr(b if b in own else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair each longer token was merged from: what lower ranks leave of it."""
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda k: (r if (r := ranks.get(parts[k] + parts[k + 1], rank)) < rank else rank, k))
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            merges.append((parts[0], parts[1]))
    return merges


class _Remembered(dict):
    """Ids by match; those beyond REMEMBERED are kept for the batch only."""

    def __init__(self):
        self.batch: dict[str, bytes] = {}

    def __missing__(self, match: str) -> bytes:
        return self.batch[match]


class Encoder:
    """Ids and character spans of the tokens of each match, by the tokenizers library."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        named = byte_characters()
        name = lambda token: "".join(named[b] for b in token)
        self._find = regex.compile(pattern).findall
        self._model = Tokenizer(BPE({name(t): r for t, r in ranks.items()}, [(name(a), name(b)) for a, b in merges_of(ranks)], cache_capacity=0))
        self._model.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self._known = _Remembered()

    def forget(self) -> None:
        """Start anew where no more can be remembered, as other texts may follow."""
        if len(self._known) >= REMEMBERED:
            self._known.clear()

    def _learn(self, matches: list[str]) -> None:
        room = REMEMBERED - len(self._known)
        for k, (match, found) in enumerate(zip(matches, self._model.encode_batch_fast(matches, add_special_tokens=False), strict=True)):
            (self._known if k < room else self._known.batch)[match] = np.array(found.ids, dtype="<u4").tobytes()

    def __call__(self, texts: list[str], with_offsets: bool) -> Iterator[tuple[bytes, bytes | None]]:
        split = [self._find(text) for text in texts]
        self._known.batch = {}
        self._learn([m for m in set().union(*split) if m not in self._known])
        for matches in split:
            yield b"".join(map(self._known.__getitem__, matches)), self._spans(matches) if with_offsets else None

    def _spans(self, matches: list[str]) -> bytes:
        spans, start = [], 0
        for match, found in zip(matches, self._model.encode_batch(matches, add_special_tokens=False), strict=True):
            spans.append((np.array(found.offsets, dtype="<u4").reshape(-1, 2) + np.uint32(start)).astype("<u4").tobytes())
            start += len(match)
        return b"".join(spans)


_encoders: dict[tuple, Encoder] = {}


def _encoder(key: tuple, ranks: dict[bytes, int], pattern: str) -> Encoder:
    """The encoder of this worker, which is used by one task after another."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks, pattern)
    _encoders[key].forget()
    return _encoders[key]


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", with_offsets: bool = True) -> DataFrame:
    """Add ``token_ids`` and ``token_spans`` to each row.

    Both are packed little-endian unsigned 32-bit integers: the ids, and for each token the first and last
    character (end exclusive) of ``text`` that it has bytes of, so tokens inside one character share its span. A null
    or empty text has no tokens. Columns of these names are replaced; all others are kept, duplicates and ties too.
    """
    known = read_ranks(ranks_path)
    ranks, key = df.sparkSession.sparkContext.broadcast(known), (ranks_path, len(known), pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, ranks.value, pattern)
        for big in batches:
            for batch in (big.slice(k, 128) for k in range(0, big.num_rows, 128)):
                found = list(encoder([t or "" for t in batch.column("_bpe_text").to_pylist()], with_offsets))
                columns = [batch.column(k) for k in range(batch.num_columns) if batch.schema.names[k] != "_bpe_text"]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([x[0] for x in found], pa.binary()), pa.array([x[1] for x in found], pa.binary())], names)

    base = df.drop("token_ids", "token_spans")
    given = base.withColumn("_bpe_text", F.col(text))
    names = [*base.columns, "token_ids", "token_spans"]
    schema = base.select("*", F.lit(b"").alias("token_ids"), F.lit(None).cast("binary").alias("token_spans")).schema
    return given.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str) -> DataFrame:
    """Add ``decoded`` (bytes) and ``decoded_text`` to rows with packed ``token_ids``.

    Bytes of all tokens are put together before they become characters, so a character split over tokens
    comes back whole; bytes that form none become U+FFFD in the text only. Null ids give empty results.
    """
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        characters = byte_characters()
        named = {c: b for b, c in enumerate(characters)}
        spelled = {r: "".join(characters[b] for b in t) for t, r in ranks.value.items()}
        back = {r: bytes(named[c] for c in token) for r, token in spelled.items()}
        for big in batches:
            for batch in (big.slice(k, 128) for k in range(0, big.num_rows, 128)):
                packed = batch.column(batch.schema.get_field_index("token_ids")).to_pylist()
                whole = [b"".join(map(back.__getitem__, np.frombuffer(p or b"", "<u4").tolist())) for p in packed]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(whole, pa.binary()), pa.array([w.decode("utf-8", "replace") for w in whole], pa.string())], names)

    base = df.drop("decoded", "decoded_text")
    names = [*base.columns, "decoded", "decoded_text"]
    return base.mapInArrow(run, base.select("*", F.lit(b"").alias("decoded"), F.lit("").alias("decoded_text")).schema)


def digests(df: DataFrame) -> DataFrame:
    """Per row: number of tokens, SHA-256 of the packed ids and of the decoded bytes."""
    return df.select(
        "doc_id", (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("token_ids"), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
