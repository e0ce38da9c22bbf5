"""Byte-level BPE encoding and decoding (operator 2).

A rank file (base64 token, rank per line) is serialised directly as a sentencepiece BPE model: every token becomes
a piece whose bytes are written as printable characters (one character per byte), its score is the negative rank,
and normalisation is the identity (no dummy prefix, no white-space changes). sentencepiece then merges the pair of
highest score first, leftmost on ties, which is the merge order of the ranks. Texts are cut into pre-tokens by the
vocabulary's pattern and every pre-token is encoded on its own; decoding maps ids back to pieces and characters to
bytes. Piece 0 is sentencepiece's mandatory unknown piece, so rank r is piece r + 1; a byte-complete vocabulary
never uses it.

Defined results: null and empty texts have no tokens (the hash of an empty string, the hash of no bytes). The
vocabulary file is read by the driver and sent to the tasks (its size is fixed: under 1 MB). A text of any length is
encoded whole; repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import map_rows

#: Pre-tokens remembered per task (those of up to CACHED_LENGTH characters); the memory is emptied when full.
CACHE, CACHED_LENGTH = 50_000, 32


def byte_characters() -> list[str]:
    """One printable character for each byte: itself where it is printable Latin-1, else one from U+0100 on."""
    plain = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


# -- protobuf wire format of the few model fields that are needed -------------------------------------------------
def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _piece(text: str, score: float, kind: int) -> bytes:
    import struct

    return _message(1, _message(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised ModelProto: pieces in rank order, BPE trainer type, identity normaliser."""
    chars = byte_characters()
    by_rank = sorted(ranks.items(), key=lambda x: x[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
    unknown, normal = 2, 1
    pieces = _piece("<unk>", 0.0, unknown) + b"".join(
        _piece("".join(chars[b] for b in token), -float(rank), normal) for token, rank in by_rank)
    trainer = _number(3, 2) + _number(4, len(by_rank) + 1) + _number(40, 0)  # model_type BPE, vocab_size, unk_id
    normalizer = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return pieces + _message(2, trainer) + _message(3, normalizer)


class Codec:
    """Encodes and decodes texts with the serialised model; ids are ranks."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        chars = byte_characters()
        self.to_chars = {b: c for b, c in enumerate(chars)}
        to_byte = {c: b for b, c in enumerate(chars)}
        self.bytes_of = [bytes(to_byte[c] for c in self.sp.id_to_piece(i)) for i in range(1, self.sp.get_piece_size())]
        self.known: dict[str, list[int]] = {}

    def _encode(self, token: str) -> list[int]:
        return [i - 1 for i in self.sp.encode(token.encode().decode("latin-1").translate(self.to_chars))]

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        known = self.known
        for token in self.split(text or ""):
            ids = known.get(token)
            if ids is None:
                ids = self._encode(token)
                if len(token) <= CACHED_LENGTH:
                    if len(known) >= CACHE:
                        known.clear()
                    known[token] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def codec_factory(ranks_path: str, pattern: str):
    """A per-task factory of ``Codec``; only the vocabulary bytes travel with the task."""
    model = sentencepiece_model(read_ranks(ranks_path))
    return lambda: Codec(model, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, token_ids array<int>, decoded binary (the bytes of the decoded ids); one row per row of ``docs``."""
    make = codec_factory(ranks_path, pattern)

    def per_task():
        codec = make()

        def per_batch(cols):
            ids = [codec.encode(t) for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "token_ids": ids, "decoded": [codec.decode(i) for i in ids]}
        return per_batch

    per_task.per_task = True
    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), per_task,
                    "doc_id long, token_ids array<int>, decoded binary")


def digest(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests of ``encode``, made beside it in the same task."""
    make = codec_factory(ranks_path, pattern)

    def per_task():
        codec = make()

        def per_batch(cols):
            n, a, b = [], [], []
            for t in cols["text"]:
                ids = codec.encode(t)
                n.append(len(ids))
                a.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                b.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            return {"doc_id": cols["doc_id"], "n_tokens": n, "ids_sha256": a, "decoded_sha256": b}
        return per_batch

    per_task.per_task = True
    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), per_task,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op2(docs: DataFrame) -> DataFrame:
    return digest(docs, *default_vocabulary())
