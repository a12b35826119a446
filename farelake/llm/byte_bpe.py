"""Byte-level BPE by a sentencepiece model that is serialised from a rank file.

Method: every vocabulary entry becomes a piece of one character per byte (the usual printable byte alphabet), scored
by its negative rank; normalisation is the identity. A text is split by the pre-token pattern, each pre-token is
encoded by itself, ids are decoded by the inverse byte mapping. Results equal those of a rank-file encoder, but for
characters that one library's Unicode tables know as letters or numbers and the other's do not yet.

Nothing is trained: the model holds the given vocabulary. It is serialised on the driver (about 1 MB, bounded by the
vocabulary) and shipped with the task, so executors need no vocabulary file.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

CACHE_ENTRIES = 200_000  # pre-tokens a task remembers before it starts anew
CACHE_LENGTH = 64  # longer pre-tokens are remembered for one text only


def byte_alphabet() -> list[str]:
    """One printable character per byte: a byte that prints stands for itself, the others follow from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = itertools.count(0x100)
    return [chr(b if b in prints else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary of a rank file: base64 of the bytes, a space, the rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protocol buffer field: varint, 32-bit float or length-delimited."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(value)


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """Serialised sentencepiece model of a rank vocabulary; the piece id is the rank.

    Ranks must be 0..n-1. The unknown piece, which every model needs, follows them and is never used, because each
    single byte is a piece.
    """
    if sorted(ranks.values()) != list(range(len(ranks))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must be 0..n-1 and hold every single byte")
    alphabet = byte_alphabet()
    model = bytearray()
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        piece = "".join(alphabet[b] for b in token).encode()
        model += _field(1, _field(1, piece) + _field(2, -float(rank)) + _field(3, 1))
    model += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    off = (1 << 64) - 1  # -1: the model has no such piece
    trainer = _field(3, 2) + _field(4, len(ranks) + 1) + _field(40, len(ranks))
    trainer += b"".join(_field(n, off) for n in (41, 42, 43))
    model += _field(2, trainer)
    model += _field(3, _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5)))
    return bytes(model)


class PieceCoder:
    """Encoder and decoder over a serialised model; built once per task."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.alphabet = {b: c for b, c in enumerate(byte_alphabet())}
        back = {c: b for b, c in self.alphabet.items()}
        self.bytes_of = [bytes(back[c] for c in self.pieces.id_to_piece(i)) for i in range(self.pieces.unk_id())]
        self.known: dict[str, tuple[list[int], str, bytes]] = {}

    def coded(self, text: str) -> list[tuple[list[int], str, bytes]]:
        """Per pre-token of ``text``: ids, their decimals, the bytes they decode to. Seen pre-tokens are remembered."""
        tokens = self.split(text)
        distinct = set(tokens)
        new = [t for t in distinct if t not in self.known]
        # latin-1 gives one character per byte, the table then its printable one
        ids = self.pieces.encode([t.encode().decode("latin-1").translate(self.alphabet) for t in new], num_threads=1)
        book = self.known
        if any(len(t) > CACHE_LENGTH for t in new):
            book = {t: book[t] for t in distinct if t in book}
        elif len(book) + len(new) > CACHE_ENTRIES:
            book = self.known = {t: book[t] for t in distinct if t in book}
        book.update((t, (i, " ".join(map(str, i)), self.decode(i))) for t, i in zip(new, ids))
        return [book[t] for t in tokens]

    def encode(self, text: str) -> list[int]:
        return list(itertools.chain.from_iterable(ids for ids, _, _ in self.coded(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def encode_bpe(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """The input's rows with the ids of ``text`` in ``out`` (array of int); a clashing column is replaced.

    NULL and empty texts give an empty array. Repeated rows stay repeated, an empty table stays empty. No shuffle.
    """
    rest = [c for c in docs.columns if c != out]
    model = serialise_model(read_ranks(ranks_path))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*map(_quoted, rest)).schema)
    coder: list[PieceCoder] = []

    def work(rows):
        coder[:] = coder or [PieceCoder(model, pattern)]
        return rows | {out: [coder[0].encode(t or "") for t in rows[text]]}

    return map_batches(docs.select(*map(_quoted, rest)), f"{schema}, `{out}` array<int>", work)


def _quoted(name: str):
    return F.col(f"`{name}`")


def decode_bpe(tokens: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The input's rows with the bytes that ``ids`` stand for in ``out``; NULL ids give NULL."""
    rest = [c for c in tokens.columns if c != out]
    model = serialise_model(read_ranks(ranks_path))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(*map(_quoted, rest)).schema)
    coder: list[PieceCoder] = []

    def work(rows):
        coder[:] = coder or [PieceCoder(model, pattern)]
        return rows | {out: [None if i is None else coder[0].decode(i) for i in rows[ids]]}

    return map_batches(tokens.select(*map(_quoted, rest)), f"{schema}, `{out}` binary", work)


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens, digest of the ids, digest of the decoded bytes (and the ids).

    NULL texts count as empty. Ids are digested as decimals joined by one space.
    """
    model = serialise_model(read_ranks(ranks_path))
    coder: list[PieceCoder] = []

    def work(rows):
        coder[:] = coder or [PieceCoder(model, pattern)]
        made = {"doc_id": rows["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        for text in rows["text"]:
            ids, decimals, decoded = zip(*coder[0].coded(text)) if text else ((), (), ())
            made["n_tokens"].append(sum(map(len, ids)))
            made["ids_sha256"].append(hashlib.sha256(" ".join(decimals).encode()).hexdigest())
            made["decoded_sha256"].append(hashlib.sha256(b"".join(decoded)).hexdigest())
            if with_ids:
                made["ids"].append(list(itertools.chain.from_iterable(ids)))
        return made

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return map_batches(kept, schema, work)
