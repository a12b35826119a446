"""Token ids in Huffman-coded files.

Method: ids are counted over all documents; package-merge turns the counts into code lengths of at most ``most_bits``,
from which a canonical code follows, so a file holds only the lengths. Documents are coded one by one, each from a byte
boundary on, with the bit offset of every ``STEP``-th id as a checkpoint. Files consist of blocks that are read on their
own. A table of 2^most_bits entries gives the id and the length of the next code; all stretches between checkpoints are
decoded in step, one table look-up for each of them at a time.

Files follow the order of ``doc_id``: ranges of ids are dealt to files, a task sorts what it writes. Only coded documents
are shuffled. Files are written under names that no other attempt uses; a table of the files of successful tasks says
which ones count.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import stored
from .warc import open_folder

STEP = 256  # ids between two checkpoints
MAGIC, BLOCK, END = b"FLHUFF1\0", b"FLBK", b"FLEN"  # fixed values: marks of the file format
BLOCK_HEAD = struct.Struct("<4sIQQI")  # mark, documents, checkpoints, payload bytes, crc32 of all that follows the head
BLOCK_BYTES = 1 << 20
FILE_BYTES = 32 << 20
MOST_FILES = 10_000  # id ranges that the driver and every task know; beyond that files grow
TEXT_BYTES = 12 << 20  # texts whose words are looked up together
KNOWN_WORDS = 500_000  # words, and pieces of words, whose ids a Python worker remembers

# The steps of a tokenizer file that read every word by itself.
WORD_STEPS = (
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    [
        {
            "type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed", "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
)
# Words of these characters are the same under every version of Unicode, so they are cut here.
PLAIN_WORD = "^[!-~À-ÖØ-öø-ÿ]+$"
PLAIN_PIECE = "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 ]+"


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches ``values[start : start + length]`` one after the other."""
    ends = np.cumsum(lengths)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


class TextEncoder:
    """Ids of whole texts under a tokenizer file, as ``encode(text, add_special_tokens=False)`` of its library gives them.

    Names of special tokens inside a text are ordinary text. Where the file reads every word by itself, the library is
    asked once for each distinct word, or for each distinct piece of words in ASCII and Latin letters.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        parts = json.loads(definition)
        steps = ((parts["normalizer"] or {}).get("normalizers"), (parts["pre_tokenizer"] or {}).get("pretokenizers"))
        self.by_word = steps == WORD_STEPS and parts["post_processor"] is None and parts["model"]["type"] == "BPE" and not parts["model"].get("dropout")
        if self.by_word:
            level = self.tokenizer.pre_tokenizer[1]
            self.letters = {c: level.pre_tokenize_str(c)[0][0] for c in map(chr, (*range(0x21, 0x7F), *range(0xC0, 0x100)))}
        self._forget()

    def _forget(self) -> None:
        self.pieces: dict[str, list[int]] = {}
        self.words = pa.array([], pa.string())
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain pieces, and how many each has."""
        known, cut, letter = self.pieces, self.tokenizer.model.tokenize, self.letters.__getitem__
        out = list(map(known.get, pieces))
        for i, ids in enumerate(out):
            if ids is None:
                p = pieces[i]
                out[i] = ids = [t.id for t in cut(p if p.isascii() else "".join(map(letter, p)))]
                if len(p) <= 64:
                    known[p] = ids
        return np.fromiter(chain.from_iterable(out), np.uint32), np.fromiter(map(len, out), np.int64, len(out))

    def _new_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and how many each has."""
        plain = pc.match_substring_regex(words, PLAIN_WORD)
        spaced = pc.replace_substring_regex(pc.utf8_lower(words.filter(plain)), f"({PLAIN_PIECE})", r"\1 ")
        cut = pc.ascii_split_whitespace(pc.utf8_rtrim_whitespace(spaced))
        pieces = cut.flatten().dictionary_encode()
        ids, many = self._pieces(_strings(pieces.dictionary))
        at = pieces.indices.to_numpy()
        flat = _gather(ids, (np.cumsum(many) - many)[at], many[at])
        plain_counts = np.diff(np.concatenate([[0], np.cumsum(many[at])])[cut.offsets.to_numpy()])
        rest = [e.ids for e in self.tokenizer.encode_batch(_strings(words.filter(pc.invert(plain))), add_special_tokens=False)]
        if not rest:
            return flat, plain_counts
        mask = plain.to_numpy(zero_copy_only=False)
        counts, starts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        rest_counts = np.array([len(x) for x in rest], np.int64)
        counts[mask], counts[~mask] = plain_counts, rest_counts
        starts[mask], starts[~mask] = np.cumsum(plain_counts) - plain_counts, len(flat) + np.cumsum(rest_counts) - rest_counts
        return _gather(np.concatenate([flat, np.fromiter(chain.from_iterable(rest), np.uint32)]), starts, counts), counts

    def _words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words: an array that holds their ids, and where those of each word start and how many they are."""
        if len(self.words) > KNOWN_WORDS or len(self.pieces) > KNOWN_WORDS:
            self._forget()
        at = pc.index_in(words, value_set=self.words)
        new = pc.is_null(at)
        found = words.filter(new)
        ids, counts = self._new_words(found)
        base = len(self.words)
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        self.words = pa.concat_arrays([self.words, found])
        at, new = pc.fill_null(at, 0).to_numpy().astype(np.int64), new.to_numpy(zero_copy_only=False)
        at[new] = base + np.arange(len(found))
        return self.ids, self.ends[at], np.diff(self.ends)[at]

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the place where each text ends, with 0 in front."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            ids = [e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for x in ids for i in x], np.uint32), np.cumsum([0, *map(len, ids)])
        cut = pc.ascii_split_whitespace(texts)
        words = cut.flatten().dictionary_encode()
        ids, starts, counts = self._words(words.dictionary)
        at = words.indices.to_numpy()
        flat = _gather(ids, starts[at], counts[at])
        return flat, np.concatenate([[0], np.cumsum(counts[at])])[cut.offsets.to_numpy()]


@lru_cache(maxsize=1)
def encoder_of(definition: str) -> TextEncoder:
    """One encoder per Python worker, so that tasks which follow each other share what it remembers."""
    return TextEncoder(definition)


def code_lengths(counts: np.ndarray, most_bits: int) -> np.ndarray:
    """Optimal code lengths of at most ``most_bits`` by package-merge; ids that do not occur have length 0."""
    seen = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(seen) < 2:
        lengths[seen] = 1
        return lengths
    if len(seen) > 1 << most_bits:
        raise ValueError(f"{len(seen)} ids do not fit codes of {most_bits} bits")
    order = seen[np.argsort(counts[seen], kind="stable")]
    leaves = counts[order].astype(np.int64)
    row, single = leaves, [np.ones(len(leaves), bool)]
    for _ in range(most_bits - 1):
        packed = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, packed])
        by = np.argsort(both, kind="stable")
        row = both[by]
        single.append(by < len(leaves))
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(single):  # the leaves among the cheapest are always the rarest ids
        n = int(is_leaf[:take].sum())
        lengths[order[:n]] += 1
        take = 2 * (take - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, id); 0 for ids without a code."""
    codes, code, before = np.zeros(len(lengths), np.uint64), 0, 0
    for n in range(1, int(lengths.max(initial=0)) + 1):
        code <<= n - before
        ids = np.flatnonzero(lengths == n)
        codes[ids] = np.arange(code, code + len(ids), dtype=np.uint64)
        code, before = code + len(ids), n
    return codes


def code_documents(ids: np.ndarray, ends: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Coded documents one after the other, where each ends in bytes, all checkpoints, and where each one's end.

    ``ends`` as from ``TextEncoder.encode``. A checkpoint is a bit offset from the start of its document.
    """
    size = lengths[ids].astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    at = np.concatenate([[0], np.cumsum(-(-np.diff(total[ends]) // 8))])
    n_ids = np.diff(ends)
    marked = -(-n_ids // STEP)
    marks = total[_every(ends[:-1], marked)] - np.repeat(total[ends[:-1]], marked)
    words = np.zeros(int(at[-1]) // 4 + 2, np.uint64)
    if len(ids):
        place = total[:-1] + np.repeat(8 * at[:-1] - total[ends[:-1]], n_ids)
        word = place >> 5
        pair = codes[ids] << (64 - (place & 31) - size).astype(np.uint64)  # over this word of 32 bits and the next one
        first = np.flatnonzero(np.diff(word, prepend=-1))
        pair = np.bitwise_or.reduceat(pair, first)
        words[word[first]] |= pair >> np.uint64(32)
        words[word[first] + 1] |= pair & np.uint64(0xFFFFFFFF)
    return words.astype(">u4").view(np.uint8)[: int(at[-1])], at, marks.astype("<u8"), np.concatenate([[0], np.cumsum(marked)])


def _every(starts: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Places of every ``STEP``-th id of each document."""
    ends = np.cumsum(marked)
    return np.repeat(starts, marked) + STEP * (np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - marked, marked))


class Decoder:
    """Table-driven decoder of a canonical code given by its lengths."""

    def __init__(self, lengths: np.ndarray):
        self.bits = max(int(lengths.max(initial=0)), 1)
        if self.bits > 25:
            raise ValueError("codes of more than 25 bits")
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        span = np.int64(1) << (self.bits - lengths[order].astype(np.int64))
        self.table = np.repeat(order.astype(np.int64) << 5 | lengths[order], span)
        self.table = np.concatenate([self.table, np.full((1 << self.bits) - len(self.table), -1)])

    def run(self, payload: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of the stretches that begin at the bit offsets ``starts`` and hold ``counts`` ids each."""
        b = np.concatenate([payload, np.zeros(4, np.uint8)]).astype(np.uint32)
        window = b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]
        order = np.argsort(-counts, kind="stable")
        at, left = starts[order].astype(np.int64), counts[order]
        out = np.zeros((len(counts), int(left[0]) if len(left) else 0), np.uint32)
        shift = np.uint32(32 - self.bits)
        active = np.searchsorted(-left, -np.arange(out.shape[1]), side="left")  # stretches with more than j ids
        for j, n in enumerate(active):
            at = at[:n]
            entry = self.table[(window[at >> 3] << (at & 7).astype(np.uint32)) >> shift]
            out[:n, j] = entry >> 5
            if entry.min() < 0:
                raise ValueError("a code that no id has")
            at = at + (entry & 31)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return out[back][np.arange(out.shape[1]) < counts[:, None]]


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column without NULLs, and where each value ends, with 0 in front."""
    wide = pa.types.is_large_binary(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return data, ends - ends[0]


def encode_texts(docs: DataFrame, definition: str, end_id: int | None) -> DataFrame:
    """doc_id, text_key (hash of the text), ids (little-endian, ``width`` bytes each) of every row of doc_id and text.

    NULL texts count as empty; every document ends with ``end_id`` unless that is None. Stored.
    """
    kind = id_type(definition, end_id)
    book = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(book.value)

        def coded(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts).combine_chunks()
            ids, ends = encoder.encode(t["text"].combine_chunks().cast(pa.string()))
            if end_id is not None:
                ids = np.insert(ids, ends[1:], end_id)
                ends = ends + np.arange(len(ends))
            key = t["text_key"].combine_chunks()
            return pa.RecordBatch.from_arrays([t["doc_id"].combine_chunks(), key, _binary(ids.astype(kind).view(np.uint8), ends * kind.itemsize)], names=["doc_id", "text_key", "ids"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > TEXT_BYTES:
                yield coded(held)
                held, size = [], 0
        if held:
            yield coded(held)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("text_key", F.xxhash64("text"))
    return stored(rows.mapInArrow(run, "doc_id long, text_key long, ids binary"), "token_ids", compression="zstd")


def id_type(definition: str, end_id: int | None) -> np.dtype:
    """Two bytes per id where all ids fit, else four."""
    parts = json.loads(definition)
    most = max([*parts["model"]["vocab"].values(), *(t["id"] for t in parts["added_tokens"]), end_id or 0])
    return np.dtype("<u2" if most < 1 << 16 else "<u4")


def count_ids(rows: DataFrame, kind: np.dtype) -> np.ndarray:
    """How often each id occurs in the column ``ids``; what reaches the driver is bounded by the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            n = np.bincount(_plain(batch.column(0))[0].view(kind))
            if len(n) > len(total):
                n, total = total, n.astype(np.int64)
            total[: len(n)] += n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    found = rows.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = found["id"].to_numpy(), found["n"].to_numpy()
    counts = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    counts[ids] = n
    return counts


def _ranges(rows: DataFrame, files: int) -> tuple[int, np.ndarray]:
    """Number of files for rows without id, and the doc_ids at which the other files begin."""
    n, none = rows.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    for_none = -(-files * none // max(n, 1))
    shares = [i / files for i in range(1, files)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 100 * files)).first()[0] if shares and n > none else None
    return for_none, np.array(cuts or [], np.int64)


def write_token_files(docs: DataFrame, folder: str, definition: str, end_id: int | None, most_bits: int = 20, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of all documents into files below ``folder``, in ascending order of doc_id, NULL first.

    Returns part, seq, path, documents, tokens of every file; (part, seq) is the order of the files. Rows of one doc_id lie
    side by side; where such rows fill several files, their order is the same in every run but not that of their texts.
    An empty table makes no files. Columns other than doc_id and text are left out.
    """
    kind = id_type(definition, end_id)
    rows = encode_texts(docs, definition, end_id)
    counts = count_ids(rows, kind)
    lengths = code_lengths(counts, max(most_bits, int(np.count_nonzero(counts)).bit_length()))
    coded_bytes = int((lengths[: len(counts)].astype(np.int64) * counts).sum()) // 8
    for_none, cuts = _ranges(rows, min(MOST_FILES, coded_bytes // file_bytes + 1))
    n_files = for_none + len(cuts) + 1
    book = docs.sparkSession.sparkContext.broadcast((lengths, canonical_codes(lengths), cuts))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, codes, starts = book.value
        turn = 0
        for batch in batches:
            data, ends = _plain(batch.column("ids"))
            bits, at, marks, marked = code_documents(data.view(kind), ends // kind.itemsize, sizes, codes)
            own = batch.column("doc_id")
            doc_id, none = pc.fill_null(own, 0).to_numpy(), pc.is_null(own).to_numpy(zero_copy_only=False)
            low, high = (np.searchsorted(starts, doc_id, side) for side in ("left", "right"))
            turns = np.arange(turn, turn + len(own))
            turn += len(own)
            # an id that several files begin with has its rows dealt to all of them
            part = for_none + np.where(high - low > 1, low + turns % np.maximum(high - low, 1), low)
            part = np.where(none, turns % max(for_none, 1), part)
            n = np.diff(ends) // kind.itemsize
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), own, batch.column("text_key"), pa.array(n), _binary(marks.view(np.uint8), marked * 8), _binary(bits, at)],
                names=["part", "doc_id", "text_key", "n", "marks", "bits"],
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = open_folder(folder)
        files.create_dir(top, recursive=True)
        head = zlib.compress(book.value[0].tobytes())
        writer, done = None, []
        for batch in batches:
            part = batch.column("part").to_numpy()
            for lo, hi in _runs(part):
                here = batch.slice(lo, hi - lo)
                if writer is not None and (writer.part != part[lo] or writer.bytes > 2 * file_bytes):
                    done.append(writer.close())
                    writer = None
                if writer is None:
                    seq = 1 + max((d[1] for d in done if d[0] == part[lo]), default=-1)
                    writer = _Writer(files, top, folder, int(part[lo]), seq, head)
                writer.add(here)
        if writer is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            names=["part", "seq", "path", "documents", "tokens"],
        )

    coded = rows.mapInArrow(code, "part int, doc_id long, text_key long, n long, marks binary, bits binary")
    placed = coded.repartition(n_files, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "text_key")
    return stored(placed.mapInArrow(write, "part int, seq int, path string, documents long, tokens long"), "token_files")


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


class _Writer:
    """One file; documents are gathered into blocks of about ``BLOCK_BYTES``."""

    def __init__(self, files, top: str, folder: str, part: int, seq: int, lengths: bytes):
        name = f"{part:06d}-{seq:04d}-{uuid.uuid4().hex}.ids"
        self.part, self.seq, self.path = part, seq, f"{folder}/{name}"
        self.out = files.open_output_stream(f"{top}/{name}", compression=None)
        self.out.write(MAGIC + struct.pack("<I", len(lengths)) + lengths)
        self.documents = self.tokens = self.bytes = self.held = 0
        self.blocks: list[pa.RecordBatch] = []

    def add(self, rows: pa.RecordBatch) -> None:
        weight = np.cumsum(np.diff(_plain(rows.column("bits"))[1])) + self.held
        for lo, hi in _runs(weight // BLOCK_BYTES):
            self.blocks.append(rows.slice(lo, hi - lo))
            self.held = int(weight[hi - 1])
            if self.held >= BLOCK_BYTES:
                self._flush()

    def _flush(self) -> None:
        if not self.blocks:
            return
        t = pa.Table.from_batches(self.blocks).combine_chunks()
        own, n = t["doc_id"].combine_chunks(), t["n"].to_numpy()
        bits, at = _plain(t["bits"].combine_chunks())
        marks, marked = _plain(t["marks"].combine_chunks())
        marks = marks.view("<u8") + np.repeat(8 * at[:-1], np.diff(marked) // 8).astype(np.uint64)
        has = (~pc.is_null(own).to_numpy(zero_copy_only=False)).astype(np.uint8)
        body = b"".join((pc.fill_null(own, 0).to_numpy().astype("<i8").tobytes(), has.tobytes(), n.astype("<u8").tobytes(), marks.astype("<u8").tobytes(), bits.tobytes()))
        self.out.write(BLOCK_HEAD.pack(BLOCK, len(n), len(marks), len(bits), zlib.crc32(body)) + body)
        self.documents, self.tokens, self.bytes = self.documents + len(n), self.tokens + int(n.sum()), self.bytes + len(body)
        self.blocks, self.held = [], 0

    def close(self) -> tuple:
        self._flush()
        self.out.write(END + struct.pack("<QQ", self.documents, self.tokens))
        self.out.close()
        return self.part, self.seq, self.path, self.documents, self.tokens


def read_blocks(stream) -> Iterator[tuple[list[int | None], np.ndarray, Iterator[tuple[int, np.ndarray]]]]:
    """Blocks of one file: doc_ids, number of ids of each document, and pieces (document, ids) in order.

    A piece holds at most 2^20 ids, so a very long document comes in several. Damage and missing ends are errors.
    """
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    decoder = Decoder(np.frombuffer(zlib.decompress(stream.read(struct.unpack("<I", stream.read(4))[0])), np.uint8))
    documents = tokens = 0
    while (mark := stream.read(4)) == BLOCK:
        _, docs, n_marks, size, crc = BLOCK_HEAD.unpack(mark + stream.read(BLOCK_HEAD.size - 4))
        body = stream.read(17 * docs + 8 * n_marks + size)
        if len(body) != 17 * docs + 8 * n_marks + size or zlib.crc32(body) != crc:
            raise ValueError("damaged block")
        doc_id, has = np.frombuffer(body, "<i8", docs), np.frombuffer(body, np.uint8, docs, 8 * docs)
        n = np.frombuffer(body, "<u8", docs, 9 * docs).astype(np.int64)
        marks = np.frombuffer(body, "<u8", n_marks, 17 * docs).astype(np.int64)
        payload = np.frombuffer(body, np.uint8, size, 17 * docs + 8 * n_marks)
        documents, tokens = documents + docs, tokens + int(n.sum())
        yield [int(i) if h else None for i, h in zip(doc_id, has)], n, _decoded(decoder, n, marks, payload)
    if mark != END or struct.unpack("<QQ", stream.read(16)) != (documents, tokens):
        raise ValueError("the file ends within a block")


def _decoded(decoder: Decoder, n: np.ndarray, marks: np.ndarray, payload: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    stretches = -(-n // STEP)
    of = np.repeat(np.arange(len(n)), stretches)
    counts = np.full(len(of), STEP)
    last = np.cumsum(stretches)[stretches > 0] - 1
    counts[last] = n[stretches > 0] - STEP * (stretches[stretches > 0] - 1)
    for lo in range(0, len(of), 4096):
        hi = min(lo + 4096, len(of))
        first, end = int(marks[lo]) >> 3, int(marks[hi]) // 8 + 8 if hi < len(of) else len(payload)
        ids = decoder.run(payload[first:end], marks[lo:hi] - 8 * first, counts[lo:hi])
        ends = np.concatenate([[0], np.cumsum(counts[lo:hi])])
        for a, b in _runs(of[lo:hi]):
            yield int(of[lo + a]), ids[ends[a] : ends[b]]


def read_token_files(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document of ``files``.

    ``files`` is the table that ``write_token_files`` returns. ``ids_crc32`` is that of all ids as little-endian unsigned
    32-bit integers. ``with_ids`` adds those bytes as column ``ids``.
    """
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = stored(files.select("path", before.cast("long").alias("base")), "file_starts")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns)):
                folder, _, name = path.rpartition("/")
                opened, top = open_folder(folder)
                with opened.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    for doc_ids, n, pieces in read_blocks(stream):
                        crc, held = [0] * len(n), [[] for _ in n] if with_ids else None
                        for d, ids in pieces:
                            data = ids.astype("<u4").tobytes()
                            crc[d] = zlib.crc32(data, crc[d])
                            if with_ids:
                                held[d].append(data)
                        starts = base + np.cumsum(n) - n
                        base += int(n.sum())
                        made = [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(n), pa.array(crc, pa.int64())]
                        made += [pa.array([b"".join(x) for x in held], pa.binary())] if with_ids else []
                        yield pa.RecordBatch.from_arrays(made, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return placed.repartition(max(1, placed.count())).mapInArrow(read, schema)


def token_file_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int | None = 2, folder: str | None = None, with_ids: bool = False) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) and read them back: one row per input row.

    NULL and empty texts have the end id alone; NULL ids come first; repeated rows are documents of their own; an empty table
    gives no rows; extra columns are left out.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    return read_token_files(write_token_files(docs, folder or scratch_dir(docs.sparkSession, "ids"), definition, end_id), with_ids)
