"""Packing: concatenate and cut, with global offsets from prefix sums over partition totals."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomcast.llm.common import in_parts, kept, whole
from loomcast.session import settled

TOKENIZER = "word_bpe_49k.json"
# Marks that end a word are a piece of their own after a letter or digit, as the tokenizer splits
# them too. Only letters that no normal form takes apart are listed; other words simply stay whole.
_ENDING = re.compile(r"(?<=[a-zA-Z0-9\u00df-\u00f6\u00f8-\u00ff])([.,;:!?$#%*&)]+)(?=[ \n]|\Z)")
# Words whose normal form is their lower case, letter by letter.
_PLAIN = re.compile("[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")

# The steps of a tokenizer that treats words one by one, as the library names them.
WORD_STEPS = (
    'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\\s+"), content=" "), Lowercase()])',
    'Sequence(pretokenizers=[Split(pattern=Regex("\'s|\'t|\'re|\'ve|\'m|\'ll|\'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"), '
    "behavior=Removed, invert=True), ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])",
    "BPE",
)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for a byte: itself if it can be printed, else the next one from 256 on."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printed]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()


@dataclass(frozen=True)
class Packing:
    """``tokenizer`` is a file of the tokenizers library, or a name that public_tokenizers knows."""

    tokenizer: str = TOKENIZER
    window: int = 2048
    end_id: int = 1
    cached_words: int = 1_000_000


def tokenizer_path(name: str) -> str:
    """The path itself, or where this machine keeps the public file of that name."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts through a bounded cache of words.

    A tokenizer with ``WORD_STEPS`` drops white space and never merges across it, so the ids of a
    text are those of its words one after another; only words that are not in the cache reach it.
    The cache has two halves: when the newer is full it becomes the older one, and words that are
    met again move to the newer. Any other tokenizer encodes whole texts.
    """

    def __init__(self, packing: Packing):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(packing.tokenizer))
        steps = (repr(self.tokenizer.normalizer), repr(self.tokenizer.pre_tokenizer), type(self.tokenizer.model).__name__)
        marked = all("<|" in t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.by_words = steps == WORD_STEPS and marked
        self.half = max(1, packing.cached_words // 2)
        top = max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, packing.end_id)
        self.width = 2 if top < 1 << 16 else 4  # bytes of a stored id
        self.code = "H" if self.width == 2 else "I"
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def pieces(text: str) -> list[str]:
        """Parts of a text that the tokenizer treats alone, in few spellings: ASCII letters are
        lower-cased as the tokenizer does, except near its special strings."""
        if "<|" not in text:
            text = text.encode().lower().decode()
        return _ENDING.sub(r" \1", text).replace("\n", " ").split(" ")

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        """Ids of each text, then ``end_id``, as little-endian unsigned numbers of ``width`` bytes."""
        end, out = self._bytes([end_id]), []
        if not self.by_words:
            return [self._bytes(x.ids) + end for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        for text in texts:
            pieces = self.pieces(text)
            ids = list(map(self.known.get, pieces))
            if None in ids:
                own = self.learn({p for p, known in zip(pieces, ids, strict=True) if known is None})
                ids = [own[p] if known is None else known for p, known in zip(pieces, ids, strict=True)]
            ids.append(end)
            out.append(b"".join(ids))
        return out

    def _bytes(self, ids: Iterable[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def learn(self, new: set[str]) -> dict[str, bytes]:
        """Ids of pieces that are not in the newer half; they are added to it. A word of plain
        letters passes to the model directly, its bytes written as the tokenizer writes them."""
        own = {p: self.older[p] for p in new if p in self.older}
        tokenize, rest = self.tokenizer.model.tokenize, []
        for p in new:
            if p in own:
                continue
            if _PLAIN.fullmatch(p):
                letters = p if p.isascii() else p.lower().encode().decode("latin-1").translate(BYTE_LETTERS)
                own[p] = self._bytes([t.id for t in tokenize(letters.lower() if p.isascii() else letters)])
            else:
                rest.append(p)
        for piece, got in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            own[piece] = self._bytes(got.ids)
        if len(self.known) + len(own) > self.half:
            self.older, self.known = self.known, {}
        self.known.update(own)
        return own


def encoder_of(packing: Packing) -> WordEncoder:
    """The encoder of this process: tasks that run in it one after the other share its cache."""
    return kept(packing, lambda: WordEncoder(packing))


def _tokenised(packing: Packing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = encoder_of(packing), 0
        for rows in in_parts(batches, 64):
            ids = encoder.encode(rows.column("text").to_pylist(), packing.end_id)
            lengths = np.array([len(x) // encoder.width for x in ids], dtype=np.int64)
            before = total + np.cumsum(lengths) - lengths
            total += int(lengths.sum())
            yield pa.RecordBatch.from_arrays(
                [rows.column("part"), rows.column("doc_id"), pa.array(ids, pa.binary()), pa.array(lengths), pa.array(before)],
                names=["part", "doc_id", "ids", "doc_tokens", "before"],
            )

    return run


def _pieces(packing: Packing):
    window = packing.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, start, length, crc = [], [], [], []
            begins = batch.column("begin").to_numpy()
            totals = batch.column("doc_tokens").to_numpy()
            for row, (begin, total, ids) in enumerate(zip(begins, totals, batch.column("ids"), strict=True)):
                stored = ids.as_buffer()  # a document has at least its end id
                wide = memoryview(np.frombuffer(stored, dtype=f"<u{stored.size // int(total)}").astype("<u4")).cast("B")
                at = 0
                while at < total:
                    n = min(int(total) - at, window - (int(begin) + at) % window)
                    rows.append(row)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(wide[4 * at : 4 * (at + n)]))
                    at += n
            place = begins[rows] + np.array(start, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(totals[rows], pa.int64()),
                    pa.array(place // window, pa.int64()),
                    pa.array(place % window, pa.int64()),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def token_table(docs: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """Ids of every document with the number of ids before it in its partition, as a stored table.

    ``ids`` holds little-endian unsigned numbers: of 16 bits where the vocabulary has at most
    65,536 ids, as that of the default tokenizer, else of 32 bits.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = docs.select(F.spark_partition_id().alias("part"), "doc_id", whole().alias("text"))
    tokens = parts.mapInArrow(
        _tokenised(packing), f"part int, doc_id {kind}, ids binary, doc_tokens bigint, before bigint"
    )
    return settled(tokens, "packing-tokens")


def pack(docs: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """Pieces of documents in sequences of ``window`` ids.

    The first pass stores ids and counts them per partition; prefix sums over the partition
    totals (one small row each) give every partition its global offset, and a second, narrow
    pass cuts documents where a window ends. Returns doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id and offset; only the last sequence may be short. A null or empty
    text is its end id alone; repeated rows and null ids are packed like others; an empty table
    gives no rows; columns besides doc_id and text are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    tokens = token_table(docs, packing)
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = settled(totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), "packing-bases")
    placed = tokens.join(bases, "part").select("doc_id", "ids", "doc_tokens", (F.col("base") + F.col("before")).alias("begin"))
    return placed.mapInArrow(
        _pieces(packing),
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
