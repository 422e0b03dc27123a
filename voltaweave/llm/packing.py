"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as
many of the largest length as fit, then the binary digits of what is left, in
falling order.  Every piece is a training sequence of its own, so no sequence
crosses documents and none is padded.  ``bucket`` is the binary logarithm of
the length; batches are drawn from one bucket at a time.

No row depends on another, so nothing is shuffled: work grows with the text
alone and a lost task is simply run again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_chunks

#: Control characters that str.split() takes for white space and the tokenizer doesn't.
ODD_SPACE = re.compile("[\x1c-\x1f]")


#: Marks that close a word before white space: a token string of their own, as the white space put before them keeps it.
CLOSING = re.compile(r"(?<=[^\W_])([,.!?%$*&#|;:]+)(?=\s|$)")
#: Letters whose lower case depends on more than the letter.
ODD_LETTERS = re.compile("[\u0130\u03a3]")


def byte_letters() -> dict[int, str]:
    """Byte -> the printable character that stands for it in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Encodes texts with a tokenizer that never joins what white space parts.

    Words are encoded once and kept as little-endian bytes of their ids.  Beyond
    ``most`` words only those of the texts at hand are kept on.  If the
    tokenizer lower-cases and splits letters from marks, and its vocabulary
    shows where words end, texts are lower-cased and closing marks parted from
    words beforehand, which leaves fewer words to know; and new words of letters
    are encoded many at a time by the bare model, all others by the whole
    tokenizer.
    """

    def __init__(self, path: str, most: int = 800_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known, self.most = Tokenizer.from_file(path), {}, most
        made = json.loads(self.tokenizer.to_str())
        kinds = [x.get("type") for part in ("normalizer", "pre_tokenizer") for x in (made[part] or {}).get("normalizers", (made[part] or {}).get("pretokenizers", []))]
        self.bare = None
        if kinds == ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"] and made["model"].get("end_of_word_suffix") == "</w>":
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocab = self.tokenizer.get_vocab()
            self.closes = np.zeros(max(vocab.values()) + 1, bool)
            self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
            self.letters = str.maketrans(byte_letters())

    def _ids(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4").tobytes() for x in got]

    def _bare_ids(self, words: list[str]) -> dict[str, bytes]:
        """Of words of letters, lower-cased; those that the bare model can't part are left out."""
        out = {}
        for at in range(0, len(words), 500):
            some = words[at : at + 500]
            raw = [w if w.isascii() else w.encode().decode("latin-1").translate(self.letters) for w in some]
            ids = np.asarray(self.bare.encode(" ".join(raw), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
                out.update((w, data[a:b]) for w, a, b in zip(some, cuts, cuts[1:], strict=False))
        return out

    def _learn(self, words: set[str]) -> None:
        if self.bare:
            self.known.update(self._bare_ids([w for w in words if w.isalpha() and w.islower() and is_normalized("NFC", w)]))
        rest = [w for w in words if w not in self.known]
        self.known.update(zip(rest, self._ids(rest), strict=True))

    def _split(self, text: str) -> list[str] | None:
        """The text's words, parted further where that changes nothing; None if it must be encoded whole."""
        if ODD_SPACE.search(text):
            return None
        if self.bare and is_normalized("NFC", text) and not ODD_LETTERS.search(text):
            text = CLOSING.sub(r" \1", text.lower())
        return text.split()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        split = [self._split(x) for x in texts]
        words = set().union(*(x for x in split if x))
        if len(self.known) > self.most:
            self.known = {w: self.known[w] for w in words if w in self.known}
        if new := words - self.known.keys():
            self._learn(new)
        for text, words in zip(texts, split, strict=True):
            yield self._ids([text])[0] if words is None else b"".join(map(self.known.__getitem__, words))


def piece_lengths(n: int, longest: int) -> list[int]:
    """The lengths, all powers of two up to ``longest``, that ``n`` tokens are cut into."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in range(longest.bit_length(), -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    longest: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece of each row of ``docs``.

    Columns: doc_id, start, length, ids (binary: unsigned 32-bit, little
    endian), doc_tokens, bucket, sequence_id, offset.  ``end_id`` closes every
    document.  A null or empty text is the one piece that holds ``end_id``.
    Rows that repeat an id or a text are packed each on its own; null ids stay
    null; an empty table gives no pieces.  Very long texts are encoded whole.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    ship(docs.sparkSession)

    def run(batches):
        encoder, end = WordEncoder(tokenizer_path), np.asarray([end_id], "<u4").tobytes()
        for batch, texts in text_chunks(batches, "text"):
            rows, start, length, ids, total = [], [], [], [], []
            for i, data in enumerate(encoder.encode(texts)):
                data += end
                at, n = 0, len(data) // 4
                for size in piece_lengths(n, longest):
                    rows.append(i)
                    start.append(at)
                    length.append(size)
                    ids.append(data[4 * at : 4 * (at + size)])
                    total.append(n)
                    at += size
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int32())),
                    *(pa.array(x, pa.int64()) for x in (start, length)),
                    pa.array(ids, pa.binary()),
                    pa.array(total, pa.int64()),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    pieces = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long"
    )
    return pieces.select(
        "*",
        F.round(F.log2("length")).cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the pieces of :func:`pack` so that each folder ``bucket=b`` has the sequences of one length, 2**b.

    A reader draws its batches from one folder at a time, so all sequences of a
    batch are equally long.
    """
    pieces.write.partitionBy("bucket").parquet(path)
