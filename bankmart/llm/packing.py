"""Cut documents into sequences of power-of-two length.

Each document is tokenised and cut into pieces as its length is written in binary: as many
of the full sequence length as fit, then one for each further binary digit, longest first.
A piece is a sequence of its own, so none crosses documents and none needs padding, and
pieces of one length form a bucket from which batches of equal shape are taken.

Nothing is shuffled: a scan task tokenises its own documents.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bankmart.llm.columns import pick
from bankmart.llm.memory import tidy
from bankmart.llm.shipping import ship

TOKENIZER = "word_bpe_49k.json"
END = 1
ROWS = 64
KNOWN = 200_000
LONGEST_KNOWN = 200

# Texts of these characters alone are split into words here, as the tokenizer does; their
# normal form is themselves in lower case. Any other text goes to the tokenizer whole.
PLAIN = re.compile(r"[\t-\r -~\xa0-įı-ſ]*")
LETTERS = r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
DIGITS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
PIECES = re.compile(rf"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{DIGITS}]|[^\s{LETTERS}{DIGITS}]+")


def _byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in the vocabulary: printable ones for themselves, the others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


class Words:
    """Token ids of texts as little-endian unsigned 32-bit bytes, remembering pieces met before.

    Pieces are kept in two generations: when the young one is full it becomes the old one, whose
    pieces come back as they are met. Memory is bounded and frequent pieces stay.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # A text that names an added token, which is one id wherever it stands, goes to the tokenizer whole.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.first = {c for a in added for c in (a[0].lower(), a[0].upper())}
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)", re.IGNORECASE)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        found = [PIECES.findall(t.lower()) if PLAIN.fullmatch(t) and not self.names_token(t) else None for t in texts]
        flat = list(chain.from_iterable(filter(None, found)))
        ids = list(map(self.young.get, flat))
        holes = [i for i, known in enumerate(ids) if known is None]
        for i in holes:
            ids[i] = self.piece(flat[i])
        if len(self.young) > KNOWN:
            self.young, self.old = {}, self.young
        out, at = [], 0
        for pieces_, text in zip(found, texts):
            if pieces_ is None:
                out.append(self.whole(text))
            else:
                out.append(b"".join(ids[at : at + len(pieces_)]))
                at += len(pieces_)
        return out

    def names_token(self, text: str) -> bool:
        return any(c in text for c in self.first) and self.added.search(text) is not None

    def piece(self, piece: str) -> bytes:
        """The ids of one piece, from memory or the vocabulary's merges."""
        known = self.young.get(piece) or self.old.get(piece)
        if known is None:
            tokens = self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))
            known = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        if len(piece) <= LONGEST_KNOWN:
            self.young[piece] = known
        return known

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4").tobytes()


def pieces(length: int, longest: int) -> list[int]:
    """The lengths a document of this length is cut into, longest first."""
    rest = length % longest
    return [longest] * (length // longest) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


@tidy
def _pack(batches: Iterable[pa.RecordBatch], path: str, longest: int) -> Iterator[pa.RecordBatch]:
    words, end = Words(path), np.array([END], "<u4").tobytes()
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            out: list[tuple] = []
            texts = [t or "" for t in part.column(1).to_pylist()]
            for doc, ids in zip(part.column(0).to_pylist(), words.encode(texts)):
                ids += end
                at = 0
                for n in pieces(len(ids) // 4, longest):
                    out.append((doc, at, n, ids[4 * at : 4 * (at + n)], len(ids) // 4))
                    at += n
            columns = list(zip(*out))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "start", "length", "ids", "doc_tokens"]
            )


def pack(docs: DataFrame, *, longest: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """One row per sequence: ``doc_id``, ``start``, ``length`` (its bucket), ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` are unsigned 32-bit little-endian bytes, the end token being the document's last.
    Names of the tokenizer's added tokens in a text are these tokens, as a plain call of it has them.
    A null or empty text is the end token alone. Rows that repeat an id, or have none, are
    packed each on its own, with that id. Other columns are ignored. No rows: no rows.
    ``longest`` is a power of two. ``tokenizer``: path of a file that every executor has.
    ``sequence_id`` follows the position in the scan, so a task that runs again gives it again.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    ship(docs.sparkSession)
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    texts = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    out = texts.mapInArrow(
        partial(_pack, path=path, longest=longest),
        "doc_id long, start long, length long, ids binary, doc_tokens long",
    )
    return out.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per length, from which batches of one shape are read."""
    packed.write.mode("overwrite").partitionBy("length").parquet(path)
