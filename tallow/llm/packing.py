"""Vector bin packing of token sequences.

Every document is an example: a prompt (its leading characters, as many as the caller says) that bears no loss, and a
response that does. It is tokenised, gets an end id, and is cut where a piece would break a limit of its own. Pieces
are placed under three limits at once: tokens, segments and loss-bearing tokens of a sequence. An open sequence takes
the piece whose demand has the largest dot product with what the sequence has left (both as shares of the limits), so
that pieces which need what is plentiful go first: where little loss is left, a shorter piece full of loss loses to
one that is mostly prompt. Where no piece fits, the one that can fill most of the room is cut to it.

Packing happens inside the task that tokenised the rows: no shuffle, a bounded pool of waiting pieces, and at most
one sequence of a task that isn't full for lack of pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

#: Limits of a sequence: tokens, segments, loss-bearing tokens. A segment's first id has no context, so bears no loss.
LIMITS = (2048, 64, 2000)
#: Pieces that wait before they are packed, and those left for the next round so that late choices stay good.
POOL, LEFT = 4096, 256
#: A gap of fewer tokens is padded, not filled with a cut piece.
GAP = 8
END_ID = 1


class ByteTokenizer:
    """ids of a byte-level BPE file in the format of the tokenizers library."""

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, file: bytes):
        import tiktoken

        spec = json.loads(file)
        before = spec.get("pre_tokenizer") or {}
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec.get("normalizer"):
            raise ValueError("a file whose texts are not split by the byte-level pattern alone")
        added = spec.get("added_tokens", ())
        if any(x.get(k) for x in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that depend on what stands beside them")
        special = {x["content"]: x["id"] for x in added}
        self.added = special
        # the longest of those that start at one place
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        # the file shows a byte as its Latin-1 sign where that is printable, else as a sign from U+0100 on, in order
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        sign = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(sign[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        self.bpe = tiktoken.Encoding("byte-bpe", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = np.zeros(1 + max([*ranks.values(), *special.values()]), np.int64)
        for piece, i in ranks.items():
            self.bytes[i] = len(piece)
        for piece, i in special.items():
            self.bytes[i] = len(piece.encode())

    def encode(self, text: str) -> list[int]:
        """ids of a text in which added tokens count as ordinary text."""
        return self.bpe.encode_ordinary(text)

    def encode_added(self, text: str) -> list[int]:
        """As encode, but the file's added tokens have their own ids, and text on either side is encoded for itself: the library's default."""
        if self.cut is None or not self.cut.search(text):
            return self.encode(text)
        out: list[int] = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(self.added[part])
            else:
                out += self.encode(part)
        return out

    def prompt_ids(self, ids: np.ndarray, n_bytes: int) -> int:
        """How many of the first ids lie wholly in the text's first bytes."""
        return int(np.searchsorted(np.cumsum(self.bytes[ids[:n_bytes]]), n_bytes, side="right"))


class Item(NamedTuple):
    """A piece that waits: ids [start, start + len(ids)) of a document of n ids, the first ``prompt`` of them without loss."""

    doc: int | None
    start: int
    ids: np.ndarray
    n: int
    prompt: int

    def cut(self, size: int) -> tuple[Item, Item]:
        return self._replace(ids=self.ids[:size]), Item(self.doc, self.start + size, self.ids[size:], self.n, max(self.prompt - size, 0))


def loss_of(size, prompt):
    """Loss-bearing ids of a segment of that many: without the prompt's, and without the first one."""
    return np.maximum(size - np.maximum(prompt, 1), 0)


class Packer:
    """Waiting items and the sequences made of them: rows (item, sequence, offset)."""

    def __init__(self, limits: tuple[int, int, int], first_sequence: int):
        self.limits, self.next = limits, first_sequence
        self.items: list[Item] = []

    def add(self, doc, ids: np.ndarray, prompt: int = 0) -> None:
        """Cuts a document where its pieces would break a limit on their own."""
        tokens, _, loss = self.limits
        item = Item(doc, 0, ids, len(ids), prompt)
        while len(item.ids) > (most := min(tokens, loss + max(item.prompt, 1))):
            piece, item = item.cut(most)
            self.items.append(piece)
        self.items.append(item)

    def pack(self, leave: int) -> Iterator[tuple]:
        """Sequences of waiting items until no more than ``leave`` wait."""
        tokens, segments, loss = self.limits
        items = self.items
        size = np.array([len(x.ids) for x in items], np.float32)
        prompt = np.maximum(np.array([x.prompt for x in items], np.float32), 1)
        bears = loss_of(size, prompt)
        waiting = len(items)
        while waiting > leave:
            room = [tokens, segments, loss]
            while waiting and room[0] and room[1]:
                fits = (size <= room[0]) & (bears <= room[2])
                # the segment's share is the same for all; a demand of 0 is still better than none
                value = np.where(fits, size * (room[0] / tokens**2) + bears * (room[2] / loss**2) + 1.0, 0.0)
                k = int(value.argmax())
                if value[k]:
                    item = items[k]
                    waiting -= 1
                    size[k] = np.inf
                    take, borne = len(item.ids), int(bears[k])
                else:
                    # what each one could put here; of equal ones the longest is cut
                    most = np.where(np.isinf(size), 0, np.minimum(np.minimum(room[0], room[2] + prompt), size))
                    k = int((most * 4096 + np.where(np.isinf(size), 0, np.minimum(size, 4095))).argmax())
                    take = int(most[k])
                    if take < GAP:
                        break
                    item, items[k] = items[k].cut(take)
                    borne = int(loss_of(take, item.prompt))
                    size[k], prompt[k] = len(items[k].ids), max(items[k].prompt, 1)
                    bears[k] = loss_of(size[k], prompt[k])
                yield (item, self.next, tokens - room[0])
                room = [room[0] - take, room[1] - 1, room[2] - borne]
            self.next += 1
        self.items = [x for x, s in zip(items, size, strict=True) if not np.isinf(s)]


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    limits: tuple[int, int, int] = LIMITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    prompt: Column | None = None,
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, n_loss and, if with_ids, ids.

    A document's ids are those of its whole text (a null one counts as empty), with the file's added tokens as such,
    and one end id, so every row of docs has a piece; each id lies in exactly one piece, and a sequence keeps all
    three limits. ``prompt`` gives the number of leading characters that bear no loss (null or below 1: none); ids that
    reach beyond them bear loss, and n_loss counts those of the piece that do. Repeated rows are documents of their
    own; null identifiers are kept; an empty table gives an empty result; other columns of docs are ignored. Sequence
    numbers are unique, not gapless. The tokenizer file is read once by the driver and sent to the workers (its size
    doesn't depend on the data).
    """
    with open(tokenizer_path, "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_loss"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 8 + [pa.list_(pa.int32())] * with_ids

    def rows_of(pieces: list[tuple]) -> pa.RecordBatch:
        out = [
            (item.doc, item.start, len(item.ids), zlib.crc32(item.ids), item.n, sequence, offset, int(loss_of(len(item.ids), item.prompt)), *([item.ids.astype(np.int32)] if with_ids else []))
            for item, sequence, offset in pieces
        ]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds, strict=True)], names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _loaded(file.value)
        packer = Packer(limits, TaskContext.get().partitionId() << 33)
        made: list[tuple] = []
        for batch in batches:
            for doc, text, lead in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = text.as_py()
                ids = np.array([*tokenizer.encode_added(text), END_ID], "<u4")
                packer.add(doc, ids, tokenizer.prompt_ids(ids[:-1], len(text[:lead].encode())) if lead and lead > 0 else 0)
                if len(packer.items) >= POOL:
                    made.extend(packer.pack(LEFT))
                while len(made) >= POOL:
                    yield rows_of(made[:POOL])
                    made = made[POOL:]
        made.extend(packer.pack(0))
        for k in range(0, len(made), POOL):
            yield rows_of(made[k : k + POOL])

    schema = ", ".join(f"{n} long" for n in names[:8]) + ", ids array<int>" * with_ids
    lead = F.lit(None) if prompt is None else prompt
    return shared.map_arrow(docs.select(F.col(id_col).cast("long"), shared.text_of(text_col), lead.cast("long")), packed, schema)


def first_line(text_col: str = "text") -> Column:
    """Characters of a text's first line with its line feed, where another one follows: the prompt of plain documents."""
    return F.coalesce(F.locate("\n", F.col(text_col)), F.lit(0))


_tokenizer: dict[int, ByteTokenizer] = {}


def _loaded(file: bytes) -> ByteTokenizer:
    """The tokenizer, built once in a worker."""
    key = hash(file)
    if key not in _tokenizer:
        _tokenizer.clear()
        _tokenizer[key] = ByteTokenizer(file)
    return _tokenizer[key]


def op7_vector_packing(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(shared.table(spark, sf_dir, "documents"), path, with_ids=False, prompt=first_line())
