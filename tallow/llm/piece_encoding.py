"""SentencePiece encoding and decoding, by backtracking over Aho-Corasick matches.

A merge-type (BPE) vocabulary with byte fallback. A run of characters has exactly one split into pieces in which
every two neighbours stay apart when their joint text is merged again from its characters; that split is what
merging yields. So the encoder walks from left to right, takes the longest match at each position that is
compatible with the piece before it, and goes back when none is; positions from which no split leads on are marked
in a bitfield and never tried again.

Text splits beforehand where no piece of the vocabulary can cross: before a run of spaces, around line feeds,
between letters and signs. Such chunks repeat, so each worker keeps the ids of those that it has seen, up to a bound.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: The visible sign that stands for a space inside pieces.
MARK = "▁"
#: Ways to split a text, the finest first; a model gets the first that none of its pieces crosses. A boundary
#: depends on the two characters beside it alone, so one look at every piece settles that.
SPLITS = [re.compile(x) for x in (r"\n+| *[^\W\d_]+| *[^ \n\w]+| *[\d_]+| +", r"\n+| *[^ \n]+| +", r"(?s).+")]
#: Texts that models of other kinds encode in other ways: compatibility signs, runs and ends of white space, the mark itself.
PROBES = ("ﬁne ① Ａ ½", "a  b   c", " x ", "a\u00a0b\u3000c", "tab\tline\n\nend\n", "▁a▁ ▁", "e\u0301 é İ", "漢字😀\x00\x01")
#: Chunks kept by a worker (in two generations), and the longest that it keeps.
KEPT, LONGEST = 400_000, 64


class PieceModel:
    """Encoder and decoder for one model file."""

    def __init__(self, proto: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        ids = range(sp.get_piece_size())
        self.begin, self.end, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.pieces: dict[str, int] = {}
        self.score = [0.0] * len(ids)
        self.byte = [self.unknown] * 256
        shown = [b""] * len(ids)
        for i in ids:
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value], shown[i] = i, bytes([value])
            elif sp.is_unknown(i):
                shown[i] = " ⁇ ".encode()
            elif not sp.is_control(i) and not sp.is_unused(i):
                text = piece.replace(MARK, " ")
                self.pieces[text], self.score[i], shown[i] = i, sp.get_score(i), text.encode()
        self.text = {i: p for p, i in self.pieces.items()}
        self.lengths = np.array([len(b) for b in shown], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(shown), np.uint8)
        self.apart: dict[int, bool] = {}
        self.matcher = ahocorasick.Automaton()
        for p, i in self.pieces.items():
            if len(p) == 1 or self.merged(p) == [i]:  # a piece that merging can't reach never stands in a result
                self.matcher.add_word(p, (len(p), i))
        self.matcher.make_automaton()
        self.split = next(x for x in SPLITS if all(len(x.findall(p)) == 1 for p in self.pieces)).findall
        self.known = shared.Kept(self.chunk, KEPT, LONGEST)
        for text in PROBES:
            if np.frombuffer(self.encode(text), "<u4").tolist() != sp.encode(text, add_bos=True, add_eos=True):
                raise ValueError("a model that changes texts before it splits them, or has pieces of its own kind")

    def merged(self, text: str) -> list[int]:
        """ids of a short text by merging: the best-scored neighbours first, the leftmost where they tie."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.pieces.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.pieces.get(p, -1) for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are when their joint text is merged again."""
        key = left << 32 | right
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) >= 4 * KEPT:
                self.apart.clear()
            found = self.apart[key] = self.merged(self.text[left] + self.text[right]) == [left, right]
        return found

    def _run(self, text: str, out: list[int]) -> None:
        """Appends the ids of a run of characters that are all pieces themselves."""
        n = len(text)
        starting: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for last, (length, i) in self.matcher.iter(text):
            starting[last + 1 - length].append((last + 1, i))  # shorter matches come first
        failed = bytearray(n // 8 + 1)
        path: list[tuple[int, int, int]] = []
        at, choice = 0, len(starting[0]) - 1
        while at < n:
            options = starting[at]
            while choice >= 0:
                to, i = options[choice]
                if not failed[to >> 3] >> (to & 7) & 1 and (not path or self.compatible(path[-1][2], i)):
                    break
                choice -= 1
            if choice >= 0:
                path.append((at, choice, i))
                at, choice = to, len(starting[to]) - 1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at, choice, _ = path.pop()
                choice -= 1
        out.extend(i for _, _, i in path)

    def chunk(self, text: str) -> bytes:
        """ids of one chunk as little-endian unsigned 32-bit integers."""
        out: list[int] = []
        first = 0
        for k, c in enumerate(text):
            if c not in self.pieces:
                if k > first:
                    self._run(text[first:k], out)
                out.extend(self.byte[b] for b in c.encode("utf-8", "surrogatepass"))
                first = k + 1
        if first < len(text):
            self._run(text[first:], out)
        return np.array(out, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """ids of a whole text, begin and end included, as little-endian unsigned 32-bit integers."""
        # the space in front is the model's dummy prefix; an empty text has none
        chunks = self.split(" " + text.replace(MARK, " ")) if text else ()
        body = b"".join(map(self.known.__getitem__, chunks))
        return self.begin.to_bytes(4, "little") + body + self.end.to_bytes(4, "little")

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text: pieces in a row, control ids left out, without the dummy prefix."""
        n = self.lengths[ids]
        to = np.cumsum(n)
        at = np.repeat(self.starts[ids] - (to - n), n) + np.arange(to[-1] if len(to) else 0)
        shown = self.flat[at].tobytes()
        return shown[1:] if shown[:1] == b" " else shown


_model: dict[int, PieceModel] = {}


def _loaded(proto: bytes) -> PieceModel:
    """The model, built once in a worker."""
    key = hash(proto)
    if key not in _model:
        _model.clear()
        _model[key] = PieceModel(proto)
    return _model[key]


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if with_ids, ids and decoded.

    Whole texts; a null text counts as empty and gives the begin and end ids alone. Repeated rows and null
    identifiers are kept; an empty table gives an empty result; other columns of docs are ignored. The model file
    is read once by the driver and sent to the workers (its size doesn't depend on the data).
    """
    with open(model_path, "rb") as f:
        proto = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int32()), pa.string()] * with_ids

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _loaded(proto.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = []
                for doc, text in zip(batch.column(0)[lo : lo + 512].to_pylist(), batch.column(1)[lo : lo + 512], strict=True):
                    data = model.encode(text.as_py())
                    ids = np.frombuffer(data, "<u4")
                    back = model.decode(ids)
                    row = (doc, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(back).hexdigest())
                    rows.append((*row, ids.astype(np.int32), back.decode()) if with_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds, strict=True)], names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    return shared.map_arrow(docs.select(F.col(id_col).cast("long"), shared.text_of(text_col)), encoded, schema)


def op10_piece_encoding(spark, sf_dir):
    import public_tokenizers

    return encode_pieces(shared.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)
