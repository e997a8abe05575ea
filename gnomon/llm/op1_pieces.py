"""Exact merge-type (BPE) encoding with a public SentencePiece model, and decoding.

A sequence of pieces is the encoding of its text exactly when re-merging every two neighbours gives
these two back. The coder walks the text by longest matches of an Aho-Corasick automaton, checks each
piece against the one before it, falls back to shorter prefixes, and keeps a bit for every position
from which no encoding continues, so that none is tried twice. Texts are cut where no piece can
cross (before white space, and at characters that occur in no longer piece); what each cut segment
gives is kept in a bounded memo of the worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.llm.common import only, table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Entries of a worker's memo of segments, and of its memo of neighbours.
MEMO = 400_000


class PieceCoder:
    """Encodes and decodes with a merge-type SentencePiece model that does not normalise."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.bos, self.eos, self.unk = model.bos_id(), model.eos_id(), model.unk_id()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.order = {p: -model.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.raw = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for i in range(size):
            if model.is_control(i):
                self.raw[i] = b""
            elif model.is_unknown(i):
                self.raw[i] = " ⁇ ".encode()
            elif model.is_byte(i):
                self.raw[i] = bytes([int(self.pieces[i][3:5], 16)])
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        longer = [p for p in self.ids if len(p) > 1]
        crossing = any(SPACE in p.lstrip(SPACE) for p in longer)
        inside = set("".join(longer))
        alone = "".join(re.escape(c) for c in "\n\t" if c not in inside)
        one = f"[{alone}]" if alone else r"(?!)"
        self.segment = re.compile(r"[\s\S]+") if crossing else re.compile(f"{one}|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+")
        #: Pairs of characters that stand side by side in a piece; elsewhere a segment can be cut.
        self.joined = {p[i : i + 2] for p in longer for i in range(len(p) - 1)}
        self.length = [len(p) for p in self.pieces]
        #: By piece, its longest proper prefix that is a piece, or -1.
        self.shorter = [-1] * size
        for p, i in self.ids.items():
            self.shorter[i] = next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), -1)
        self.size = size
        self.fits: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging: best piece first, leftmost of equals."""
        parts, order = list(text), self.order
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                r = order.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def neighbours(self, left: int, right: int) -> bool:
        """Whether re-merging two pieces gives the two; with left -1, whether one gives itself."""
        if len(self.fits) >= MEMO:
            self.fits.clear()
        pair = [self.pieces[i] for i in (left, right) if i >= 0]
        known = self.fits[(left + 1) * self.size + right] = self.merged("".join(pair)) == pair
        return known

    def split(self, text: str) -> list[int]:
        """Piece ids of a text all of whose characters are pieces."""
        n, length, fits, size = len(text), self.length, self.fits, self.size
        longest = [-1] * n
        for end, i in self.automaton.iter(text):
            longest[end + 1 - length[i]] = i
        # A bit for each position from which the rest cannot be split.
        failed, at, out, last, piece = bytearray((n >> 3) + 1), 0, [], -1, longest[0]
        while True:
            to = at + length[piece]
            if not failed[to >> 3] >> (to & 7) & 1:
                fit = fits.get((last + 1) * size + piece)
                if self.neighbours(last, piece) if fit is None else fit:
                    out.append(piece)
                    if to == n:
                        return out
                    at, last, piece = to, piece, longest[to]
                    continue
            piece = self.shorter[piece]
            while piece < 0:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= length[piece]
                last = out[-1] if out else -1
                piece = self.shorter[piece]

    def segment_ids(self, text: str) -> bytes:
        """Ids of one segment, packed, of its parts between which no piece can stand."""
        joined, start, parts = self.joined, 0, []
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in joined:
                parts.append(self.known(text[start:i]))
                start = i
        return b"".join([*parts, self.known(text[start:])])

    def known(self, text: str) -> bytes:
        """Ids of a part; a character that is no piece becomes its bytes."""
        got = self.memo.get(text) or self.older.get(text)
        if got is None:
            ids = [self.byte_ids[b] for b in text.encode()] if len(text) == 1 and text not in self.ids else self.split(text)
            got = np.array(ids, "<u4").tobytes()
            self.keep(text, got)
        return got

    def keep(self, text: str, got: bytes) -> None:
        """Two generations of a bounded memo: what is not asked for again goes."""
        if len(text) <= 64:
            if len(self.memo) >= MEMO:
                self.memo, self.older = {}, self.memo
            self.memo[text] = got

    def encode_packed(self, text: str) -> bytes:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        parts = [np.array([self.bos], "<u4").tobytes()]
        if text:
            for s in self.segment.findall(SPACE + text.replace(" ", SPACE)):
                got = self.memo.get(s)
                if got is None:
                    got = self.older.get(s) or self.segment_ids(s)
                    self.keep(s, got)
                parts.append(got)
        parts.append(np.array([self.eos], "<u4").tobytes())
        return b"".join(parts)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode_packed(self, ids: bytes) -> bytes:
        """UTF-8 text of packed ids: begin and end give nothing, and the space put first goes."""
        out = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return out[1:] if out[:1] == b" " else out

    def decode(self, ids: list[int]) -> str:
        return self.decode_packed(np.array(ids, "<u4").tobytes()).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def coder(model: str) -> PieceCoder:
    """The coder of a public model by name, or of a model file by path; one for each worker."""
    import public_tokenizers

    return PieceCoder(model if "/" in model else public_tokenizers.path(model))


def encode(df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",), model: str = MODEL, decoded: bool = False, rows: int = 256) -> DataFrame:
    """keys, n_tokens and ids (packed little-endian unsigned 32-bit integers) of every whole text;
    with decoded, also the text that decoding these ids gives.

    A null text counts as empty and has the begin and end ids only. Repeated rows stay, null keys
    too, and an empty table gives an empty table. Other columns are left out. A text of any length
    is encoded whole; a worker holds one incoming batch and the results of `rows` texts.
    """
    own = only(df, *keys, text)
    fields = [pa.field("n_tokens", pa.int64()), pa.field("ids", pa.binary())] + [pa.field("decoded", pa.string())] * decoded
    schema = ", ".join([*(f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keys), "n_tokens bigint", "ids binary", *["decoded string"] * decoded])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(model)
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                ids = [c.encode_packed(t or "") for t in batch.column(len(keys)).to_pylist()]
                made = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decoded:
                    made.append(pa.array([c.decode_packed(x).decode("utf-8", "replace") for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *made], [*keys, *(f.name for f in fields)])

    return own.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", keys: tuple[str, ...] = ("doc_id",), model: str = MODEL) -> DataFrame:
    """keys and the text that packed ids decode to. Null ids decode to an empty text."""
    own = only(df, *keys, ids)
    schema = ", ".join([*(f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keys), "decoded string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(model)
        for batch in batches:
            out = [c.decode_packed(x or b"").decode("utf-8", "replace") for x in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(out, pa.string())], [*keys, "decoded"])

    return own.mapInArrow(run, schema)


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    coded = encode(table(spark, sf_dir, "documents"), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
