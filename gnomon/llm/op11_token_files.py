"""Token ids as flat binary files with 64-bit document offsets, as a Spark data source.

Documents are dealt into ranges of doc_id and sorted, each range is tokenized where it is written, and every
task leaves one shard: the ids of its documents one after the other as unsigned little-endian integers (two
bytes where the vocabulary allows, else four), the offsets of its documents in them, and their doc_ids. What
shards hold is known only when all are written, so the bases of their documents and ids come from prefix sums
over the tasks' messages at commit, and stand in the manifest, which makes the files visible all at once. The
reader maps shards into memory; a document is the slice between two offsets, and starts at its shard's base.

Tokenizing is the library's. Texts of usual characters are cut into pieces as the vocabulary's pattern cuts them, no
token reaches from one piece into the next, each distinct piece of a batch is looked up once, and those not seen before
are given to the library's model. Other texts are given to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from gnomon.llm.common import only, table
from gnomon.operators.tables import place
from gnomon.sources.files import replaced, whole

VOCABULARY = "byte_bpe_50k.json"
#: The id that closes every document.
END = 2
#: Pieces remembered within a worker before it starts anew, and how many the library's model gets at once.
MEMO, ASKED = 250_000, 5_000
#: Bytes of text that are encoded at once, and ids that are read at once, about.
BATCH_BYTES, BATCH_IDS = 500_000, 250_000
#: A mark between pieces that the library's model gets; it is a byte that no usual text has.
MARK = "\x01"
#: Classes of characters: blanks (a space apart from others), letters, numbers, all else, and what is not cut here.
SPACE, BLANK, LETTER, NUMBER, OTHER, UNUSUAL = range(6)
#: Characters whose classes have been the same in all versions: Latin, general punctuation, currency.
STABLE = (range(0x250), range(0x2010, 0x2028), range(0x2030, 0x205F), range(0x20A0, 0x20BB))
#: Contractions that the pattern cuts off, after their apostrophe.
SHORT, LONG = "stmd", ("re", "ve", "ll")


def classes() -> np.ndarray:
    """The class of each code point; the last one stands for all beyond."""
    out = np.full(0x20BC, UNUSUAL, np.uint8)
    for x in (x for some in STABLE for x in some):
        kind, blank = unicodedata.category(chr(x)), chr(x).isspace()
        if x == ord(MARK) or 0x1C <= x <= 0x1F or kind == "Cn":
            continue
        out[x] = SPACE if x == 32 else BLANK if blank else LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else OTHER
    return out


def cut(codes: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin: at each blank, and where the class changes, a single space going with what follows it.
    After an apostrophe that begins a piece, a contraction is a piece. codes are the characters of all texts and
    first says which of them begin one."""
    before = np.concatenate((np.array([UNUSUAL], np.uint8), kind[:-1]))
    begins = first | (kind <= BLANK) | ((kind != before) & (before != SPACE))
    quote = np.flatnonzero((codes == 39) & begins)
    padded, edge = np.concatenate((codes, np.zeros(3, codes.dtype))), np.concatenate((first, np.ones(3, bool)))
    one, two = padded[quote + 1], padded[quote + 2]
    inside = ~edge[quote + 1]
    short = quote[inside & np.isin(one, [ord(x) for x in SHORT])]
    long = quote[inside & ~edge[quote + 2] & np.logical_or.reduce([(one == ord(x[0])) & (two == ord(x[1])) for x in LONG])]
    begins = np.concatenate((begins, np.ones(3, bool)))
    begins[short + 1] = begins[long + 1] = begins[long + 2] = False
    begins[short + 2] = begins[long + 3] = True
    return begins[: len(codes)]


def byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones stand for themselves, the
    others for letters from U+0100 on. MARK becomes a blank."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)} | {ord(MARK): " "}


class Coder:
    """The tokenizer of one worker, with the pieces that it has met."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        kind = json.loads(self.library.to_str())
        before = kind["pre_tokenizer"] or {}
        self.by_piece = before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and kind["model"]["type"] == "BPE" and not kind["normalizer"]
        # Special tokens in a text would be ids of their own; texts with one go to the library whole.
        self.special = "|".join(re.escape(x["content"]) for x in kind["added_tokens"])
        self.classes = classes()
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = byte_letters()
        self.forget()

    def forget(self) -> None:
        """Start with no pieces known but the empty one, which closes a document."""
        self.known: dict[str, int] = {"": 0}
        self.ends, self.ids = [np.array([0, 1])], [np.array([END], np.uint32)]

    def learn(self, pieces: list[str]) -> None:
        """Ids of pieces that are not known, from the library's model."""
        for at in range(0, len(pieces), ASKED):
            some = pieces[at : at + ASKED]
            found = self.model.encode(MARK.join(some).encode().decode("latin-1").translate(self.letters), add_special_tokens=False)
            self.ends.append(self.ends[-1][-1] + np.searchsorted(found.word_ids, np.arange(len(some)), "right"))
            self.ids.append(np.array(found.ids, np.uint32))
            self.known.update(zip(some, range(len(self.known), len(self.known) + len(some)), strict=True))

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts as the library cuts them."""
        return [np.array([*x.ids, END], np.uint32) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, texts: pa.Array) -> tuple[pa.Array | None, np.ndarray, np.ndarray]:
        """The pieces of all texts, how many each text has, and which texts have to go to the library instead."""
        edges, data = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1], texts.buffers()[2]
        content = memoryview(data)[edges[0] : edges[-1]] if data else b""
        codes = np.frombuffer(bytes(content).decode().encode("utf-32-le"), np.uint32)
        kind = self.classes[np.minimum(codes, len(self.classes) - 1)]
        at = np.cumsum(1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000), dtype=np.int64)
        starts = np.concatenate(([0], np.searchsorted(at, edges[1:] - edges[0], "right")))
        first = np.zeros(len(codes) + 1, bool)
        first[starts] = True
        first, full = first[:-1], np.flatnonzero(np.diff(starts))
        odd = np.zeros(len(texts), bool)
        # The pattern looks ahead where three blanks stand together, or two at the end.
        blank = kind <= BLANK
        two = np.concatenate(([False], blank[1:] & blank[:-1] & ~first[1:]))
        bad = (kind == UNUSUAL) | (two & np.concatenate(([False], two[:-1])) & ~first)
        if len(full):
            odd[full] = np.logical_or.reduceat(bad, starts[full]) | two[starts[full + 1] - 1]
        if self.special:
            odd |= pc.match_substring_regex(texts, self.special).to_numpy(zero_copy_only=False)
        if odd.any():
            return None, starts, odd
        begins = np.flatnonzero(cut(codes, kind, first))
        offsets = np.concatenate((np.concatenate(([0], at))[begins], [len(content)])).astype(np.int32)
        cut_ = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(content)) if len(begins) else pa.array([], pa.string())
        return cut_, np.diff(np.searchsorted(begins, starts)), odd

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (strings without nulls) one after the other, each closed by END, and how many each has."""
        pieces, n_pieces, alone = self.pieces(texts) if self.by_piece else (None, None, np.ones(len(texts), bool))
        if alone.any():
            each = iter(self.whole(texts.filter(pa.array(alone)).to_pylist()))
            ids, n = self.batch(texts.filter(pa.array(~alone))) if not alone.all() else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            plain = iter(np.split(ids, np.cumsum(n)[:-1]))
            made = [next(each) if x else next(plain) for x in alone.tolist()]
            return np.concatenate([*made, np.zeros(0, np.uint32)]), np.array([len(x) for x in made], np.int64)
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.known) > MEMO:
            self.forget()
        self.learn([x for x in words if x not in self.known])
        self.ends, self.ids = [np.concatenate(self.ends)], [np.concatenate(self.ids)]
        which = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        # The empty piece, which is END, after the last piece of each text.
        closes = np.cumsum(n_pieces)
        which = np.insert(which, closes, 0)
        starts, sizes = self.ends[0][which], self.ends[0][which + 1] - self.ends[0][which]
        ends = np.cumsum(sizes)
        # Every id's place: its piece's start, and how far it is into the piece.
        ids = self.ids[0][np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        return ids, np.diff(ends[closes + np.arange(len(closes))], prepend=0)


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """One coder in each worker, kept from task to task."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


@dataclass
class Shard(WriterCommitMessage):
    """What a task has written."""

    part: int
    name: str
    docs: int
    nulls: int
    tokens: int
    width: int


class TokenFiles(DataSource):
    """Files of token ids. Options: path; to write, vocabulary; to read, columns of COLUMNS."""

    COLUMNS = {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids": "array<int>", "ids_crc32": "bigint"}

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def asked(self) -> list[str]:
        return [x.strip() for x in self.options.get("columns", "doc_id,start,n_tokens,ids").split(",")]

    def schema(self) -> str:
        return ", ".join(f"{x} {self.COLUMNS[x]}" for x in self.asked())

    def reader(self, schema: StructType) -> DataSourceReader:
        return TokenReader(self.options["path"], self.asked())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return TokenWriter(self.options["path"], self.options.get("vocabulary", VOCABULARY))


class TokenWriter(DataSourceArrowWriter):
    """Tokenizes rows of doc_id and text in the order in which they come. One shard from each task, named anew by each
    attempt; the manifest names those of the attempts that count."""

    def __init__(self, path: str, vocabulary: str):
        self.path, self.vocabulary = path, vocabulary

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shard:
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{os.urandom(8).hex()}"
        own = coder(self.vocabulary if "/" in self.vocabulary else public_tokenizers.path(self.vocabulary))
        docs = nulls = tokens = 0
        with replaced(f"{self.path}/{name}.ids") as ids, replaced(f"{self.path}/{name}.off") as offsets, replaced(f"{self.path}/{name}.doc") as doc_ids:
            offsets.write(np.zeros(1, "<u8").tobytes())
            for batch in iterator:
                for some in slices(batch):
                    made, n = own.batch(pc.fill_null(some.column(1), ""))
                    ids.write(made.astype(f"<u{own.width}").tobytes())
                    offsets.write((tokens + np.cumsum(n)).astype("<u8").tobytes())
                    doc_ids.write(pc.fill_null(some.column(0), 0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                    docs, nulls, tokens = docs + some.num_rows, nulls + some.column(0).null_count, tokens + len(made)
        return Shard(part, name, docs, nulls, tokens, own.width)

    def commit(self, messages: list[Shard | None]) -> None:
        """Bases by prefix sums over the shards in order, one row a task; then the manifest appears."""
        shards = sorted((x for x in messages if x and x.docs), key=lambda x: x.part)
        docs, tokens = (np.concatenate(([0], np.cumsum([getattr(x, k) for x in shards], dtype=np.int64))).tolist() for k in ("docs", "tokens"))
        rows = [{"name": x.name, "docs": x.docs, "nulls": x.nulls, "tokens": x.tokens, "width": x.width, "first_doc": d, "base": t} for x, d, t in zip(shards, docs, tokens, strict=False)]
        with replaced(f"{self.path}/manifest.json") as out:
            out.write(json.dumps({"version": 1, "docs": docs[-1], "tokens": tokens[-1], "shards": rows}).encode())

    def abort(self, messages: list[Shard | None]) -> None:
        """Shards without a manifest are never read."""


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about BATCH_BYTES of text, each of a row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_BYTES)))
        yield batch.slice(at, to - at)
        at = to


@dataclass
class Part(InputPartition):
    """A shard to read."""

    name: str
    docs: int
    nulls: int
    base: int
    width: int


class TokenReader(DataSourceReader):
    """A task for each shard."""

    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def partitions(self) -> list[Part]:
        manifest = json.loads(bytes(whole(f"{self.path}/manifest.json")))
        return [Part(x["name"], x["docs"], x["nulls"], x["base"], x["width"]) for x in manifest["shards"]] or [Part("", 0, 0, 0, 4)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.docs:
            return
        ids = np.frombuffer(whole(f"{self.path}/{partition.name}.ids"), f"<u{partition.width}")
        offsets = np.frombuffer(whole(f"{self.path}/{partition.name}.off"), "<u8").astype(np.int64, copy=False)
        doc_ids = np.frombuffer(whole(f"{self.path}/{partition.name}.doc"), "<i8")
        at = 0
        while at < partition.docs:
            end = min(partition.docs, at + 10_000, max(at + 1, int(np.searchsorted(offsets, offsets[at] + BATCH_IDS, "right")) - 1))
            edges = offsets[at : end + 1]
            made = {
                "doc_id": lambda a=at, b=end: pa.array(doc_ids[a:b], pa.int64(), mask=np.arange(a, b) < partition.nulls),
                "start": lambda e=edges: pa.array(e[:-1] + partition.base, pa.int64()), "n_tokens": lambda e=edges: pa.array(np.diff(e), pa.int64()),
                "ids": lambda e=edges: pa.ListArray.from_arrays(pa.array(e - e[0], pa.int32()), pa.array(ids[e[0] : e[-1]].astype(np.int32), pa.int32())),
                "ids_crc32": lambda e=edges: pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in np.split(ids[e[0] : e[-1]], (e[1:-1] - e[0]))], pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([made[x]() for x in self.columns], self.columns)
            at = end


def write_tokens(df: DataFrame, path: str, vocabulary: str = VOCABULARY, text: str = "text", doc_id: str = "doc_id", shards: int | None = None) -> None:
    """Files (so many shards, or as many as Spark deals) of the ids of every row's whole text in ascending order of doc_id, a null id before all others; rows
    with one id follow each other by their texts. A null text is an empty one, repeated rows all stay, very long texts
    are documents like any other, an empty table gives a manifest without shards, and other columns are not read."""
    spark = df.sparkSession
    spark.dataSource.register(TokenFiles)
    own = only(df, doc_id, text).select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = own.repartitionByRange(*([shards] if shards else []), *by).sortWithinPartitions(*by, "text")
    dealt.write.format("token_files").option("vocabulary", vocabulary).mode("append").save(path)


def read_tokens(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Documents of written files: doc_id, start (ids of all documents before it), n_tokens, ids; or other columns of
    TokenFiles.COLUMNS."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").option("columns", ",".join(columns or ("doc_id", "start", "n_tokens", "ids"))).load(path)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document of the files written from documents, read from the files. Null and
    empty texts are END alone; an empty table gives an empty one."""
    path = place(spark)
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path, "doc_id", "start", "n_tokens", "ids_crc32")
