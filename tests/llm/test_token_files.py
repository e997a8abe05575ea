"""Token files against the library, and back from the files."""

from __future__ import annotations

import json
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

DOCS = "doc_id bigint, text string, ids string, start string"
PARTS = [
    "a", "the", "ing", "Z", "re", "ll", "s", "don", "1", "23", " ", " ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "᠎", "\x1c", "\x85", "\x01", "\0", "é", "ß", "ª", "Ⅳ", "٣", "ʰ", "的", "😀", "½", "\xad", "ﬁ",
    ".", ",", "=", "_", "'", "'s", "'ll", "’", "—", "€", "₿", "<|endoftext|>", "﻿",
]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    from gnomon.llm.op11_token_files import VOCABULARY

    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def texts_of(rng, n):
    usual = [x for x in PARTS if len(x.encode()) < 3 and x not in "\x01\x1c\x85"]
    made = ["".join(rng.choice(PARTS if rng.random() < 0.3 else usual) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return [*made, "", " ", "\n\n", "x" * 5000, " ".join("ab" for _ in range(3000)), "don't we'll I'd's 's ''s're", "'", "'s", "'ll", "'l", "a'", "it's'", "x 's"]


def test_every_text_is_encoded_as_the_library_does(library):
    import public_tokenizers

    from gnomon.llm import op11_token_files as op

    coder, rng = op.Coder(public_tokenizers.path(op.VOCABULARY)), random.Random(1)
    usual = op.MEMO
    try:
        for op.MEMO in (usual, 300):
            texts = texts_of(rng, 6000)
            for at in range(0, len(texts), 700):
                some = texts[at : at + 700]
                ids, n = coder.batch(pa.array(["before", *some])[1:])
                for text, got in zip(some, np.split(ids, np.cumsum(n)[:-1]), strict=True):
                    assert got.tolist() == [*library.encode(text, add_special_tokens=False).ids, op.END], text
    finally:
        op.MEMO = usual
    ids, n = coder.batch(pa.array([], pa.string()))
    assert len(ids) == len(n) == 0


def test_other_vocabularies_go_through_the_library_whole():
    import public_tokenizers
    from tokenizers import Tokenizer

    from gnomon.llm.op11_token_files import END, Coder

    path = public_tokenizers.path("word_bpe_49k.json")
    coder, plain = Coder(path), Tokenizer.from_file(path)
    ids, n = coder.batch(pa.array(["The Red house", "", "don't"]))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [[*plain.encode(x, add_special_tokens=False).ids, END] for x in ("The Red house", "", "don't")]


def test_files_hold_what_was_written(spark, library, tmp_path):
    from gnomon.llm import op11_token_files as op

    rng = random.Random(3)
    rows = [(rng.randint(-5, 400), x, "x", "y") for x in texts_of(rng, 300)] + [(None, "no id", "x", None), (None, None, None, None), (7, None, "x", "y"), (8, "ab " * 200_000, "x", "y"), (9, "twice", "x", "y"), (9, "twice", "x", "y")]
    rng.shuffle(rows)
    path = str(tmp_path / "tokens")
    op.write_tokens(spark.createDataFrame(rows, DOCS).repartition(5), path, shards=4)
    got = sorted(op.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    at, want = 0, {}
    for i, t, *_ in rows:
        want.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, op.END])
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        want[r["doc_id"]].remove(r["ids"])
        at += r["n_tokens"]
    assert not any(want.values())
    sums = {r["start"]: r["ids_crc32"] for r in op.read_tokens(spark, path, "start", "ids_crc32").collect()}
    assert sums == {r["start"]: zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got}
    # The format: flat ids of two bytes and 64-bit offsets, bases by prefix sums.
    shards = json.loads((tmp_path / "tokens" / "manifest.json").read_text())["shards"]
    assert len(shards) > 1
    flat = np.concatenate([np.fromfile(f"{path}/{x['name']}.ids", "<u2") for x in shards])
    assert flat.tolist() == [i for r in got for i in r["ids"]]
    for x, base in zip(shards, np.cumsum([0, *(x["tokens"] for x in shards)]), strict=False):
        offsets = np.fromfile(f"{path}/{x['name']}.off", "<u8")
        assert x["base"] == base and offsets[0] == 0 and offsets[-1] == x["tokens"] and len(offsets) == x["docs"] + 1


def test_attempts_that_do_not_count_are_not_read(spark, tmp_path):
    from gnomon.llm import op11_token_files as op

    path, docs = str(tmp_path / "tokens"), spark.createDataFrame([(1, "one", "x", "y")], DOCS)
    op.write_tokens(docs, path)
    name = json.loads((tmp_path / "tokens" / "manifest.json").read_text())["shards"][0]["name"]
    for kind in ("ids", "off", "doc"):
        os.link(f"{path}/{name}.{kind}", f"{path}/part-00007-lost.{kind}")
    assert op.read_tokens(spark, path).count() == 1
    op.write_tokens(docs.limit(0), str(tmp_path / "none"))
    assert op.read_tokens(spark, str(tmp_path / "none")).count() == 0


