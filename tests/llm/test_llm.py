"""Operators for corpora against brute force, libraries and round trips, with nulls, ties and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

DOCS = "doc_id bigint, text string, extra string"
PROSE = "the red house by the old river was sold to a man from the north who had come with his dog and a small cart full of apples and pears in late autumn".split()


def prose(rng, n):
    return " ".join(rng.choice(PROSE) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    base = [prose(rng, 80) for _ in range(6)]
    made = [(i, base[i % 6] if i % 5 == 0 else prose(rng, rng.randint(1, 120))) for i in range(60)]
    return [*made, (60, None), (61, ""), (62, base[0].upper()), (63, "é" * 150), (None, "nobody's text"), (7, made[7][1])]


def test_pieces_equal_the_library(spark, rows):
    import public_tokenizers
    import sentencepiece

    from gnomon.llm.op1_pieces import MODEL, PieceCoder, encode

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))
    coder, rng = PieceCoder(public_tokenizers.path(MODEL)), random.Random(1)
    parts = ["a", "the", " ", "  ", "▁", "\n", "é", "😀", "的", ".", "=" * 5, "<s>", "\0", "\t", "ing", "Z"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        ids = lib.encode(text, add_bos=True, add_eos=True)
        assert coder.encode(text) == ids and coder.decode(ids) == lib.decode(ids)
    for text in ("".join(rng.choice("abcdefghij") for _ in range(100_000)), "ab" * 20_000):
        assert coder.encode(text) == lib.encode(text, add_bos=True, add_eos=True)
    got = encode(frame(spark, rows), decoded=True).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["decoded"] for r in got}[60] == ""
    assert encode(frame(spark, []), decoded=True).count() == 0


def test_exact_groups_equal_grouping_by_text(spark, rows):
    from gnomon.llm.op6_exact import exact_groups, filter_block, filter_rows, merged

    norm = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    for r in exact_groups(frame(spark, rows)).collect():
        own = next(v for v in groups.values() if r["doc_id"] in v and hashlib.sha256(next(k for k in groups if groups[k] is v).encode()).hexdigest() == r["text_sha256"])
        assert r["group_size"] == len(own) and r["keep_id"] == max((x for x in own if x is not None), default=None)
        assert r["kept"] == (r["doc_id"] == r["keep_id"])
    assert exact_groups(frame(spark, [])).count() == 0
    rng = np.random.default_rng(1)
    for bits in (0, 3):
        head = np.uint64(5 << 61) if bits else np.uint64(0)
        a, b = (np.unique(rng.integers(0, 1 << 61, 300, dtype=np.uint64)) | head for _ in range(2))
        one = filter_rows(5 if bits else 0, filter_block(a, np.ones(len(a), np.int64), bits), bits)
        assert (one[0] == a).all()
        both = merged(one, merged(one, (b, np.ones(len(b), np.int64))))
        assert both[1].sum() == 2 * len(a) + len(b)


def test_repeats_equal_brute_force(spark):
    from gnomon.llm import op4_substrings as op

    rng = random.Random(5)
    base = ["".join(rng.choice("abcd é") for _ in range(300)) for _ in range(4)]
    rows = [(i, "ab" * rng.randint(0, 200) if i % 9 == 0 else None if i % 17 == 3 else rng.choice(base)[rng.randint(0, 99) :] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 40))) + rng.choice(base)) for i in range(50)]
    seen, want = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(b[k : k + 100])
        want[i] = bytes(x for x, y in zip(b, gone, strict=True) if not y)
    usual = op.ZONES
    try:
        for op.ZONES in (usual, 2):
            got = {r["doc_id"]: bytes(r["kept"]) for r in op.remove_repeats(frame(spark, rows)).collect()}
            assert got == want
    finally:
        op.ZONES = usual
    assert op.remove_repeats(frame(spark, [])).count() == 0


def removed_by_brute_force(rows):
    """Kept bytes of each (doc_id, text), in the given order of rows."""
    seen, want = set(), []
    for _, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(b[k : k + 100])
        want.append(bytes(x for x, y in zip(b, gone, strict=True) if not y))
    return want


def test_longest_previous_factors_equal_brute_force():
    from gnomon.llm.op4_substrings import LENGTH, longest_previous

    rng = np.random.default_rng(3)
    for _ in range(20):
        parts = [rng.integers(1, 3, rng.integers(100, 160)) for _ in range(4)]
        parts.append(parts[0][:140])
        text = np.concatenate([np.append(x, 0) for x in parts]).astype(np.int64)
        begin = np.cumsum([0, *(len(x) + 1 for x in parts)])[:-1]
        starts = np.concatenate([b + np.arange(len(x) - LENGTH + 1) for b, x in zip(begin, parts, strict=True)])
        got = longest_previous(text, starts)
        for k, i in enumerate(starts):
            best = 0
            for j in starts[starts < i]:
                same = text[i : i + 112][: len(text) - i] == text[j : j + 112][: len(text[i : i + 112])]
                best = max(best, len(same) if same.all() else int(same.argmin()))
            assert min(got[k], LENGTH) == min(best, LENGTH)


def test_texts_without_id_are_told_apart_and_long_ones_read_whole(spark):
    from gnomon.llm.op4_substrings import remove_repeats

    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 300))) + (passage[rng.randint(0, 200) :] if i % 3 else "") for i in range(400)]
    long = "".join(rng.choice("abcdefgh ") for _ in range(1_300_000))
    rows = [(None, t) for t in texts] + [(1, long), (2, "x" + long[600_000:700_000] + "y" + long[-500:]), (3, passage), (3, passage)]
    got = remove_repeats(frame(spark, rows)).collect()
    by = {r["doc_id"]: bytes(r["kept"]) for r in got if r["doc_id"]}
    assert by == {1: long.encode(), 2: b"xy", 3: b""} and len(got) == 404
    # The order of the texts without id is by their content's hash; whatever it is, the result is that of one order.
    kept = [(r["n_bytes"], bytes(r["kept"])) for r in got if r["doc_id"] is None]
    whole = sum(n == len(k) for n, k in kept)
    joined = b"\n".join(k for _, k in kept)
    assert joined.count(passage[300:].encode()) == 1 and whole >= sum(i % 3 == 0 for i in range(400))
    assert sum(len(k) for _, k in kept) >= sum(len(t) for i, t in enumerate(texts) if not i % 3)


def test_phrases_equal_brute_force(spark, rows):
    from gnomon.llm.op7_decontaminate import find, words

    texts = [r[1] or "" for r in rows]
    items = [(1, " ".join(texts[3].split()[:14])), (2, "old river"), (3, None), (4, texts[12]), (5, "unheard of words in here that nobody ever has said before now"), (None, "dog")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    windows = {}
    for i, t in items:
        ws = words((t or "").encode())
        for k in range(max(1, len(ws) - 9) if ws else 0):
            windows.setdefault(tuple(ws[k : k + 10]), set()).add("" if i is None else str(i))
    got = find(frame(spark, rows), bench).collect()
    assert len(got) == len(rows)
    for r, text in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)), (t for _, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0))), strict=True):
        ws = words((text or "").encode())
        hit, found = set(), set()
        for w, names in windows.items():
            for k in range(len(ws) - len(w) + 1):
                if tuple(ws[k : k + len(w)]) == w:
                    hit.update(range(k, k + len(w)))
                    found |= names
        assert (r["n_words"], r["n_hit"], list(r["items"])) == (len(ws), len(hit), sorted(found))


def test_near_copies_meet_and_strangers_do_not(spark):
    from gnomon.llm.op10_near import aligned, near_groups

    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(200)] for _ in range(8)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i in range(8, 40):
        copy = list(base[i % 4])
        for k in rng.sample(range(200), 3):
            copy[k] = rng.choice(vocabulary)
        rows.append((i, " ".join(copy)))
    rows += [(40, None), (41, ""), (42, rows[5][1])]
    got = {r["doc_id"]: r["class_id"] for r in near_groups(frame(spark, rows)).collect()}
    assert got == {i: i if i < 8 or i in (40, 41) else 5 if i == 42 else i % 4 for i in range(43)}
    for _ in range(300):
        a, b = (np.array([rng.randint(0, 3) for _ in range(rng.randint(0, 14))], np.uint64) for _ in range(2))
        table = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                table[i][j] = min(table[i - 1][j] + 1, table[i][j - 1] + 1, table[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        longer = max(len(a), len(b))
        assert aligned(a, b) == (table[-1][-1] <= int(0.2 * longer + 1e-9))


def test_language_follows_words_and_knows_nothing_of_digits(spark):
    from gnomon.llm.op3_language import fit, identify

    rng = random.Random(6)
    other = "der hund ging durch die strasse und kaufte ein brot bei dem alten mann mit hut".split()
    rows = [(i, " ".join(rng.choice(PROSE if i % 2 else other) for _ in range(30)), "en" if i % 2 else "de") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = fit(docs)
    half = " ".join(rng.choice(PROSE) for _ in range(40)) + " " + " ".join(rng.choice(other) for _ in range(20))
    new = [(1, rows[1][1]), (2, rows[2][1]), (3, None), (4, "12 34!"), (5, half), (6, "Привет")]
    got = {r["doc_id"]: r for r in identify(frame(spark, new), model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5)] == ["en", "de", "und", "und", "en"]
    assert [s["lang"] for s in got[5]["spans"]] == ["en", "de"] and got[6]["score"] == 0
    assert identify(frame(spark, new), fit(docs.limit(0))).where("lang_pred <> 'und'").count() == 0


def test_base_score_equals_its_formula_and_lattice_sums_segmentations(spark, rows):
    from gnomon.llm.op9_score import MODEL, Lattice, score, tokens

    docs = [(i, t) for i, t in rows if i is not None][:64]
    train = docs[:40]
    count = Counter(w for _, t in train for w in [*tokens((t or "").encode()), None])
    n, v = sum(count.values()), len(count)
    for r in score(frame(spark, docs), frame(spark, train)).collect():
        ws = [*tokens((dict(docs)[r["doc_id"]] or "").encode()), None]
        want = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert r["base_score"] == pytest.approx(want) and r["n_tokens"] == len(ws) and r["n_known"] == sum(w in count for w in ws) and r["train_tokens"] == n
        assert math.isfinite(r["score"]) and r["score"] <= 0
    lattice = Lattice(MODEL, {}, 0)
    import public_tokenizers
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))
    ids = {lib.id_to_piece(i): i for i in range(3, lib.get_piece_size()) if not lib.is_byte(i)}

    def total(text, first):
        if not text:
            return lattice.stop
        out = 0.0 if first else math.prod(math.exp(lattice.byte_log[b]) for b in text[0].encode()) * total(text[1:], False)
        return out + sum(math.exp((lattice.start if first else lattice.inner)[ids[text[:k]]]) * total(text[k:], False) for k in range(1, len(text) + 1) if text[:k] in ids)

    words = ["the", "hat", "é", "quick", "a"]
    assert lattice.log10(words) == pytest.approx([math.log10(total("▁" + w, True)) for w in words])


def test_insults_are_learned_with_gaps(spark):
    from gnomon.llm.op8_toxicity import fit, rate

    rng = random.Random(9)
    rows = [(i, prose(rng, 60) + (f" you {rng.choice(['nitwit', 'blockhead'])} " * 2 if i % 4 == 0 else "")) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    machine = fit(frame(spark, rows), labels)
    new = [(0, prose(rng, 40)), (1, "what a nitwit and a nitwit"), (2, "n-i-t-w-i-t nitwiit block*head nitwit"), (3, None)]
    got = {r["doc_id"]: r for r in rate(frame(spark, new), machine).collect()}
    assert [got[i]["predicted"] for i in range(4)] == [0, 1, 1, 0]
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_main_text():
    from gnomon.llm.op2_html import extract, weights

    page = "<html><body><nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1><p>One\n two <b>three</b><p>Four words stand here<div class='ad'>Buy!</div><form>Name</form></article><footer>end</footer>"
    assert extract(page, weights(Counter(), Counter())) == "A & B\nOne two three\nFour words stand here"
    assert extract("", {}) == "" and extract("<script>x</script>", {}) == ""


def test_main_text_of_odd_pages():
    import time

    from gnomon.llm.op2_html import best_region, extract, pieces, weights

    learned = weights(Counter(), Counter())
    said = lambda page: extract(page, learned)
    assert said("<p title=it's>First of them all</p><p>Second para isn't long</p><p>Third para</p>") == "First of them all\nSecond para isn't long\nThird para"
    assert "<" not in said('<p>Hello there my friend and all<a href="x>link</a> more of it comes here</p>')
    assert said('<article><p>Some words are here for all</p><p class="share-price">Shares rose nine percent today</p></article>') == "Some words are here for all\nShares rose nine percent today"
    assert said('<p>Alpha beta gamma</p><div id="side-effects"><p>Side effects of the drug are many</p></div><p>Delta and more of it</p>') == "Alpha beta gamma\nSide effects of the drug are many\nDelta and more of it"
    advert = "buy this now " * 50
    for box in ("ad-slot", "post comments", "sidebar", "cookie-notice", "social-share"):
        assert said(f'<article><p>One two three four five six</p><div class="{box}">{advert}</div><p>Seven eight nine ten eleven twelve</p></article>') == "One two three four five six\nSeven eight nine ten eleven twelve"
    assert said("<header><h1>Site of all sites</h1></header><article><header><h1>Title of the text</h1></header><p>Body of the text is here</p></article>") == "Title of the text\nBody of the text is here"
    rng = random.Random(9)
    for _ in range(200):
        x = [rng.choice((-2, -1, -0.5, 0.5, 1, 3)) for _ in range(rng.randint(0, 12))]
        first, end = best_region(x)
        assert sum(x[first:end]) == max([0.0, *(sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1))])
    begun = time.time()
    deep = extract("<p>" + "<b>" * 100_000 + "words of a deep page stand here and go on for long " * 1000, learned)
    assert deep.startswith("words of") and time.time() - begun < 20
    assert len(pieces("<div>" * 3000 + "</section>" * 3000)) == 6000


def test_pages_without_rows_text_or_key(spark):
    from gnomon.llm.op2_html import fit, main_text

    schema = "page_id bigint, url string, html string, text string, key string, _row string"
    empty = spark.createDataFrame([], schema)
    assert main_text(empty, fit(empty)).count() == 0
    page = "<article><p>Some words are here for all of you to read</p></article>"
    some = spark.createDataFrame([(1, "u", page, "t", "k", "r"), (None, None, None, None, None, None), (1, "u", page, "t", "k", "r"), (2, "v", "", "t", "k", "r")], schema)
    got = sorted((r["page_id"] or 0, r["text"]) for r in main_text(some, fit(some)).collect())
    said = "Some words are here for all of you to read"
    assert got == [(0, ""), (1, said), (1, said), (2, "")]


def test_surrogates_keep_type_and_identity(spark):
    from gnomon.llm.op5_surrogates import luhn, permuted, pseudonymise

    assert sorted(permuted(i, 100, b"k") for i in range(100)) == list(range(100))
    rows = [(1, "Mail a.b@x.example.com or call +1 (743) 555-3824; Mrs. Anna Smith"), (2, "A.B@x.example.com 4539578763621486 10.0.0.1 Frau Smith"), (3, None)]
    got = {r["doc_id"]: r for r in pseudonymise(frame(spark, rows), "a key").collect()}
    one, two = got[1]["new_text"], got[2]["new_text"]
    assert re.findall(r"\S+@\S+", one)[0].lower() == re.findall(r"\S+@\S+", two)[0].lower() != "a.b@x.example.com"
    assert luhn(re.search(r"\d{16}", two)[0]) and "10.0.0.1" not in two and "Smith" not in one + two
    assert one.split()[-1] == two.split()[-1] and got[3]["new_text"] == ""


def test_pipeline_keeps_clean_documents(spark, tmp_path, rows):
    import corpus_pipeline

    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(5)) for _ in range(300)]
    text = [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(12)]
    near = text[1].split()
    near[30] = "changed"
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate([*text, text[0].upper(), " ".join(near), "123", text[2] + " " + text[3]])]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(text[5].split()[10:30]))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12, 15}


def test_exact_stage_tells_texts_of_one_id_apart(spark):
    import corpus_pipeline

    rows = [(None, "One"), (None, "two"), (None, "two"), (7, "Three"), (7, "four"), (9, "three"), (9, "three"), (1, None), (2, "")]
    got = corpus_pipeline.exact_dedup(spark, frame(spark, rows), "").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == [(0, "One"), (0, "two"), (2, ""), (7, "four"), (9, "three")]
    assert got[0].asDict().keys() == {"doc_id", "text", "extra"}


def test_near_copies_that_only_the_original_links_are_one_class(spark):
    from gnomon.llm.op10_near import near_groups

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    base = [word() for _ in range(1000)]
    rows = [(99, " ".join(base))]
    for i in range(10):
        at = 50 + 90 * i
        rows.append((i, " ".join(base[:at] + [word() for _ in range(200)] + base[at:])))
    got = near_groups(frame(spark, rows)).collect()
    assert {r["class_id"] for r in got} == {0} and {r["class_size"] for r in got} == {11}


def test_copies_with_a_few_words_in_a_hundred_changed_meet_as_by_brute_force(spark):
    from gnomon.llm.op10_near import aligned, near_groups, word_ids

    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows, n = [], 120
    for i in range(120):
        base = [word() for _ in range(n)]
        copy = list(base)
        for k in rng.sample(range(n), rng.randint(n * 5 // 100, n * 10 // 100)):
            copy[k] = word()
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    got = {r["doc_id"]: r["class_id"] for r in near_groups(frame(spark, rows)).collect()}
    true = [i for i in range(0, 240, 2) if aligned(word_ids(rows[i][1].encode().split()), word_ids(rows[i + 1][1].encode().split()))]
    found = sum(got[i] == got[i + 1] for i in true) / len(true)
    print(f"recall {found:.3f} of {len(true)}")
    assert len(true) == 120 and found >= 0.95
    assert all(got[i] in (i, i - 1) for i in got)


def test_short_texts_meet_as_by_brute_force(spark):
    from gnomon.llm.op10_near import aligned, near_groups, word_ids

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    made = []
    for n in range(1, 13):
        for _ in range(3):
            base = [word() for _ in range(n)]
            made += [base, [*base, word()], [word(), *base]]
            for k in {0, n // 2, n - 1}:
                made += [[*base[:k], word(), *base[k + 1 :]], [*base[:k], *base[k + 1 :]], [*base[:k], word(), word(), *base[k:]]]
    made = [w for w in made if 1 <= len(w) <= 12]
    ids = [word_ids([x.encode() for x in w]) for w in made]
    true = list(range(len(made)))
    for i in range(len(made)):
        for j in range(i):
            if true[i] != true[j] and aligned(ids[i], ids[j]):
                low, high = sorted((true[i], true[j]))
                true = [low if x == high else x for x in true]
    got = {r["doc_id"]: r["class_id"] for r in near_groups(frame(spark, [(i, " ".join(w)) for i, w in enumerate(made)])).collect()}
    assert [got[i] for i in range(len(made))] == true


def test_secrets_are_found_in_texts_without_digits(spark):
    from gnomon.llm.op5_surrogates import pseudonymise

    letters = "abcdefghijklmnopqrst"
    secrets = ["correcthorse"] * 5 + [f"{k}{letters}" for k in ("ghp_", "gho_", "sk-", "pk_", "xoxa-", "xoxb-", "xoxp-")] + ["AKIA" + "QWERTYUIOPASDFGH", "abcdef" * 6]
    before = ["password=", "passwd=", "api_key=", "secret=", "token="] + ["with "] * 9
    rows = [(i, f"login {b}{x} now") for i, (b, x) in enumerate(zip(before, secrets, strict=True))]
    rows += [(20, "Mail ab@example.com"), (21, "Herr Schmidt")]
    got = {r["doc_id"]: r for r in pseudonymise(frame(spark, rows), "a key").collect()}
    assert all(got[i]["n_entities"] == 1 and got[i]["new_text"] != rows[k][1] for k, (i, _) in enumerate(rows))
    assert all(x not in got[i]["new_text"] for i, x in enumerate(secrets))


def test_near_stage_tells_texts_of_one_id_apart(spark):
    import corpus_pipeline

    rng = random.Random(8)
    one, other = ([f"{rng.choice('abcdef')}{rng.randint(0, 10**6)}" for _ in range(60)] for _ in range(2))
    rows = [(1, " ".join(one)), (2, " ".join([*one, "more"])), (2, " ".join(other)), (None, "nobody's text"), (3, None)]
    got = corpus_pipeline.near_dedup(spark, frame(spark, rows), "")
    assert {(r["doc_id"], r["text"]) for r in got.collect()} == {rows[i] for i in (0, 2, 3, 4)}


def test_units_of_short_words_and_dense_scripts():
    from gnomon.llm.op8_toxicity import CODES, subsequences, units

    assert units("go to hell you ass an id 12") == ["go", "to", "hell", "you", "ass", "an", "id", "12"]
    assert units("a b c d of e") == ["abcd", "of", "e"]
    assert units("傻瓜们 ok傻瓜") == ["傻瓜", "瓜们", "ok", "傻瓜"]
    codes, weights = subsequences(["дурак", "мирно", "idiot", "傻瓜"])
    seen = [set(c[w > 0].tolist()) for c, w in zip(codes, weights, strict=True)]
    assert codes.max() < CODES and not seen[0] & seen[1] and all(seen)


def test_kernel_equals_brute_force():
    from itertools import combinations

    from gnomon.llm.op8_toxicity import DECAY, PATTERNS, norms, subsequences

    def brute(word):
        found = Counter()
        s = "^" + word + "$"
        for size, span in ((3, 5), (4, 6)):
            for places in combinations(range(len(s)), size):
                if places[-1] - places[0] < span:
                    found["".join(s[i] for i in places)] += DECAY ** (places[-1] - places[0] + 1 - size)
        return found

    assert len(PATTERNS) == 6 + 10
    words = ["idiot", "idxiot", "id", "moron", "a", "banana"]
    codes, weights = subsequences(words)
    sparse = [Counter() for _ in words]
    for own, c, w in zip(sparse, codes, weights, strict=True):
        for code, value in zip(c.tolist(), w.tolist(), strict=True):
            if value:
                own[code] += value
    dot = lambda a, b: sum(v * b[k] for k, v in a.items())
    for i, a in enumerate(words):
        assert abs(norms(codes, weights)[i] - dot(brute(a), brute(a)) ** 0.5) < 1e-9
        for j, b in enumerate(words):
            assert abs(dot(sparse[i], sparse[j]) - dot(brute(a), brute(b))) < 1e-9


def test_toxicity_of_held_out_documents(spark):
    from gnomon.llm.op8_toxicity import fit, rate

    rng = random.Random(10)
    clean = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    bad = ["blorkex", "дурачина", "傻瓜", "vrumpit"]
    rows, marks = [], []
    for i in range(600):
        words = [rng.choice(clean) for _ in range(30)]
        if i % 3 == 0:
            w = rng.choice(bad)
            at = rng.randint(1, len(w) - 1)
            words[rng.randint(0, 29)] = w if len(w) < 3 or i % 2 else w[:at] + rng.choice("*.xq") + w[at:]
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 3 == 0)))
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    docs = frame(spark, rows)
    machine = fit(docs.where("doc_id < 400"), labels)
    got = {r["doc_id"]: r["predicted"] for r in rate(docs, machine).collect()}
    held = range(400, 600)
    assert sum(got[i] == (i % 3 == 0) for i in held) / len(held) >= 0.95
    empty = rate(frame(spark, []), fit(frame(spark, []), labels.limit(0)))
    assert empty.count() == 0
    odd = rate(frame(spark, [(None, None), (1, ""), (1, ""), (2, "clean " * 200_000)]), machine).collect()
    assert len(odd) == 4 and all(0 <= r["score"] < 0.5 for r in odd)


def test_numbers_are_no_letters(spark):
    from gnomon.llm.op3_language import words

    assert words("½ ² ① Ⅳ 12 _") == [] and words("x² Straße Ⅳth") == ["x", "straße", "th"]


def test_surrogates_keep_families_formats_and_check_digits(spark):
    import datetime

    from gnomon.llm.op5_surrogates import iban_check, luhn, names_that_meet, pseudonymise

    rows = [
        (1, "Dr. Smith met Mrs. Smith and Mr. Smith, then Jane Smith and Dr. Jane Smith"), (2, "IBAN GB82 WEST 1234 5698 7654 32 and GB83 WEST 1234 5698 7654 32"), (3, "born 1999-12-31, DOB: 4.5.1987, geboren am 31.02.1990"),
        (4, "passport no. C01234567, call 555-0199, range 555-0199"), (5, "card 4111 1111 1111 1111"), (6, None), (6, None), (7, ""), (None, "John Public"),
    ]
    got = {r["doc_id"]: r for r in pseudonymise(frame(spark, rows), "a key").collect()}
    words = re.findall(r"[^\W\d_]+", got[1]["new_text"])
    family = words[1]
    assert words == ["Dr", family, "met", "Mrs", family, "and", "Mr", family, "then", words[9], family, "and", "Dr", words[9], family] and "Smith" not in words and "Jane" not in words
    assert words[9][-1] == "a" and got[1]["n_entities"] == 5
    one, other = got[2]["new_text"].removeprefix("IBAN ").split(" and ")
    for text, valid in ((one, True), (other, False)):
        bare = text.replace(" ", "")[:22]
        assert (bare[2:4] == iban_check(bare[:2], bare[4:])) == valid and bare[:2] == "GB"
    first, second, third = (x["start"] for x in got[3]["entities"])
    datetime.date.fromisoformat(got[3]["new_text"][first : first + 10])
    assert got[3]["n_entities"] == 3 and "1999-12-31" not in got[3]["new_text"] and "31.02.1990" not in got[3]["new_text"]
    assert got[4]["n_entities"] == 2 and got[4]["new_text"].endswith("range 555-0199") and "C01234567" not in got[4]["new_text"]
    assert luhn("".join(c for c in got[5]["new_text"] if c.isdigit())) and "4111 1111" not in got[5]["new_text"]
    assert got[6]["new_text"] == "" == got[7]["new_text"] and "Public" not in got[None]["new_text"]
    assert pseudonymise(frame(spark, []), "a key").count() == 0
    names = [(i, f"Mr. {''.join(random.Random(i).choice('abcdefghijklmnop') for _ in range(6)).capitalize()}") for i in range(4000)]
    docs = frame(spark, names)
    turns, length = names_that_meet(docs, "text", "a key")
    made = [r["new_text"] for r in pseudonymise(docs, "a key").collect()]
    assert len(set(made)) == len({x for _, x in names}) and not {m.lower() for m in made} & {x.lower() for _, x in names}


def test_recall_at_the_similarity_that_makes_a_link(spark):
    """Nine of ten links at the least, for every length and kind of edit, at the similarity that just makes one."""
    from gnomon.llm.op10_near import aligned, near_groups, word_ids

    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows, kinds = [], []
    for n, pairs in ((60, 120), (150, 100), (400, 60), (1000, 30)):
        for kind in ("substituted", "mixed"):
            for _ in range(pairs):
                base, copy = [word() for _ in range(n)], []
                edits = set(rng.sample(range(n), n // 5))
                for k, w in enumerate(base):
                    how = rng.choice("sid") if kind == "mixed" else "s"
                    copy += [w] if k not in edits else [word()] if how == "s" else [w, word()] if how == "i" else []
                i = len(rows)
                rows += [(i, " ".join(base)), (i + 1, " ".join(copy))]
                kinds.append((i, n, kind))
    ids = [word_ids(t.encode().split()) for _, t in rows]
    true = [(i, n, kind) for i, n, kind in kinds if aligned(ids[i], ids[i + 1])]
    got = {r["doc_id"]: r["class_id"] for r in near_groups(frame(spark, rows)).collect()}
    assert all(x in true for x in kinds if x[2] == "substituted")
    for n in (60, 150, 400, 1000):
        for kind in ("substituted", "mixed"):
            mine = [got[i] == got[i + 1] for i, m, k in true if (m, k) == (n, kind)]
            print(f"{n} words, {kind}: recall {sum(mine) / len(mine):.3f} of {len(mine)}")
            assert len(mine) > 15 and sum(mine) / len(mine) >= 0.9, (n, kind)
    assert all(got[i] in (i, i - i % 2) for i in got)


def test_texts_under_one_id_meet_by_id_and_text(spark):
    from gnomon.llm.op10_near import near_groups

    rng = random.Random(5)
    made = [" ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(40)) for _ in range(300)]
    got = near_groups(frame(spark, [(7, t) for t in made] + [(7, made[0] + " more"), (8, made[1])])).collect()
    assert sorted((r["class_size"], r["class_id"]) for r in got) == [(1, 7)] * 298 + [(2, 7)] * 4


def test_copies_around_a_common_passage_meet_as_by_brute_force(spark, monkeypatch):
    from gnomon.llm import op10_near as op

    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(50)]
    made = []
    for i in range(80):
        own = [word() for _ in range(60)]
        made.append(own[:30] + passage + own[30:])
        if i % 2:
            made.append([word() if rng.random() < 0.08 else w for w in made[-1]])
    made += [["short", "words", "of", "one", "kind", str(i)] for i in range(30)]
    docs = frame(spark, [(i, " ".join(w)) for i, w in enumerate(made)])
    ids = [op.word_ids([x.encode() for x in w]) for w in made]
    true = list(range(len(made)))
    for i in range(len(made)):
        for j in range(i):
            if true[i] != true[j] and op.aligned(ids[i], ids[j]):
                low, high = sorted((true[i], true[j]))
                true = [low if x == high else x for x in true]
    assert len(set(true)) == 81
    # The usual way, sketches of single words, and blocks of what they leave.
    for small, block in ((op.SMALL, op.BLOCK), (10, op.BLOCK), (1, 7)):
        monkeypatch.setattr(op, "SMALL", small)
        monkeypatch.setattr(op, "BLOCK", block)
        got = {r["doc_id"]: r["class_id"] for r in op.near_groups(docs).collect()}
        assert [got[i] for i in range(len(made))] == true


def test_odd_tables_of_near_duplicates(spark):
    from gnomon.llm.op10_near import aligned, near_groups

    assert near_groups(frame(spark, [])).count() == 0
    schema = "doc_id bigint, text string, _wanted bigint, node bigint, at string, keys string, content string"
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, 5, 1, "a", "k", "c"), (1, text, 5, 1, "a", "k", "c"), (2, text + " more", 6, 2, "b", "k", "c"), (3, None, None, None, None, None, None), (None, text, 1, 1, "a", "k", "c"), (4, "", 1, 1, "a", "k", "c")], schema)
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["class_size"]) for r in near_groups(docs).collect())
    assert got == [(0, 0, 1), (1, 1, 3), (1, 1, 3), (2, 1, 3), (3, 3, 1), (4, 4, 1)]
    rng = np.random.default_rng(1)
    long = rng.integers(0, 5000, 100_000).astype(np.uint32)
    copy = long.copy()
    copy[::9] += 1
    assert aligned(long, copy) and not aligned(long, rng.integers(0, 5000, 100_000).astype(np.uint32))


def test_odd_rows_and_clashing_names_in_every_operator(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows and columns named like an operator's own."""
    import corpus_pipeline
    from gnomon.llm import op1_pieces, op3_language, op4_substrings, op5_surrogates, op6_exact, op7_decontaminate, op9_score

    extra = ["row", "_row", "_sha", "key", "id", "fp", "norm", "tag", "pos", "node", "word", "_block", "_text", "score", "sha", "n_hit", "keep", "start"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{x}` string" for x in extra)
    more = ["x"] * len(extra)
    rng = random.Random(14)
    prose_ = [" ".join("".join(rng.choice("abcdefghilmnorstu") for _ in range(5)) for _ in range(40)) for _ in range(5)]
    long = " ".join("".join(rng.choice("abcdefghilmnorstu") for _ in range(6)) for _ in range(60_000))
    rows = [(i, t, "en", "s", 1, *more) for i, t in enumerate(prose_)] + [(1, prose_[1], "en", "s", 1, *more), (None, prose_[2], None, None, None, *[None] * len(extra)), (7, None, None, None, None, *more), (8, "", "en", "s", 0, *more), (9, long, "en", "s", 1, *more)]
    docs = spark.createDataFrame(rows, schema)
    empty = docs.limit(0)
    items = spark.createDataFrame([(1, " ".join(prose_[3].split()[5:20]), "x"), (None, None, None)], "item_id bigint, text string, n_hit string")
    model = op3_language.fit(docs)
    runs = {
        "op1": lambda d: op1_pieces.encode(d, decoded=True), "op3": lambda d: op3_language.identify(d, model), "op4": op4_substrings.remove_repeats, "op5": lambda d: op5_surrogates.pseudonymise(d, "k"),
        "op6": op6_exact.exact_groups, "op7": lambda d: op7_decontaminate.find(d, items), "op9": lambda d: op9_score.score(d, d),
    }
    for name, run in runs.items():
        assert run(docs).count() == len(rows), name
        assert run(empty).count() == 0, name
    assert op7_decontaminate.find(docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert {r["doc_id"] for r in op7_decontaminate.find(docs, items).where("n_hit > 0").collect()} == {3}
    assert op3_language.identify(docs, op3_language.fit(empty)).where("lang_pred <> 'und'").count() == 0
    items.drop("n_hit").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {"language": {0, 1, 2, 3, 4, 9, None}, "exact_dedup": {0, 1, 2, 3, 4, 8, 9}, "near_dedup": {0, 1, 2, 3, 4, 7, 8, 9, None}, "decontaminate": {0, 1, 2, 4, 7, 8, 9, None}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        # Of equal texts under two ids the exact stage keeps one; a null text is an empty one.
        assert {r["doc_id"] for r in got.collect()} == kept[name], name
        assert stage(spark, empty, str(tmp_path)).count() == 0
    assert corpus_pipeline.pieces(spark, docs, "").count() == len(rows)


def test_scores_mix_the_share_of_a_word_with_the_lattice(spark):
    from gnomon.llm.op9_score import score

    docs = frame(spark, [(1, "one two two"), (2, "two three"), (3, "unseen"), (4, None)])
    got = {r["doc_id"]: r for r in score(docs, docs.where("doc_id < 3")).collect()}
    assert got[1]["n_tokens"] == 4 and got[1]["n_known"] == 4 and got[3]["n_known"] == 1 and got[4]["n_tokens"] == 1
    # An end alone is the likeliest text; what is common is likelier than what was never seen.
    assert max(got[2]["score"], got[3]["score"]) < got[4]["score"] < 0 and got[1]["score"] > 3 * got[3]["score"]
    n, v = 7, 4
    base = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    assert abs(got[1]["base_score"] - (base(1) + 2 * base(3) + base(2))) < 1e-9
