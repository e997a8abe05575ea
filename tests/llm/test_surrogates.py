"""Coreference, loud titles, addresses and assigned secrets of the surrogates."""

from __future__ import annotations

import ipaddress
import random
import re

DOCS = "doc_id bigint, text string, start string"


def changed(spark, texts):
    from gnomon.llm.op5_surrogates import pseudonymise

    rows = [(i, t, "x") for i, t in enumerate(texts)]
    return {r["doc_id"]: r for r in pseudonymise(spark.createDataFrame(rows, DOCS), "a key").collect()}


def test_parts_of_a_name_go_wherever_they_stand(spark):
    texts = [
        "Jane Roe met John Public and Jane again", "Robert Miller called. Miller said no, and MILLER's dog too.", "Mr. Smith spoke to Smith", "MR. SMITH and Smith and Mr. Smith", "Paul Street is closed, and so is Maria Hospital", "A miller and a smith, as Miller is a trade",
        "DR SMITH-JONES left; Jones came back", "Frau Özil und Özil", "Maria Anna met Anna Maria",
    ]
    got = {i: r["new_text"] for i, r in changed(spark, texts).items()}
    words = {i: re.findall(r"[^\W\d_]+", t) for i, t in got.items()}
    assert words[0][0] == words[0][6] and not {"Jane", "Roe", "John", "Public"} & set(words[0])
    assert words[1][1] == words[1][3] == words[1][7].capitalize() and words[1][7].isupper() and "iller" not in got[1].lower()
    assert words[2][1] == words[2][4] and words[3][1] == words[3][3].upper() == words[3][6].upper() and words[3][3] == words[2][1]
    assert got[4] == texts[4] and got[5] == texts[5]
    assert words[6][2] == words[6][4].upper() and words[7][1] == words[7][3] and "zil" not in got[7]
    assert not {"Maria", "Anna"} & set(words[8])


def test_addresses_and_secrets_of_other_forms(spark):
    texts = ["from 2001:db8::8a2e:370:7334 and 2001:DB8:0:0:0:0:0:1 at 12:34:56", "api_key: a8Zk29dkQpLm", "\"token\": \"xyz123uvw456\"", "the secret: he never came", "password: correcthorse", "a::b and std::vector<int> x; fe80::1"]
    got = {i: r["new_text"] for i, r in changed(spark, texts).items()}
    first, second = re.findall(r"[0-9A-Fa-f:]{12,}", got[0])
    assert ipaddress.IPv6Address(first) and ipaddress.IPv6Address(second) and "db8" not in got[0].lower() and second == second.upper() and got[0].endswith("at 12:34:56")
    assert re.fullmatch(r"api_key: [a-z]\d[A-Z][a-z]\d\d[a-z]{2}[A-Z][a-z][A-Z][a-z]", got[1]) and "a8Zk" not in got[1]
    assert re.fullmatch(r'"token": "[a-z]{3}\d{3}[a-z]{3}\d{3}"', got[2]) and got[2] != texts[2]
    assert got[3] == texts[3] and got[4] == texts[4]
    assert "std::vector<int>" in got[5] and "fe80::1" not in got[5]


def test_no_part_of_a_found_name_is_left(spark):
    """Brute force: every word of every name that a text is made with, against the words of the result."""
    from gnomon.llm.op5_surrogates import FEMALE_GIVEN, MALE_GIVEN

    rng = random.Random(9)
    plain = "the house by river was sold then someone came and went home again".split()
    family = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3)).capitalize() for _ in range(40)]
    texts, names = [], []
    for _ in range(400):
        people = [(rng.choice(MALE_GIVEN + FEMALE_GIVEN), rng.choice(family)) for _ in range(rng.randint(1, 3))]
        words = [f"{a} {b}" for a, b in people] + [x for a, b in people for x in rng.sample([a, b, b.upper(), f"Mr. {b}", f"DR {b.upper()}", f"{b}'s", f"({a})"], 3)] + [rng.choice(plain) for _ in range(12)]
        rng.shuffle(words)
        texts.append(", ".join(words))
        names.append({x for p in people for x in p})
    got = changed(spark, texts)
    for i, own in enumerate(names):
        left = set(re.findall(r"[^\W\d_]+", got[i]["new_text"]))
        assert not {x for w in own for x in (w, w.upper())} & left, (texts[i], got[i]["new_text"])
        # Small words stay, in their order, and spans are those of the text as it was.
        small = lambda t: [w for w in re.findall(r"[^\W\d_]+", t) if w in plain]
        assert small(got[i]["new_text"]) == small(texts[i])
        assert all(texts[i][x["start"] : x["end"]].lower().strip("'s") for x in got[i]["entities"])
        ends = [0, *(x["end"] for x in got[i]["entities"])]
        assert all(x["start"] >= e for x, e in zip(got[i]["entities"], ends, strict=False))
