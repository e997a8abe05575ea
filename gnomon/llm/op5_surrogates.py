"""Personal data replaced by keyed surrogates of the same type and format.

Numbers, dates, addresses and keys go through a keyed permutation of all values of their format, so two of
them never share a surrogate and one has the same everywhere; check digits are made anew. Names are drawn
by a keyed hash from names built for their script, given names also for their gender. Family names know no
gender, so that Mr. and Mrs. Smith stay one family. Who is found by a full name or a title once is replaced wherever
a part of that name stands in the document. The distinct names of the corpus are checked for
surrogates that meet each other or a real name, and those draw again until none do.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
import secrets
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.llm.common import durable, only, table

#: Setting of the session that holds the key of the query; where it is unset a new one is made for the run.
KEY_SETTING = "spark.gnomon.surrogates.key"
#: Names whose first surrogate met another's and that are broadcast; beyond, all names get longer.
EXCEPTIONS = 50_000
#: Common given names, which tell a name without a title, and its gender.
MALE_GIVEN = "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Paul Steven Andrew Kenneth George Edward Brian Kevin Hans Peter Klaus Jürgen Wolfgang Stefan Andreas Jean Pierre Michel François Jacques Luis José Juan Carlos Miguel Javier Antonio Manuel Pedro Ivan Sergei Dmitri".split()
FEMALE_GIVEN = "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Margaret Sandra Jane Emily Anna Maria Ursula Monika Sabine Petra Claudia Marie Sophie Camille Isabelle Nathalie Carmen Isabel Ana Lucía Elena Olga Natalia Tatiana".split()
_GIVEN = rf"\b(?:{'|'.join([*MALE_GIVEN, *FEMALE_GIVEN])}) "
#: Words after a given name that make it a place or an institution, not a person.
PLACES = "Street St Road Avenue Lane Square Bridge Church Hospital University College School Airport Station River Park Bay Island Hall Prize Award Foundation Institute".split()
_TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Lady|Herr|Frau|Monsieur|Madame|Mme|Mlle|Señora|Señor|Sra|Sr|Don|Doña|Господин|Госпожа"
_LOUD = "MR|MRS|MS|MISS|DR|PROF|HERR|FRAU"
ENTITY = re.compile(
    r"(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|(?P<secret>\bAKIA[0-9A-Z]{16}\b|\b(?:ghp|gho|sk|pk|xox[abp])[_-][A-Za-z0-9_-]{16,}|\b[0-9a-f]{32,64}\b|(?<=password=)\S+|(?<=passwd=)\S+|(?<=api_key=)\S+|(?<=secret=)\S+|(?<=token=)\S+)"
    r"|(?:\b(?:password|passwd|api[_-]?key|secret|token)[\"']?\s?: ?[\"']?(?P<assigned>(?=[^\s\"',]*\d)[^\s\"',]{8,}))"
    r"|(?P<ip6>(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]{0,38}[0-9A-Fa-f])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![\w:]))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?:\b(?:[Bb]orn(?: on)?|DOB|[Dd]ate of [Bb]irth|[Gg]eboren(?: am)?|[Nn]ée? le|[Nn]acid[oa] el)[: ]+(?P<birth>\d{4}-\d{2}-\d{2}|\d{1,2}[./-]\d{1,2}[./-]\d{4})(?!\d))"
    r"|(?:\b[Pp]as(?:sport|seport|aporte|s)\b(?: ?(?:[Nn]o|[Nn]umber|[Nn]umero|[Nn]úmero|[Nn]r)\b\.?)?[:# ]+(?P<passport>[A-Z]{0,2}\d{6,9})\b)"
    r"|(?:\b(?:[Tt]el|[Pp]hone|[Cc]all|[Ff]ax|[Mm]obile)\b[.:]? ?(?P<local>\d{3}[ .-]\d{4})(?![\d-]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\d-]))"
    r"|(?P<phone>(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\d)(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\d))"
    rf"|\b(?P<title>{_TITLES})\b\.? (?P<name>[^\W\d_]+(?:[ -][^\W\d_]+)?)"
    rf"|\b(?P<loud>{_LOUD})\b\.? (?P<shout>[A-ZÀ-ÖØ-Þ]{{2,}}(?:[ -][A-ZÀ-ÖØ-Þ]{{2,}})?)"
    rf"|(?P<person>{_GIVEN}(?!(?:{'|'.join(PLACES)})\b)[A-ZÀ-ÖØ-Þ][^\W\d_]+)"
)
#: A superset of ENTITY: whatever has an entity has one of these.
_HINT = re.compile(rf"[0-9@]|::|(?:password|passwd|api_key|secret|token)=|\b(?:AKIA|(?:ghp|gho|sk|pk|xox[abp])[_-])|[a-f]{{32}}|\b(?:{_TITLES}|{_LOUD})\b|" + _GIVEN)
_WORD = re.compile(r"[^\W\d_]+")
FEMALE = {"Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Госпожа"}
NEUTRAL = {"Dr", "Prof"}
#: Titles that stand before a given name.
BEFORE_GIVEN = {"Sir", "Lady", "Don", "Doña"}
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Parts of made names by script: beginnings and middles, then endings of male and of female names.
PARTS = {
    "latin": ([c + v for c in "bdfgklmnprstv" for v in "aeiou"], ["n", "r", "s", "l", "m", "d"], ["na", "ra", "sa", "la", "ma", "da"]),
    "cyrillic": ([c + v for c in "бвдгклмнпрст" for v in "аеиоу"], ["н", "р", "с", "л", "м", "д"], ["на", "ра", "са", "ла", "ма", "да"]),
    "greek": ([c + v for c in "βγδκλμνπρστ" for v in "αειοω"], ["ος", "ης", "ας", "ων"], ["α", "η", "ια", "ω"]),
    "han": (list("安伯成大德方高国海和建江金立林明平文新永"), list("强刚军伟"), list("芳丽娜静")),
}


def permuted(value: int, size: int, key: bytes) -> int:
    """A keyed permutation of range(size): a Feistel network, walked until it lands inside."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for r in range(6):
            f = hashlib.blake2b(right.to_bytes(width, "big"), key=key, salt=bytes([r]), digest_size=min(64, width + 8)).digest()
            left, right = right, left ^ int.from_bytes(f, "big") & mask
        value = left << half | right
        if value < size:
            return value


def reshaped(text: str, what: str, key: str, keep: int = 0) -> str:
    """Letters and digits of text permuted together within their kinds; the first `keep` stay."""
    kinds = [a for c in text for a in (DIGITS, LOWER, UPPER) if c in a]
    places = [i for i, c in enumerate(text) if c in DIGITS or c in LOWER or c in UPPER][keep:]
    kinds = kinds[keep:]
    if not places:
        return text
    value, size = 0, 1
    for i, a in zip(places, kinds, strict=True):
        value, size = value * len(a) + a.index(text[i]), size * len(a)
    shape = what + "".join(a[0] for a in kinds)
    value = permuted(value, size, hashlib.blake2b(f"{key}|{shape}".encode(), digest_size=32).digest())
    out = list(text)
    for i, a in zip(reversed(places), reversed(kinds), strict=True):
        value, k = divmod(value, len(a))
        out[i] = a[k]
    return "".join(out)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def refilled(text: str, digits: str) -> str:
    """text with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c in DIGITS else c for c in text)


def iban_check(country: str, body: str) -> str:
    """The two check digits of an IBAN."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def dated(text: str, key: str) -> str:
    """Another day of the two centuries from 1900 in the same format; other digits where it is no such day."""
    parts = re.split("([./-])", text)
    year_first = len(parts[0]) == 4
    y, m, d = (int(parts[k]) for k in ((0, 2, 4) if year_first else (4, 2, 0)))
    first, end = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal()
    american = not year_first and m > 12 >= d
    try:
        day = datetime.date(y, d, m) if american else datetime.date(y, m, d)
    except ValueError:
        return reshaped(text, "no day", key)
    if not first <= day.toordinal() < end:
        return reshaped(text, "no day", key)
    new = datetime.date.fromordinal(first + permuted(day.toordinal() - first, end - first, hashlib.blake2b(f"{key}|day".encode(), digest_size=32).digest()))
    values = (new.year, new.month, new.day) if year_first else (new.month, new.day, new.year) if american else (new.day, new.month, new.year)
    return "".join(x if i % 2 else f"{values[i // 2]:0{len(x)}d}" for i, x in enumerate(parts))


def surrogate(what: str, text: str, key: str) -> str:
    """The surrogate of anything but a name."""
    if what == "birth":
        return dated(text, key)
    if what == "iban":
        bare = text.replace(" ", "")
        country, check, body = bare[:2], bare[2:4], bare[4:]
        valid = check == iban_check(country, body)
        if valid:
            body = reshaped(body, f"iban{country}", key)
            new = country + iban_check(country, body) + body
        else:
            new = country + reshaped(check + body, f"iban-{country}", key)
            while new[2:4] == iban_check(country, new[4:]):  # still a permutation of those that fail the check
                new = country + reshaped(new[2:], f"iban-{country}", key)
        it = iter(new)
        return "".join(c if c == " " else next(it) for c in text)
    if what == "email":
        local, _, host = text.partition("@")
        labels = host.split(".")
        changed = reshaped(f"{local}@{'.'.join(labels[:-1])}".lower(), what, key)
        cased = "".join(c.upper() if o.isupper() else c for c, o in zip(changed, text, strict=False))
        return f"{cased}.{labels[-1]}"
    if what == "ip":
        value = 0
        for x in text.split("."):
            value = value << 8 | int(x)
        value = permuted(value, 1 << 32, hashlib.blake2b(f"{key}|ip".encode(), digest_size=32).digest())
        return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
    if what == "ip6":
        value = permuted(int(ipaddress.IPv6Address(text)), 1 << 128, hashlib.blake2b(f"{key}|ip6".encode(), digest_size=32).digest())
        new = str(ipaddress.IPv6Address(value))
        return new.upper() if text.upper() == text else new
    if what == "card":
        digits = "".join(c for c in text if c in DIGITS)
        if not luhn(digits):
            changed = reshaped(digits, "card-", key, 1)
            while luhn(changed):  # still a permutation of the numbers that fail the check
                changed = reshaped(changed, "card-", key, 1)
            return refilled(text, changed)
        body = reshaped(digits[:-1], "card", key, 1)
        return refilled(text, body + next(d for d in DIGITS if luhn(body + d)))
    if what in ("phone", "local"):
        digits = "".join(c for c in text if c in DIGITS)
        own = digits[-10:]
        # The first digit of the national number stays, so that it remains one that can be dialled.
        return refilled(text, digits[: -len(own)] + reshaped(own, "phone", key, 1))
    if what == "secret" and re.fullmatch("[0-9a-f]+", text):
        value = permuted(int(text, 16), 16 ** len(text), hashlib.blake2b(f"{key}|hex{len(text)}".encode(), digest_size=32).digest())
        return f"{value:0{len(text)}x}"
    return reshaped(text, what, key, 4 if what == "secret" and text.startswith("AKIA") else 0)


def script(word: str) -> str:
    c = ord(word[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "han" if 0x3400 <= c < 0xA000 else "latin"


def name_surrogate(word: str, kind: str, turn: int, key: str, length: int = 3) -> str:
    """A made name for a lower-case word that is a male ("m") or female ("f") given name or a family name ("s");
    other turns give other names."""
    parts, male, female = PARTS[script(word)]
    value = int.from_bytes(hashlib.blake2b(f"{kind}|{turn}|{word}".encode(), key=hashlib.blake2b(key.encode(), digest_size=32).digest(), digest_size=16).digest(), "big")
    out = ""
    for _ in range(length):
        value, k = divmod(value, len(parts))
        out += parts[k]
    ends = female if kind == "f" else male
    return out + ends[value % len(ends)]


_MALE, _FEMALE = ({x.lower() for x in names} for names in (MALE_GIVEN, FEMALE_GIVEN))


def names_in(m: re.Match[str]) -> list[tuple[str, str]]:
    """Words of a matched name in order, and what each is: "m", "f", "s", or "" for a word in small letters, which
    is no name. The last of several words, and a word alone but for a few titles, is a family name."""
    title = m["title"] or (m["loud"] or "").capitalize() or None
    words = re.split("[ -]", m[name_of(m)])
    named = [w[:1].isupper() or script(w) == "han" for w in words]
    last = max((i for i, x in enumerate(named) if x), default=0)
    out = []
    for i, (w, is_name) in enumerate(zip(words, named, strict=True)):
        low = w.lower()
        given = "f" if title in FEMALE else "m" if title and title not in NEUTRAL else "f" if low in _FEMALE or low not in _MALE and low[-1:] in "aа" else "m"
        family = i == last and not (sum(named) == 1 and title in BEFORE_GIVEN)
        out.append((w, "" if not is_name else "s" if family else given))
    return out


def name_of(m: re.Match[str]) -> str:
    """The group that holds a name; empty where the entity is none."""
    return next((k for k in ("name", "shout", "person") if m[k] is not None), "")


def in_text(text: str) -> Iterator[re.Match[str]]:
    """Entities in order. Six groups of digits and two colons may be no address, and are left."""
    if text and _HINT.search(text):
        for m in ENTITY.finditer(text):
            if m["ip6"] is None or is_address(m["ip6"]):
                yield m


def is_address(text: str) -> bool:
    try:
        return bool(ipaddress.IPv6Address(text))
    except ValueError:
        return False


def parts_of_names(found: list[re.Match[str]]) -> dict[str, str]:
    """Words in small letters of the names found in a text, and what each is there: what it is most often, a family
    name where that is even."""
    seen: Counter[tuple[str, str]] = Counter()
    for m in found:
        if name_of(m):
            seen.update((w.lower(), kind) for w, kind in names_in(m) if kind and len(w) > 1)
    out: dict[str, str] = {}
    for (w, kind), _ in sorted(seen.items(), key=lambda x: (x[1], x[0][1] == "s", x[0][1])):
        out[w] = kind
    return out


def replaced(text: str, key: str, turns: dict[tuple[str, str], int], length: int) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with surrogates, and type, start and end of each entity in the text as it was."""
    out, spans, at = [], [], 0
    found = list(in_text(text))
    parts = parts_of_names(found)

    def cased(w: str, kind: str) -> str:
        made = name_surrogate(w.lower(), kind, turns.get((kind, w.lower()), 0), key, length)
        return made.upper() if w.isupper() and len(w) > 1 else made.capitalize()

    def again(start: int, end: int) -> None:
        """What stands between entities, with parts of the document's names replaced too."""
        begun = start
        for m in _WORD.finditer(text, start, end) if parts else ():
            kind = parts.get(m[0].lower())
            if kind and (m[0][:1].isupper() or script(m[0]) == "han"):
                out.extend((text[begun : m.start()], cased(m[0], kind)))
                spans.append(("name", *m.span()))
                begun = m.end()
        out.append(text[begun:end])

    for m in found:
        where = name_of(m)
        if where:
            what, (start, end) = "name", m.span(where)
            known = names_in(m)
            if not any(kind for _, kind in known):
                continue
            while not known[-1][1]:
                end -= len(known.pop()[0]) + 1
            new = []
            for w, kind in known:
                new.append(cased(w, kind) if kind else w)
            between = re.findall("[ -]", m[where])[: len(known) - 1]
            new = "".join(x for pair in zip(new, [*between, ""], strict=True) for x in pair)
        else:
            what = m.lastgroup
            start, end = m.span(what)
            new = surrogate("secret" if what == "assigned" else what, m[what], key)
            what = {"local": "phone", "assigned": "secret", "ip6": "ip"}.get(what, what)
        again(at, start)
        out.append(new)
        spans.append((what, start, end))
        at = end
    again(at, len(text))
    return "".join(out), spans


def names_that_meet(df: DataFrame, text: str, key: str) -> tuple[dict[tuple[str, str], int], int]:
    """Turns of the names whose surrogates met another or a real name, and the length of made names. All names are
    checked; only those that have to draw again come to the driver, EXCEPTIONS at most."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {(w.lower(), kind) for t in batch.column(0).to_pylist() for m in in_text(t or "") if name_of(m) for w, kind in names_in(m) if kind}
            rows = sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([g for _, g in rows], pa.string())], ["word", "gender"])

    names = durable(only(df, text).mapInArrow(find, "word string, gender string").distinct().withColumn("turn", F.lit(0)))
    for length in range(3, 12):
        state = names
        while True:

            def make(batches: Iterator[pa.RecordBatch], n: int = length) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    made = [name_surrogate(w, g, t, key, n) for w, g, t in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)]
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], ["word", "gender", "turn", "made"])

            drawn = state.mapInArrow(make, "word string, gender string, turn int, made string")
            first = drawn.groupBy("made").agg(F.min(F.struct("turn", "word", "gender")).alias("first"), F.count("*").alias("n"))
            real = names.select(F.col("word").alias("made"), F.lit(True).alias("real")).distinct()
            # A real name is nobody's surrogate, so even the first that drew it draws again.
            first = first.join(real, "made", "left").where("n > 1 OR real").select("made", F.when(F.col("real").isNull(), F.col("first")).otherwise(F.struct(F.lit(-1).alias("turn"), F.lit("").alias("word"), F.lit("").alias("gender"))).alias("first"))
            again = drawn.join(first, "made", "left").select("word", "gender", F.when(F.col("first").isNotNull() & ((F.col("first.word") != F.col("word")) | (F.col("first.gender") != F.col("gender"))), F.col("turn") + 1).otherwise(F.col("turn")).alias("turn"), F.col("first").isNotNull().alias("met"))
            state = durable(again)
            meeting = state.where("met").limit(1).count()
            state = state.drop("met")
            if not meeting:
                break
            if state.where("turn > 0").count() > EXCEPTIONS:
                break
        if not meeting and state.where("turn > 0").count() <= EXCEPTIONS:
            return {(r["gender"], r["word"]): r["turn"] for r in state.where("turn > 0").collect()}, length
    raise ValueError("too many names meet")


def pseudonymise(df: DataFrame, key: str, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keys, text with surrogates, n_entities and entities (type, start, end in the text as it was).

    A null text counts as empty; very long texts are read whole, other columns are not read. Repeated rows and null
    keys stay; an empty table gives an empty one. One entity has one surrogate in all rows, and two entities never
    share one; no made name is a name of the corpus. Whoever has the key can undo the permutations: it is the
    caller's to choose and to keep, and with another key all surrogates are others. What is found are the formats and titles of ENTITY and names that begin with
    one of the common given names; it is no general recogniser of names.
    """
    own, n = only(df, *keys, text), len(keys)
    shared = df.sparkSession.sparkContext.broadcast(names_that_meet(df, text, key))
    schema = ", ".join([*(f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keys), "new_text string, n_entities bigint, entities array<struct<type:string,start:bigint,end:bigint>>"])
    kind = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns, length = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                done = [replaced(t or "", key, turns, length) for t in batch.column(n).to_pylist()]
                spans = [[{"type": k, "start": a, "end": b} for k, a, b in s] for _, s in done]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array([t for t, _ in done], pa.string()), pa.array([len(s) for s in spans], pa.int64()), pa.array(spans, kind)], [*keys, "new_text", "n_entities", "entities"])

    return own.mapInArrow(run, schema)


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, under the key that the session's KEY_SETTING holds. Null and
    empty texts are empty, repeated rows stay and are changed alike, an empty table gives an empty one."""
    key = spark.conf.get(KEY_SETTING, None) or secrets.token_hex(16)
    return pseudonymise(table(spark, sf_dir, "documents"), key).select("doc_id", F.col("new_text").alias("text"), "n_entities", "entities")
