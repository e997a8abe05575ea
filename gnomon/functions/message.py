"""Fields of nested messages: one path of lists and keys, null where any hop of it is not there."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gnomon.operators.tables import once

c = F.col


def parsed(text: Column) -> Column:
    """A message as a variant; null where the text is no JSON."""
    return F.try_parse_json(text)


def path(*hops: int | str) -> str:
    """The path of list places (from 0) and keys; a key can hold one kind of quotes, not both."""
    out = "$"
    for x in hops:
        quote = '"' if isinstance(x, str) and "'" in x else "'"
        if isinstance(x, str) and quote in x:
            raise ValueError(f"no path can name the key {x}")
        out += f"[{x}]" if isinstance(x, int) else f"[{quote}{x}{quote}]"
    return out


def field(message: Column, *hops: int | str, kind: str = "string") -> Column:
    """What a path of a parsed message leads to. A missing place or key, a hop into a value that is neither list nor
    map, a JSON null and a value of another kind are all null."""
    return F.try_variant_get(message, path(*hops), kind)


#: Where a response says what was found, and where its orientation and depth are.
CODE, FOUND = (1, 0, 0, 0), (1, 3)
HEADING, PITCH, ROLL, PAYLOAD = ((1, 0, 5, 0, 1, 2, 0), (1, 0, 5, 0, 1, 2, 1), (1, 0, 5, 0, 1, 2, 2), (1, 0, 5, 0, 5, 1, 2))


def responses(df: DataFrame, text: str = "response") -> DataFrame:
    """df with found, heading, pitch and roll (radians; the pitch is a quarter turn less the stored one), payload of the
    depth data and error. A response without a code is none that is known, which is an error and not "not found"; an
    empty payload is none."""
    own = once(df, {"_message": parsed(c(text))})
    own = once(own, {"_code": field(c("_message"), *CODE, kind="bigint")})
    real = lambda at: F.when(c("found"), field(c("_message"), *at, kind="double"))
    turn = math.pi / 180.0
    own = own.withColumns({"found": F.coalesce(c("_code").isin(*FOUND), F.lit(False)), "error": F.when(c("_code").isNull(), "unknown response")})
    made = {"heading": real(HEADING) * turn, "pitch": (90.0 - real(PITCH)) * turn, "roll": real(ROLL) * turn, "payload": F.when(c("found"), F.nullif(field(c("_message"), *PAYLOAD), F.lit("")))}
    return own.withColumns(made).drop("_message", "_code")
