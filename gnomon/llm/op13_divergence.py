"""Divergence of sources by joint histograms of counts.

Each language keeps the terms in enough of its documents; a group (language and source) gives every kept term a
smoothed share of its tokens. How far two groups of a language are apart is a sum over all kept terms of a
function of the two shares, and a share depends on the term's count alone. So the sum needs no row for each
term: the joint histogram of two groups tells how many terms have each (count, count), and the function is
evaluated once for each such combination, times its multiplicity.

Tasks tally combinations of the terms that both groups have. Terms that one of them lacks are implied: the
group's own histogram less what the tally has of it, and terms that both lack are the rest of the vocabulary.
Tallies carry these differences along as cells with a negative multiplicity, so one sum by combination adds
everything up. A term has at most one count for each source of its language; pairs of sources are what
the audit returns, so their number is that of its rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gnomon.llm.common import ASCII_UPPER, durable, only, table, texts

#: Documents of a language that a term has to be in, ranks of terms, the pseudo-count and the unit of shares.
LEAST_DOCS, TOP, PSEUDO, UNIT = 30, 50, 5, 1_000_000_000
#: Different terms held in a task before they are handed on, and pairs of counts tallied at once.
HELD, PAIRS = 400_000, 1_000_000
#: For bytes.translate: A-Z in lower case, other letters and bytes beyond ASCII as they are, the rest blank.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
c = F.col


def term_counts(df: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (rows with it); a row with an empty term names each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter[bytes], Counter[bytes]]] = {}
        for batch in batches:
            for lang_, source_, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), strict=True):
                n, docs = held.setdefault((lang_, source_), (Counter({b"": 0}), Counter()))
                own = Counter(t.translate(TERMS).split())
                n.update(own)
                docs.update(own.keys())
            if sum(len(n) for n, _ in held.values()) > HELD:
                yield out(held)
                held = {}
        yield out(held)

    def out(held: dict) -> pa.RecordBatch:
        rows = [(*k, term, n, docs[term]) for k, (ns, docs) in held.items() for term, n in ns.items()]
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], ["lang", "source", "term", "n", "docs"])

    own = only(df, *dict.fromkeys((lang, source, text)))
    blank = lambda x: F.coalesce(F.col(f"`{x}`").cast("string"), F.lit(""))
    made = own.select(blank(lang).alias("lang"), blank(source).alias("source"), blank(text).alias("text")).mapInArrow(run, "lang string, source string, term binary, n bigint, docs bigint")
    return made.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def tallied(kept: DataFrame) -> DataFrame:
    """lang, a, b (sources, a < b), x, y (their counts of a term) and m, how many terms have both: for terms that both
    have (x, y > 0), and less as many for the cells that each has without the other and for those of neither."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            edges = lists.offsets.to_numpy().astype(np.int64)
            rows = lists.flatten()
            sources, n = rows.field(0).dictionary_encode(), rows.field(1).to_numpy()
            langs = batch.column(0).dictionary_encode()
            size = np.diff(edges)
            lang = np.repeat(langs.indices.to_numpy(), size)
            # Entry i of a term meets those after it.
            left = np.repeat(edges[1:] - edges[0], size) - np.arange(len(n)) - 1
            ends, at = np.cumsum(left), 0
            while at < len(n):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
                first = np.repeat(np.arange(at, to), left[at:to])
                if len(first):
                    second = first + 1 + np.arange(len(first)) - np.repeat(ends[at:to] - left[at:to] - (ends[at - 1] if at else 0), left[at:to])
                    code = sources.indices.to_numpy()
                    yield cells(lang[first], code[first], code[second], n[first], n[second], langs.dictionary, sources.dictionary)
                at = to

    def cells(lang: np.ndarray, a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, langs: pa.Array, sources: pa.Array) -> pa.RecordBatch:
        one, m = grouped([lang, a, b, x, y], np.ones(len(a), np.int64))
        lang, a, b, x, y = one
        zero = np.zeros_like(x)
        parts = [(one, m)]
        for keys, sign in (([lang, a, b, x, zero], -1), ([lang, a, b, zero, y], -1), ([lang, a, b, zero, zero], 1)):
            parts.append(grouped(keys, sign * m))
        lang, a, b, x, y = (np.concatenate([p[0][i] for p in parts]) for i in range(5))
        made = [langs.take(pa.array(lang)), sources.take(pa.array(a)), sources.take(pa.array(b)), pa.array(x), pa.array(y), pa.array(np.concatenate([p[1] for p in parts]))]
        return pa.RecordBatch.from_arrays(made, ["lang", "a", "b", "x", "y", "m"])

    # Sorted by source, so that the smaller one comes first in every pair.
    return kept.select("lang", F.array_sort("counts").alias("counts")).mapInArrow(run, "lang string, a string, b string, x bigint, y bigint, m bigint")


def grouped(keys: list[np.ndarray], m: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of keys, and the sum of m of each."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.append(True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))
    starts = np.flatnonzero(new)
    return [k[starts] for k in keys], np.add.reduceat(m[order], starts)


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + PSEUDO) / (total + PSEUDO * terms)), exact; null without terms."""
    top, bottom = count + PSEUDO, F.nullif(total + PSEUDO * terms, F.lit(0))
    wide = lambda x: x.cast("decimal(20,0)")
    small = F.call_function("div", top * UNIT, bottom)
    large = F.call_function("div", wide(top) * F.lit(UNIT).cast("decimal(10,0)"), wide(bottom))
    return F.when(terms > 0, 1 + F.when(top < 9 * 10**9, small).otherwise(large))


def divergence(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: of every group its distance from each other source of its language
    (part pair), and its `top` terms that are commoner in it than in the language (part term).

    A null text, lang or source is an empty one; a group counts though it has no terms. Repeated rows count as often
    as they come, texts are read whole, other columns are not read, ties go by item, and an empty table gives an empty
    one. Where a language keeps no term its distances are 0."""
    counts = durable(term_counts(df, text, lang, source))
    whole = counts.where("term <> X''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"), F.collect_list(F.struct("source", "n")).alias("counts"))
    kept = durable(whole.where(c("docs") >= least_docs).select("lang", c("term").cast("string").alias("term"), "n_lang", "counts"))
    own = kept.select("lang", "term", "n_lang", F.inline("counts"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("lang_total"))
    held = own.groupBy("lang", "source").agg(F.count("*").alias("held"), F.sum("n").alias("total"))
    zero = lambda x: F.coalesce(x, F.lit(0).cast("bigint")).alias(x)
    groups = durable(counts.where("term = X''").select("lang", "source").join(held, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", *map(zero, ("held", "total", "terms", "lang_total"))))
    pair = pairs_apart(kept, own, groups)
    shares = own.join(groups, ["lang", "source"]).select("lang", "source", c("term").alias("item"), (share(c("n"), c("total"), c("terms")) - share(c("n_lang"), c("lang_total"), c("terms"))).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    named = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank)
    return named(pair, "pair").unionByName(named(shares.where("value > 0"), "term").where(c("rank") <= top))


def pairs_apart(kept: DataFrame, own: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source of the language) and value, both ways round."""
    side = lambda k: groups.select("lang", *(c(x).alias(f"{k}_{x}" if x != "source" else k) for x in ("source", "held", "total")))
    both = side("a").join(side("b"), "lang").where("a < b").join(groups.groupBy("lang").agg(F.max("terms").alias("terms")), "lang")
    # Terms by their count in each group, as if no other group had them; the tally takes back those that have.
    histogram = own.groupBy("lang", "source", "n").agg(F.count("*").alias("m"))
    none = F.lit(0).cast("bigint")
    cell = lambda x, y, m: ("lang", "a", "b", x.alias("x"), y.alias("y"), m.alias("m"))
    in_a = both.select("lang", "a", "b").join(histogram.withColumnRenamed("source", "a"), ["lang", "a"]).select(*cell(c("n"), none, c("m")))
    in_b = both.select("lang", "a", "b").join(histogram.withColumnRenamed("source", "b"), ["lang", "b"]).select(*cell(none, c("n"), c("m")))
    rest = both.select(*cell(none, none, c("terms") - c("a_held") - c("b_held")))
    joint = tallied(kept).unionByName(in_a).unionByName(in_b).unionByName(rest).groupBy("lang", "a", "b", "x", "y").agg(F.sum("m").alias("m")).where("m <> 0 OR x = 0 AND y = 0")
    gap = F.abs(share(c("x"), c("a_total"), c("terms")) - share(c("y"), c("b_total"), c("terms")))
    apart = joint.join(both, ["lang", "a", "b"]).groupBy("lang", "a", "b").agg(F.coalesce(F.sum(gap * c("m")), none).alias("value"))
    ways = F.array(F.struct(c("a").alias("source"), c("b").alias("item")), F.struct(c("b").alias("source"), c("a").alias("item")))
    return apart.select("lang", "value", F.inline(ways)).select("lang", "source", "item", "value")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of all groups of documents, and the terms that tell each."""
    return divergence(table(spark, sf_dir, "documents"))


_SHARE = f"1 + ({UNIT} * ({{0}} + {PSEUDO})) // ({{1}} + {PSEUDO} * {{2}})"
ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
grp AS (SELECT DISTINCT lang, source FROM d),
occ AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
own AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cell AS (
  SELECT g.lang, g.source, k.term, k.n AS n_lang, coalesce(o.n, 0) AS n
  FROM grp g JOIN kept k ON k.lang = g.lang LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
tot AS (SELECT lang, source, sum(n) AS n FROM cell GROUP BY ALL),
p AS (
  SELECT c.lang, c.source, c.term, c.n, {_SHARE.format('c.n', 't.n', 'v.v')} AS p, {_SHARE.format('c.n_lang', 'v.n', 'v.v')} AS q
  FROM cell c JOIN tot t ON t.lang = c.lang AND t.source = c.source JOIN v ON v.lang = c.lang),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
term AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (FROM pair UNION ALL FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
