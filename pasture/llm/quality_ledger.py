"""Quality rules with a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and one bit per failed rule; a policy is
a versioned set of rules, applied to the stored bits, and ablations (what a rule costs, alone and beside the others)
are sums over the same bits.  A new policy never rereads a text.

All of it is row-local DataFrame code: no shuffle, no Python on the executors.  Repeated three-word windows are found by
sorting a document's window hashes, so a long text costs n log n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasture.llm.scratch import kept, pick

SPACE = " \t\n\x0b\x0c\r"
_GAP = "[ \\t-\\r]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: name -> failure condition over the measurements; the position is the rule's bit.
RULES: dict[str, Column | str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 4 * word_chars",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "long_words": "word_chars > 15 * n_words",
    "short_words": "word_chars < 2 * n_words",
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}

#: Versioned policies: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "2024-1": ("few_words", "repeated_words", "symbols", "repeated_lines", "long_words", "short_words"),
}
BASE = "base"
CURRENT = "2024-1"


def mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, ledger) per row of ``docs``: its columns as one struct, and its measurements and ``fail_bits``.

    Null texts measure as empty ones.  The input's own columns, whatever their names, cannot clash.
    """
    d = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    bare = F.btrim("t", F.lit(SPACE))
    d = d.select(
        "row",
        F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, _GAP)).alias("words"),
        F.length(_without(F.col("t"), SPACE)).cast("bigint").alias("word_chars"),
        (F.length("t") - F.length(_without(F.col("t"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0).alias("lines"))
    d = d.withColumns({"n_words": F.size("words").cast("bigint"), "n_lines": F.size("lines").cast("bigint"),
                       "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint")})
    grams = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    d = d.withColumn("grams", F.slice(grams, 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))))
    # (hash, position) in order: equal windows become neighbours
    d = d.withColumn("sorted", F.when(
        F.size(F.array_distinct("grams")) < F.size("grams"),
        F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    again = F.filter("sorted", lambda e, k: e["g"].eqNullSafe(F.get("sorted", k - 1)["g"])
                     | e["g"].eqNullSafe(F.get("sorted", k + 1)["g"]))
    d = d.withColumn("hits", F.sort_array(F.transform(again, lambda e: e["i"])))
    # each repeated window covers three words, less what the next one covers
    new = F.transform("hits", lambda p, k: F.coalesce(
        F.least(F.get("hits", k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    d = d.withColumn("n_repeat_words", F.coalesce(F.aggregate(new, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint"))
    d = d.select("row", *MEASURES)
    bits = F.lit(0)
    for name, fails in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(fails) if isinstance(fails, str) else fails, BIT[name]).otherwise(0))
    return d.select("row", F.struct(*MEASURES, bits.alias("fail_bits")).alias("ledger"))


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements, fail_bits) per row of ``docs`` (doc_id, text); repeated rows each return a row."""
    return measured(pick(docs, doc_id="bigint", text="string")).select("row.doc_id", "ledger.*")


def passes(bits: Column, policy: str) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy))) == 0


def verdicts(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under one policy version; reads bits only."""
    return book.withColumns({"base_failed": ~passes(F.col("fail_bits"), BASE),
                             "kept": passes(F.col("fail_bits"), BASE) & passes(F.col("fail_bits"), policy)})


def ablations(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """(rule, n_failed, n_only): documents each rule of a policy fails, and those that only it fails, which leaving
    it out would bring back.  One aggregate over the bits; a row per rule, with zeros for an empty ledger."""
    own = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)))
    rules = POLICIES[policy]
    sums = book.agg(*(F.count_if(own.bitwiseAND(F.lit(BIT[r])) != 0).alias(f"f{k}") for k, r in enumerate(rules)),
                    *(F.count_if(own == BIT[r]).alias(f"o{k}") for k, r in enumerate(rules)))
    rows = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"f{k}").alias("n_failed"),
                                        F.col(f"o{k}").alias("n_only")) for k, r in enumerate(rules))))
    return sums.select(rows.alias("r")).select("r.*")


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` (with their columns) that the policy keeps; base failures always go, so null and empty
    texts, which have no words, go too.  Repeated rows are judged alike."""
    d = measured(docs)
    bits = F.col("ledger.fail_bits")
    return kept(d, passes(bits, BASE) & passes(bits, policy)).select("row.*")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
tri AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM tri) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid),
m AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
      FROM w LEFT JOIN cov USING (rid)),
b AS (SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
             + 4 * (100 * n_symbols > 4 * word_chars)::INT + 8 * (100 * n_dup_lines > 40 * n_lines)::INT
             + 16 * (word_chars > 15 * n_words)::INT + 32 * (word_chars < 2 * n_words)::INT AS fail_bits FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_lines::BIGINT AS n_lines, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       fail_bits::INT AS fail_bits, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept
FROM b
"""
