"""Quality rules as a ledger: every rule is evaluated once, and a document carries one bit per failed rule.

``ledger`` adds the measurements and ``failed_bits``. A policy is a versioned set of rules, a bit mask; applying
one, or comparing policies, only reads the bits. ``ablations`` counts distinct bit patterns once and tells, by
bitwise aggregation, what each rule decides alone. Everything is a column expression: no shuffle, no Python.

A null text counts as empty: all measurements are 0 and the document fails ``too_few_words``. Equal rows give equal
rows, an empty table an empty table. Long texts are measured whole. Input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trisect.llm.tables import text_or_empty

SPACE = r"[\x20\x09-\x0D]"
# The window of words that is looked for again in a text, and the symbols that are counted.
WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
PLACED = "array<struct<h: bigint, i: int>>"

MEASUREMENTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaim", "n_distinct_words"
)

# Rules in the order of their bits. A rule is appended, never changed or moved: its bit means the same for ever.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("many_symbols", "100 * n_symbols > 30 * n_words"),
    ("shouting", "100 * n_exclaim > 50 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
    ("few_distinct_words", "n_words >= 100 AND 100 * n_distinct_words < 5 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


def mask(*rules: str) -> int:
    return sum(BIT[r] for r in rules)


# Versions of the policy. An old version stays, so that old decisions can be repeated. Vocabulary share falls with
# length, so the last rule is measured but in no policy.
POLICIES: dict[str, int] = {
    "base": mask("too_few_words", "repeated_windows"),
    "v1": mask("too_few_words", "repeated_windows", "many_symbols", "shouting"),
    "v2": mask("too_few_words", "repeated_windows", "many_symbols", "shouting", "duplicate_lines", "word_length"),
}
CURRENT = "v2"


def window_hashes(hashes: Column) -> Column:
    """A 64-bit hash of each run of five words, from a column of word hashes that is already made."""
    return F.when(
        F.size(hashes) >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
            lambda i: F.xxhash64(*[F.try_element_at(hashes, i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _neighbours(array: str, combine) -> Column:
    """combine(x[i], x[i + 1]) for all i of an array column; the array is shifted so that no place is looked up."""
    short = F.greatest(F.size(array) - 1, F.lit(0))
    return F.zip_with(F.slice(array, 1, short), F.slice(array, 2, short), combine)


def measured(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with one column per measurement."""
    kept = documents.drop(*MEASUREMENTS, "failed_bits")
    own = ["_text", "_words", "_hashes", "_windows", "_lines", "_again", "_placed", "_starts"]
    # Input columns with such names wait under others meanwhile.
    spare = "_" * (max(map(len, kept.columns), default=0) + 1)
    held = {c: f"{spare}{c}" for c in own if c in kept.columns}
    table = kept.withColumnsRenamed(held).withColumn("_text", text_or_empty(held.get(text, text)))
    # The regular expressions run once; later expressions read the columns made here.
    table = table.withColumns({
        "_words": F.filter(F.split("_text", SPACE + "+"), lambda w: w != ""),
        "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    table = table.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    table = table.withColumn("_windows", window_hashes(F.col("_hashes")))
    # Words inside windows that occur twice or more: windows sorted with their places, equal neighbours give the places,
    # and overlaps count once. Most texts have no window twice; their arrays are empty here. Every step is a column of
    # its own, as an expression that is used twice would be computed twice.
    table = table.withColumn("_again", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    table = table.withColumn("_placed", F.when(F.col("_again"), placed).otherwise(F.array().cast(PLACED)))
    both = _neighbours("_placed", lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(
        F.array().cast("array<int>")
    ))
    table = table.withColumn("_starts", F.sort_array(F.array_distinct(F.flatten(both))))
    covered = F.aggregate(
        _neighbours("_starts", lambda a, b: F.least(b - a, F.lit(WINDOW))), F.lit(WINDOW), lambda total, x: total + x
    )
    table = table.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(F.col("_again"), covered).otherwise(F.lit(0)).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_exclaim": (F.length("_text") - F.length(F.replace(F.col("_text"), F.lit("!"), F.lit("")))).cast("long"),
        "n_distinct_words": F.size(F.array_distinct("_hashes")).cast("long"),
    })
    return table.drop(*own).withColumnsRenamed({new: c for c, new in held.items()})


def failed_bits() -> Column:
    bits = F.lit(0).cast("long")
    for name, fails in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BIT[name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their measurements and the bits of the rules they fail."""
    return measured(documents, text).withColumn("failed_bits", failed_bits())


def passes(policy: str = CURRENT) -> Column:
    """Whether a row of a ledger fails no rule of a policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0


def keep_passing(documents: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns, also where they are named like an output."""
    names = [f"_{i}" for i in range(len(documents.columns))]
    by_name = dict(zip(documents.columns, names, strict=True))
    # The task number keeps the optimizer from moving the test below the measurements, which would make them again.
    table = ledger(documents.toDF(*names), by_name[text]).withColumn("_task", F.spark_partition_id())
    return table.where(passes(policy) & (F.col("_task") >= 0)).select(*names).toDF(*documents.columns)


def ablations(table: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, fail only it, and would be kept without it.

    A ledger has at most 2 ** rules patterns; they are counted first, so only these few rows are expanded.
    """
    every = POLICIES[policy]
    patterns = table.groupBy(F.col("failed_bits").bitwiseAND(F.lit(every).cast("long")).alias("bits")).count()
    rules = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).cast("long").alias("bit"))
        for name, _ in RULES if BIT[name] & every
    ])
    rows = patterns.select("bits", "count", F.explode(rules).alias("r")).select("bits", "count", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return rows.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(hit, F.col("count"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("count"))), F.lit(0)).alias("n_failed_alone"),
        F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0, F.col("count"))), F.lit(0)).alias(
            "n_kept_without"
        ),
    )


# The same in SQL, for a table of documents. Windows are compared as text here, not as hashes.
LEDGER = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
           [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM d
), p AS (
    SELECT r, i, array_to_string(words[i : i + 4], ' ') AS win
    FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
), again AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM p) WHERE n >= 2
), covered AS (
    SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n
    FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM again) GROUP BY r
), m AS (
    SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
           (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclaim, len(list_distinct(words))::BIGINT AS n_distinct_words
    FROM w LEFT JOIN covered USING (r)
)"""
FAILED_BITS = " + ".join(f"CASE WHEN {fails} THEN {BIT[name]} ELSE 0 END" for name, fails in RULES)
ORACLE = f"""{LEDGER}, b AS (SELECT *, ({FAILED_BITS})::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & {POLICIES["base"]}) <> 0 AS base_failed,
       (failed_bits & {POLICIES[CURRENT]}) = 0 AS kept, failed_bits
FROM b
"""
ABLATIONS = f"""{LEDGER}, b AS (SELECT ({FAILED_BITS}) & {POLICIES[CURRENT]} AS bits FROM m),
r AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {b})" for n, b in BIT.items() if b & POLICIES[CURRENT])}) v(rule, bit))
SELECT rule, count(*) FILTER (bits & bit <> 0) AS n_failed, count(*) FILTER (bits = bit) AS n_failed_alone,
       count(*) FILTER (bits & ~bit = 0) AS n_kept_without
FROM b, r GROUP BY rule
"""
