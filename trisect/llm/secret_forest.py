"""Secret scanning with a random forest that removes false positives.

Candidates are runs of 8 token characters that hold a digit, any runs of 20, and, digit or not, runs of 6 after an
assignment or the name of a secret and whole quoted values; a full stop at the end is not part of one. Each is described by its length, the transitions between
its character classes, how much of it dictionary words cover, the document's path and the neighbouring words. A random forest,
trained on labelled findings, votes; findings with a majority are secrets. The trees are turned into column
expressions, so a scan is one narrow pass over the documents: no shuffle, no Python, nothing collected.

Labelled findings come as a table. Where there is none, ``format_label`` labels what a known format settles: key
formats and values assigned to secret words on one side, addresses, numbers, phone numbers and dictionary words on the other. All the rest
is left to the forest.

A null or empty text has no findings. Equal rows give equal rows; an empty table gives an empty table. Long texts
are scanned whole. A null path is no path. Without labelled findings of both classes there is no forest, and the format
labels decide alone. Input columns named like an output are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trisect.llm.tables import stored, text_or_empty, up_to_share

# What a candidate looks like, and formats and words that settle a label. Lookbehinds have fixed widths, so
# that the pattern means the same to other engines.
TOKEN = r"[A-Za-z0-9+/_.@-]"
# A token's last character: a full stop ends the sentence.
LAST = r"[A-Za-z0-9+/_-]"
QUOTED = r"[^\x00-\x20\"'`\x7f]"
# Values that stand free after an assignment, and what they end in.
FREE = r"[^\x00-\x20\"'`\x7f<>(){}\[\],;:&|=\\]"
FREE_LAST = r"[^\x00-\x20\"'`\x7f<>(){}\[\],;:&|=\\.!?]"
GAPS = ("", "[ \\t]", "[ \\t]{2}", "[ \\t]{3}", "[ \\t]{4}")
NAMES = ("password", "passwd", "passphrase", "pwd", "secret", "token", "key", "auth", "credential", "credentials", "bearer")


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


AFTER_SIGN = "(?:" + "|".join(f"(?<=[=:]{g})" for g in GAPS) + ")"
AFTER_SIGN_AND_QUOTE = "(?:" + "|".join(f"(?<=[=:]{g}[\"'`])" for g in GAPS) + ")"
AFTER_NAME = "(?:" + "|".join(f"(?<={_any_case(n)}[ \\t])" for n in NAMES) + ")"
CANDIDATE = (
    rf"(?<!{TOKEN})(?=[^\x00-\x20]{{6}})(?:"
    # Whole quoted values, assigned or not of letters alone; names before an assignment are none.
    rf"(?<=[\"'`])(?:{AFTER_SIGN_AND_QUOTE}{QUOTED}{{6,}}|(?=[A-Za-z]*[^A-Za-z\x00-\x20\"'`\x7f]){QUOTED}{{8,}})(?=[\"'`](?![ \t]*[=:]))"
    rf"|(?<=[=:\x20\t]){AFTER_SIGN}{FREE}{{5,}}{FREE_LAST}={{0,2}}"
    rf"|(?<=[\x20\t]){AFTER_NAME}{FREE}{{5,}}{FREE_LAST}={{0,2}}"
    rf"|(?=[A-Za-z+/_.@-]*[0-9]){TOKEN}{{7,}}{LAST}={{0,2}}"
    # Long runs, but for those that are one short part over and over.
    rf"|(?={TOKEN}{{20}})(?!({TOKEN}{{1,4}}?)\1{{4,}}{TOKEN}{{0,3}}(?!{TOKEN})){TOKEN}{{19,}}{LAST}={{0,2}})"
)
KEY_FORMAT = r"^((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,})$"
OPAQUE = r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_-]{12,}={0,2}$"
HARMLESS = r"^([A-Za-z0-9+_.-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+\.?|[0-9.+/_-]+|[0-9]{1,3}(\.[0-9]{1,3}){3})$"
# What a quoted value is assigned to when it is a secret whatever it looks like.
NAMED_QUOTE = r"(?i)(passw(or)?d|passphrase|pwd|secret|token|api.?key|access.?key|credentials?)[A-Za-z0-9_]*[\"'`]?\s*[=:]\s*[\"'`]$"
SECRET_WORD = r"(?i)(passw|pwd|secret|token|api.?key|access.?key|auth|credential|bearer)"
ASSIGNED = r"(?i)(passw(or)?d|pwd|secret|token|api.?key|access.?key|auth|credentials?|bearer)[A-Za-z_]*\s*[=:]?\s*[\"']?$"
TEST_PATH = r"(?i)(test|example|sample|fixture|mock|dummy)"
MASK = "[SECRET]"

FEATURES = (
    "length", "digits", "uppers", "lowers", "symbols", "transitions", "distinct", "hexes", "covered", "vowels",
    "secret_word", "assigned", "quoted", "test_path", "at_sign", "dots", "right_quote", "left_known",
)
# Characters of the neighbourhood that are looked at on either side.
NEAR = 32
# Candidates whose starts are added up in one array.
CHUNK = 256


@dataclass(frozen=True)
class Forest:
    """Trees as nested tuples (feature, threshold, low, high), leaves 0 or 1, and the dictionary they were trained with."""

    trees: tuple
    dictionary: tuple[str, ...]


def described(documents: DataFrame, dictionary: tuple[str, ...], text: str = "text", path: str = "source") -> DataFrame:
    """The documents with ``_gaps``, the text between candidates, and ``_found``, the candidates with features."""
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path in documents.columns else F.lit("")
    table = documents.drop("_gaps", "_values", "_found").withColumns({
        "_gaps": F.split(text_or_empty(text), CANDIDATE, -1),
        "_values": F.regexp_extract_all(text_or_empty(text), F.lit(CANDIDATE), F.lit(0)),
    })
    # Starts are running sums of the lengths before, within chunks and over chunks: an array that grows by one element at a time is
    # copied each time, so a text with many candidates would take their square. Texts without candidates stop at an empty array.
    steps = F.zip_with("_gaps", "_values", lambda g, v: F.struct(F.length(g).alias("g"), F.coalesce(F.length(v), F.lit(0)).alias("v")))
    table = table.withColumn("_steps", F.when(F.size("_values") > 0, steps).otherwise(F.array().cast("array<struct<g: int, v: int>>")))
    places = F.sequence(F.lit(0), F.floor((F.size("_steps") - 1) / CHUNK).cast("int"))
    chunks = F.transform(F.filter(places, lambda k: k >= 0), lambda k: F.slice("_steps", k * CHUNK + 1, F.lit(CHUNK)))
    table = table.withColumn("_chunks", chunks)
    total = lambda c: F.aggregate(c, F.lit(0), lambda acc, s: acc + s["g"] + s["v"])
    offsets = F.aggregate(
        F.transform("_chunks", total), F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))
    )
    table = table.withColumn("_offsets", F.slice(offsets, 1, F.size("_chunks")))
    inside = lambda c, o: F.aggregate(
        c, F.struct(o.alias("at"), F.array().cast("array<int>").alias("all")),
        lambda acc, s: F.struct((acc["at"] + s["g"] + s["v"]).alias("at"), F.concat(acc["all"], F.array(acc["at"] + s["g"])).alias("all")),
        lambda acc: acc["all"],
    )
    table = table.withColumn("_starts", F.flatten(F.zip_with("_chunks", "_offsets", inside))).drop("_steps", "_chunks", "_offsets")
    context = F.arrays_zip(
        F.col("_values").alias("value"), F.slice("_starts", 1, F.size("_values")).alias("start"),
        # What stands before may itself be a candidate, such as the name of what is assigned.
        F.zip_with(
            F.concat(F.array(F.lit("")), F.slice("_values", 1, F.greatest(F.size("_values") - 1, F.lit(0)))),
            F.slice("_gaps", 1, F.greatest(F.size("_values"), F.lit(1))), lambda v, g: F.right(F.concat(v, g), F.lit(NEAR)),
        ).alias("left"),
        F.transform(F.slice("_gaps", 2, F.size("_values")), lambda g: F.left(g, F.lit(NEAR))).alias("right"),
    )
    table = table.withColumn("_context", F.slice(context, 1, F.size("_values")))
    return table.withColumn("_found", F.transform("_context", lambda c: _features(c, dictionary, where))).drop(
        "_values", "_starts", "_context"
    )


def _features(c: Column, dictionary: tuple[str, ...], where: Column) -> Column:
    value = c["value"]
    n = F.length(value).cast("double")

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(value, pattern, "")) / n

    flag = lambda test: F.when(test, 1.0).otherwise(0.0)
    shape = value
    for pattern, mark in (("[a-z]", "a"), ("[A-Z]", "A"), ("[0-9]", "9"), ("[^aA9]", "-")):
        shape = F.regexp_replace(shape, pattern, mark)
    runs = F.regexp_extract_all(F.lower(value), F.lit("[a-z]{3,}"), F.lit(0))
    # Words and nothing but words: letters that the dictionary covers.
    letters = F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
    known = F.aggregate(F.filter(runs, lambda r: r.isin(*dictionary)), F.lit(0), lambda acc, r: acc + F.length(r))
    before = F.lower(F.regexp_extract(c["left"], r"([A-Za-z]{3,})[^A-Za-z]*$", 1))
    return F.struct(
        value.alias("value"), c["start"].alias("start"), _format_label(value, c["left"], c["right"], (letters > 0) & (known == letters)).alias("label"),
        n.alias("length"), share("[^0-9]").alias("digits"), share("[^A-Z]").alias("uppers"), share("[^a-z]").alias("lowers"),
        share("[A-Za-z0-9]").alias("symbols"),
        ((F.length(F.regexp_replace(shape, r"(.)\1+", "$1")) - 1) / n).alias("transitions"),
        (F.size(F.array_distinct(F.split(value, ""))) / n).alias("distinct"), share("[^0-9a-f]").alias("hexes"),
        (known / n).alias("covered"), share("[^aeiouAEIOU]").alias("vowels"),
        flag(c["left"].rlike(SECRET_WORD)).alias("secret_word"), flag(c["left"].rlike(r"[=:]\s*[\"']?$")).alias("assigned"),
        flag(c["left"].rlike(r"[\"']$")).alias("quoted"), flag(where.rlike(TEST_PATH)).alias("test_path"),
        flag(value.contains("@")).alias("at_sign"), (F.length(value) - F.length(F.replace(value, F.lit("."), F.lit("")))).cast(
            "double"
        ).alias("dots"),
        flag(c["right"].rlike(r"^[\"']")).alias("right_quote"), flag(before.isin(*dictionary)).alias("left_known"),
    )


def _format_label(value: Column, left: Column, right: Column, is_words: Column) -> Column:
    return F.when(value.rlike(KEY_FORMAT), 1).when(value.rlike(HARMLESS), 0).when(
        (value.rlike(OPAQUE) & left.rlike(ASSIGNED)) | (left.rlike(NAMED_QUOTE) & right.rlike(r"^[\"'`]") & (F.length(value) >= 8)), 1
    ).when(~value.rlike("[0-9]") & ~left.rlike(SECRET_WORD) & is_words, 0)


def _no_words() -> tuple[str, ...]:
    # A word no text holds, so that the expression is the same without a dictionary.
    return ("\u0000", "\u0001")


def common_words(
    documents: DataFrame, most: int, min_documents: int, text: str = "text", lang: str = "lang"
) -> tuple[str, ...]:
    """The ``most`` words of three letters or more that most documents of their language hold, counted over all documents.

    Languages take turns, so that none is crowded out; without the column there is one. A word counts from ``min_documents``
    documents of a language on, or from a hundredth of them, two at least, where that is less.
    """
    speech = F.coalesce(F.col(lang).cast("string"), F.lit("")) if lang in documents.columns else F.lit("")
    rows = documents.select(speech.alias("lang"), F.array_distinct(F.split(F.lower(text_or_empty(text)), "[^a-z0-9]+")).alias("words"))
    # The empty word, kept for each document, counts the documents.
    words = F.filter("words", lambda w: (F.length(w) >= 3) & ~w.rlike("[0-9]"))
    counts = rows.select("lang", F.explode(F.concat(words, F.array(F.lit("")))).alias("w")).groupBy("lang", "w").agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = stored(counts.where((F.col("n") > 1) | (F.col("w") == "")), "words")
    sizes = counts.where("w = ''").select("lang", F.least(F.lit(min_documents), F.greatest(F.lit(2), F.col("n") / 100)).alias("bar"))
    # The first ``most`` of each part of a language's words hold the first ``most`` of all, so that no task ranks a whole language.
    words = counts.where("w <> ''").join(sizes, "lang").where("n >= bar").withColumn("part", F.pmod(F.xxhash64("w"), F.lit(64)))
    order = (F.desc("n"), "w")
    turn = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    words = words.withColumn("turn", turn).where(F.col("turn") <= most)
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = words.withColumn("turn", turn).where(F.col("turn") <= most)
    first = ranked.groupBy("w").agg(F.min("turn").alias("turn"), F.max("n").alias("n")).orderBy("turn", F.desc("n"), "w").limit(most)
    return tuple(sorted(r["w"] for r in first.select("w").collect()))


def fit(
    documents: DataFrame, findings: DataFrame | None = None, text: str = "text", path: str = "source",
    most_findings: int = 20_000, dictionary_words: int = 8000, min_documents: int = 20, trees: int = 25, depth: int = 6,
    lang: str = "lang",
) -> Forest:
    """Train on about ``most_findings`` candidates of each label, or all where there are fewer: those with the smallest hashes.

    ``findings`` is (doc_id, start, is_secret); without it the format labels are learned.
    """
    dictionary = common_words(documents, dictionary_words, min_documents, text, lang) + _no_words()
    narrow = documents.select(*[c for c in ("doc_id", text, path) if c in documents.columns])
    table = described(narrow, dictionary, text, path).select("doc_id", F.explode_outer("_found").alias("f"))
    table = table.where("f IS NOT NULL").select("doc_id", "f.*")
    if findings is None:
        labelled = table.where("label IS NOT NULL").withColumn("label", F.col("label").cast("double"))
    else:
        marks = findings.groupBy("doc_id", "start").agg(F.max(F.col("is_secret").cast("double")).alias("label"))
        labelled = table.drop("label").join(marks, ["doc_id", "start"]).where("label IS NOT NULL")
    order = F.xxhash64("value", "start", "doc_id")
    known = stored(labelled.select(order.alias("_order"), "label", *FEATURES), "findings")
    # Each label has a bound of its own, so that the one never thins out the other; equal rows have equal hashes, hence the least.
    ends = known.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("_order").alias("least")).collect()
    if len(ends) < 2:
        return Forest((), dictionary)
    last = {r["label"]: max(up_to_share(r["n"], most_findings), r["least"]) for r in ends}
    chosen = known.where(F.col("_order") <= F.when(F.col("label") == 1, last[1.0]).otherwise(last[0.0])).drop("_order")
    counts = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    even = F.when(F.col("label") == 1, 0.5 / counts[1.0]).otherwise(0.5 / counts[0.0]) * sum(counts.values())
    # A bounded sample in a fixed order: the forest does not depend on the partitioning of the documents.
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        chosen.withColumn("weight", even).coalesce(1).sortWithinPartitions("label", *FEATURES)
    )
    model = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=3, weightCol="weight", featureSubsetStrategy="onethird", minInstancesPerNode=2
    ).fit(rows)
    return Forest(tuple(_tree(t.toDebugString.splitlines()[1:]) for t in model.trees), dictionary)


def _tree(lines: list[str]):
    """A tree as MLlib prints it, as nested tuples."""

    def node():
        line = lines.pop(0).strip()
        if line.startswith("Predict"):
            return int(float(line.split(":")[1]))
        feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = node()
        lines.pop(0)
        return (int(feature), float(limit), low, node())

    return node()


def _vote(tree, c: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(tree)
    feature, limit, low, high = tree
    if low == high:
        return _vote(low, c)
    return F.when(c[FEATURES[feature]] <= limit, _vote(low, c)).otherwise(_vote(high, c))


def _score(forest: Forest, c: Column) -> Column:
    if not forest.trees:
        return F.coalesce(c["label"], F.lit(0)).cast("double")
    votes = F.lit(0)
    for tree in forest.trees:
        votes = votes + _vote(tree, c)
    return votes / float(len(forest.trees))


def scanned(documents: DataFrame, forest: Forest, text: str = "text", path: str = "source") -> DataFrame:
    """The documents with ``_gaps`` and ``findings``: start, length, value, score and is_secret of each candidate."""
    table = described(documents.drop("findings"), forest.dictionary, text, path)
    scores = F.transform("_found", lambda c: F.struct(
        c["start"].alias("start"), F.length(c["value"]).alias("length"), c["value"].alias("value"), _score(forest, c).alias("score")
    ))
    table = table.withColumn("_scored", scores)
    return table.withColumn("findings", F.transform("_scored", lambda c: F.struct(
        c["start"].alias("start"), c["length"].alias("length"), c["value"].alias("value"), c["score"].alias("score"),
        (c["score"] > 0.5).alias("is_secret"),
    ))).drop("_found", "_scored")


def scan(documents: DataFrame, forest: Forest, text: str = "text", path: str = "source") -> DataFrame:
    """The documents with ``findings``."""
    return scanned(documents, forest, text, path).drop("_gaps")


def redact(documents: DataFrame, forest: Forest, text: str = "text", path: str = "source") -> DataFrame:
    """The documents with each secret replaced by a mask; ``n_chars``, where there is one, follows. Nulls stay."""
    table = scanned(documents, forest, text, path)
    pieces = F.zip_with("_gaps", "findings", lambda g, f: F.concat(
        g, F.coalesce(F.when(f["is_secret"], F.lit(MASK)).otherwise(f["value"]), F.lit(""))
    ))
    masked = F.when(F.exists("findings", lambda f: f["is_secret"]), F.array_join(pieces, ""))
    table = table.withColumn("_masked", masked)
    changed = {text: F.coalesce("_masked", F.col(text))}
    if "n_chars" in documents.columns:
        kind = dict(documents.dtypes)["n_chars"]
        changed["n_chars"] = F.coalesce(F.length("_masked").cast(kind), F.col("n_chars"))
    return table.withColumns(changed).select(*documents.columns)
