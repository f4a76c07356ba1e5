"""Quality rules whose cutoffs come with a guarantee.

Text statistics are taken with built-in functions, a row at a time and without a
shuffle of words.  A labelled holdout decides how far each rule may go: per stratum
and rule, cutoffs are tried from the mildest on, and one is accepted while an exact
binomial test shows that at most the allowed share of good documents is rejected.
Fixed-sequence testing needs no correction along a sequence; over strata and rules the
error is divided (Bonferroni).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanworks.llm.columns import other_columns
from spanworks.session import ensure_checkpoints

_SEPARATORS = " \t\n\x0b\x0c\r"
_SEPARATOR = "[\\x20\\x09-\\x0D]"
_SPLIT = _SEPARATOR + "+"
_SYMBOL = "[#*$%&|<>]"

#: Rules: a score per document that is higher for worse text, and cutoffs from mild to strict (reject at or above).
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols_per_word": ("n_symbols / n_words", [4.0, 3.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1]),
    "long_words": ("word_chars / n_words", [40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 14.0, 13.0, 12.0, 11.0, 10.0]),
    "repeat_words": ("n_repeat_words / n_words", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2]),
    "dup_lines": ("n_dup_lines / n_words", [0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.03, 0.02]),
}
#: Allowed share of good documents rejected per stratum by all rules together, and the chance to exceed it anywhere.
RISK, ERROR = 0.02, 0.05
#: Labelled ids up to which they are broadcast (8 bytes each, about 40 in a hash table); beyond, they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def word_array(text: Column) -> Column:
    """The words of a text, none for null."""
    return let(F.trim(F.coalesce(text, F.lit("")), F.lit(_SEPARATORS)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, _SPLIT)))


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three that occurs twice or more in the text.

    Windows are hashed.  Only where some hash is there twice they are sorted with their
    places: equal neighbours give the places, and each adds the words up to the next
    one, three at most.
    """

    def hashed(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def places(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.filter(F.transform(s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])), lambda p: p.isNotNull()))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(F.sort_array(places(h)), covered))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(hashed(words), count)).cast("bigint")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x, F.lit(_SEPARATORS)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns with the text's statistics, ``base_failed`` and one score per rule."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = let(word_array(text), lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    found = F.struct(
        words.alias("words"),
        (F.length(text) - F.regexp_count(text, F.lit(_SEPARATOR))).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(_SYMBOL)).cast("bigint").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
    )
    # exploding an array of one keeps later filters above the statistics, which would else be taken again for each of them
    out = docs.select("*", F.explode(F.array(found)).alias("_w"))
    out = out.withColumns({"n_words": F.col("_w.words.n_words"), "word_chars": F.col("_w.word_chars"), "n_symbols": F.col("_w.n_symbols"), "n_dup_lines": F.col("_w.n_dup_lines"), "n_repeat_words": F.col("_w.words.n_repeat_words")}).drop("_w")
    out = out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return out.withColumns({name: F.coalesce(F.try_divide(*[F.col(c).cast("double") for c in form.split(" / ")]), F.lit(0.0)) for name, (form, _) in RULES.items()})


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) of a binomial(n, p), exact up to rounding, summed in logarithms.

    A rate above p can't be rejected at a useful level, so the sum is taken up to n * p only.
    """
    step = F.log(F.lit(p / (1 - p)))
    start = F.struct((n * F.log(F.lit(1 - p))).alias("term"), (n * F.log(F.lit(1 - p))).alias("sum"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + step
        top = F.greatest(term, acc["sum"])
        return F.struct(term.alias("term"), (top + F.log(F.exp(term - top) + F.exp(acc["sum"] - top))).alias("sum"))

    few = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), F.greatest(k, F.lit(1)))).otherwise(F.array().cast("array<bigint>"))
    return F.when(k > n * F.lit(p), F.lit(1.0)).otherwise(F.exp(F.aggregate(few, start, add)["sum"]))


def good_ids(labels: DataFrame) -> DataFrame:
    """(_id) of the labelled documents that must not be rejected."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").alias("_id")).distinct()


def cutoffs(good: DataFrame, stratum: str, risk: float = RISK, error: float = ERROR, text_key: str | None = None) -> DataFrame:
    """(stratum, rule, cutoff): the strictest cutoff that the holdout supports; none if it supports none.

    ``good`` are the measured rows of good labelled documents (quality 1, not toxic); those that pass the base
    rules count.  Equal texts of a stratum, as ``text_key`` tells them, are one draw: copies would make the test too sure.
    """
    held = good.where(~F.col("base_failed"))
    held = held.dropDuplicates([stratum, text_key]) if text_key else held
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("score"), F.array(*map(F.lit, cuts)).alias("cuts")) for name, (_, cuts) in RULES.items()])
    long = held.select(F.col(stratum).alias("stratum"), F.explode(rules).alias("r")).select("stratum", "r.rule", "r.cuts", F.size(F.filter("r.cuts", lambda c: F.col("r.score") < c)).alias("passed"))
    # a document passes its first `passed` cutoffs and is rejected by the stricter ones
    tally = long.groupBy("stratum", "rule", "cuts", "passed").agg(F.count("*").alias("n"))
    per_rule = tally.groupBy("stratum", "rule", "cuts").agg(F.sum("n").alias("n"), F.collect_list(F.struct("passed", "n")).alias("hits")).checkpoint()
    tests = max(1, per_rule.count())
    tried = per_rule.select("stratum", "rule", "n", "hits", F.posexplode("cuts").alias("step", "cutoff"))
    rejected = F.aggregate("hits", F.lit(0).cast("bigint"), lambda a, h: a + F.when(h["passed"] <= F.col("step"), h["n"]).otherwise(0))
    tested = tried.withColumn("rejected", rejected).withColumn("p_value", binomial_tail(F.col("n"), F.col("rejected"), risk / len(RULES)))
    ok = F.col("p_value") <= F.lit(error / tests)
    steps = tested.groupBy("stratum", "rule").agg(F.array_sort(F.collect_list(F.struct("step", "cutoff", ok.alias("ok")))).alias("t"))
    # the run of accepted cutoffs from the mildest one
    run = F.aggregate("t", F.struct(F.lit(True).alias("on"), F.lit(None).cast("double").alias("at")), lambda a, x: F.struct((a["on"] & x["ok"]).alias("on"), F.when(a["on"] & x["ok"], x["cutoff"]).otherwise(a["at"]).alias("at")))
    return steps.select("stratum", "rule", run["at"].alias("cutoff")).where("cutoff is not null")


def verdicts(measured: DataFrame, limits: DataFrame, stratum: str) -> DataFrame:
    """All rows with ``kept``: the base rules passed and no accepted cutoff of the stratum reached."""
    # at most one row per stratum, as wide as there are rules
    wide = limits.groupBy(F.col("stratum").alias("_s")).agg(*[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_c_{r}") for r in RULES])
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(F.col(r) >= F.col(f"_c_{r}"), F.lit(False))
    joined = measured.join(wide, measured[stratum].eqNullSafe(wide["_s"]), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("_s", *[f"_c_{r}" for r in RULES])


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def _text_key(text_col: str) -> Column:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.struct(F.xxhash64(text), F.crc32(text.cast("binary")), F.length(text))


def _limits(docs: DataFrame, labels: DataFrame, stratum: str, id_col: str, text_col: str, risk: float, error: float) -> DataFrame:
    good = good_ids(labels).checkpoint()
    good = F.broadcast(good) if good.count() <= BROADCAST_ROWS else good.hint("shuffle_hash")
    narrow = docs.select(F.col(id_col).alias("id"), F.col(stratum).alias("stratum"), F.col(text_col).alias("text"), _text_key(text_col).alias("text_key"))
    held = narrow.join(good, F.col("id") == F.col("_id"), "left_semi")
    return cutoffs(features(held, "text").drop("text"), "stratum", risk, error, "text_key").checkpoint()


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """All rows and columns with the statistics, ``base_failed`` and ``kept``, which replace columns of these names
    (compared as the session does, so in any case of letters by default).

    Strata without enough labels have no cutoffs.  Null and empty texts have no words and
    fail the base; null strata are a stratum; ids are of any type that compares with that of the labels; ids that are null have no label; labels of
    unknown ids are ignored; an empty table gives no rows; rows that repeat are judged alike.  Statistics of labelled good
    rows are taken twice, for the cutoffs and for the verdict, so that texts are neither shuffled nor stored in between.
    """
    ensure_checkpoints(docs.sparkSession)
    limits = _limits(docs, labels, stratum, id_col, text_col, risk, error)
    # the user's columns travel in a struct, so that their names can't clash
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(stratum).alias("stratum"), F.col(text_col).alias("text"))
    judged = verdicts(features(rows, "text"), limits, "stratum")
    return judged.select(*[F.col("doc").getField(c).alias(c) for c in other_columns(docs, *STATISTICS)], *STATISTICS)


def kept_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The rows that :func:`judge` keeps, with their own columns only."""
    ensure_checkpoints(docs.sparkSession)
    limits = _limits(docs, labels, stratum, id_col, text_col, risk, error)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(stratum).alias("stratum"), F.col(text_col).alias("text"))
    return verdicts(features(rows, "text"), limits, "stratum").where("kept").select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def judge_narrow(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """:func:`judge` without the texts: id, stratum and statistics, each taken once."""
    ensure_checkpoints(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(stratum).alias("stratum"), F.col(text_col).alias("text"), _text_key(text_col).alias("text_key"))
    measured = features(rows, "text").drop("text").checkpoint()
    good = measured.join(good_ids(labels), F.col("id") == F.col("_id"), "left_semi")
    limits = cutoffs(good, "stratum", risk, error, "text_key").checkpoint()
    return verdicts(measured, limits, "stratum").select(F.col("id").alias(id_col), F.col("stratum").alias(stratum), *STATISTICS)
