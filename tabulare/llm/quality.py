"""Quality rules whose cutoffs come with a guarantee on labelled documents. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulare.llm.rows import packed
from tabulare.session import work_table

SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# A share or mean per document, larger is worse, with cutoffs from lenient to strict. They are fixed beforehand, and so
# is the order in which they are tightened: every rule's first cutoff, rule by rule, then every rule's second, and so on.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / word_chars", [0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02]),
    "dup_lines": ("n_dup_lines / n_lines", [0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25]),
    "repeats": ("n_repeat_words / n_words", [0.48, 0.45, 0.42, 0.4, 0.38, 0.35, 0.32, 0.3, 0.27, 0.25]),
    "long_words": ("word_chars / n_words", [30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0, 11.0, 10.0, 9.0]),
    "short_words": ("n_words / word_chars", [0.8, 0.7, 0.6, 0.55, 0.5, 0.45, 0.42, 0.4, 0.37, 0.35]),
}
STEPS = sum(len(cutoffs) for _, cutoffs in RULES.values())
FALSE_REJECTIONS = 0.02
ERROR = 0.05


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one more column ``_f``, a struct of the counts of each text.

    A null or empty text has all counts 0. Repeated three-word windows are
    found by sorting the windows of one text, so a row never leaves its task
    and the work grows with the text times the logarithm of its length.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    cut = docs.withColumn("_t", value).withColumn(
        "_w", F.filter(F.split("_t", SPACES, -1), lambda word: word != "")
    )
    windows = F.transform(
        F.slice("_w", 1, F.greatest(F.size("_w") - 2, F.lit(0))),
        lambda word, i: F.struct(
            F.concat_ws(" ", word, F.get("_w", i + 1), F.get("_w", i + 2)).alias("k"), i.alias("p")
        ),
    )
    ordered = cut.withColumn("_s", F.sort_array(windows))
    # Neighbours that are equal: the windows found twice or more, with their places.
    again = F.filter(
        "_s",
        lambda x, i: (x["k"] == F.coalesce(F.get("_s", i - 1)["k"], F.lit("")))
        | (x["k"] == F.coalesce(F.get("_s", i + 1)["k"], F.lit(""))),
    )
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))))
    lines = ordered.withColumn("_l", F.filter(F.split("_t", "\n", -1), lambda line: line.rlike(NOT_SPACE)))
    counts = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": F.regexp_count("_t", F.lit(SYMBOLS)),
        "n_lines": F.size("_l"),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": F.size(covered),
    }
    return lines.withColumn("_f", F.struct(*(c.cast("bigint").alias(name) for name, c in counts.items()))).drop(
        "_t", "_w", "_s", "_l"
    )


def base_failed() -> Column:
    """The rules without labels: too short, or more than half of the words in repeated windows."""
    few = F.col("_f.n_words") < MIN_WORDS
    return few | (F.col("_f.n_repeat_words") * 100 > F.col("_f.n_words") * MAX_REPEAT_PERCENT)


def badness() -> list[Column]:
    """One value per rule; a text without words or lines has 0."""
    values = []
    for share, _ in RULES.values():
        over, under = (F.col(f"_f.{name}").cast("double") for name in share.split(" / "))
        values.append(F.when(under > 0, over / under).otherwise(0.0))
    return values


def first_step() -> Column:
    """The first joint set of rules, counted from 0 and from lenient to strict, that rejects a document; ``STEPS`` if none does.

    Set t has tightened t + 1 cutoffs in the fixed order, so each set rejects
    all that the ones before reject.
    """
    steps = [
        F.when(value > cutoff, F.lit(level * len(RULES) + rule))
        for rule, (value, (_, cutoffs)) in enumerate(zip(badness(), RULES.values(), strict=True))
        for level, cutoff in enumerate(cutoffs)
    ]
    return F.least(*steps, F.lit(STEPS))


def binomial_at_most(k: Column, n: Column, rate: float) -> Column:
    """Probability that a binomial count of ``n`` trials at ``rate`` is ``k`` or less, for ``k`` below the mean; else 1.

    The term at ``k`` is summed in logarithms and the ones below it by their
    ratios, which are under 1, so that nothing under- or overflows.
    """
    ones = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    log_choose = F.aggregate(ones, F.lit(0.0), lambda total, i: total + F.log((n - k + i) / i))
    log_term = log_choose + k * F.log(F.lit(rate)) + (n - k) * F.log(F.lit(1 - rate))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def below(state: Column, i: Column) -> Column:
        j = k - i + 1  # from the term at j to the one at j - 1
        term = state["term"] * j / (n - j + 1) * ((1 - rate) / rate)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    total = F.aggregate(ones, start, below, lambda state: state["total"])
    return F.when(k < n * rate, F.exp(log_term) * total).otherwise(1.0)


def calibrate(
    features: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    key: str = "doc_id",
    label_key: str = "doc_id",
    false_rejections: float = FALSE_REJECTIONS,
    error: float = ERROR,
) -> DataFrame:
    """One row per stratum with a joint set that is safe: ``_stratum``, ``_limit`` (the set), ``_n``, ``_k`` and ``_bad``.

    The joint sets are tested in their fixed order, lenient to strict, on all
    good labelled documents of the stratum that they reject by any rule. A set
    is safe if, were its true share of false rejections ``false_rejections``,
    so few of them (``_k`` of ``_n``) would be seen with a probability of
    ``error`` over the number of strata at most (Bonferroni): the exact
    one-sided binomial bound. Testing stops at the first set that is not safe,
    so no further correction is needed within a stratum: with probability 1 -
    ``error``, in no stratum are more than ``false_rejections`` of the good
    documents lost by the rules together. Of the safe sets the one that rejects
    the most bad documents (``_bad``) is taken, the most lenient one of these.

    At the default rates 149 good labels are the fewest with one stratum, and
    217 with four. A null label: none. A null stratum is one of its own. A key
    that is labelled or occurs more than once counts once: as good if any of its
    labels is, and by the text that the most lenient set rejects.
    """
    marked = labels.where(F.col("quality").isNotNull()).groupBy(F.col(label_key).alias("_label_id")).agg(
        F.max(F.col("quality") > 0).alias("_good")
    )
    labelled = (
        features.join(marked, F.col(key) == F.col("_label_id"))
        .select(F.col(stratum).alias("_stratum"), "_label_id", "_good", first_step().alias("_step"))
        .groupBy("_label_id")
        .agg(F.min_by("_stratum", F.struct("_step", "_stratum")).alias("_stratum"), F.first("_good").alias("_good"), F.min("_step").alias("_step"))
    )
    per_step = labelled.groupBy("_stratum", "_step").agg(F.count_if("_good").alias("_g"), F.count_if(~F.col("_good")).alias("_b"))
    steps = per_step.groupBy("_stratum").agg(
        F.sum("_g").alias("_n"), F.collect_list(F.struct("_step", "_g", "_b")).alias("_seen")  # STEPS + 1 entries at most
    )
    steps = steps.where("_n > 0").withColumn("_strata", F.count("*").over(Window.partitionBy()))  # one row per stratum
    step = F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))).alias("_limit")
    zero = F.lit(0).cast("bigint")

    def so_far(name: str) -> Column:
        rejected = F.filter("_seen", lambda s: s["_step"] <= F.col("_limit"))
        return F.aggregate(rejected, zero, lambda total, s: total + s[name])

    level = F.lit(error) / F.col("_strata")
    tested = steps.select("_stratum", "_n", "_strata", "_seen", step).select(
        "_stratum", "_n", "_limit", so_far("_g").alias("_k"), so_far("_b").alias("_bad"), level.alias("_level")
    )
    tested = tested.withColumn("_safe", binomial_at_most(F.col("_k"), F.col("_n"), false_rejections) <= F.col("_level"))
    in_order = Window.partitionBy("_stratum").orderBy("_limit")
    safe = tested.withColumn("_all", F.min("_safe").over(in_order)).where("_all")
    best = F.max_by(F.struct("_limit", "_n", "_k", "_bad"), F.struct(F.col("_bad"), -F.col("_limit")))
    return safe.groupBy("_stratum").agg(best.alias("_best")).select("_stratum", "_best.*")


def apply_rules(features: DataFrame, limits: DataFrame, stratum: str = "lang") -> DataFrame:
    """``features`` with ``_base_failed`` and ``_kept``. The limits, a row per stratum, are read from a written table."""
    written = work_table(limits.select(F.col("_stratum").alias("_of"), "_limit"), "limits")
    over = F.coalesce(first_step() <= F.col("_limit"), F.lit(False))
    return (
        features.join(written, F.col(stratum).eqNullSafe(F.col("_of")), "left")
        .withColumn("_base_failed", base_failed())
        .withColumn("_kept", ~(F.col("_base_failed") | over))
        .drop("_of", "_limit")
    )


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id") -> DataFrame:
    """Per document: ``doc_id``, the counts, ``base_failed`` and ``kept``.

    One pass over the texts writes the counts; the labels are joined to the
    counts, never to texts. Repeated rows and null keys are judged like any
    other; an empty table, or one without labels, leaves the base rules only.
    """
    narrow = docs.select(F.col(key).alias("_id"), F.col(stratum).alias("_lang"), F.col("text").alias("_text"))
    counted = with_features(narrow, "_text").select("_id", "_lang", "_f")
    features = work_table(counted, "features")
    judged = apply_rules(features, calibrate(features, labels, "_lang", "_id"), "_lang")
    return judged.select(
        F.col("_id").alias("doc_id"),
        *(f"_f.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id") -> DataFrame:
    """The rows that pass, with the columns they came with.

    Null and empty texts have no words and go; texts of any length are counted
    whole; repeated rows and null keys are judged like others; an empty table
    stays empty, and without labels only the base rules hold.
    """
    rows = packed(docs, _id=key, _lang=stratum, _text="text")
    features = work_table(with_features(rows, "_text").drop("_text"), "features")
    judged = apply_rules(features, calibrate(features, labels, "_lang", "_id"), "_lang")
    return judged.where("_kept").select("_row.*")
