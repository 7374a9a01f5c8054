"""Quality rules as a short-circuit cascade; DataFrame functions only.

Base counts are made for every document. The further rules run only on documents that
pass the base rules, in one CASE chain that stops at the first rule that rejects. Each
rule's cost and selectivity are estimated on a sample, and the chain takes next the rule that rejects
most per cost of what the rules before it leave. The order
changes the time only, never the verdict: a document is kept if every rule passes.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, words_of

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
#: Rows of the sample that costs and selectivities are estimated on, about. They set an order, not a result.
SAMPLE_ROWS = 512
#: Times that a rule reads the sample while it is timed, so that its work outweighs the job around it; runs, of which the shortest counts.
READS, RUNS = 24, 2


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column) -> Column:
    """The number of words in windows of ``WINDOW`` words that a text holds twice or more."""

    def of_hashes(hashes: Column) -> Column:
        windows = F.transform(F.slice(hashes, 1, F.size(hashes) - (WINDOW - 1)), lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]))
        return let(windows, lambda w: F.when(F.size(w) == F.size(F.array_distinct(w)), F.lit(0)).otherwise(of_windows(w)))

    def of_windows(windows: Column) -> Column:
        keyed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(keyed, lambda k: let(repeats(k), covered))

    def repeats(keyed: Column) -> Column:
        same = lambda x, j: F.coalesce(x["h"] == F.get(keyed, j)["h"], F.lit(False))
        again = lambda x, j: same(x, j + 1) | ((j > 0) & same(x, F.greatest(j - 1, F.lit(0))))
        return F.sort_array(F.transform(F.filter(keyed, again), lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        spans = F.transform(starts, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(spans, F.lit(0), lambda a, x: a + x)

    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes))


def counted(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    Null or blank text: all counts 0, base_failed true. _words, _lines hold the arrays.
    The windows of a text are compared by a 64-bit hash of their words' hashes: sorted, equal ones
    are neighbours, so the cost of a text is that of sorting it, however often a window repeats.
    """
    first = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    split = first.select(*keep, "_text", words_of(F.col("_text")).alias("_words"), F.filter(F.split("_text", "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0).alias("_lines"))
    made = split.select(
        *keep,
        "_text",
        "_words",
        "_lines",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size(F.split("_text", SYMBOLS)) - 1).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"),
    )
    return made.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def rules() -> dict[str, Column]:
    """name: true where the rule rejects. They read what ``counted`` makes."""
    words, n = F.col("_words"), F.col("n_words")
    share = lambda part: F.size(F.filter(words, part)) / n
    return {
        "symbols": F.col("n_symbols") > 0.3 * n,
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 14 * n),
        "duplicate_lines": F.col("n_dup_lines") > 0.3 * F.size("_lines"),
        "letters": share(lambda w: w.rlike(r"\p{L}")) < 0.6,
        "capitals": share(lambda w: w.rlike(r"\p{Lu}\P{Ll}*\p{Lu}") & ~w.rlike(r"\p{Ll}")) > 0.5,
        "few_distinct": (n >= 50) & (F.size(F.array_distinct(words)) < 0.1 * n),
        "ellipses": F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|\x{2026})[\x20\x09-\x0D]*\z"))) > 0.3 * F.size("_lines"),
        "bullets": F.size(F.filter("_lines", lambda x: x.rlike(r"\A[\x20\x09-\x0D]*[\x{2022}*-][\x20\x09-\x0D]"))) > 0.9 * F.size("_lines"),
    }


def rejections(sample: DataFrame, found: dict[str, Column]) -> list[tuple[int, int]]:
    """(pattern, rows): how many rows of ``sample`` that pass the base rules each set of rules rejects (bit k: the k-th rule). At most a row a set reaches the driver."""
    pattern = sum((F.coalesce(rule, F.lit(False)).cast("int") * F.lit(1 << k) for k, rule in enumerate(found.values())), F.lit(0))
    return [(r["p"], r["n"]) for r in sample.where("NOT base_failed").groupBy(pattern.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def costs(sample: DataFrame, found: dict[str, Column]) -> dict[str, float]:
    """Seconds that each rule takes to read ``sample`` ``READS`` times, beyond those of a rule that reads nothing. ``sample`` should be kept in memory."""
    many = sample.where("NOT base_failed").withColumn("_read", F.explode(F.sequence(F.lit(1), F.lit(READS))))

    def least(rule: Column) -> float:
        took = []
        for _ in range(RUNS):
            began = time.perf_counter()
            # The verdict depends on the reading's number, so it is not worked out once for all.
            many.agg(F.count_if(F.coalesce(rule, F.lit(False)) & (F.col("_read") > 0))).collect()
            took.append(time.perf_counter() - began)
        return min(took)

    sample.count()
    nothing = least(F.col("n_words") < 0)
    return {name: max(least(rule) - nothing, 1e-4) for name, rule in found.items()}


def ordered(names: list[str], patterns: list[tuple[int, int]], cost: dict[str, float]) -> list[str]:
    """Rule names: next is always the one that rejects most rows per cost, of the rows that those before it leave; ties by name."""
    left, out = list(names), []
    while left:
        gain = {n: sum(rows for p, rows in patterns if p >> names.index(n) & 1) / cost[n] for n in left}
        out.append(min(left, key=lambda n: (-gain[n], cost[n] if not gain[n] else 0, n)))
        left.remove(out[-1])
        patterns = [(p, rows) for p, rows in patterns if not p >> names.index(out[-1]) & 1]
    return out


def judged(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), order: list[str] | None = None) -> DataFrame:
    """``counted`` and kept, rejected_by (null if kept; 'base' for the base rules).

    ``order`` None: estimated here. Null text fails the base rules. An empty table gives
    an empty result.
    """
    made, found = counted(docs, text, keep), rules()
    if order is None:
        sample = counted(docs.sample(min(1.0, SAMPLE_ROWS / max(1, docs.count())), seed=1), text, keep).persist()
        order = ordered(list(found), rejections(sample, found), costs(sample, found))
        sample.unpersist()
    verdict = F.when(F.col("base_failed"), "base")
    for name in order:
        verdict = verdict.when(F.coalesce(found[name], F.lit(False)), name)
    made = made.withColumn("rejected_by", verdict)
    return made.withColumn("kept", F.col("rejected_by").isNull()).drop("_text", "_words", "_lines")
