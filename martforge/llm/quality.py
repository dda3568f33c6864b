"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at one or two counts of a text and votes 1 (good), 0 (bad) or abstains (null). The two-class
Dawid-Skene model - every rule has its own rates of good, bad and abstaining votes in either class - is fitted to
the counts of vote patterns, of which there are at most 3 ** rules; a pattern's posterior probability of quality
then decides, instead of all rules having to pass.

Everything that touches texts is built from SQL functions. Only the pattern counts come to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import stored, words

#: Positions that fit beside a hash in one sortable long.
PLACES = 24


def _repeats(df: DataFrame) -> DataFrame:
    """Replaces word array ``w`` by n_repeat_words: words in 3-word windows found twice or more, first included.

    Window hashes are sorted as longs with their place in the low bits; only windows whose upper hash bits meet a
    neighbour's are sorted again by the whole hash. The work is n log n in the words of a text.
    """
    two = F.lit(0).cast("long")
    low = (1 << PLACES) - 1
    df = df.withColumn("h", F.when(F.size("w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("w") - 3),
        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))).otherwise(F.array().cast("array<bigint>"))).drop("w")
    df = df.withColumn("s", F.when(F.size(F.array_distinct("h")) == F.size("h"), F.array().cast("array<bigint>"))
                       .when(F.size("h") <= low, F.sort_array(F.transform(
                           "h", lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))))
    same = lambda x, y: x.bitwiseAND(F.lit(~low)) == y.bitwiseAND(F.lit(~low))
    met = lambda a, equal: F.filter(a, lambda x, i: F.coalesce(equal(x, F.get(a, i - 1)), F.lit(False))
                                    | F.coalesce(equal(x, F.get(a, i + 1)), F.lit(False)))
    df = df.withColumn("c", F.when(F.col("s").isNull(), F.sequence(F.lit(0), F.size("h") - 1)).otherwise(
        F.transform(met(F.col("s"), same), lambda x: x.bitwiseAND(F.lit(low)).cast("int")))).drop("s")
    df = df.withColumn("t", F.sort_array(F.transform("c", lambda i: F.struct(F.get("h", i).alias("h"), i.alias("i"))))).drop("c", "h")
    df = df.withColumn("p", F.sort_array(F.transform(
        met(F.col("t"), lambda x, y: x["h"] == y["h"]), lambda x: x["i"]))).drop("t")
    steps = F.transform("p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - x, F.lit(3))))
    return df.withColumn("n_repeat_words", F.aggregate(steps, two, lambda a, x: a + x)).drop("p")


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_letters, n_marks) per row.

    Null and empty texts count 0 throughout. Other columns are not read; repeated rows each come back.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("t")).withColumns({
        "w": words(F.col("t")),
        "l": F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    rows = rows.withColumns({"j": F.array_join("w", ""), "n_words": F.size("w").cast("long"),
                             "n_lines": F.size("l").cast("long"),
                             "n_dup_lines": (F.size("l") - F.size(F.array_distinct("l"))).cast("long")}).drop("t", "l")
    without = lambda chars: F.length("j") - F.length(F.regexp_replace("j", chars, ""))
    rows = rows.withColumns({
        "word_chars": F.length("j").cast("long"),
        "n_symbols": without(r"[#*$%&|<>]+").cast("long"),
        "n_upper": without(r"[A-Z]+").cast("long"),
        "n_letters": without(r"[A-Za-z]+").cast("long"),
        "n_marks": without(r"[!?]+").cast("long")}).drop("j")
    return _repeats(rows)


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, 0).when(good, 1)




def rules() -> dict[str, Column]:
    """The rules over the columns of :func:`counts`. Every kind of defect is seen by more than one."""
    words_, symbols, marks = F.col("n_words"), _share("n_symbols", "word_chars"), _share("n_marks", "n_words")
    lines, repeats = _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words")
    upper, mean = _share("n_upper", "n_letters"), _share("word_chars", "n_words")
    return {
        "short": _vote(words_ < 50, words_ >= 100),
        "symbols": _vote(symbols > 0.04, symbols < 0.01),
        "symbol_words": _vote(_share("n_symbols", "n_words") > 0.25, _share("n_symbols", "n_words") < 0.05),
        "dup_lines": _vote((lines > 0.3) & (F.col("n_dup_lines") >= 3), F.col("n_dup_lines") == 0),
        "repeats": _vote(repeats > 0.4, repeats < 0.2),
        "heavy_repeats": F.when(repeats > 0.5, 0).when(repeats < 0.25, 1),
        "upper": _vote((upper > 0.4) & (F.col("n_letters") > 0), upper < 0.15),
        "marks": _vote(marks > 0.2, marks < 0.05),
        "word_length": _vote((mean < 2.5) | (mean > 14), mean.between(3.5, 10)),
    }


def fit(patterns: list[tuple[tuple[int | None, ...], int]], prior: float = 0.85, rounds: int = 60) -> dict[tuple, float]:
    """Posterior probability of quality per vote pattern, from (pattern, count) pairs.

    Starts from the share of bad votes and runs expectation-maximisation with one pseudo-document per rate. The
    rates are tied to the rules' meaning: a rule never votes bad more often on good texts than on bad ones. No
    patterns give an empty result.
    """
    if not patterns:
        return {}
    n_rules = len(patterns[0][0])
    good = {p: min(0.99, max(0.01, prior if 0 not in p else 0.75 ** (2 * p.count(0)) * 0.5)) for p, _ in patterns}
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        share = (sum(n * good[p] for p, n in patterns) + prior) / (total + 1)
        rate = []
        for j in range(n_rules):
            sums = {(c, v): 1.0 / 3 for c in (0, 1) for v in (0, 1, None)}
            for p, n in patterns:
                sums[1, p[j]] += n * good[p]
                sums[0, p[j]] += n * (1 - good[p])
            size = {c: sum(sums[c, v] for v in (0, 1, None)) for c in (0, 1)}
            own = {(c, v): sums[c, v] / size[c] for c in (0, 1) for v in (0, 1, None)}
            if own[1, 0] > own[0, 0]:  # turned round: the rule says nothing
                own = {(c, v): (own[0, v] + own[1, v]) / 2 for c in (0, 1) for v in (0, 1, None)}
            rate.append(own)
        new = {}
        for p, _ in patterns:
            odds = math.log(share / (1 - share)) + sum(math.log(rate[j][1, v] / rate[j][0, v]) for j, v in enumerate(p))
            new[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        moved = max(abs(new[p] - good[p]) for p in new)
        good = new
        if moved < 1e-6:
            break
    return good


def judge(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, quality, kept) per row.

    ``base_failed``: fewer than 50 words or over half of the words in repeated windows (null and empty texts fail).
    ``quality`` is the posterior probability; ``kept`` is false if the base failed, else quality >= threshold. An
    empty table gives no rows, repeated rows each come back, ties of a rule's thresholds abstain.
    """
    table = rules()
    names = [f"v_{n}" for n in table]
    rows = stored(counts(docs, id_col, text_col).withColumns({f"v_{n}": c for n, c in table.items()}), "quality-counts")
    found = rows.groupBy(*names).agg(F.count("*").alias("n")).collect()  # at most 3 ** rules patterns
    posterior = fit([(tuple(r[v] for v in names), r["n"]) for r in found])
    spark = docs.sparkSession
    scheme = ", ".join(f"{v} int" for v in names) + ", quality double"
    scored = spark.createDataFrame([(*p, q) for p, q in posterior.items()], scheme)
    same = F.lit(True)
    for v in names:
        same = same & rows[v].eqNullSafe(scored[v])
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return rows.join(F.broadcast(scored), same, "left").select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "quality", (~failed & (F.col("quality") >= threshold)).alias("kept"))
