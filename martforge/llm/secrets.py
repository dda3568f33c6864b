"""Secret scans: key patterns plus a battery of randomness tests under a false-discovery bound.

Candidates are runs of 20 or more characters of the usual key alphabets. The smallest alphabet that holds all of a
candidate's characters is its inferred encoding (decimal, hex, small or capital letters, base32, base62, base64).

Battery, against independent uniform draws from the encoding's alphabet: chi-squared of the symbol counts, runs
above and below the middle of the alphabet, and lag-one serial correlation. Each null has its exact mean and variance
at the candidate's length and alphabet. The combined p-value is three times the smallest (Bonferroni), at most one.

False discoveries: ordinary writing - slugs, paths, identifiers - is modelled as a chain of symbols: its letters follow
each other as in the words of the corpus, its changes between capitals, small letters, digits and separators are the
fixed ``CHANGES``. A candidate's p-value is its likelihood under that model over the likelihood of uniform draws from the
encoding times the battery's combined p-value. As that is at most one, the divisor sums to at most one over all strings, so
writing falls below x with a chance of x at most (Markov); for keys the ratio falls with every symbol, and a string that
the battery finds uneven needs as many more orders of magnitude. Benjamini-Hochberg is applied per length class over all
candidates.

Only SQL functions touch the texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.llm.common import stored

#: Kinds in the order in which spans that start together are listed. Fixed patterns.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "random": r"[A-Za-z0-9+/_-]+={0,2}",
}
LEAST = {"assign": 12, "access": 18, "hex": 16, "random": 20}
#: Quick test whether a text can hold a span of the kind at all.
PRESENT = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": r"AKIA[A-Z0-9]{14}",
    "hex": r"[0-9a-f]{16}",
    "random": r"[A-Za-z0-9+/_-]{20}",
}
#: What is cut out: only runs that are long enough, where that gives the same matches.
CUT = {
    "assign": PATTERNS["assign"],
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    "random": r"[A-Za-z0-9+/_-]{20,}={0,2}",
}
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "small": "abcdefghijklmnopqrstuvwxyz",
    "capital": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Lengths at which a new class begins for the false-discovery bound.
CLASSES = (32, 48, 64, 128)
#: Chances that a symbol of writing (U capital, L small letter, D digit, S separator) is followed by one of each class.
CHANGES = {"U": {"U": 0.40, "L": 0.45, "D": 0.07, "S": 0.08}, "L": {"U": 0.06, "L": 0.80, "D": 0.06, "S": 0.08},
           "D": {"U": 0.06, "L": 0.10, "D": 0.70, "S": 0.14}, "S": {"U": 0.20, "L": 0.55, "D": 0.20, "S": 0.05}}
#: Letter frequencies in percent, a to z, that stand for ``PRIOR`` pairs per first letter beside those of the corpus.
LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
PRIOR = 50


def _cut(kind: str, rank: int) -> Column:
    """Array of (rank, i, gap, hit): the matches of a kind and the length of what lies before each."""
    zipped = F.arrays_zip(F.split("t", CUT[kind], -1), F.regexp_extract_all("t", F.lit(CUT[kind]), F.lit(0)))
    return F.transform(zipped, lambda x, i: F.struct(
        F.lit(rank).alias("rank"), i.alias("i"), F.length(x["0"]).alias("gap"), x["1"].alias("hit")))


def _spans(docs: DataFrame) -> DataFrame:
    """(id, h, k, kind, start, end, hit): every match of ``CUT`` that is long enough, by text (id, h, k)."""
    parts = [F.when(F.col("t").rlike(PRESENT[kind]), _cut(kind, rank)).otherwise(
        F.array().cast("array<struct<rank:int,i:int,gap:int,hit:string>>")) for rank, kind in enumerate(CUT)]
    rows = docs.select("id", "h", "k", F.explode(F.concat(*parts)).alias("m")).select("id", "h", "k", "m.*").where("hit is not null")
    before = Window.partitionBy("id", "h", "k", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("hit")).over(before)
    kind = F.element_at(F.array(*map(F.lit, CUT)), F.col("rank") + 1)
    held = F.when(F.col("kind") == "assign", F.length(F.regexp_extract("hit", PATTERNS["assign"], 2)) >= LEAST["assign"]).otherwise(True)
    return (rows.withColumns({"end": end.cast("long"), "kind": kind})
            .withColumn("start", F.col("end") - F.length("hit")).where(held))


def _tail(z: Column) -> Column:
    """Upper tail of the standard normal (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    far = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, far).otherwise(1 - far)


def _battery(rows: DataFrame) -> DataFrame:
    """Adds n, length class, chi_p, runs_p, serial_p and their combined p-value ``battery`` to candidates (column ``hit``)."""
    bare = F.translate(F.regexp_replace("hit", "=+$", ""), "-_", "+/")
    encoding = (F.when(F.col("s").rlike("^[0-9]+$"), "decimal").when(F.col("s").rlike("^[0-9a-f]+$"), "hex")
                .when(F.col("s").rlike("^[0-9A-F]+$"), "hex")
                .when(F.col("s").rlike("^[a-z]+$"), "small").when(F.col("s").rlike("^[A-Z]+$"), "capital").when(F.col("s").rlike("^[A-Z2-7]+$"), "base32")
                .when(F.col("s").rlike("^[A-Za-z0-9]+$"), "base62").otherwise("base64"))
    alphabet = F.lit(None).cast("string")
    for name, symbols in ALPHABETS.items():
        alphabet = F.when(F.col("encoding") == name, symbols).otherwise(alphabet)
    rows = rows.withColumn("s", bare).withColumn("encoding", encoding).withColumn("alphabet", alphabet)
    rows = rows.withColumn("s", F.when(F.col("encoding") == "hex", F.lower("s")).otherwise(F.col("s")))
    rows = rows.withColumns({"n": F.length("s").cast("double"), "size": F.length("alphabet").cast("double")})
    rows = rows.withColumn("values", F.transform(F.split("s", ""), lambda c: F.instr(F.col("alphabet"), c).cast("double") - 1))
    square = F.aggregate(F.split("alphabet", ""), F.lit(0.0), lambda a, c: a + F.pow(F.length("s") - F.length(F.replace("s", c, F.lit(""))), F.lit(2)))
    high = F.transform("values", lambda v: (v >= F.col("size") / 2).cast("int"))
    rows = rows.withColumns({"square": square, "high": high})
    add = lambda a, x: a + x
    rows = rows.withColumns({
        "n1": F.aggregate("high", F.lit(0), add).cast("double"),
        "runs": 1 + F.aggregate(F.transform("high", lambda x, i: F.coalesce((x != F.get("high", i - 1)).cast("int"), F.lit(0))), F.lit(0), add),
        "mean": F.aggregate("values", F.lit(0.0), add) / F.col("n")})
    rows = rows.withColumns({
        "spread": F.aggregate("values", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean"))),
        "lagged": F.aggregate(F.transform("values", lambda x, i: F.when(i > 0, (x - F.col("mean")) * (F.get("values", i - 1) - F.col("mean"))).otherwise(F.lit(0.0))), F.lit(0.0), add)})
    # the statistic has mean size - 1 and variance 2 (size - 1) (n - 1) / n: a gamma of that mean and variance
    n, n1, n2, df = F.col("n"), F.col("n1"), F.col("n") - F.col("n1"), (F.col("size") - 1) * F.col("n") / (F.col("n") - 1)
    chi = F.col("size") / n * F.col("square") - n
    chi_z = (F.pow(F.greatest(chi, F.lit(0.0)) / (F.col("size") - 1), F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    both = 2 * n1 * n2
    spread = both * (both - n) / (n * n * (n - 1))
    runs_p = F.when((n1 == 0) | (n2 == 0) | (spread <= 0), 0.0).otherwise(2 * _tail(F.abs((F.col("runs") - both / n - 1) / F.sqrt(F.greatest(spread, F.lit(1e-9))))))
    serial_p = F.when(F.col("spread") == 0, 0.0).otherwise(2 * _tail(F.abs((F.col("lagged") / F.greatest(F.col("spread"), F.lit(1e-9)) + 1 / n) * F.sqrt(n))))
    return rows.withColumns({
        "chi_p": _tail(chi_z), "runs_p": runs_p, "serial_p": serial_p,
        "battery": F.least(3 * F.least(_tail(chi_z), runs_p, serial_p), F.lit(1.0)),
        "class": sum((n >= at).cast("int") for at in CLASSES)})


def _writing(texts: DataFrame) -> list[float]:
    """log10 of the chance that writing goes on from symbol a with symbol b, at place 64a + b in the order of base64.

    Learnt from the words (2 to 19 ASCII letters) of all texts.
    """
    words = texts.select(F.explode(F.regexp_extract_all("t", F.lit(r"(?<![A-Za-z0-9+/_-])[A-Za-z]{2,19}(?![A-Za-z0-9+/_-])"), F.lit(0))).alias("w"))
    counted = words.groupBy(F.lower("w").alias("w")).agg(F.count("*").alias("n"))
    pairs = counted.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring("w", i, F.lit(2)))).alias("pair"))
    seen = {r.pair: r.n for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect()}  # at most 26 x 26 rows
    letters = "abcdefghijklmnopqrstuvwxyz"
    single = {c: f / sum(LETTERS) for c, f in zip(letters, LETTERS)}
    total = {c: sum(seen.get(c + d, 0) for d in letters) for c in letters}
    kind = lambda c: "U" if c.isupper() else "L" if c.islower() else "D" if c.isdigit() else "S"

    def chance(a: str, b: str) -> float:
        if not b.isalpha():
            return 0.1 if b.isdigit() else 0.5
        a, b = a.lower(), b.lower()
        return (seen.get(a + b, 0) + PRIOR * single[b]) / (total[a] + PRIOR) if a.isalpha() else single[b]

    return [math.log10(CHANGES[kind(a)][kind(b)] * chance(a, b)) for a in ALPHABETS["base64"] for b in ALPHABETS["base64"]]


def discoveries(candidates: DataFrame, writing: list[float], rate: float = 0.05) -> DataFrame:
    """The candidates that hold at false-discovery rate ``rate`` in their length class, by the p-values of the module's text.

    p-values are rounded up to hundredths of a power of ten so that Benjamini-Hochberg runs over counts per step (at most 30,001 per
    class) instead of a sort of all candidates.
    """
    tested = _battery(candidates)
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in writing)), ",").cast("array<double>")
    places = F.transform(F.split("s", ""), lambda c: F.instr(F.lit(ALPHABETS["base64"]), c) - 1)
    # the first symbol as after a separator
    chain = F.aggregate("places", F.struct(F.lit(0.0).alias("sum"), F.lit(63).alias("last")), lambda a, x: F.struct(
        (a["sum"] + F.get(F.col("table"), a["last"] * 64 + x)).alias("sum"), x.alias("last")), lambda a: a["sum"])
    # written out, so that no later filter pulls the battery's expressions apart
    odds = chain + F.col("n") * F.log10("size") - F.log10("battery")  # null where the battery's p-value is zero
    rows = stored(tested.withColumns({"places": places, "table": table}).withColumn("log_p", odds).drop(
        "values", "high", "s", "alphabet", "places", "table"), "secret-tests")
    step = F.least(F.floor(-F.col("log_p") * 100), F.lit(30_000)).cast("int")
    rows = rows.withColumn("step", F.when(F.col("log_p").isNull(), 0).otherwise(F.greatest(step, F.lit(0))))
    counts = rows.groupBy("class", "step").agg(F.count("*").alias("c"))
    down = Window.partitionBy("class").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("class")
    held = counts.withColumns({"so_far": F.sum("c").over(down), "all": F.sum("c").over(whole)}).where(
        F.pow(F.lit(10.0), -F.col("step") / 100) <= rate * F.col("so_far") / F.col("all"))
    bar = held.groupBy("class").agg(F.min("step").alias("bar"))
    return rows.join(F.broadcast(bar), "class").where("step >= bar")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, spans): texts has a row per row of ``docs`` (id, h, k), spans (id, h, k, kind, start, end, hit).

    A text is known by its id and two hashes, so repeated rows are scanned once and share their spans. Positions are
    code points, ends exclusive. Base matches are leftmost and do not overlap within a kind; a random string that a
    base match covers is not listed again. Null and empty texts have no spans; an empty table gives empty tables.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).withColumns(
        {"h": F.xxhash64("t"), "k": F.xxhash64(F.lit(1), "t")})
    any_of = F.lit(False)
    for kind in PRESENT.values():
        any_of = any_of | F.col("t").rlike(kind)
    found = stored(_spans(texts.where(any_of)).select("id", "h", "k", "kind", "start", "end", "hit").distinct(), "secret-spans")
    long = found.where("kind = 'random'")
    chosen = discoveries(long, _writing(texts)).select("id", "h", "k", "kind", "start", "end", "hit")
    spans = found.where("kind <> 'random'").union(chosen)
    until = Window.partitionBy("id", "h", "k").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    spans = spans.withColumn("covered", F.max(F.when(F.col("kind") != "random", F.col("end"))).over(until))
    spans = spans.where((F.col("kind") != "random") | F.col("covered").isNull() | (F.col("covered") < F.col("end"))).drop("covered")
    return texts.select("id", "h", "k"), spans


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) per row of ``docs``; see :func:`scan`."""
    texts, spans = scan(docs, id_col, text_col)
    place = F.struct("start", F.array_position(F.array(*map(F.lit, CUT)), F.col("kind")).alias("rank"), "end", "kind")
    listed = spans.groupBy("id", "h", "k").agg(F.sort_array(F.collect_list(place)).alias("all"))  # one text's spans
    shown = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("all", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    a, b = texts.alias("a"), listed.alias("b")
    same = F.expr("a.id <=> b.id and a.h = b.h and a.k = b.k")
    none = F.array().cast("array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>")
    joined = a.join(b, same, "left").select(F.col("a.id").alias(id_col), F.coalesce("all", none).alias("all"))
    base = F.filter("all", lambda x: x["kind"] != "random")
    return joined.select(id_col, count("assign"), count("access"), count("hex"),
                         F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("all")).alias("spans"))
