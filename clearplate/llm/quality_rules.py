"""Quality rules: text statistics, and robust multivariate outliers among them.

For each language and source the minimum covariance determinant is estimated by
concentration steps: take the share of rows nearest to the present centre in Mahalanobis
distance, compute their mean and covariance, repeat. Three starts are tried (median and
quartile range per dimension; mean and covariance of all rows; median and median absolute
deviation) and the smallest determinant wins. Half of the rows enter an estimate, so up to
nearly half of a group can be junk, be it copies of one row. A row far from its group's estimate is rejected.

Everything is DataFrame expressions. The statistics are whole numbers (thousandths), so
sums are exact and results do not depend on the order of rows. Each step is one pass over
narrow rows: counts and moments by group and distance bin, cut to one small row per bin
before the shuffle, so a group with a third of all rows costs its tasks a few hundred rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearplate.llm.base import SPACE, WORD, filled, let, query, table
from clearplate.session import written

MIN_WORDS = 50
STATS = ["x1", "x2", "x3", "x4", "x5"]
# Least standard deviation of each statistic, in thousandths: smaller differences never reject.
FLOORS = [700, 300, 120, 250, 120]
KEEP_SHARE = 0.5
STEPS = 5
MIN_GROUP = 100
# The group of rows judged by the whole table; no key of a language or source reads so.
WHOLE = "*"
# 99.9 % quantile of the chi-squared distribution with five degrees of freedom.
CUTOFF = 20.515
# Median of the chi-squared distribution with five degrees of freedom.
CHI2_MEDIAN = 4.351
BINS_PER_E = 32
FILES = 4


def _repeated(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more, of an array of words.

    Windows are sorted by hash with the position in the low bits; neighbours with equal
    hashes are compared word by word, so a collision is not a repeat.
    """

    def found(w: Column, b: Column) -> Column:
        keys = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.call_function("shiftleft", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), b).bitwiseOR(i.cast("long")),
        )
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1

        def meets(x: Column, y: Column) -> Column:
            i, j = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
            same = F.call_function("shiftright", x, b) == F.call_function("shiftright", y, b)
            for k in range(3):
                same = same & (F.get(w, i + k) == F.get(w, j + k))
            return F.coalesce(same, F.lit(False))

        hits = let(F.array_sort(keys), lambda s: F.filter(s, lambda x, k: meets(x, F.get(s, k - 1)) | meets(x, F.get(s, k + 1))))
        places = F.array_sort(F.transform(hits, lambda x: x.bitwiseAND(mask)))
        start = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(places, start, lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(3).cast("long"), x - acc["last"])).alias("n")), lambda acc: acc["n"])

    bits = F.ceil(F.log2(F.size(w) + 1)).cast("int")
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(found(w, bits))


def base_statistics(text: str = "text") -> list[Column]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text; null counts as empty."""
    t = filled(text)
    trimmed = F.trim(t, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeated(w).alias("n_repeat_words")))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    dup_lines = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    symbols = F.char_length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long")
    return [of_words.alias("of_words"), symbols.alias("n_symbols"), dup_lines.alias("n_dup_lines")]


def _milli(c: Column) -> Column:
    return F.round(c * 1000).cast("long")


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Statistics, their transformed vector in thousandths, the base verdict and the group of each row."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.to_json(F.struct(F.col(lang).alias("l"), F.col(source).alias("s"))).alias("fine"), F.to_json(F.struct(F.col(lang).alias("l"))).alias("coarse"), *base_statistics(text))
    base = base.select("doc_id", "fine", "coarse", "of_words.*", "n_symbols", "n_dup_lines")
    n = F.greatest(F.col("n_words"), F.lit(1))
    vector = [F.log(n), F.col("word_chars") / n, F.sqrt(F.col("n_symbols") / n), F.sqrt(F.col("n_dup_lines") / n) * 3, F.sqrt(F.col("n_repeat_words") / n)]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return base.select("*", *[_milli(v).alias(x) for x, v in zip(STATS, vector)], failed.alias("base_failed"))


def _grouped(stats: DataFrame, least: int) -> DataFrame:
    """Group key by language and source; groups with few rows are pooled by language, and what is still few with the whole table."""
    fine = stats.filter("not base_failed").groupBy("fine", "coarse").agg(F.count("*").alias("n"))
    fine = fine.withColumn("group", F.when(F.col("n") >= least, F.col("fine")).otherwise(F.col("coarse")))
    size = F.sum("n").over(Window.partitionBy("group"))
    fine = fine.withColumn("group", F.when(size >= least, F.col("group")).otherwise(F.lit(WHOLE)))
    keys = written(fine.select("fine", "group").coalesce(FILES), "groups")
    return stats.join(keys, "fine", "left")


def _taught(stats: DataFrame) -> DataFrame:
    """``group`` and vector of the rows that shape an estimate; the whole table's, where some group is judged by it, is shaped by all."""
    rows = stats.filter("not base_failed").select("group", *STATS)
    if stats.filter(F.col("group") == WHOLE).isEmpty():
        return rows
    return rows.filter(F.col("group") != WHOLE).unionByName(rows.withColumn("group", F.lit(WHOLE)))


def _moments() -> list[Column]:
    first = [F.sum(x).alias(f"s_{i}") for i, x in enumerate(STATS)]
    second = [F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"s_{i}_{j}") for i in range(len(STATS)) for j in range(i + 1)]
    return [F.count("*").alias("n"), *first, *second]


def _total(df: DataFrame, *keys: str) -> DataFrame:
    names = ["n", *[f"s_{i}" for i in range(len(STATS))], *[f"s_{i}_{j}" for i in range(len(STATS)) for j in range(i + 1)]]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])


def _estimate(sums: DataFrame, *keys: str) -> DataFrame:
    """Mean and Cholesky factor of the covariance, with the floors added to its diagonal, from moments."""
    p = range(len(STATS))
    df = sums.select(*keys, *[(F.col(f"s_{i}") / F.col("n")).alias(f"m_{i}") for i in p], *[(F.col(f"s_{i}_{j}") / F.col("n")).alias(f"c_{i}_{j}") for i in p for j in range(i + 1)])
    for i in p:
        for j in range(i + 1):
            c = F.col(f"c_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}")
            for k in range(j):
                c = c - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            df = df.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(c, F.lit(0.0)) + float(FLOORS[i] ** 2)) if i == j else c / F.col(f"l_{j}_{j}"))
    return df.select(*keys, *[f"m_{i}" for i in p], *[f"l_{i}_{j}" for i in p for j in range(i + 1)])


def _distance(scale: Column | None = None) -> Column:
    """Squared Mahalanobis distance of the row's vector under the estimate joined to it."""
    z: list[Column] = []
    for i, x in enumerate(STATS):
        r = F.col(x) - F.col(f"m_{i}")
        for k in range(i):
            r = r - F.col(f"l_{i}_{k}") * z[k]
        z.append(r / F.col(f"l_{i}_{i}"))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _bin(d2: Column) -> Column:
    return F.floor(F.log(d2 + 1e-9) * BINS_PER_E).cast("int")


def _quantiles(counted: DataFrame, x: str, **shares: float) -> DataFrame:
    """Quantiles of ``x`` by group and statistic, of rows counted by value."""
    w = Window.partitionBy("group", "i")
    ranked = counted.select("*", F.sum("n").over(w.orderBy(x)).alias("upto"), F.sum("n").over(w).alias("all"))
    return ranked.groupBy("group", "i").agg(*[F.min(F.when(F.col("upto") >= q * F.col("all"), F.col(x))).alias(name) for name, q in shares.items()])


def _robust_starts(rows: DataFrame) -> DataFrame:
    """Estimates without correlations from the median of each statistic by group.

    The scale of ``robust`` is the quartile range, which a quarter of the rows can stretch
    at will; that of ``deviation`` is the median absolute deviation, which takes half of them.
    """
    counted = rows.select("group", F.posexplode(F.array(*STATS)).alias("i", "x")).groupBy("group", "i", "x").agg(F.count("*").alias("n"))
    counted = written(counted, "counted")
    quartiles = written(_quantiles(counted, "x", a=0.25, m=0.5, b=0.75).coalesce(FILES), "quartiles")
    away = counted.join(quartiles, ["group", "i"]).groupBy("group", "i", F.abs(F.col("x") - F.col("m")).alias("d")).agg(F.sum("n").alias("n"))
    both = quartiles.join(_quantiles(away, "d", s=0.5), ["group", "i"])
    floor = F.element_at(F.array(*[F.lit(float(f)) for f in FLOORS]), F.col("i") + 1)
    scales = F.array(
        F.struct(F.lit("robust").alias("start"), F.greatest((F.col("b") - F.col("a")) / 1.349, floor).alias("s")),
        F.struct(F.lit("deviation").alias("start"), F.greatest(F.col("s") * 1.4826, floor).alias("s")),
    )
    p = range(len(STATS))
    return both.select("group", "i", "m", F.explode(scales).alias("x")).select("group", "i", "m", "x.*").groupBy("group", "start").agg(
        *[F.max(F.when(F.col("i") == i, F.col("m"))).cast("double").alias(f"m_{i}") for i in p],
        *[(F.max(F.when(F.col("i") == i, F.col("s"))) if i == j else F.lit(0.0)).alias(f"l_{i}_{j}") for i in p for j in range(i + 1)],
    )


def estimates(rows: DataFrame, share: float = KEEP_SHARE, steps: int = STEPS) -> DataFrame:
    """Minimum-covariance-determinant estimate by ``group``, with the distances' scale ``c``."""
    every = _estimate(rows.groupBy("group").agg(*_moments()), "group")
    # Few files, so that Spark sees how small the estimates are and broadcasts them.
    now = written(_robust_starts(rows).unionByName(every.withColumn("start", F.lit("all"))).coalesce(FILES), "start")
    w = Window.partitionBy("group", "start")
    for step in range(steps + 1):
        bins = rows.join(now, "group").withColumn("bin", _bin(_distance())).groupBy("group", "start", "bin").agg(*_moments())
        bins = written(bins.select("*", F.sum("n").over(w.orderBy("bin")).alias("upto"), F.sum("n").over(w).alias("all")), "bins")
        if step < steps:
            near = bins.filter(F.col("upto") - F.col("n") < share * F.col("all"))
            now = written(_estimate(_total(near, "group", "start"), "group", "start").coalesce(FILES), "step")
    middle = bins.groupBy("group", "start").agg(F.min(F.when(F.col("upto") >= 0.5 * F.col("all"), F.col("bin"))).alias("mid"))
    middle = middle.select("group", "start", (F.exp((F.col("mid") + 0.5) / BINS_PER_E) / CHI2_MEDIAN).alias("c"))
    p = len(STATS)
    size = sum((F.log(f"l_{i}_{i}") for i in range(1, p)), F.log("l_0_0"))
    best = Window.partitionBy("group").orderBy(F.round(size, 6), F.col("start").desc())
    ranked = now.join(middle, ["group", "start"]).withColumn("k", F.row_number().over(best))
    return ranked.filter("k = 1").drop("k", "start")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", cutoff: float = CUTOFF, least: int = MIN_GROUP) -> DataFrame:
    """One row per document: statistics, ``base_failed``, ``distance`` and ``kept``.

    Rows that fail the base rules (few words, mostly repeats) neither shape an estimate nor
    get a distance. Others are kept unless their squared distance, scaled so that its
    median is that of a chi-squared variable but never scaled up, exceeds ``cutoff``. Null
    languages and sources are groups of their own; groups below ``least`` rows are pooled
    by language, and where that is still too small they are judged by the estimate of the
    whole table, so that every row has a distance. Null and empty texts have zero words. Repeated rows return repeated rows, an empty table none; columns
    of other names are ignored.
    """
    stats = written(statistics(docs, doc_id, text, lang, source), "stats")
    stats = written(_grouped(stats, least), "grouped")
    fit = estimates(_taught(stats))
    joined = stats.join(written(fit.coalesce(FILES), "fit"), "group", "left")
    distance = F.when(~F.col("base_failed"), _distance() / F.greatest(F.col("c"), F.lit(1.0)))
    out = joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", distance.alias("distance"))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True)))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
