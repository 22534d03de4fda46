"""Quality rules: text statistics, and multivariate outliers by minimum covariance determinants.

All of it is DataFrame expressions. Statistics come from one pass over a text, without a shuffle.
For each language and source, the scatter of transformed statistics is estimated from the part of
the rows with the smallest covariance determinant. Concentration steps (mean, covariance and distances of
the closest rows) run from several starts; the start whose determinant is least after a few steps goes on
until its determinant no longer falls. Only counts per histogram bin and sums per group are shuffled,
whatever the size of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.llm.common import cut_lineage

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Share of a group's rows that the determinant is minimised over.
CORE = 0.75
#: Concentration steps from every start, after which the best start of a group goes on alone.
FIRST_STEPS = 2
#: A determinant falls if its logarithm does so by this much. Steps end when none falls, and at the latest after so many.
LEAST_FALL, MOST_STEPS = 1e-4, 30
#: Smallest spread of each transformed statistic: below it, differences say nothing about quality.
LEAST_SPREAD = (0.12, 0.08, 0.12, 0.10)
#: Groups with fewer rows share the estimate of their language, and languages with fewer that of all.
LEAST_ROWS = 60
#: Median and cut of the squared distance: chi-squared with four degrees of freedom, at 1 - 1e-6.
MEDIAN_4, CUT_4 = 3.3567, 33.377


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts in ``STATISTICS`` for each whole text; existing columns of these names are replaced.

    Words are runs of characters other than the six ASCII blanks. A null or empty text counts zero
    everywhere. ``n_repeat_words`` counts the words in three-word windows that occur twice or more. To
    find these, windows are sorted by a key of hash and position, and neighbours of equal hash are
    compared word by word; time grows as n log n with the length of a text.
    """
    kept = [c for c in df.columns if c not in STATISTICS]
    value = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(value, r"[\x20\x09-\x0D]+", -1), "")
    lines = F.filter(F.split(value, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    base = df.select(
        *kept,
        words.alias("__words"),
        lines.alias("__lines"),
        F.char_length(F.translate(value, BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length(value) - F.char_length(F.translate(value, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    base = base.select(
        *kept, "word_chars", "n_symbols", "__words",
        F.size("__words").cast("long").alias("n_words"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
    )
    windows = F.col("n_words") - 2

    def word(at: Column) -> Column:
        return F.get("__words", at.cast("int"))

    def key(at: Column) -> Column:
        hashed = F.shiftright(F.xxhash64(word(at), word(at + 1), word(at + 2)), 1)
        return hashed - F.pmod(hashed, windows) + at

    keys = F.when(windows > 1, F.sort_array(F.transform(F.sequence(F.lit(0).cast("long"), windows - 1), key)))
    sorted_keys = base.withColumn("__keys", keys)

    def place(k: Column) -> Column:
        return F.pmod(k, windows)

    def equal(a: Column, b: Column) -> Column:
        one, two = place(a), place(b)
        same = [word(one + i) == word(two + i) for i in range(3)]
        return F.coalesce((a - one == b - two) & same[0] & same[1] & same[2], F.lit(False))

    # each key against the next: whether the two windows are equal
    later = F.slice("__keys", F.lit(2), F.greatest(F.size("__keys") - 1, F.lit(0)))
    sorted_keys = sorted_keys.withColumn("__next", F.zip_with("__keys", later, equal))

    def neighbour(k: Column, i: Column) -> Column:
        return F.get("__next", i) | F.coalesce(F.get("__next", i - 1), F.lit(False))

    places = F.sort_array(F.transform(F.filter("__keys", neighbour), place))
    repeated = sorted_keys.withColumn("__places", F.coalesce(places, F.array().cast("array<bigint>")))
    covered = F.transform(
        "__places", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("__places", i + 1) - p, F.lit(3).cast("long")))
    )
    return repeated.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> list[Column]:
    """Transformed statistics: word length, and the rates of symbols, repeated lines and repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log1p(F.col("word_chars") / n),
        F.sqrt(F.col("n_symbols") / n),
        F.sqrt(F.col("n_dup_lines") / F.sqrt(n)) * 0.5,
        F.sqrt(F.col("n_repeat_words") / n),
    ]


_X = [f"__x{i}" for i in range(len(LEAST_SPREAD))]


def _with_vector(df: DataFrame, groups: list[str]) -> DataFrame:
    key = F.to_json(F.struct(*groups), {"ignoreNullFields": "false"})
    wide = F.to_json(F.struct(groups[0]), {"ignoreNullFields": "false"})
    return df.withColumns({"__fine": key, "__wide": wide, **dict(zip(_X, _vector()))})


def _at_share(bins: DataFrame, share: float, keys: list[str]) -> DataFrame:
    """The first bin up to which ``share`` of the counts lie."""
    own = Window.partitionBy(*keys)
    running = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return (
        bins.withColumn("__run", F.sum("n").over(running)).withColumn("__all", F.sum("n").over(own))
        .where(F.col("__run") >= share * F.col("__all")).groupBy(*keys).agg(F.min("bin").alias("at"))
    )


def _distance(df: DataFrame) -> Column:
    """Squared Mahalanobis distance by forward substitution; the parameters are columns ``m``, ``l``."""
    solved: list[Column] = []
    total = F.lit(0.0)
    for i, x in enumerate(_X):
        rest = F.col(x) - F.col("m")[i]
        for k in range(i):
            rest = rest - F.col("l")[i * len(_X) + k] * solved[k]
        solved.append(rest / F.col("l")[i * len(_X) + i])
        total = total + solved[i] * solved[i]
    return total


def _factor(moments: DataFrame) -> DataFrame:
    """Mean, lower Cholesky factor of the covariance from sums, one column per entry, and ``logdet`` from its diagonal."""
    size = range(len(_X))
    out = moments.withColumns({f"__m{i}": F.round(F.col(f"__s{i}") / F.col("__n"), 9) for i in size})
    for i in size:
        for j in range(i + 1):
            value = F.col(f"__s{i}_{j}") / F.col("__n") - F.col(f"__s{i}") * F.col(f"__s{j}") / F.col("__n") / F.col("__n")
            value = F.round(value, 9) + (LEAST_SPREAD[i] ** 2 if i == j else 0.0)
            for k in range(j):
                value = value - F.col(f"__l{i}_{k}") * F.col(f"__l{j}_{k}")
            entry = F.sqrt(F.greatest(value, F.lit(LEAST_SPREAD[i] ** 2 / 4))) if i == j else value / F.col(f"__l{j}_{j}")
            out = out.withColumn(f"__l{i}_{j}", entry)
    entries = [F.col(f"__l{i}_{j}") if j <= i else F.lit(0.0) for i in size for j in size]
    logdet = sum((F.log(F.col(f"__l{i}_{i}")) for i in size), F.lit(0.0)) * 2
    return out.select(
        "g", "start", F.array(*[F.col(f"__m{i}") for i in size]).alias("m"), F.array(*entries).alias("l"), F.round(logdet, 9).alias("logdet")
    )


def _starts(quartiles: DataFrame) -> DataFrame:
    """Where concentration starts: at the medians with the spread of the quartiles, and at the medians, the lower and the
    upper quartiles with the least spread. A cluster that moves medians or widens quartiles misleads some of these only."""
    size = range(len(_X))

    def at(quartile: int) -> Column:
        return F.array(*[F.max(F.when(F.col("x") == i, (F.col(f"q{quartile}") + 0.5) / 100)) for i in size])

    wide = [F.max(F.when(F.col("x") == i, F.greatest((F.col("q2") - F.col("q0")) / 134.9, F.lit(LEAST_SPREAD[i])))) for i in size]
    least = [F.lit(x) for x in LEAST_SPREAD]

    def diagonal(spread: list[Column]) -> Column:
        return F.array(*[spread[i] if i == j else F.lit(0.0) for i in size for j in size])

    starts = [(at(1), diagonal(wide)), (at(1), diagonal(least)), (at(0), diagonal(least)), (at(2), diagonal(least))]
    found = quartiles.groupBy("g").agg(*[c.alias(f"{n}{i}") for i, pair in enumerate(starts) for n, c in zip("ml", pair)])
    each = F.array(*[F.struct(F.lit(i).alias("start"), F.col(f"m{i}").alias("m"), F.col(f"l{i}").alias("l")) for i in range(len(starts))])
    return found.select("g", F.explode(each).alias("of")).select("g", "of.start", "of.m", "of.l")


def fit(stats: DataFrame, groups: list[str]) -> DataFrame:
    """Estimates per group: key ``g``, mean ``m``, Cholesky factor ``l``, ``logdet`` and the cut of the distance.

    ``stats`` holds the statistics and the group columns, language first; it is read several times,
    so pass a written table. Rows that fail the base rules take no part. A null group value is a
    group like any other. Every group has an estimate of its own from ``LEAST_ROWS`` rows on; there
    is also one for each language (key of the language alone) and one for all rows (``"all"``). Of the
    estimates met on the way, a group has the one with the least determinant.
    """
    rows = _with_vector(stats.where(~base_failed()), groups).select("__fine", "__wide", *_X)
    counts = rows.groupBy("__fine", "__wide").agg(F.count(F.lit(1)).alias("n"))
    # a row takes part under its own key, its language and all
    homes = F.array(F.col("__fine"), F.col("__wide"), F.lit("all"))
    sizes = counts.select(F.explode(F.array_distinct(homes)).alias("g"), "n").groupBy("g").agg(F.sum("n").alias("n"))
    large = cut_lineage(sizes.where((F.col("n") >= LEAST_ROWS) | (F.col("g") == "all")).select("g"))
    members = rows.withColumn("g", F.explode(F.array_distinct(homes))).join(large, "g", "left_semi").select("g", *_X)

    cells = members.select("g", F.posexplode(F.array(*[F.floor(F.col(x) * 100).cast("int") for x in _X])).alias("x", "bin"))
    cells = cut_lineage(cells.groupBy("g", "x", "bin").agg(F.count(F.lit(1)).alias("n")))
    low, mid, high = (_at_share(cells, q, ["g", "x"]).withColumnRenamed("at", f"q{i}") for i, q in enumerate((0.25, 0.5, 0.75)))
    estimate = cut_lineage(_starts(low.join(mid, ["g", "x"]).join(high, ["g", "x"])))
    size = range(len(_X))

    def measured(estimate: DataFrame) -> DataFrame:
        found = members.join(estimate, "g")
        return found.withColumn("bin", F.floor(32 * F.log2(_distance(found) + 1e-6)).cast("int"))

    def histogram(estimate: DataFrame) -> DataFrame:
        return cut_lineage(measured(estimate).groupBy("g", "start", "bin").agg(F.count(F.lit(1)).alias("n")))

    def concentrated(estimate: DataFrame) -> DataFrame:
        core = _at_share(histogram(estimate), CORE, ["g", "start"])
        within = cut_lineage(estimate.join(core, ["g", "start"]).select("g", "start", "m", "l", "at"))
        chosen = measured(within).where(F.col("bin") <= F.col("at"))
        sums = [F.sum(F.col(_X[i])).alias(f"__s{i}") for i in size]
        products = [F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"__s{i}_{j}") for i in size for j in range(i + 1)]
        return cut_lineage(_factor(chosen.groupBy("g", "start").agg(F.count(F.lit(1)).alias("__n"), *sums, *products)))

    for _ in range(FIRST_STEPS):
        estimate = concentrated(estimate)
    best = cut_lineage(
        estimate.groupBy("g").agg(F.min_by(F.struct("start", "m", "l", "logdet"), F.struct("logdet", "start")).alias("of")).select("g", "of.*")
    )
    falling = best
    for _ in range(MOST_STEPS):
        after = concentrated(falling)
        lower = after.join(best.select("g", F.col("logdet").alias("__before")), "g").where(F.col("logdet") < F.col("__before") - LEAST_FALL)
        falling = cut_lineage(lower.drop("__before"))
        if falling.isEmpty():
            break
        best = cut_lineage(best.join(falling, "g", "left_anti").unionByName(falling.select(best.columns)))

    # the core is narrower than the whole: bring the median distance to where it is for a normal distribution
    middle = _at_share(histogram(best), 0.5, ["g"])
    scale = F.greatest(F.pow(F.lit(2.0), (F.col("at") + 1) / 32.0) / MEDIAN_4, F.lit(1.0))
    return cut_lineage(best.join(middle, "g").select("g", "m", "l", "logdet", (scale * CUT_4).alias("cut")))


def judge(df: DataFrame, estimates: DataFrame, groups: list[str]) -> DataFrame:
    """Add ``base_failed``, ``distance`` (of its cut; null if the base rules fail) and ``kept``.

    ``df`` holds the statistics and the group columns. A row is measured by its own group's estimate,
    else its language's, else that of all; with no estimate at all it is kept if the base rules hold.
    Existing columns of these names are replaced; null groups, repeated rows and empty tables are
    treated as any other.
    """
    columns = [c for c in df.columns if c not in ("base_failed", "distance", "kept")]
    rows = _with_vector(df.select(*columns), groups)
    known = estimates.select("g").withColumn("__known", F.lit(True))
    keys = rows.groupBy("__fine", "__wide").agg(F.count(F.lit(1)).alias("__rows"))
    for name, key in (("__has_fine", "__fine"), ("__has_wide", "__wide")):
        keys = keys.join(known.select(F.col("g").alias(key), F.col("__known").alias(name)), key, "left")
    used = F.when(F.col("__has_fine"), F.col("__fine")).when(F.col("__has_wide"), F.col("__wide")).otherwise("all")
    # written, so that Spark knows its size and leaves the rows where they are as long as it is small
    own = cut_lineage(keys.select("__fine", used.alias("g")).join(estimates.drop("logdet"), "g", "left").drop("g"))
    found = rows.join(own, "__fine", "left")
    distance = F.when(~base_failed(), _distance(found) / F.col("cut"))
    return found.select(
        *columns, base_failed().alias("base_failed"), distance.alias("distance"),
        (~base_failed() & (F.coalesce(distance, F.lit(0.0)) <= 1)).alias("kept"),
    )
