"""Quality rules: fixed counts, and robust multivariate outliers per language and source.

Each document gets a vector of transformed statistics. Per language and source the mean and covariance
of the least scattered part of the vectors (minimum covariance determinant) are sought by concentration
steps from two starts: measure all vectors by the present estimate, keep the nearest three quarters,
estimate again, until the determinants stand; the start with the smaller determinant wins. The same is done
per language and for all rows. Each estimate is mixed with that of the next wider level, with the weight of
PRIOR rows there: a group of a million rows speaks for itself, a lone document is judged by its language,
and there is no size at which the rule changes. A document too far away in the Mahalanobis distance is
rejected. Only DataFrame functions are used.

Vectors are whole multiples of 1 / UNIT and sums are of whole numbers, so results do not depend on the
partitioning. Distances are counted in classes per group instead of being sorted, so a source that
holds a third of all rows costs its group a bounded table: partial aggregation comes before each shuffle.

Defined results: a null or empty text has no words and fails the fixed rules; null languages or sources
form groups of their own; a group of one document is judged mostly by its language, a language of one
document mostly by all; repeated rows are judged once each; an empty table gives an empty result; other columns stay, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import keeps_columns
from matchloom.session import store

#: Patterns of the contract.
SPACES = " \t\n\x0b\x0c\r"
NOT_SPACE = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
WINDOW = 8  # a power of two
MIN_WORDS = 20
REPEAT_PERCENT = 30

UNIT = 256
#: Rows that the estimate of the next wider level counts for.
PRIOR = 64
#: Share of the rows of a group that the estimates come from.
KEPT = 0.75
#: Concentration steps end when no determinant changes by more than TOLERANCE (of its logarithm), or after STEPS.
STEPS = 6
TOLERANCE = 0.01
#: Least standard deviation of each statistic: length of words, symbols, repeated lines, repeated
#: words, capitals. Clean groups hardly vary in most of them.
FLOORS = (0.06, 0.4, 1.1, 0.85, 0.3)
#: Least covariance of repeated lines and repeated words, as a correlation: the former bring the latter.
FLOOR_CORRELATION = {(3, 2): 0.5}
#: Share of normally distributed vectors that may be rejected. With the floors, each statistic alone can pass
#: the limit: 90 % of lines or 29 % of words repeated do so where clean documents have none.
TAIL = 1e-3

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
D = len(FLOORS)


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words found at least twice."""
    n = F.size(words)

    def doubled(hashes: Column, width: int) -> Column:
        """Hashes of `width` words to those of twice as many; the last ones are incomplete."""
        longer = let(hashes, lambda h: F.zip_with(h, F.slice(h, width + 1, F.size(h)), lambda x, y: F.xxhash64(x, y)))
        return longer if 2 * width == WINDOW else doubled(longer, 2 * width)

    each = F.transform(words, lambda w: F.xxhash64(w))
    windows = F.when(n >= WINDOW, F.slice(doubled(each, 1), 1, n - (WINDOW - 1)))

    def covered(at: Column) -> Column:
        last = F.size(at) - 1
        steps = F.transform(at, lambda p, k: F.when(k < last, F.least(F.lit(WINDOW), F.get(at, k + 1) - p)).otherwise(WINDOW))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def count(found: Column) -> Column:
        def twice(s: Column) -> Column:
            same = F.filter(s, lambda e, k: (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"]))
            return let(F.array_sort(F.transform(same, lambda e: e["at"])), covered)

        ordered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("at"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(let(ordered, twice))

    return F.coalesce(let(windows, count), F.lit(0)).cast("long")


def statistics(text: Column) -> Column:
    """The counts of a text as one struct; every step is computed once."""

    def lines(t: Column) -> Column:
        filled = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_SPACE))
        return let(filled, lambda x: F.struct(F.size(x).cast("long").alias("lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))

    def of(t: Column) -> Column:
        return let(
            words_of(t),
            lambda words: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                F.length(F.regexp_replace(t, NOT_SYMBOL, "")).cast("long").alias("n_symbols"),
                repeated_words(words).alias("n_repeat_words"),
                F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("long").alias("capitals"),
                lines(t).alias("of_lines"),
            ),
        )

    return let(F.coalesce(text, F.lit("")), of)


def words_of(text: Column) -> Column:
    """Words between the white space characters of the contract."""
    for space in SPACES[1:]:
        text = F.replace(text, F.lit(space), F.lit(SPACES[0]))
    return F.array_remove(F.split(text, SPACES[0]), "")


def measure(docs: DataFrame, name: str = "__quality", text: str = "text") -> DataFrame:
    """All columns and the statistics of each text as one struct column."""
    return docs.withColumn(name, statistics(F.col(text)))


def vector(q: Column) -> list[Column]:
    """The transformed statistics, in whole units."""
    words, chars = F.greatest(q["n_words"], F.lit(1)), F.greatest(q["word_chars"], F.lit(1))
    rates = [
        F.log1p(q["word_chars"] / words),
        F.log1p(100 * q["n_symbols"] / words),
        F.log1p(100 * q["of_lines"]["dup"] / F.greatest(q["of_lines"]["lines"], F.lit(1))),
        F.log1p(100 * q["n_repeat_words"] / words),
        F.log1p(100 * q["capitals"] / chars),
    ]
    return [F.round(r * UNIT).cast("long") for r in rates]


def base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > REPEAT_PERCENT * q["n_words"])


# ---------------------------------------------------------------- chi-squared


def chi2_cdf(x: float, d: int) -> float:
    """Regularised lower incomplete gamma function of d / 2 at x / 2, by its series."""
    a, x = d / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = 1 / a
    k = 1
    while term > total * 1e-17 and k < 10_000:
        term *= x / (a + k)
        total += term
        k += 1
    return min(1.0, math.exp(a * math.log(x) - x - math.lgamma(a)) * total)


def chi2_quantile(p: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, d) < p else (low, mid)
    return low


def consistency(kept: float, d: int) -> float:
    """Factor that makes the covariance of the nearest share right for normal data."""
    return kept / chi2_cdf(chi2_quantile(kept, d), d + 2)


# ---------------------------------------------------------------- estimates

GROUP = ["g_lang", "g_source"]
TRIAL = [*GROUP, "start"]
#: Stands for all sources of a language, and for all languages. Other keys have a mark of their own before them.
ALL = "+"
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]
MEANS, COVARIANCES = [f"mean{i}" for i in range(D)], [f"c{i}{j}" for i, j in PAIRS]
FACTORS = [f"w{i}{j}" for i, j in PAIRS]


def with_group(measured: DataFrame, name: str) -> DataFrame:
    """Adds the group of each row and its vector x0, x1, ...

    Languages and sources come in as texts with a leading mark, so nulls are groups like others.
    """
    key = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in ("lang", "source")]
    return measured.select(key[0].alias("g_lang"), key[1].alias("g_source"), "*").withColumns({f"__x{i}": x for i, x in enumerate(vector(F.col(name)))})


def levels(rows: DataFrame) -> DataFrame:
    """Each row in its group, in its language and among all."""
    of = [F.struct(F.col("g_lang") if wide < 2 else F.lit(ALL), F.col("g_source") if wide < 1 else F.lit(ALL)) for wide in range(3)]
    named = [s.cast("struct<g_lang:string,g_source:string>") for s in of]
    return rows.withColumn("__level", F.explode(F.array(*named))).withColumns({c: F.col(f"__level.{c}") for c in GROUP}).drop("__level")


def floor_moment(i: int, j: int) -> float:
    """What the floors add to a covariance."""
    return FLOORS[i] * FLOORS[j] * (1.0 if i == j else FLOOR_CORRELATION.get((i, j), 0.0))


def number(x: float) -> str:
    """A double in SQL."""
    return f"{float(x)!r}D"


#: Number of rows, sums and sums of products of vectors. Long expressions are written as SQL texts, since each
#: step from Python costs a call.
SUMS = ["n", *(f"s{i}" for i in range(D)), *(f"p{i}{j}" for i, j in PAIRS)]
MOMENTS = ["count(*)", *(f"sum(__x{i})" for i in range(D)), *(f"sum(__x{i} * __x{j})" for i, j in PAIRS)]


def moment_sums() -> list[Column]:
    return [F.expr(f"{moment} AS {name}") for moment, name in zip(MOMENTS, SUMS)]


def added_sums() -> list[Column]:
    """Such sums of parts added up."""
    return [F.expr(f"sum({name}) AS {name}") for name in SUMS]


def from_sums(summed: DataFrame, keys: list[str], scale: float) -> DataFrame:
    """Mean and covariance from such sums; `all` is the number of rows of the group."""
    means = summed.selectExpr("*", *(f"s{i} / n / {UNIT} AS mean{i}" for i in range(D)))
    moment = "(p{0}{1} / n / %d - mean{0} * mean{1}) * %s + {2} AS c{0}{1}" % (UNIT**2, number(scale))
    return means.selectExpr(*keys, "`all`", *MEANS, *(moment.format(i, j, number(floor_moment(i, j))) for i, j in PAIRS))


def starts(rows: DataFrame) -> DataFrame:
    """Two starts per group: the medians with the spread between the quartiles as a diagonal, and the moments of all rows.

    Values are counted per language and source before the wider levels are made of the counts.
    """
    each = rows.select(*GROUP, F.posexplode(F.array(*(F.col(f"__x{i}") for i in range(D)))).alias("i", "x"))
    counts = each.groupBy(*GROUP, "i", "x").agg(F.count("*").alias("n"))
    counts = levels(counts).groupBy(*GROUP, "i", "x").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*GROUP, "i")
    upto = counts.withColumn("upto", F.sum("n").over(whole.orderBy("x"))).withColumn("all", F.sum("n").over(whole))
    at = {q: F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, F.col("x"))) for q in (1, 2, 3)}
    spread = (at[3] - at[1]) / (1.349 * UNIT)
    found = upto.groupBy(*GROUP, "i").agg((at[2] / UNIT).alias("mean"), spread.alias("spread"), F.max("all").alias("all"))
    one = found.groupBy(*GROUP).agg(F.max("all").alias("all"), *(F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}") for i in range(D) for c in ("mean", "spread")))
    cov = [(F.pow(F.col(f"spread{i}"), 2) + floor_moment(i, j) if i == j else F.lit(floor_moment(i, j))).alias(f"c{i}{j}") for i, j in PAIRS]
    robust = one.select(*GROUP, F.lit(0).alias("start"), "all", *MEANS, *cov)
    summed = levels(rows.groupBy(*GROUP).agg(*moment_sums())).groupBy(*GROUP).agg(*added_sums())
    plain = from_sums(summed.select(*GROUP, F.lit(1).alias("start"), F.col("n").alias("all"), *SUMS), TRIAL, 1.0)
    return robust.unionByName(plain)


def mixed(raw: DataFrame) -> DataFrame:
    """Estimates of languages mixed with that of all rows, and of groups with those mixed ones.

    The table has two rows per group; it is stored. Each row meets that of its language and that of all once,
    instead of a plan for each level: what follows, and all that the driver keeps of it, is there once.
    """
    values = [*MEANS, *COVARIANCES]

    raw = raw.selectExpr(*TRIAL, "`all`", f"`all` / (`all` + {PRIOR}) AS own", *values)
    language = raw.filter(F.col("g_source") == ALL).selectExpr("g_lang", "start", "own AS lang_own", *(f"{v} AS lang_{v}" for v in values))
    top = raw.filter(F.col("g_lang") == ALL).selectExpr("start", *(f"{v} AS top_{v}" for v in values))
    met = raw.join(language, ["g_lang", "start"]).join(top, ["start"])
    wide = met.selectExpr(*TRIAL, "`all`", "own", *values, *(f"lang_own * lang_{v} + (1 - lang_own) * top_{v} AS wide_{v}" for v in values))
    level = "CASE WHEN g_lang = '{1}' THEN {0} WHEN g_source = '{1}' THEN wide_{0} ELSE own * {0} + (1 - own) * wide_{0} END AS {0}"
    return wide.selectExpr(*TRIAL, "`all`", *(level.format(v, ALL) for v in values))


def factor(estimates: DataFrame) -> DataFrame:
    """The inverse w00, w10, w11, ... of the Cholesky factor of each covariance, and the logarithm of its determinant."""

    def less(start: str, terms: list[str]) -> str:
        return " - ".join([start, *terms])

    for j in range(D):
        estimates = estimates.selectExpr("*", f"sqrt({less(f'c{j}{j}', [f'l{j}{k} * l{j}{k}' for k in range(j)])}) AS l{j}{j}")
        below = (f"({less(f'c{i}{j}', [f'l{i}{k} * l{j}{k}' for k in range(j)])}) / l{j}{j} AS l{i}{j}" for i in range(j + 1, D))
        estimates = estimates.selectExpr("*", *below)
    estimates = estimates.selectExpr("*", *(f"1 / l{i}{i} AS w{i}{i}" for i in range(D)))
    for gap in range(1, D):
        row = (f"-({' + '.join(f'l{j + gap}{k} * w{k}{j}' for k in range(j, j + gap))}) / l{j + gap}{j + gap} AS w{j + gap}{j}" for j in range(D - gap))
        estimates = estimates.selectExpr("*", *row)
    size = " + ".join(f"2 * ln(l{i}{i})" for i in range(D))
    return estimates.selectExpr(*TRIAL, *MEANS, *FACTORS, f"{size} AS log_det")


def distance() -> Column:
    """Squared Mahalanobis distance of the vector from the estimates joined to it."""
    parts = (" + ".join(f"w{i}{k} * (__x{k} / {UNIT} - mean{k})" for k in range(i + 1)) for i in range(D))
    return F.expr(" + ".join(f"pow({part}, 2)" for part in parts))


def concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Moments of the nearest KEPT of each group and start; ties in the last distance class all count."""
    ranked = levels(rows).join(estimates, GROUP).withColumn("near", F.floor(F.log1p(distance()) * 64))
    classes = ranked.groupBy(*TRIAL, "near").agg(*moment_sums())
    whole = Window.partitionBy(*TRIAL)
    before = F.coalesce(F.sum("n").over(whole.orderBy("near").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = classes.withColumn("before", before).withColumn("all", F.sum("n").over(whole)).filter(F.col("before") < F.ceil(F.col("all") * KEPT))
    total = inner.groupBy(*TRIAL).agg(F.max("all").alias("all"), *added_sums())
    return from_sums(total, TRIAL, consistency(KEPT, D))


def change(old: DataFrame, new: DataFrame) -> float:
    """The largest change of a logarithm of a determinant."""
    pairs = old.select(*TRIAL, F.col("log_det").alias("old")).join(new, TRIAL)
    return pairs.agg(F.coalesce(F.max(F.abs(F.col("log_det") - F.col("old"))), F.lit(0.0))).first()[0]


def estimate(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Mean and inverse Cholesky factor of each group, from the start with the least determinant.

    The tables have a few rows per group; each is stored, as the next step reads it several times.
    """
    rows = rows.select(*GROUP, *(f"__x{i}" for i in range(D)))
    now = store(factor(mixed(store(starts(rows), "moments"))), "estimates")
    for _ in range(steps):
        last, now = now, store(factor(mixed(store(concentrate(rows, now), "moments"))), "estimates")
        if change(last, now) <= TOLERANCE:
            break
    best = now.groupBy(*GROUP).agg(F.min_by(F.struct(*now.columns), F.struct("log_det", "start")).alias("best"))
    return best.select(*GROUP, *(F.col(f"best.{c}") for c in now.columns if c not in [*TRIAL, "log_det"]))


def judge(measured: DataFrame, name: str = "__quality", tail: float = TAIL) -> DataFrame:
    """Stored, measured rows with `__distance` (squared) and `__kept`."""
    rows = with_group(measured, name)
    # Groups are few beside the rows; Spark broadcasts them below its own size limit and otherwise
    # shuffles, splitting large groups.
    judged = rows.join(estimate(rows), GROUP).withColumn("__distance", distance())
    limit = chi2_quantile(1 - tail, D)
    return judged.withColumn("__kept", ~base_failed(F.col(name)) & (F.col("__distance") <= limit))


def assess(docs: DataFrame) -> DataFrame:
    """For each document its counts, whether it fails the fixed rules, and the verdict."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.col("text").cast("string").alias("text"))
    measured = store(measure(slim).drop("text"), "quality")
    q = F.col("__quality")
    counts = [(q["of_lines"]["dup"] if n == "n_dup_lines" else q[n]).alias(n) for n in STATS]
    return judge(measured).select("doc_id", *counts, base_failed(q).alias("base_failed"), F.col("__kept").alias("kept"))


@keeps_columns
def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns. The measured documents are stored once."""
    measured = store(measure(docs), "quality")
    return judge(measured).filter("__kept").select(*(F.col(f"`{c}`") for c in docs.columns))
