"""Operator 5: quality rules and robust multivariate outliers, in DataFrame functions only.

The statistics of a text come from its arrays of words and lines, within the row: texts are
never shuffled. Each group of language and source gets a minimum-covariance-determinant
estimate. From three deterministic starts (medians with quartile distances; mean and covariance of
all rows; medians with the correlations of the statistics' hyperbolic tangents) two concentration
steps are taken: the ``share`` of rows nearest to the centre gives the next mean and covariance.
The start with the least determinant goes on until its determinant falls no further. All sums of
a group are aggregates with partial steps, so a group may hold any share of the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logmill.llm.common import id_and_text, materialize, table

_BLANKS = r"[\x20\x09-\x0D]+"
_NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: Fixed values of the base rules.
LEAST_WORDS = 50
MOST_REPEATED = (50, 100)

#: Transformed statistics, and the standard deviation that each has at least.
FEATURES = {
    "f_words": ("ln(n_words + 1)", 0.5),
    "f_length": ("word_chars / n_words", 0.25),
    "f_symbols": ("ln(1 + 100 * n_symbols / word_chars)", 0.25),
    "f_lines": ("n_dup_lines / n_lines", 0.05),
    "f_repeats": ("n_repeat_words / n_words", 0.05),
}
#: Concentration steps of every start, then at most of the best one, and by how much the logarithm
#: of its determinant must fall for another.
FIRST_STEPS, MOST_STEPS, FALL = 2, 10, 1e-4


def normal_tail(x: float) -> float:
    """The chance that five independent normal values have a squared distance above ``x``: the tail
    of chi-square with five degrees of freedom."""
    return math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)


def normal_cutoff(tail: float) -> float:
    """The squared distance that such values exceed with the chance ``tail``."""
    low, high = 0.0, 1500.0
    for _ in range(100):
        low, high = ((low + high) / 2, high) if normal_tail((low + high) / 2) > tail else (low, (low + high) / 2)
    return high


def statistics(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``doc``, the counts of each row's whole text, and ``more``."""
    rows = id_and_text(df, id_col, text_col, *more)
    keep = [c for c in rows.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, _BLANKS), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(_NOT_BLANK))
    counted = rows.select(
        *keep,
        words.alias("w"),
        lines.alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    counted = counted.select(
        *keep,
        "w",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
    )
    return _repeat_words(counted)


def _repeat_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words`` from the words ``w``: those in a 3-word window found twice or more.

    A window is its 64-bit hash and its place. Sorted, equal windows are neighbours. Their places,
    sorted again, cover three words each, less what they share with the next.
    """
    rest = [c for c in df.columns if c != "w"]
    windows = F.expr("""sort_array(if(n_words < 3, array(), transform(sequence(1, size(w) - 2), i ->
        struct(xxhash64(w[i - 1], w[i], w[i + 1]) AS h, i AS p))))""")
    places = F.expr("""sort_array(array_distinct(flatten(array_compact(zip_with(s, slice(s, 2, size(s)), (a, b) ->
            if(a.h = b.h, array(a.p, b.p), null))))))""")
    covered = F.expr("""aggregate(zip_with(p, slice(p, 2, size(p)), (a, b) -> least(3L, coalesce(b - a, 3L))),
        0L, (total, x) -> total + x)""")
    return (
        df.select(*rest, windows.alias("s"))
        .select(*rest, places.alias("p"))
        .select(*rest, covered.alias("n_repeat_words"))
    )


def base_failed(least_words: int = LEAST_WORDS, repeated: tuple[int, int] = MOST_REPEATED) -> Column:
    few = F.col("n_words") < least_words
    return few | (F.col("n_repeat_words") * repeated[1] > F.col("n_words") * repeated[0])


def _keys(groups: DataFrame) -> list[str]:
    return [c for c in ("group", "start") if c in groups.columns]


def _joined(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups, [c for c in _keys(groups) if c in rows.columns], "left")


def _distances(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``d2``: squared Mahalanobis distance of each row from its group's centre, by forward
    substitution with the Cholesky factor of the group's covariance; for every start, if there are."""
    names = list(FEATURES)
    out = _joined(rows, _factored(groups))
    for i, f in enumerate(names):
        rest = F.col(f) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"c{i}{j}") * F.col(f"y{j}")
        out = out.withColumn(f"y{i}", rest / F.col(f"c{i}{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, len(names))), F.col("y0") * F.col("y0"))
    return out.select(*rows.columns, *[k for k in _keys(groups) if k not in rows.columns], d2.alias("d2"))


def _factored(groups: DataFrame) -> DataFrame:
    """Cholesky factor ``cij`` of each group's covariance ``sij``, with the least variances added, and
    ``log_det``, the logarithm of its determinant."""
    names = list(FEATURES)
    out = groups
    for i, f in enumerate(names):
        for j in range(i + 1):
            value = F.col(f"s{i}{j}") + (F.lit(FEATURES[f][1] ** 2) if i == j else F.lit(0.0))
            for k in range(j):
                value = value - F.col(f"c{i}{k}") * F.col(f"c{j}{k}")
            if i == j:
                value = F.sqrt(F.greatest(value, F.lit(FEATURES[f][1] ** 2)))
            else:
                value = value / F.col(f"c{j}{j}")
            out = out.withColumn(f"c{i}{j}", value)
    keep = [f"m{i}" for i in range(len(names))] + [f"c{i}{j}" for i in range(len(names)) for j in range(i + 1)]
    size = sum((2 * F.ln(f"c{i}{i}") for i in range(1, len(names))), 2 * F.ln("c00"))
    return out.select(*_keys(groups), *keep, size.alias("log_det"))


def _estimates() -> list[Column]:
    """Mean ``mi`` and covariance ``sij`` of the features, as aggregates."""
    names = list(FEATURES)
    means = [F.avg(f).alias(f"m{i}") for i, f in enumerate(names)]
    return means + [F.covar_pop(names[i], names[j]).alias(f"s{i}{j}") for i in range(len(names)) for j in range(i + 1)]


def _starts(rows: DataFrame) -> DataFrame:
    """Three first estimates of each group."""
    names = list(FEATURES)
    both = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    quarters = [F.percentile_approx(f, [0.25, 0.5, 0.75], 10_000).alias(f) for f in names]
    middle = rows.groupBy("group").agg(*quarters).select(
        "group",
        *[F.col(f)[1].alias(f"m{i}") for i, f in enumerate(names)],
        *[((F.col(f)[2] - F.col(f)[0]) / 1.349).alias(f"d{i}") for i, f in enumerate(names)],
    )
    middle, _ = materialize(middle, "medians")
    spread = [F.when(F.lit(i == j), F.col(f"d{i}") * F.col(f"d{j}")).otherwise(0.0).alias(f"s{i}{j}") for i, j in both]
    centre = [f"m{i}" for i in range(len(names))]
    plain = middle.select("group", F.lit(0).alias("start"), *centre, *spread)
    mean = rows.groupBy("group").agg(*_estimates()).select("group", F.lit(1).alias("start"), *plain.columns[2:])
    # far values count little in a tangent; a statistic that doesn't vary goes with none
    bent = _joined(rows, middle).select(
        "group", *[F.tanh((F.col(f) - F.col(f"m{i}")) / F.greatest(f"d{i}", F.lit(FEATURES[f][1]))).alias(f) for i, f in enumerate(names)]
    )
    alike = bent.groupBy("group").agg(*[F.covar_pop(names[i], names[j]).alias(f"t{i}{j}") for i, j in both])
    alike = alike.select(
        "group",
        *[F.try_divide(F.col(f"t{i}{j}"), F.sqrt(F.col(f"t{i}{i}") * F.col(f"t{j}{j}"))).alias(f"r{i}{j}") for i, j in both if i != j],
    )
    told = _joined(middle, alike)
    cross = [
        (F.col(f"d{i}") * F.col(f"d{j}") * (F.lit(1.0) if i == j else F.coalesce(f"r{i}{j}", F.lit(0.0)))).alias(f"s{i}{j}")
        for i, j in both
    ]
    return plain.unionByName(mean).unionByName(told.select("group", F.lit(2).alias("start"), *centre, *cross))


def _concentrated(rows: DataFrame, groups: DataFrame, share: float) -> DataFrame:
    """Mean and covariance of the ``share`` of each group's rows that lie nearest to its centre."""
    near, keys = _distances(rows, groups), _keys(groups)
    cut = near.groupBy(*keys).agg(F.percentile_approx("d2", share, 10_000).alias("cut"))
    near = _joined(near, cut).filter("d2 <= cut")
    return near.groupBy(*keys).agg(*_estimates())


def least_determinants(rows: DataFrame, share: float) -> DataFrame:
    """Each group's mean and covariance: the rows nearest to it, of least determinant over the starts."""
    groups, _ = materialize(_starts(rows), "centres")
    for _ in range(FIRST_STEPS):
        groups, _ = materialize(_concentrated(rows, groups, share), "centres")
    ranked = _joined(groups, _factored(groups).select("group", "start", "log_det"))
    kept = [c for c in groups.columns if c not in ("group", "start")]
    best = ranked.groupBy("group").agg(F.min(F.struct("log_det", "start", *kept)).alias("best"))
    groups, _ = materialize(best.select("group", *[F.col(f"best.{c}").alias(c) for c in kept]), "centres")
    for _ in range(MOST_STEPS):
        after, _ = materialize(_concentrated(rows, groups, share), "centres")
        new, old = (_factored(g).select("group", F.col("log_det").alias(c)) for g, c in ((after, "new"), (groups, "old")))
        fall = new.join(old, "group").agg(F.max(F.col("old") - F.col("new")).alias("fall")).first()["fall"]
        groups = after
        if (fall or 0.0) < FALL:
            break
    return groups


def judged(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    share: float = 0.75,
    tail: float = 1e-11,
    least_rows: int = 50,
    least_judged: int = 20,
) -> DataFrame:
    """``doc``, the counts, ``base_failed``, ``distance`` (squared, scaled) and ``kept``.

    A row that fails the base rules is not kept and takes no part in the estimates. Another is
    kept unless its distance exceeds the cutoff, that which five independent normal statistics
    exceed with the chance ``tail`` (chi-square with five degrees of freedom: 60 for 1e-11).
    Distances are divided by the ratio of their median to that of a normal sample, where that is
    above 1, as a covariance of the nearest rows is too small.

    Groups of language and source (null is a value of its own) with fewer than ``least_rows``
    rows, ten for each statistic, are taken together by language; where these are still fewer than
    ``least_judged``, nothing is judged: their rows have distance 0. A null or empty text has no
    words. Repeated rows count each. Other columns are not read.
    """
    lang, source = (F.col(f"`{c}`").cast("string") for c in (lang_col, source_col))
    rows = statistics(df, id_col, text_col, lang.alias("lang"), source.alias("source"))
    rows = rows.withColumn("base_failed", base_failed())
    for f, (value, _) in FEATURES.items():
        rows = rows.withColumn(f, F.when(~F.col("base_failed"), F.expr(value)))
    rows, _ = materialize(rows, "statistics")
    good = rows.filter("not base_failed")
    wide, narrow = F.to_json(F.struct("lang")), F.to_json(F.struct("lang", "source"))
    large = good.groupBy(narrow.alias("narrow")).count().filter(F.col("count") >= least_rows).select("narrow")
    large, _ = materialize(large, "large-groups")
    marked = rows.withColumn("narrow", narrow).join(large.withColumn("own", F.lit(True)), "narrow", "left")
    marked = marked.withColumn("group", F.when(F.col("own"), F.col("narrow")).otherwise(wide)).drop("narrow", "own")
    good = marked.filter("not base_failed").select("group", *FEATURES)
    good, _ = materialize(good, "features")
    groups = least_determinants(good, share)
    middle = _distances(good, groups).groupBy("group").agg(
        F.percentile_approx("d2", 0.5, 10_000).alias("middle"), F.count("*").alias("size")
    )
    middle, _ = materialize(middle, "scales")
    scaled = _joined(_distances(marked, groups), middle)
    distance = F.when(F.col("size") >= least_judged, F.col("d2") / F.greatest(F.col("middle") / normal_cutoff(0.5), F.lit(1.0)))
    distance = F.when(~F.col("base_failed"), F.coalesce(distance, F.lit(0.0)))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return scaled.select("doc", *counts, "base_failed", distance.alias("distance")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("distance") <= normal_cutoff(tail))
    )


def op5_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")
