"""Quality rules: robust multivariate outliers by the minimum covariance determinant.

Each text gives a vector of transformed statistics.  For each pair of language and source the
minimum-covariance-determinant (MCD) location and scatter are estimated from that group's rows, and a
document is rejected when its Mahalanobis distance exceeds a chi-square quantile.  A group of fewer than
``MIN_GROUP`` passing rows is judged by the estimate of its language, and where the language has fewer
too, by the estimate of the whole table; every document is judged by some estimate.

The quantile is that of ``TAIL`` = 1e-6, a distance of 6.2.  Statistics of clean texts are not quite
normal (short texts, few symbols), so that the usual 0.975 rejects four times as many of them for hardly
more of the others; measured on labelled documents, which the README gives.

Everything is DataFrame expressions.  One concentration step is one aggregation: rows are summed by
group and by a fine logarithmic bin of their squared distance, so that the half set (the share
``h_share`` of the group with the smallest distances) is a prefix of at most ``BINS`` sums, and no
group is ever gathered or sorted.  Statistics are integers in 1/256 units, so sums are exact and
reruns agree.

Results for special rows: a null or blank text has no words and fails the base rules; a null
language or source is a group of its own; a group none of whose rows passes the base rules needs no
estimate; repeated rows are judged each; whole texts are counted whatever their length; an empty table
gives an empty result; further input columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import char_count, let, words
from corpusloom.runtime import checkpoint, stored

#: Statistics are stored in this many steps a unit.
UNIT = 256
#: Logarithmic bins of squared distances: STEPS for each doubling.
STEPS, BINS = 16, 512
WINDOW = 5
#: The vector: its name, and the standard deviation (in units) below which a scatter is not trusted.
FLOORS = {"x_length": 0.12, "x_symbols": 0.06, "x_upper": 0.06, "x_marks": 0.06, "x_lines": 0.08, "x_repeats": 0.08}
DIMS = list(FLOORS)
#: Estimates are broadcast up to this many groups (about 300 bytes each); beyond it Spark joins them by shuffle.
BROADCAST_GROUPS = 20_000
CONCENTRATION_STEPS = 4
H_SHARE = 0.6
#: Passing rows that a group needs for an estimate of its own.
MIN_GROUP = 8
#: The share of a normal sample beyond the largest accepted distance.
TAIL = 1e-6
#: The group of the whole table.
WHOLE = "*"


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows of five that occur at least twice, from the words' hashes."""

    def covered(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

        def starts(s: Column) -> Column:
            same = lambda e, j: F.coalesce(F.get(s, j)["h"] == e["h"], F.lit(False))
            repeated = F.filter(s, lambda e, j: same(e, j - 1) | same(e, j + 1))
            return F.sort_array(F.transform(repeated, lambda e: e["p"]))

        def total(p: Column) -> Column:
            gaps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
            return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

        return let(let(ordered, starts), total)

    def of_words(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))),
        )
        distinct = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
        return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(let(windows, distinct))

    return let(hashes, of_words)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts and the integer vector of each text."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    packed = let(
        words(F.col(text)),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(F.transform(w, lambda x: F.xxhash64(x))).cast("long").alias("n_repeat_words"),
        ),
    )
    out = docs.withColumns(
        {
            "_w": packed,
            "n_symbols": char_count(body, r"#*$%&|<>"),
            "n_dup_lines": let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"),
            "_upper": char_count(body, r"\p{Lu}"),
            "_marks": char_count(body, r"\p{P}\p{S}"),
            "_lines": F.length(F.regexp_replace(body, r"[^\n]++", "")).cast("long") + 1,
        }
    )
    out = out.withColumns({c: F.col("_w")[c] for c in ("n_words", "word_chars", "n_repeat_words")}).drop("_w")
    share = lambda a, b: F.floor(F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1))) * UNIT)
    return out.withColumns(
        {
            "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
            "x_length": F.floor(F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))) * UNIT),
            "x_symbols": share("n_symbols", "word_chars"),
            "x_upper": share("_upper", "word_chars"),
            "x_marks": share("_marks", "word_chars"),
            "x_lines": share("n_dup_lines", "_lines"),
            "x_repeats": share("n_repeat_words", "n_words"),
        }
    ).drop("_upper", "_marks", "_lines")


def group_keys(lang: str = "lang", source: str = "source") -> list[Column]:
    """``grp``, one string for each pair of language and source, and ``pool``, one for each language; null is unlike any text."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~"))
    return [F.concat(part(lang), F.lit("\x01"), part(source)).alias("grp"), part(lang).alias("pool")]


def _chi2_even_cdf(x: float, df: int) -> float:
    """The chi-square distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(df // 2))


def chi2_quantile(q: float, df: int) -> float:
    """By bisection; ``df`` must be even."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_even_cdf(mid, df) < q else (low, mid)
    return high


def _consistency(share: float, df: int) -> float:
    """The factor that makes the scatter of the central share of a normal sample consistent."""
    return share / _chi2_even_cdf(chi2_quantile(share, df), df + 2)


P = len(DIMS)
#: Pairs (i, j) of the lower triangle, by rows.
LOWER = [(i, j) for i in range(P) for j in range(i + 1)]
ESTIMATE = [f"m_{i}" for i in range(P)] + [f"l_{i}_{j}" for i, j in LOWER]
MOMENTS = {"m": "count(*)"} | {f"s_{i}": f"sum({c})" for i, c in enumerate(DIMS)} | {f"s_{i}_{j}": f"sum({DIMS[i]} * {DIMS[j]})" for i, j in LOWER}


def _moment_sums() -> list[Column]:
    return [F.expr(f"{e} AS {name}") for name, e in MOMENTS.items()]


def _plus(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` with further columns given as SQL; one call, where columns built piece by piece take thousands."""
    return df.selectExpr("*", *(f"{e} AS {name}" for name, e in columns.items()))


def _factored(sums: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Location ``m_i``, Cholesky factor ``l_i_j`` of the scatter times ``factor``, and its log determinant.

    The squared floors stand on the diagonal, so the factor exists for any sample.
    """
    floor = [repr((FLOORS[c] * UNIT) ** 2) + "D" for c in DIMS]
    less = lambda i, j: "".join(f" - l_{i}_{k} * l_{j}_{k}" for k in range(j))
    out = _plus(sums, **{f"m_{i}": f"s_{i} / m" for i in range(P)})
    out = _plus(out, **{f"c_{i}_{j}": f"{factor!r}D * (s_{i}_{j} / m - m_{i} * m_{j})" + (f" + {floor[i]}" if i == j else "") for i, j in LOWER})
    for j in range(P):
        out = _plus(out, **{f"l_{j}_{j}": f"sqrt(greatest(c_{j}_{j}{less(j, j)}, {floor[j]}))"})
        if j + 1 < P:
            out = _plus(out, **{f"l_{i}_{j}": f"(c_{i}_{j}{less(i, j)}) / l_{j}_{j}" for i in range(j + 1, P)})
    return out.selectExpr(*keys, *ESTIMATE, " + ".join(f"ln(l_{j}_{j})" for j in range(P)) + " AS log_det")


def _distance(rows: DataFrame) -> DataFrame:
    """``rows``, which hold an estimate, with their squared Mahalanobis distance ``d2``."""
    for i, c in enumerate(DIMS):
        lower = "".join(f" - l_{i}_{k} * y_{k}" for k in range(i))
        rows = _plus(rows, **{f"y_{i}": f"({c} - m_{i}{lower}) / l_{i}_{i}"})
    return _plus(rows, d2=" + ".join(f"y_{i} * y_{i}" for i in range(P))).drop(*(f"y_{i}" for i in range(P)))


def _bin() -> Column:
    return F.least(F.lit(BINS), F.floor(F.log2(1 + F.col("d2")) * STEPS))


def _starts(rows: DataFrame) -> DataFrame:
    """Two starting estimates for each group: median and quartiles by coordinate, mean and variance."""
    width = UNIT // 8
    long = rows.select("grp", F.posexplode(F.array(*(F.floor(F.col(c) / width) for c in DIMS))).alias("dim", "cell"))
    counts = long.groupBy("grp", "dim", "cell").agg(F.count("*").alias("n"))
    order = Window.partitionBy("grp", "dim").orderBy("cell")
    whole = Window.partitionBy("grp", "dim")
    ranked = counts.withColumns({"upto": F.sum("n").over(order), "all": F.sum("n").over(whole)})
    at = lambda q: (F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("cell"))) + 0.5) * width
    spread = ranked.groupBy("grp", "dim").agg(at(0.5).alias("mid"), (at(0.75) - at(0.25)).alias("iqr"))
    floor = F.element_at(F.array(*(F.lit(FLOORS[c] * UNIT) for c in DIMS)), F.col("dim") + 1)
    spread = spread.withColumn("sd", F.greatest(F.col("iqr") / 1.349, floor))
    at_dim = lambda c, i: f"max(CASE WHEN dim = {i} THEN {c} END)"
    diagonal = lambda i, j: at_dim("sd", i) if i == j else "0D"
    robust = spread.groupBy("grp").agg(
        *(F.expr(f"{at_dim('mid', i)} AS m_{i}") for i in range(P)), *(F.expr(f"{diagonal(i, j)} AS l_{i}_{j}") for i, j in LOWER)
    )
    plain = _factored(rows.groupBy("grp").agg(*_moment_sums()), ["grp"], 1.0)
    robust = robust.selectExpr("grp", "0 AS start", *ESTIMATE)
    return robust.unionByName(plain.selectExpr("grp", "1 AS start", *(c if c[0] == "m" or len({*c.split("_")[1:]}) == 1 else f"0D AS {c}" for c in ESTIMATE)))


def _join(rows: DataFrame, estimates: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    return rows.join(F.broadcast(estimates) if few else estimates, "grp", how)


def estimate(features: DataFrame, h_share: float = H_SHARE) -> DataFrame:
    """The reweighted MCD estimate of each group of ``features`` (columns ``grp`` and the vector).

    ``features`` is read about eight times; pass a stored table.
    """
    few = features.select("grp").distinct().count() <= BROADCAST_GROUPS
    rows = features.select("grp", *DIMS)
    current = checkpoint(_starts(rows))
    for _ in range(CONCENTRATION_STEPS):
        binned = _distance(_join(rows, current, few)).groupBy("grp", "start", _bin().alias("bin")).agg(*_moment_sums())
        before = Window.partitionBy("grp", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy("grp", "start")
        half = binned.withColumns({"before": F.coalesce(F.sum("m").over(before), F.lit(0)), "all": F.sum("m").over(whole)})
        half = half.filter(F.col("before") < h_share * F.col("all"))
        sums = half.groupBy("grp", "start").agg(*(F.sum(c).alias(c) for c in MOMENTS))
        current = checkpoint(_factored(sums, ["grp", "start"], _consistency(h_share, P)))
    best = current.groupBy("grp").agg(F.min_by(F.struct(*ESTIMATE), F.struct("log_det", "start")).alias("e"))
    best = checkpoint(best.select("grp", "e.*"))
    central = _distance(_join(rows, best, few)).filter(F.col("d2") <= chi2_quantile(0.975, P))
    final = _factored(central.groupBy("grp").agg(*_moment_sums()), ["grp"], _consistency(0.975, P))
    return checkpoint(final.select("grp", *ESTIMATE))


def estimates_of(passing: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The estimate that each group of ``passing`` (``grp``, ``pool`` and the vector) is judged by.

    Pools are estimated from all their rows, and only those that a small group needs.
    """
    sizes = passing.groupBy("grp", "pool").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("pool_n", F.sum("n").over(Window.partitionBy("pool")))
    judged_by = F.when(F.col("n") >= min_group, F.col("grp")).when(F.col("pool_n") >= min_group, F.col("pool")).otherwise(F.lit(WHOLE))
    groups = checkpoint(sizes.select("grp", "pool", judged_by.alias("judge")))
    few = groups.count() <= BROADCAST_GROUPS
    own = _join(passing, groups.filter("judge = grp").select("grp"), few).select("grp", *DIMS)
    pools = groups.filter("judge = pool").select("pool").distinct()
    pooled = passing.join(F.broadcast(pools) if few else pools, "pool").select(F.col("pool").alias("grp"), *DIMS)
    parts = own if pools.isEmpty() else own.unionByName(pooled)
    if not groups.filter(F.col("judge") == WHOLE).isEmpty():
        parts = parts.unionByName(passing.select(F.lit(WHOLE).alias("grp"), *DIMS))
    found = estimate(parts).withColumnRenamed("grp", "judge")
    return checkpoint(groups.select("grp", "judge").join(found, "judge").drop("judge"))


def judge(rows: DataFrame, estimates: DataFrame, tail: float = TAIL) -> DataFrame:
    """``rows`` (statistics and ``grp``) with ``d2`` and ``kept``; only groups without a passing row have a null ``d2``."""
    few = estimates.count() <= BROADCAST_GROUPS
    judged = _distance(_join(rows, estimates, few, "left"))
    near = F.coalesce(F.col("d2") <= chi2_quantile(1 - tail, P), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & near).drop(*ESTIMATE)


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The counts and the verdict for each document, texts not carried."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *group_keys(lang, source))
    rows = stored(statistics(rows).drop("text"))
    return judge(rows, estimates_of(rows.filter(~F.col("base_failed"))))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns.

    Texts are counted once and stored beside their statistics, which alone are read for the estimates;
    they are never shuffled.
    """
    every = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    rows = stored(statistics(docs.select(every, F.col(text).alias("text"), *group_keys(lang, source))).drop("text"))
    return judge(rows, estimates_of(rows.filter(~F.col("base_failed")))).filter("kept").select("_row.*")
