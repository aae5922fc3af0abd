"""Quality rules: counts of each text, then robust multivariate outliers within language and source."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.work import SPACE, Scratch, let, words_of

WINDOW = 8
#: Smallest spread each transformed statistic may have; a group that hardly varies rejects nothing within it.
FLOORS = {"x_len": 0.8, "x_word": 0.5, "x_symbol": 0.02, "x_repeat": 0.12, "x_lines": 0.15, "x_upper": 0.05, "x_punct": 0.04}


def _repeated(words: Column) -> Column:
    """How many words lie in 8-word windows that occur twice or more in the text, the first occurrence included."""

    def covered(starts: Column) -> Column:
        # starts, ascending, of windows that repeat: each adds the words up to the next one, 8 at most
        n = F.size(starts)
        gaps = F.transform(starts, lambda x, i: F.when(i + 1 < n, F.least(F.lit(WINDOW), F.get(starts, i + 1) - x)).otherwise(WINDOW))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, g: a + g)

    def starts(windows: Column) -> Column:
        def among(s: Column) -> Column:
            twin = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
            return let(F.sort_array(F.transform(twin, lambda x: x["p"])), covered)

        return let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), among)

    def from_hashes(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(starts(w)))

    return F.when(F.size(words) < WINDOW + 1, F.lit(0).cast("bigint")).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), from_hashes))


def text_counts(text: Column) -> Column:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the counts behind the other statistics, as a struct."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = lambda c: c.cast("bigint")
    without = lambda pattern: n(F.length(t) - F.length(F.regexp_replace(t, pattern, "")))
    line_counts = let(lines, lambda ls: F.struct(n(F.size(ls)).alias("n_lines"), n(F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines")))
    word_counts = let(words_of(text), lambda w: F.struct(n(F.size(w)).alias("n_words"), n(F.length(F.array_join(w, ""))).alias("word_chars"), _repeated(w).alias("n_repeat_words")))
    return F.struct(word_counts.alias("w"), line_counts.alias("l"), without("[#*$%&|<>]").alias("n_symbols"), without("[A-Z]").alias("n_upper"), without(r"[.,;:!?\-\"'()]").alias("n_punct"))


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep, the counts, and the transformed statistics x_*: one row a document."""
    c = docs.select(*keep, text_counts(F.col("text")).alias("c")).select(*keep, "c.w.*", "c.l.*", "c.n_symbols", "c.n_upper", "c.n_punct")
    chars, words = F.greatest(F.col("word_chars"), F.lit(1)), F.greatest(F.col("n_words"), F.lit(1))
    return c.withColumns({
        "x_len": F.log1p("n_words"),
        "x_word": F.col("word_chars") / words,
        "x_symbol": F.sqrt(F.col("n_symbols") / chars),
        "x_repeat": F.sqrt(F.col("n_repeat_words") / words),
        "x_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "x_upper": F.sqrt(F.col("n_upper") / chars),
        "x_punct": F.sqrt(F.col("n_punct") / chars),
    })


def _gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by its series."""
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= x / k
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_quantile(p: float, d: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _gamma_p(d / 2, mid / 2) < p else (lo, mid)
    return lo


def _with_distance(rows: DataFrame, xs: list[str]) -> DataFrame:
    """d2 from centre m_i and Cholesky factor l_i_j of the row's cell: forward substitution, column by column."""
    for i, x in enumerate(xs):
        y = F.col(x) - F.col(f"m_{i}")
        for j in range(i):
            y = y - F.col(f"l_{i}_{j}") * F.col(f"y_{j}")
        rows = rows.withColumn(f"y_{i}", y / F.col(f"l_{i}_{i}"))
    return rows.withColumn("d2", sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(1, len(xs))), F.col("y_0") * F.col("y_0")))


def _factor(params: DataFrame, xs: list[str]) -> DataFrame:
    """Adds the Cholesky factor of the matrix s_i_j (j <= i)."""
    for j in range(len(xs)):
        diag = F.col(f"s_{j}_{j}")
        for k in range(j):
            diag = diag - F.col(f"l_{j}_{k}") * F.col(f"l_{j}_{k}")
        params = params.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(diag, F.lit(1e-12))))
        below = {}
        for i in range(j + 1, len(xs)):
            off = F.col(f"s_{i}_{j}")
            for k in range(j):
                off = off - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            below[f"l_{i}_{j}"] = off / F.col(f"l_{j}_{j}")
        params = params.withColumns(below) if below else params
    return params


def _estimate(near: DataFrame, keys: list[str], xs: list[str], floors: dict[str, float], scale: float) -> DataFrame:
    """keys, centre m_i, factor l_i_j and the logarithm of the determinant, from the rows given."""
    d = len(xs)
    sums = near.groupBy(*keys).agg(*[F.avg(x).alias(f"m_{i}") for i, x in enumerate(xs)], *[F.avg(F.col(xs[i]) * F.col(xs[j])).alias(f"q_{i}_{j}") for i in range(d) for j in range(i + 1)])
    cov = {f"s_{i}_{j}": (F.col(f"q_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}")) * scale + F.lit(floors[xs[i]] ** 2 if i == j else 0.0) for i in range(d) for j in range(i + 1)}
    out = _factor(sums.withColumns(cov), xs)
    det = sum((F.log(f"l_{i}_{i}") for i in range(d)), F.lit(0.0)) * 2
    return out.select(*keys, *[f"m_{i}" for i in range(d)], *[f"l_{i}_{j}" for i in range(d) for j in range(i + 1)], det.alias("log_det"))


def _concentrated(rows: DataFrame, params: DataFrame, keys: list[str], xs: list[str], floors: dict[str, float], scale: float, h: float, work: Scratch, name: str) -> DataFrame:
    """One concentration step: the estimate from the share h of rows nearest to the one before."""
    far = work.save(_with_distance(rows.join(params.drop("log_det"), keys), xs).select(*keys, *xs, "d2"), f"far-{name}")
    cut = work.save(far.groupBy(*keys).agg(F.percentile_approx("d2", h, 1000).alias("cut")), f"cut-{name}")
    out = work.save(_estimate(far.join(cut, keys).where("d2 <= cut"), keys, xs, floors, scale), f"params-{name}")
    work.drop(f"far-{name}")
    return out


def robust_outliers(stats: DataFrame, groups: list[str], floors: dict[str, float], work: Scratch, h: float = 0.75, starts: int = 3, most_steps: int = 12, least_rows: int | None = None, level: float = 1 - 1e-6) -> DataFrame:
    """stats with d2 (squared robust Mahalanobis distance), cutoff and outlier.

    Minimum covariance determinant by concentration steps: keep the share `h` of a cell's rows that lie nearest, take
    their mean and covariance, measure all rows anew. Several starts (medians and absolute deviations, then disjoint
    random parts of the cell) take two steps each; the one of least determinant goes on until the cell's determinant falls no more,
    most_steps at most; only cells whose determinant still falls take a further step. The covariance is scaled for the share kept, and the squared floors are added to its diagonal, so
    that a statistic that is constant within a cell (its determinant would be 0) still gives finite distances. A cell is the
    row's `groups`; one under least_rows (five for each statistic, if not given), too few for an estimate, shares the cell of
    the first group, and if that is small too, one for all. Rows whose group is NULL form a cell of their own. Only sums and
    quantile sketches by cell leave the executors.
    """
    xs, d = list(floors), len(floors)
    least_rows = 5 * d if least_rows is None else least_rows
    first = groups[:1]
    null_safe = lambda gs: F.concat_ws("\x1f", *[F.coalesce(F.col(g).cast("string"), F.lit("\x00")) for g in gs])
    keyed = stats.withColumns({"_all": null_safe(groups), "_one": null_safe(first)})
    sizes = work.save(keyed.groupBy("_one", "_all").agg(F.count("*").alias("n")), "sizes")
    ones = sizes.groupBy("_one").agg(F.sum("n").alias("n1"))
    cells = sizes.join(ones, "_one").select("_all", F.when(F.col("n") >= least_rows, F.concat(F.lit("2\x1f"), "_all")).when(F.col("n1") >= least_rows, F.concat(F.lit("1\x1f"), "_one")).otherwise("0").alias("cell"))
    rows = work.save(keyed.join(work.save(cells, "cells"), "_all").drop("_all", "_one"), "rows")
    only = rows.select("cell", *xs)
    scale = h / _gamma_p((d + 2) / 2, chi2_quantile(h, d) / 2)
    middle = lambda c: F.percentile_approx(c, 0.5, 1000)
    centre = work.save(only.groupBy("cell").agg(*[middle(x).alias(f"m_{i}") for i, x in enumerate(xs)]), "centre")
    spread = only.join(centre, "cell").groupBy("cell").agg(*[F.first(f"m_{i}").alias(f"m_{i}") for i in range(d)], *[middle(F.abs(F.col(x) - F.col(f"m_{i}"))).alias(f"a_{i}") for i, x in enumerate(xs)])
    cov = {f"s_{i}_{j}": (F.pow(1.4826 * F.col(f"a_{i}"), 2) + F.lit(floors[xs[i]] ** 2)) if i == j else F.lit(0.0) for i in range(d) for j in range(i + 1)}
    factor = ["cell", *[f"m_{i}" for i in range(d)], *[f"l_{i}_{j}" for i in range(d) for j in range(i + 1)]]
    begun = _factor(spread.withColumns(cov), xs).select(*factor).withColumn("start", F.lit(0))
    part = F.pmod(F.xxhash64(*xs), F.lit(max(1, starts - 1))).cast("int") + 1
    if starts > 1:
        begun = begun.unionByName(_estimate(only.withColumn("start", part), ["cell", "start"], xs, floors, 1.0).drop("log_det"))
    params = work.save(begun, "begun")
    many = only.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(max(0, starts - 1)))))
    for k in range(2):
        params = _concentrated(many, params, ["cell", "start"], xs, floors, scale, h, work, f"start{k}")
    best = params.groupBy("cell").agg(F.min_by("start", "log_det").alias("start"))
    params = work.save(params.join(best, ["cell", "start"]).drop("start"), "best")
    settled = params.limit(0)
    for k in range(most_steps):
        nxt = _concentrated(only, params, ["cell"], xs, floors, scale, h, work, f"step{k}")
        was = params.select("cell", F.col("log_det").alias("_was"))
        nxt = work.save(nxt.join(was, "cell").withColumn("_falls", F.coalesce(F.col("_was") - F.col("log_det") >= 1e-3, F.lit(False))).drop("_was"), f"after{k}")
        settled = settled.unionByName(nxt.where("not _falls").drop("_falls"))
        params = nxt.where("_falls").drop("_falls")
        if params.isEmpty():
            break
    params = work.save(settled.unionByName(params), "settled")
    out = _with_distance(rows.join(params.drop("log_det"), "cell"), xs).drop(*factor[1:], *[f"y_{i}" for i in range(d)])
    return out.withColumn("cutoff", F.lit(chi2_quantile(level, d))).withColumn("outlier", F.col("d2") > F.col("cutoff"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, d2 and the statistics.

    base_failed: under 20 words, or more than 30 % of the words in windows of 8 that repeat. Other documents are kept
    unless their statistics are robust outliers of their language and source; the estimates come from the documents that
    the base passes. NULL and empty texts have no words and fail the base; so does nothing else about NULLs: a NULL
    language or source is a group of its own. Very long texts are counted whole. Repeated rows each get their row. Other columns are
    not read. No rows give no rows.
    """
    work = Scratch(docs.sparkSession, "quality")
    stats = work.save(statistics(docs, ["doc_id", "lang", "source"]), "stats")
    stats = stats.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    passed = robust_outliers(stats.where("not base_failed"), ["lang", "source"], FLOORS, work)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    failed = stats.where("base_failed").select(*cols, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("d2"), *FLOORS)
    return passed.select(*cols, (~F.col("outlier")).alias("kept"), "d2", *FLOORS).unionByName(failed)
