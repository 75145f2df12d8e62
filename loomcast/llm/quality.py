"""Quality rules: robust multivariate outliers by minimum covariance determinants.

Native only: DataFrame functions from the text to the verdict.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomcast.llm.common import let, packed, whole, words_of
from loomcast.session import settled

FEATURES = ("f_word_length", "f_symbols", "f_dup_lines", "f_repeats")
# Parts that the rows of a group are dealt to.
SALTS = 32


@dataclass(frozen=True)
class QualityRules:
    """Parameters of the rules.

    ``spread_floor`` is the least standard deviation of each feature: most documents have no
    symbol and no repeated line at all, so the raw spread of a clean group may be zero.
    ``cut`` bounds the squared distance; the 0.9999 quantile of a chi-square with four degrees
    of freedom is 23.5, and clean texts have heavier tails than that.
    """

    least_words: int = 50
    most_repeated_percent: int = 50
    spread_floor: tuple[float, ...] = (0.08, 0.10, 0.10, 0.20)
    least_group: int = 40
    steps: int = 3
    cut: float = 30.0
    # Fixed values of the chi-square with four degrees of freedom: its 0.975 quantile, and the
    # factor that makes the covariance of the central half consistent.
    reweight: float = 11.143
    consistency: float = 2.13
    bins_per_factor: int = 16


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    A window is packed into one long: the upper bits of its hash, the lower bits its position.
    After sorting, equal windows are neighbours; neighbours are compared word by word.
    """
    n = F.size(words)
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n))) - 1
    none = F.array().cast("array<bigint>")

    def packed(m: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0).cast("long"), n.cast("long") - 3),
            lambda i: F.xxhash64(
                F.get(words, i.cast("int")), F.get(words, (i + 1).cast("int")), F.get(words, (i + 2).cast("int"))
            )
            .bitwiseAND(F.bitwise_not(m))
            .bitwiseOR(i),
        )

    def same(p: Column, q: Column) -> Column:
        equal = F.lit(True)
        for k in range(3):
            equal = equal & (F.get(words, (p + k).cast("int")) == F.get(words, (q + k).cast("int")))
        return equal

    def positions(s: Column, m: Column) -> Column:
        def equal_next(x: Column, k: Column) -> Column:
            following = F.coalesce(F.get(s, k + 1), F.bitwise_not(x))
            return x.bitwiseXOR(following).between(F.lit(0), m) & same(x.bitwiseAND(m), following.bitwiseAND(m))

        marked = F.transform(s, lambda x, k: F.when(equal_next(x, k), k))
        return F.flatten(
            F.transform(
                F.array_compact(marked),
                lambda k: let(
                    F.array(F.get(s, k).bitwiseAND(m), F.get(s, k + 1).bitwiseAND(m)),
                    lambda pq: F.flatten(F.transform(pq, lambda p: F.array(p, p + 1, p + 2))),
                ),
            )
        )

    found = let(mask, lambda m: let(F.sort_array(packed(m)), lambda s: positions(s, m)))
    return F.when(n < 4, F.lit(0)).otherwise(F.size(F.array_distinct(F.coalesce(found, none)))).cast("long")


def document_statistics(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Base statistics of every whole text: one row per input row.

    Columns doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed. A null text counts as empty; other columns of the input are left out.
    """
    text = whole()
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    of_words = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda total, x: total + F.length(x)).alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    return (
        docs.select(
            "doc_id",
            F.col("lang").cast("string").alias("lang"),
            F.col("source").cast("string").alias("source"),
            of_words.alias("w"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        )
        .select(
            "doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words"
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < rules.least_words)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.most_repeated_percent),
        )
    )


def _with_features(stats: DataFrame) -> DataFrame:
    """Ratios on scales on which clean documents are roughly symmetric."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return stats.withColumns(
        {
            "f_word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
            "f_symbols": F.sqrt(F.col("n_symbols") / n),
            "f_dup_lines": F.sqrt(F.col("n_dup_lines") / n),
            "f_repeats": F.sqrt(F.col("n_repeat_words") / n),
        }
    )


def _pairs() -> list[tuple[int, int]]:
    p = len(FEATURES)
    return [(i, j) for i in range(p) for j in range(i, p)]


def _group_key(*parts: Column) -> Column:
    """One text per group: null and every value differ, whatever the values contain."""
    coded = [F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in parts]
    return F.concat_ws("|", F.lit(str(len(parts))), *coded)


def _inverted(df: DataFrame, consistency: float, rules: QualityRules) -> DataFrame:
    """From sums to centre ``m_i``, precision ``v_ij`` and log-determinant, by sweeping pivots."""
    cov = {}
    for i, j in _pairs():
        value = (F.col(f"c_{i}{j}") / F.col("n") - F.col(f"s_{i}") / F.col("n") * F.col(f"s_{j}") / F.col("n")) * consistency
        if i == j:
            value = F.greatest(value, F.lit(0.0)) + rules.spread_floor[i] ** 2
        cov[f"v_{i}{j}"] = value
    means = {f"m_{i}": F.col(f"s_{i}") / F.col("n") for i in range(len(FEATURES))}
    df = df.withColumns({**means, **cov, "logdet": F.lit(0.0)})
    entry = lambda i, j: F.col(f"v_{min(i, j)}{max(i, j)}")
    for k in range(len(FEATURES)):
        pivot = entry(k, k)
        swept = {"logdet": F.col("logdet") + F.log(pivot)}
        for i, j in _pairs():
            if i == k and j == k:
                swept[f"v_{i}{j}"] = -1.0 / pivot
            elif k in (i, j):
                swept[f"v_{i}{j}"] = entry(i, j) / pivot
            else:
                swept[f"v_{i}{j}"] = entry(i, j) - entry(i, k) * entry(j, k) / pivot
        df = df.withColumns(swept)
    return df.withColumns({f"v_{i}{j}": -F.col(f"v_{i}{j}") for i, j in _pairs()})


def _distance() -> Column:
    total = F.lit(0.0)
    for i, j in _pairs():
        z = (F.col(FEATURES[i]) - F.col(f"m_{i}")) * (F.col(FEATURES[j]) - F.col(f"m_{j}"))
        total = total + F.col(f"v_{i}{j}") * z * (1.0 if i == j else 2.0)
    return total


def _moments() -> list[Column]:
    sums = [F.sum(f).alias(f"s_{i}") for i, f in enumerate(FEATURES)]
    cross = [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"c_{i}{j}") for i, j in _pairs()]
    return [F.count(F.lit(1)).alias("n"), *sums, *cross]


def _added() -> list[Column]:
    names = ["n", *[f"s_{i}" for i in range(len(FEATURES))], *[f"c_{i}{j}" for i, j in _pairs()]]
    return [F.sum(x).alias(x) for x in names]


def _salted(stats: DataFrame) -> DataFrame:
    """Rows with a number that deals those of one group to ``SALTS`` parts."""
    return stats.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))


def _joined(rows: DataFrame, shapes: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the shape of their key. A key may hold all rows, as that of all documents does:
    shapes are copied to every salt, so that neither the join nor what follows it by key meets
    the rows of a key in one task."""
    copies = shapes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(copies, ["key", "salt"], how)


SHAPE = ("key", "start", *[f"m_{i}" for i in range(4)], *[f"v_{i}{j}" for i, j in _pairs()], "logdet", "n")


def _starts(keyed: DataFrame, rules: QualityRules) -> DataFrame:
    """Two starting shapes of a group: the classical moments, and medians with quartile spreads."""
    classical = _inverted(keyed.groupBy("key").agg(*_moments()), 1.0, rules).withColumn("start", F.lit(0))
    # Quantiles from counts in bins of a quarter of the least spread: mergeable, exact to a bin.
    cells = keyed.select(
        "key",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("feature"),
                        F.floor(F.col(f) / (rules.spread_floor[i] / 4)).alias("bin"),
                        F.lit(rules.spread_floor[i]).alias("floor"),
                    )
                    for i, f in enumerate(FEATURES)
                ]
            )
        ).alias("x"),
    ).groupBy("key", "x.feature", "x.floor", "x.bin")
    upto = Window.partitionBy("key", "feature").orderBy("bin")
    ranked = cells.agg(F.count(F.lit(1)).alias("n")).select(
        "*", F.sum("n").over(upto).alias("below"), F.sum("n").over(Window.partitionBy("key", "feature")).alias("all")
    )
    at = lambda q: (F.min(F.when(F.col("below") >= F.col("all") * q, F.col("bin"))) + 0.5) * F.first("floor") / 4
    quartiles = ranked.groupBy("key", "feature").agg(
        at(0.5).alias("centre"), ((at(0.75) - at(0.25)) / 1.349).alias("spread"), F.first("all").alias("n")
    )
    wide = quartiles.groupBy("key").agg(
        F.first("n").alias("n"),
        *[F.max(F.when(F.col("feature") == i, F.col("centre"))).alias(f"m_{i}") for i in range(len(FEATURES))],
        *[
            F.max(F.when(F.col("feature") == i, 1.0 / (F.col("spread") ** 2 + rules.spread_floor[i] ** 2))).alias(f"v_{i}{i}")
            for i in range(len(FEATURES))
        ],
    )
    blank = {f"v_{i}{j}": F.lit(0.0) for i, j in _pairs() if i != j}
    robust = wide.withColumns({**blank, "logdet": F.lit(0.0), "start": F.lit(1)})
    return classical.select(*SHAPE).unionByName(robust.select(*SHAPE))


def _concentrate(keyed: DataFrame, shapes: DataFrame, rules: QualityRules) -> DataFrame:
    """One concentration step: moments of the nearer half of each group, for each start.

    Rows are counted and summed per bin of the logarithmic distance in one aggregation, so the
    nearer half is whole bins and no group is ever gathered in one task.
    """
    near = _joined(keyed, shapes.drop("n"))
    binned = near.withColumn("bin", F.floor(F.log(F.greatest(_distance(), F.lit(1e-6))) * rules.bins_per_factor))
    cells = binned.groupBy("key", "start", "bin").agg(*_moments())
    by = Window.partitionBy("key", "start")
    before = F.coalesce(F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    half = F.floor((F.sum("n").over(by) + len(FEATURES) + 1) / 2)
    kept = cells.select("*", before.alias("before"), half.alias("half")).where("before < half")
    return _inverted(kept.groupBy("key", "start").agg(*_added()), rules.consistency, rules).select(*SHAPE)


def fit_shapes(stats: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Centre and precision per language and source, by concentration steps.

    ``stats`` has the features. Only documents that pass the base rules take part. Returns one
    row per (language, source) with its key. A pair with fewer than ``least_group`` documents
    takes the shape of its language, and such a language that of all documents.
    """
    level2 = _group_key(F.col("lang"), F.col("source"))
    level1 = _group_key(F.col("lang"))
    level0 = F.lit("0")
    sound = (stats if "salt" in stats.columns else _salted(stats)).where(~F.col("base_failed"))
    keyed = sound.select(F.explode(F.array(level2, level1, level0)).alias("key"), "salt", *FEATURES)
    sizes = settled(sound.groupBy(level2.alias("key")).agg(F.count(F.lit(1)).alias("rows"), F.first(level1).alias("key1")), "quality-sizes")
    shapes = settled(_starts(keyed, rules), "quality-shapes")
    for _ in range(rules.steps):
        shapes = settled(_concentrate(keyed, shapes, rules), "quality-shapes")
    best = shapes.groupBy("key").agg(F.min_by(F.struct(*SHAPE[1:]), F.struct("logdet", "start")).alias("x"))
    best = best.select("key", *[f"x.{c}" for c in SHAPE[1:]])
    inner = _joined(keyed, best.drop("n")).where(_distance() <= rules.reweight).groupBy("key").agg(*_moments())
    final = settled(_inverted(inner, 1.0, rules).withColumn("start", F.lit(2)).select(*SHAPE), "quality-shapes")
    language = sizes.groupBy("key1").agg(F.sum("rows").alias("rows1"))
    chosen = sizes.join(language, "key1").select(
        "key",
        F.when(F.col("rows") >= rules.least_group, F.col("key"))
        .when(F.col("rows1") >= rules.least_group, F.col("key1"))
        .otherwise(F.lit("0"))
        .alias("used"),
    )
    return chosen.join(final.drop("start", "logdet", "n").withColumnRenamed("key", "used"), "used")


def judge_quality(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Statistics and verdict of every document.

    Returns doc_id, the statistics, base_failed, kept and distance (squared Mahalanobis distance
    from the shape of the document's language and source; null where the base rules fail). One
    row per input row, repeated rows included; an empty table gives no rows; a null language or
    source is a group of its own; a null text is an empty one and fails the base rules. Columns
    other than doc_id, text, lang and source are not read.
    """
    stats = settled(_salted(_with_features(document_statistics(docs, rules))), "quality-statistics")
    shapes = fit_shapes(stats, rules)
    keyed = stats.withColumn("key", F.when(~F.col("base_failed"), _group_key(F.col("lang"), F.col("source"))))
    judged = _joined(keyed, shapes, "left").withColumn("distance", _distance())
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= rules.cut)).alias("kept"),
        "distance",
    )


def keep_sound(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Documents that pass, with all their columns.

    Every row is kept or dropped by its own verdict, which depends on its text, language and
    source only: rows that share a doc_id, or have none, are judged apart. Null and empty texts
    fail the base rules; an empty table stays empty; columns may have any name and type.
    """
    row = [F.col("row.doc_id"), F.xxhash64(whole("row.text")), F.col("row.lang").cast("string"), F.col("row.source").cast("string")]
    names = ["id", "text_hash", "lang", "source"]
    whole_rows = packed(docs)
    marked = whole_rows.select(F.struct(*[x.alias(n) for x, n in zip(row, names, strict=True)]).alias("doc_id"), "row.text", "row.lang", "row.source")
    failed = judge_quality(marked, rules).where(~F.col("kept")).select("doc_id.*").distinct()
    same = F.lit(True)
    for x, n in zip(row, names, strict=True):
        same = same & x.eqNullSafe(F.col(n))
    # Failed rows grow with the documents: a merge join at every size.
    return whole_rows.join(failed.hint("merge"), same, "left_anti").select("row.*")
