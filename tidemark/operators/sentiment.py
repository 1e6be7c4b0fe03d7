"""Sentiment of texts, by a given lexicon or by learned word weights, and its daily aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.series import attach, join_on
from tidemark.session import pin, small

Lexicon = Mapping[str, tuple[float, float]]


def tokens(text: str | Column) -> Column:
    """Lower-case words of the whole text."""
    t = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(t), "[^a-z]+")


def label(polarity: str | Column) -> Column:
    """(-1, -0.1] negative, (-0.1, 0.1] neutral, (0.1, 1] positive; null outside.

    The ninth digit decides, so a mean on an edge does not depend on the order it was summed in.
    """
    p = F.round(F.col(polarity) if isinstance(polarity, str) else polarity, 9)
    return (
        F.when((p > -1) & (p <= -0.1), "negative")
        .when((p > -0.1) & (p <= 0.1), "neutral")
        .when((p > 0.1) & (p <= 1), "positive")
    )


def score(df: DataFrame, text: str, lexicon: Lexicon = schemas.LEXICON) -> DataFrame:
    """Add polarity, subjectivity and label: means over the lexicon words of each text.

    The words are looked up inside the row, so there is no shuffle and a long text stays one row. A
    text that is null or has no lexicon word scores (0, 0).
    """
    known = F.filter(tokens(text), lambda word: word.isin(*lexicon))
    pair = F.create_map(
        *[
            F.lit(x) if isinstance(x, str) else F.struct(F.lit(float(x[0])).alias("p"), F.lit(float(x[1])).alias("s"))
            for item in lexicon.items()
            for x in item
        ]
    )
    df = df.withColumn("_hits", F.transform(known, lambda word: F.try_element_at(pair, word)))

    def mean(part: str) -> Column:
        total = F.aggregate("_hits", F.lit(0.0), lambda acc, hit: acc + hit.getField(part))
        return F.coalesce(F.try_divide(total, F.size("_hits").cast("double")), F.lit(0.0))

    df = df.withColumns({"sentiment_polarity": mean("p"), "sentiment_subjectivity": mean("s")})
    return df.withColumn("sentiment_label", label("sentiment_polarity")).drop("_hits")


def by_date(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean, deviation and count of polarity and mean subjectivity per date (null dates left out)."""
    return (
        scored.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(
            F.avg("sentiment_polarity").alias("sentiment_polarity_mean"),
            F.stddev_samp("sentiment_polarity").alias("sentiment_polarity_std"),
            F.count("sentiment_polarity").alias("sentiment_polarity_count"),
            F.avg("sentiment_subjectivity").alias("sentiment_subjectivity_mean"),
        )
    )


def features(df: DataFrame, text: str, date: str, lexicon: Lexicon = schemas.LEXICON) -> DataFrame:
    """Scores per row plus the aggregates of the row's date."""
    scored = score(df, text, lexicon)
    return attach(scored, by_date(scored, [date]), [date])


# --- learned weights ---------------------------------------------------------------------------------


def learn(df: DataFrame, text: str, positive: str, least_texts: int = 5, smoothing: float = 1.0) -> DataFrame:
    """(word, texts, weight) from labelled texts: by how much the log odds of a positive text differ with the word in it.

    A word counts once per text, and words in fewer than ``least_texts`` texts are left out. Texts that are null or
    have no label teach nothing; without texts of both labels there are no weights. Counting is one shuffle of partial
    counts, so a word that is in every text costs one row per map task.
    """
    known = df.select(F.col(text).alias("_t"), F.col(positive).cast("boolean").alias("_y")).dropna()
    of = known.agg(F.count_if("_y").alias("_p"), F.count_if(~F.col("_y")).alias("_n"))
    words = known.select("_y", F.explode(F.array_distinct(tokens("_t"))).alias("word")).filter("word <> ''")
    counts = words.groupBy("word").agg(
        F.count(F.lit(1)).alias("texts"), F.count_if("_y").alias("_wp"), F.count_if(~F.col("_y")).alias("_wn")
    )
    share = lambda part, whole: F.log((F.col(part) + smoothing) / (F.col(whole) + 2 * smoothing))
    wide = counts.filter(F.col("texts") >= least_texts).join(F.broadcast(of.filter("_p > 0 AND _n > 0")))  # one row
    return wide.select("word", "texts", (share("_wp", "_p") - share("_wn", "_n")).alias("weight"))


def _in_context(words: Column) -> Column:
    """Rows (word, before_1, before_2, before_3) of a text, to be inlined; after them come rows without a word.

    The words are laid beside themselves. ``words`` is a column that holds them already: an expression would be evaluated
    again for each of the four, and in a function over each word that looked back, for every word.
    """
    gap = F.lit(None).cast("string")
    return F.arrays_zip(
        words.alias("word"), *[F.concat(F.array(*[gap] * k), words).alias(f"before_{k}") for k in (1, 2, 3)]
    )


def _factor(negations: Sequence[str], degrees: Mapping[str, float]) -> Column:
    """The factor of a word: the degree word just before it, turned round by a negation among the three before."""
    factor = F.lit(1.0)
    if negations:
        turned = [F.coalesce(F.col(f"before_{k}").isin(*negations), F.lit(False)) for k in (1, 2, 3)]
        factor = F.when(turned[0] | turned[1] | turned[2], -1.0).otherwise(1.0)
    if degrees:
        degree = F.create_map(*[F.lit(x) for w, f in degrees.items() for x in (w, float(f))])
        factor = factor * F.coalesce(F.try_element_at(degree, F.col("before_1")), F.lit(1.0))
    return factor


def score_learned(
    df: DataFrame, keys: Sequence[str], text: str, weights: DataFrame, negations: Sequence[str] = schemas.NEGATIONS,
    degrees: Mapping[str, float] = schemas.DEGREES,
) -> DataFrame:
    """One row per key: (keys, known_words, sentiment_score, sentiment_label), the score from -1 to 1.

    The score is the hyperbolic tangent of the mean weight of the words that have one. Rows of one key are one text;
    null or empty texts, and texts without a known word, score 0 and are neutral. Words meet their weights where they
    are: the table is pinned and broadcast when its counted size allows, else joined by word under adaptive skew
    handling. Sums are formed before the texts' words are brought together.
    """
    cut = df.select(*keys, tokens(text).alias("_words"))
    words = cut.select(*keys, F.explode(_in_context(F.col("_words"))).alias("_w")).select(*keys, "_w.*").filter("word IS NOT NULL")
    words = words.select(*keys, "word", _factor(negations, degrees).alias("factor"))
    hits = words.join(small(pin(weights.select("word", "weight"))), "word")
    sums = hits.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("known_words"), F.tanh(F.avg(F.col("factor") * F.col("weight"))).alias("sentiment_score")
    )
    out = join_on(df.select(*keys).distinct(), sums, keys)
    out = out.fillna({"known_words": 0, "sentiment_score": 0.0}, subset=["known_words", "sentiment_score"])
    return out.withColumn("sentiment_label", label("sentiment_score"))
