"""Left join to reviews without multiplying rows.

A plain left join repeats an item once per review of its order, and every sum over the item
counts it that often. The same sums come out of one row per order that says how many reviews
it has: each amount is weighted with that number. Both inputs are aggregated before they
meet, so neither a much-reviewed order nor an order with very many items becomes a hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.functions import exact

# Row counts as decimals, so that their products with sums cannot overflow.
COUNT = "decimal(19,0)"


def review_stats(reviews: DataFrame) -> DataFrame:
    """Per order: number of reviews, sum of the scores, number of scores that are not NULL."""
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum(exact(reviews, "review_score")).alias("score_sum"),
        F.count("review_score").alias("scores"),
    )


def with_review_weight(
    facts: DataFrame, reviews: DataFrame, *, one_review_per_order: bool = False
) -> DataFrame:
    """Left-join review statistics to ``facts``, which hold few rows per order.

    ``weight`` is the number of rows the plain left join gives each row of an order: the
    number of reviews, or 1 without any. With ``one_review_per_order`` an item counts once
    whatever the number of reviews, and the order's mean score counts once per item.
    """
    stats = review_stats(reviews)
    if one_review_per_order:
        # The order's mean score stands in for its reviews.
        stats = stats.select(
            "order_id",
            F.lit(1).alias("reviews"),
            (F.col("score_sum").cast("decimal(24,6)") / F.nullif(F.col("scores"), F.lit(0)))
            .cast("decimal(24,6)")
            .alias("score_sum"),
            F.when(F.col("scores") > 0, 1).otherwise(0).alias("scores"),
        )
    return facts.join(stats, "order_id", "left").select(
        *[F.col(c) for c in facts.columns],
        F.coalesce("reviews", F.lit(1)).cast(COUNT).alias("weight"),
        "score_sum",
        F.coalesce("scores", F.lit(0)).cast(COUNT).alias("scores"),
    )


def weighted_row(column: str) -> Column:
    """The amount of one row as often as the plain left join would repeat it."""
    return F.col(column) * F.col("weight")


def weighted_row_scores(rows: str) -> tuple[Column, Column]:
    """What ``weighted_scores`` adds up, of one row."""
    n = F.col(rows).cast(COUNT)
    return F.col("score_sum") * n, F.col("scores") * n


def weighted(column: str) -> Column:
    """Sum of an amount as the plain left join would give it."""
    return F.sum(weighted_row(column))


def weighted_scores(rows: str) -> tuple[Column, Column]:
    """Sum and count of scores when each of ``rows`` rows meets every review of its order."""
    score_sum, scores = weighted_row_scores(rows)
    return F.sum(score_sum), F.sum(scores)
