"""Alert levels from predictions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Level names by number, worst last.
FLOOD_LEVELS = {1: "LOW", 2: "MODERATE", 3: "HIGH", 4: "CRITICAL"}
FIRE_LEVELS = {1: "LOW", 2: "MEDIUM", 3: "HIGH"}
URGENT = ["CRITICAL", "HIGH"]


def prob_of(probability: str = "probability", cls: int = 1) -> Column:
    """Probability of one class out of the model's vector; null beyond its length."""
    return F.get(vector_to_array(F.col(probability)), cls)


def level_label(number: Column, levels: dict[int, str] = FLOOD_LEVELS) -> Column:
    """Level name of a level number; unknown numbers have no name.

    A lookup evaluates the number once. Chained conditions would repeat its whole expression
    wherever a filter on the label is pushed down.
    """
    pairs = [F.lit(x) for pair in levels.items() for x in pair]
    return F.element_at(F.create_map(*pairs), number.cast("int"))


def flood_level_num() -> Column:
    """4/3/2/1; both probability bounds are strict, no prediction counts as level 1."""
    p = F.col("prob_flood")
    positive = F.when(p > 0.9, 4).when(p > 0.7, 3).otherwise(2)
    return F.when(F.col("prediction") == 1, positive).otherwise(1)


def flood_alert(df: DataFrame) -> DataFrame:
    """Add `alert_level` and `alert_level_num` from `prediction` and `prob_flood`."""
    num = flood_level_num()
    return df.withColumns({"alert_level": level_label(num), "alert_level_num": num})


def fire_level_num() -> Column:
    cls = F.col("prediction")
    return F.when(cls == 2, 3).when(cls == 1, 2).otherwise(1)


def fire_alert(df: DataFrame) -> DataFrame:
    """Add `alert_level` and `alert_level_num` from the predicted fire class."""
    num = fire_level_num()
    return df.withColumns(
        {"alert_level": level_label(num, FIRE_LEVELS), "alert_level_num": num}
    )


def high_alerts(df: DataFrame) -> DataFrame:
    """Rows that need action."""
    return df.where(F.col("alert_level").isin(URGENT))
