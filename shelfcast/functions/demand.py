"""Demand-class expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and class names of the demand grid.
ADI_LIMIT = 1.32
CV2_LIMIT = 0.49
CLASSES = ["Smooth", "Intermittent", "Erratic", "Lumpy"]


def demand_class(adi: Column, cv2: Column, adi_limit: float = ADI_LIMIT, cv2_limit: float = CV2_LIMIT) -> Column:
    """Class by demand interval and size variability; a value at the limit is high."""
    rare, varied = adi >= adi_limit, cv2 >= cv2_limit
    return (F.when(rare & varied, "Lumpy").when(rare, "Intermittent")
            .when(varied, "Erratic").otherwise("Smooth"))


def adi(sales: Column) -> Column:
    """Aggregate: periods per period with sales, infinite when there are none."""
    sold = F.count(F.when(sales > 0, True))
    return F.when(sold == 0, F.lit(float("inf"))).otherwise(F.count(sales) / F.nullif(sold, F.lit(0)))


def cv2(sales: Column) -> Column:
    """Aggregate: squared variation of the sizes sold, 0 with fewer than two."""
    size = F.when(sales > 0, sales.cast("double"))
    ratio = F.stddev_samp(size) / F.avg(size)
    return F.coalesce(ratio * ratio, F.lit(0.0))
