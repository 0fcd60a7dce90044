from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(margin: Column | str) -> Column:
    m = F.col(margin) if isinstance(margin, str) else margin
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-m))
