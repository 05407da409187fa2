"""Business constants every plan takes as an argument."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    platform_fee_rate: Decimal = Decimal("0.20")
    extreme_surge: Decimal = Decimal("10")
    churn_days: int = 30
    #: Day the "days since" metrics are measured on; None means the day the query runs.
    as_of: dt.date | None = None

    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)
