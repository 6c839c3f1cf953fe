"""The batch parameter of every program: number, date and run timestamp.

The reference reads the batch row inside each program and stamps rows with
the database's current timestamp.  Here the batch is an explicit argument and
the run timestamp is injected, so a rerun is repeatable.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Batch:
    no: int
    date: dt.date
    run_ts: dt.datetime

    @property
    def no_col(self) -> Column:
        return F.lit(self.no).cast("int")

    @property
    def date_col(self) -> Column:
        return F.lit(self.date)

    @property
    def ts_col(self) -> Column:
        # Warehouse timestamps are zone-less, like the source timestamps.
        return F.lit(self.run_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")

    def audit(self) -> dict[str, Column]:
        """The four audit columns every SCD1 write stamps."""
        return {
            "dw_update_timestamp": self.ts_col,
            "etl_batch_no": self.no_col,
            "etl_batch_date": self.date_col,
        }
