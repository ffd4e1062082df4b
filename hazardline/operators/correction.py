"""D11 ratio correction and D12 freeze after finalization.

Windows are partitioned by (ship_date, facility, freight) and ordered by
checkpoint: one row per predicted hour, so each partition holds at most a few
hundred rows however many orders there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardline.functions.keys import safe_ratio
from hazardline.params import FREEZE_ROWS

KEYS = ["ship_date", "facility_id", "freight_id"]
OUTPUT_COLUMNS = (
    "checkpoint", "facility_id", "freight_id", "alignment_timestamp", "finalization_timestamp",
    "predicted_con", "predicted_cor", "predicted_coa", "predicted_orders",
    "con", "cor", "coa", "orders",
    "delta_con", "adjusted_con", "delta_cor", "adjusted_cor", "delta_coa", "adjusted_coa",
    "ship_date",
)


def corrected(pred: DataFrame, act: DataFrame, run_keys=()) -> DataFrame:
    """J10 predicted LEFT JOIN actuals, then Δ = last known actual/predicted, ± = actual or predicted·Δ.

    ``run_keys``: further columns that tell several runs for one ship date apart (a back-test's knowledge time)."""
    x = pred.join(act, [*run_keys, "ship_date", "checkpoint", "facility_id", "freight_id"], "left")
    w = Window.partitionBy(*run_keys, *KEYS).orderBy("checkpoint").rowsBetween(Window.unboundedPreceding, 0)
    for m in ("con", "cor", "coa"):
        p, a = F.col(f"predicted_{m}"), F.col(m)
        ratio = F.last(safe_ratio(a, p), ignorenulls=True).over(w)  # computed once per measure
        x = x.withColumn(f"_r_{m}", ratio)
        r = F.col(f"_r_{m}")
        x = (x.withColumn(f"delta_{m}", F.when(p != 0, r))
             .withColumn(f"adjusted_{m}", F.when(a.isNull() & (p != 0), p * r).otherwise(a.cast("double")))
             .drop(f"_r_{m}"))
    return x


def final_prediction(corr: DataFrame, freeze_rows: int = FREEZE_ROWS, run_keys=()) -> DataFrame:
    """W7 after finalization, repeat the value at finalization seen within the last 72 rows."""
    w = Window.partitionBy(*run_keys, *KEYS).orderBy("checkpoint").rowsBetween(-freeze_rows, 0)
    cp, fin = F.col("checkpoint"), F.col("finalization_timestamp")
    x = corr
    for m in ("con", "cor", "coa"):
        adj = F.col(f"adjusted_{m}")
        frozen = F.last(F.when(cp == fin, adj), ignorenulls=True).over(w)
        x = x.withColumn(f"adjusted_{m}", F.when(cp <= fin, adj).otherwise(frozen))
    return x.select(*run_keys, *OUTPUT_COLUMNS)
