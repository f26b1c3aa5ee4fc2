"""Compute-optimal budgets as column arithmetic: C = 6 N D and D = r N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Peak dense FLOP/s of three accelerators.
PEAK_FLOPS = [("h100", 989e12), ("a100", 312e12), ("l4", 121e12)]
UTILIZATION, TOKENS_PER_PARAM = 0.40, 20.0


def compute_budget(gpus: Column, hours: Column, peak: Column, mfu: Column | float = UTILIZATION) -> Column:
    """FLOPs that devices deliver in some hours at a utilization."""
    return gpus * (peak * (F.lit(mfu) if isinstance(mfu, float) else mfu)) * (hours * 3600)


def optimal_params(c: Column, tokens_per_param: Column | float = TOKENS_PER_PARAM) -> Column:
    r = F.lit(tokens_per_param) if isinstance(tokens_per_param, float) else tokens_per_param
    return F.sqrt(c / (6 * r))


def budget_report(grid: DataFrame) -> DataFrame:
    """Append c, n, d, check_6nd and ratio to rows (gpus, hours, peak_flops, mfu, tokens_per_param)."""
    out = grid.withColumn("c", compute_budget(F.col("gpus"), F.col("hours"), F.col("peak_flops"), F.col("mfu")))
    out = out.withColumn("n", optimal_params(F.col("c"), F.col("tokens_per_param")))
    out = out.withColumn("d", F.col("tokens_per_param") * F.col("n"))
    return out.withColumn("check_6nd", 6 * F.col("n") * F.col("d")).withColumn("ratio", F.col("d") / F.col("n"))


def devices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PEAK_FLOPS, "device string, peak_flops double")


def report_text() -> Column:
    """A row of `budget_report` as readable lines."""
    lines = [
        ("Budget: %d GPU x %d h @ %.0f%% MFU", F.col("gpus"), F.col("hours"), 100 * F.col("mfu")),
        ("Compute C: %.3e FLOPs", F.col("c")),
        ("Optimal N: %.1f M params", F.col("n") / 1e6),
        ("Optimal D: %.2f B tokens", F.col("d") / 1e9),
        ("Sanity 6ND: %.3e", F.col("check_6nd")),
        ("Ratio D/N: %.1f tokens/param", F.col("ratio")),
    ]
    return F.concat_ws("\n", *(F.printf(F.lit(x), *of) for x, *of in lines))


def report(spark: SparkSession, gpus: int = 1, hours: int = 1, device: str = "l4", mfu: float = 0.30, tokens_per_param: float = TOKENS_PER_PARAM) -> DataFrame:
    """One budget as a row with its text."""
    row = devices(spark).filter(F.col("device") == device).select("device", "peak_flops", F.lit(gpus).cast("long").alias("gpus"), F.lit(hours).cast("long").alias("hours"), F.lit(mfu).alias("mfu"), F.lit(tokens_per_param).alias("tokens_per_param"))
    return budget_report(row).withColumn("report", report_text())
