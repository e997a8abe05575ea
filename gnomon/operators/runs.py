"""Health of nightly runs: windows over each city's last runs, and the rules that raise issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gnomon.operators.quantiles import running
from gnomon.sources.views import COUNTS

#: Fixed values of the rules.
STALE_DAYS, ZERO_DAYS, LOOKBACK, FAILS_A_DAY, LONG_RUN, INCOMPLETE = 3, 30, 90, 20, 3.0, 3
c = F.col


def ranked(runs: DataFrame) -> DataFrame:
    """Adds back, 1 for a city's newest run; ties go by run_id."""
    w = Window.partitionBy("city").orderBy(F.desc("start_time"), F.desc("run_id"))
    return runs.withColumn("back", F.row_number().over(w))


def trailing_failures(runs: DataFrame) -> DataFrame:
    """Mean new failures over the last 7 runs of cities with more than one; falls count as 0."""
    w = Window.partitionBy("city").orderBy("start_time", "run_id")
    delta = c("image_fail") - F.lag("image_fail").over(w)
    own = ranked(runs.withColumn("delta", F.when(delta < 0, 0.0).otherwise(delta)))
    return own.groupBy("city").agg(F.count("*").alias("n"), F.round(F.avg(F.when(c("back") <= 7, c("delta"))), 6).alias("avg_new")).where("n > 1").select("city", "avg_new", F.coalesce(c("avg_new") >= FAILS_A_DAY, F.lit(False)).alias("warns"))


def zero_progress(runs: DataFrame, days: int = ZERO_DAYS, lookback: int = LOOKBACK) -> DataFrame:
    """Cities whose last runs all brought nothing though some before them did. A blank is not 0."""
    done = c("image_success") + c("image_fallback_success")
    own = ranked(runs).withColumn("done", done)
    tail, prior = c("back") <= days, (c("back") > days) & (c("back") <= days + lookback)
    made = own.groupBy("city").agg(F.count("*").alias("n"), F.count_if(tail & ~F.coalesce(c("done") == 0, F.lit(False))).alias("not_zero"), F.count_if(prior & F.coalesce(c("done") > 0, F.lit(False))).alias("before"), F.max(F.when(c("done") > 0, c("start_time"))).alias("last_success"))
    return made.select("city", "n", "last_success", ((c("n") > days + lookback) & (c("not_zero") == 0) & (c("before") > 0)).alias("warns"))


def long_runtime(runs: DataFrame) -> DataFrame:
    """The longest of the last 7 runs against three times the median of all."""
    own = ranked(runs).groupBy("city").agg(F.percentile("total_minutes", 0.5).alias("median"), F.max(F.when(c("back") <= 7, c("total_minutes"))).alias("worst"))
    return own.select("city", F.round("median", 6).alias("median"), "worst", F.coalesce((c("median") > 0) & (c("worst") > c("median") * LONG_RUN), F.lit(False)).alias("warns"))


def incomplete(runs: DataFrame) -> DataFrame:
    """Runs of the last 7 with any blank count."""
    blank = F.lit(False)
    for name in COUNTS:
        blank = blank | c(name).isNull()
    return ranked(runs).where("back <= 7").groupBy("city").agg(F.count("*").alias("recent"), F.count_if(blank).alias("blank")).withColumn("warns", c("blank") >= INCOMPLETE)


def duplicate_days(runs: DataFrame) -> DataFrame:
    """Days with more than one of the last 30 runs."""
    return ranked(runs).where("back <= 30").groupBy("city", F.to_date("start_time").cast("string").alias("day")).agg(F.count("*").alias("n")).where("n > 1")


def staleness(runs: DataFrame, now: str) -> DataFrame:
    """Whole days since the last run, at a given time."""
    days = F.floor((F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.max("start_time"))) / 86400)
    return runs.groupBy("city").agg(F.max("start_time").alias("last"), days.alias("days")).withColumn("critical", c("days") > STALE_DAYS)


def last_values(runs: DataFrame) -> DataFrame:
    """The newest value of each count that is not blank."""
    when = F.struct("start_time", "run_id")
    return runs.groupBy("city").agg(*(F.max_by(name, F.when(c(name).isNotNull(), when)).alias(name) for name in ("image_fail", "depth_total", "total_minutes")))


def issues(runs: DataFrame, now: str) -> DataFrame:
    """city, level and rule of everything that the rules raise."""
    raised = [
        staleness(runs, now).where("critical").select("city", F.lit("CRITICAL").alias("level"), F.lit("stale").alias("rule")),
        trailing_failures(runs).where("warns").select("city", F.lit("WARNING"), F.lit("failures")),
        zero_progress(runs).where("warns").select("city", F.lit("WARNING"), F.lit("zero_progress")),
        long_runtime(runs).where("warns").select("city", F.lit("WARNING"), F.lit("long_run")),
        incomplete(runs).where("warns").select("city", F.lit("WARNING"), F.lit("incomplete")),
        duplicate_days(runs).select("city").distinct().select("city", F.lit("INFO"), F.lit("same_day")),
    ]
    out = raised[0]
    for one in raised[1:]:
        out = out.union(one)
    return out


def failure_streaks(log: DataFrame, *by: str) -> DataFrame:
    """Runs of consecutive failures in an outcome log (entry, ok), with whether a breaker at 25 trips. What succeeded
    before an entry numbers its streak, and is counted by ranges of the log."""
    own = running(log, by, ("entry",), {"streak": c("ok").cast("int")}).where("NOT ok")
    return own.groupBy(*by, "streak").agg(F.count("*").alias("length"), F.min("entry").alias("first")).select(*by, "first", "length", (c("length") >= 25).alias("trips"), F.when(c("length") >= 15, 300).when(c("length") >= 10, 120).when(c("length") >= 5, 30).otherwise(0).alias("pause_s"))


def shown(count: Column) -> Column:
    """A whole number with commas between thousands, or ? where it is not known."""
    return F.coalesce(F.format_number(F.floor(count).cast("bigint"), 0), F.lit("?"))


def city_lines(runs: DataFrame) -> DataFrame:
    """One line on each city's last run: its day, images of the last 7 runs (blanks count as none), and the newest
    totals that are not blank."""
    new = F.coalesce(c("image_success") + c("image_fallback_success"), F.lit(0.0))
    when = F.struct("start_time", "run_id")
    newest = lambda name: F.max_by(name, F.when(c(name).isNotNull(), when))
    per = ranked(runs).groupBy("city").agg(F.max("start_time").alias("last"), F.sum(F.when(c("back") <= 7, new)).alias("new"), newest("image_total").alias("total"), newest("image_fail").alias("fails"))
    line = F.format_string("last run %s | +%d images (7d) | %s total | %s permanent failures", F.date_format("last", "yyyy-MM-dd"), c("new").cast("bigint"), shown(c("total")), shown(c("fails")))
    return per.select("city", line.alias("line"))
