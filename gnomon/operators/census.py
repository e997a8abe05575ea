"""A census of a body of labels: many measures at several grains, from one replay and one pass over its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gnomon.functions import strata
from gnomon.operators.labels import r6, share
from gnomon.operators.panos import by_scopes
from gnomon.operators.quantiles import several
from gnomon.operators.tables import joined, written

c = F.col
#: Columns that are described by percentiles, and which percentiles.
SPREADS, PERCENTS = ("depression", "offaxis_v"), (5, 50, 95)
#: Grains besides all rows.
SCOPES = {"city": "city", "label_type": "label_type", "band": "band"}


def measures() -> list[Column]:
    """What is counted of the rows of a scope."""
    ok = c("eligible")
    both = c("replayable_x") & c("replayable_y")
    day = lambda x: F.date_format(x, "yyyy-MM-dd")
    return [
        F.count("*").alias("n_labels"), F.count_distinct("pano").alias("n_panos"), F.count_distinct("user_id").alias("n_users"), day(F.min("time_created")).alias("first_day"), day(F.max("time_created")).alias("last_day"),
        F.count_if(both).alias("replayable"), share(c("exact_x"), c("replayable_x")).alias("exact_x_pct"), share(c("exact_y"), c("replayable_y")).alias("exact_y_pct"), share(c("exact_x") & c("exact_y"), both).alias("exact_pct"),
        F.count_if(ok).alias("n_eligible"), F.count_if(ok & c("at_floor")).alias("n_at_pitch_floor"), F.count_if(ok & (c("depression") < 0)).alias("n_above_horizon"),
        F.count_if("by_type").alias("excluded_by_type"), F.count_if(~c("by_type") & c("by_tag")).alias("excluded_by_tag"), F.count_if(~c("by_type") & ~c("by_tag")).alias("n_comparable"),
        share(c("camera_pitch").isNotNull()).alias("camera_pitch_pct"), share(c("camera_roll").isNotNull()).alias("camera_roll_pct"),
    ]


def census(study: DataFrame) -> DataFrame:
    """scope and value (all, or each city, type and band), the measures, and percentiles of the eligible rows' depression
    and offset. study has replayed covariates and tags. Its few needed columns are written once, and both passes, the
    one over rows and the one over ranges of values, read them from there."""
    own = written(study.select(
        "city", "label_type", "band", "user_id", "time_created", "replayable_x", "replayable_y", "exact_x", "exact_y", "eligible", "at_floor", "camera_pitch", "camera_roll", *SPREADS,
        F.struct("city", "pano_id").alias("pano"), F.coalesce(c("label_type").isin(strata.NO_REFERENT_TYPES), F.lit(False)).alias("by_type"), strata.region_tagged(c("label_type"), strata.tags(c("tags"))).alias("by_tag"),
    ))
    made = by_scopes(own, SCOPES, measures())
    grains = F.inline(F.array(*(F.struct(F.lit(k).alias("scope"), x.cast("string").alias("value")) for k, x in (("all", F.lit("all")), *((k, c(x)) for k, x in SCOPES.items())))))
    found = several(own.where("eligible").select(*SPREADS, grains), {f"{k}_p{q}": (k, q / 100) for k in SPREADS for q in PERCENTS}, "scope", "value")
    return joined(made, found.select("scope", "value", *(r6(c(f"{k}_p{q}")).alias(f"{k}_p{q}") for k in SPREADS for q in PERCENTS)), ["scope", "value"])


def shared_by_users(study: DataFrame, least: int = 2) -> DataFrame:
    """By city: panoramas, those that so many users have labelled, and the most users of one."""
    per = study.groupBy("city", "pano_id").agg(F.count_distinct("user_id").alias("users"))
    return per.groupBy("city").agg(F.count("*").alias("panos"), F.count_if(c("users") >= least).alias("shared_panos"), F.max("users").alias("most_users"))
