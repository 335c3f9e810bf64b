"""Shared column expressions."""

from stationflow.functions.exprs import (  # noqa: F401
    below_tier,
    dec_avg,
    dec_sum,
    hour_bucket,
    initcap_words,
    null_greatest,
    null_least,
    rnd,
    safe_div,
    season,
    tier,
)
