"""What became of logged decisions: each row of the decision log beside the offer's pairing of today.

A log row is (offer_id, payload, time); the payload is the decision message as JSON, with its candidates and a comparison for
each of them. Offers that the catalogue hasn't got are left out. A match is right if the offer is in the product that was chosen
or in one that it has been merged into since. Ids are compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.operators.merges import merged_into
from offerloom.sources.scratch import saved

PAYLOAD = """item struct<id: string, match_name: string>, candidates array<struct<id: string, name: string, category_id: string>>,
model_info struct<name: string, version: string>, comparisons array<struct<id: string, details: string, decision: string>>,
final_decision string, final_candidate string, possible_categories string"""
#: How the details of a comparison begin that a name or an EAN has decided. Fixed values.
BY_NAME, BY_EAN = "Name match", "Ean match"
LEAST_DAYS = 3


def model_id(info: Column) -> Column:
    """name_version; empty without a model."""
    return F.coalesce(F.concat_ws("_", info["name"], info["version"]), F.lit(""))


def beside_pairing(log: DataFrame, offers: DataFrame, products: DataFrame, **told: Column) -> DataFrame:
    """Log rows with `now`, the product that the offer is in today, and flags that all rows have: paired, correct_category. `told` are
    columns over the decoded payload; what is moved to the pairing is these, the candidates' ids with their decisions (null for
    none), the model and the categories, not the messages. offers: (offer_id, product_id); products: (product_id, category_id)."""
    rows = log.select(F.col("offer_id").cast("string").alias("offer_id"), "time", F.from_json("payload", PAYLOAD).alias("p")).select("offer_id", "time", "p.*")
    candidates = F.transform("candidates", lambda c: F.struct(c["id"].alias("candidate"), _of(F.col("comparisons"), c["id"], "decision").alias("decision")))
    rows = rows.select(
        "offer_id", "time", "final_decision", "final_candidate", F.split("possible_categories", ",").alias("possible"), model_id(F.col("model_info")).alias("model"),
        candidates.alias("candidates"), *(c.alias(name) for name, c in told.items()),
    )
    today = offers.select(F.col("offer_id").cast("string").alias("offer_id"), F.col("product_id").cast("string").alias("now"))
    categories = products.select(F.col("product_id").cast("string").alias("now"), F.col("category_id").cast("string").alias("now_category"), F.lit(True).alias("known"))
    rows = rows.join(today, "offer_id").join(categories, "now", "left")
    possible = F.array_contains("possible", F.col("now_category"))
    rows = rows.withColumns({"paired": F.col("now").isNotNull(), "correct_category": F.coalesce(possible, F.lit(False))})
    return rows.drop("possible")


def _of(comparisons: Column, candidate: Column, field: str) -> Column:
    """A field of a candidate's comparison; null if there is none."""
    return F.get(F.filter(comparisons, lambda c: c["id"] == candidate), F.lit(0))[field]


def _looked_at() -> Column:
    """(candidate, decision, is_current) of the candidates with yes and of the product of today."""
    now = F.col("now")
    kept = F.filter("candidates", lambda c: (c["decision"] == "yes") | (c["candidate"] == now))
    return F.transform(kept, lambda c: F.struct(c["candidate"].alias("candidate"), c["decision"].alias("decision"), F.coalesce(c["candidate"] == now, F.lit(False)).alias("is_current")))


def evaluated_matches(log: DataFrame, offers: DataFrame, products: DataFrame, merges: DataFrame) -> DataFrame:
    """Log rows of matches with flags: paired, by_name, by_ean, correct, correct_category, in_candidates (an offer that is paired
    rightly, or with one of its candidates) and n_problems, the number of looked_at, the candidates to look at if the match is
    wrong: those with yes and the product of today. merges: (child, parent)."""
    final, now = F.col("final_candidate"), F.col("now")
    details = _of(F.col("comparisons"), final, "details")
    begins = lambda what: F.coalesce(F.startswith(details, F.lit(what)), F.lit(False))
    rows = beside_pairing(log, offers, products, by_name=begins(BY_NAME), by_ean=begins(BY_EAN))
    there = F.coalesce(F.exists("candidates", lambda c: c["candidate"] == now), F.lit(False))
    rows = saved(rows.select("offer_id", "time", "model", "final_candidate", "now", "paired", "correct_category", "by_name", "by_ean", there.alias("_there"), _looked_at().alias("looked_at")), "matches")
    merged = merged_into(rows.select(final.alias("product_id"), now.alias("ancestor")), merges.select(*(F.col(c).cast("string") for c in ("child", "parent"))))
    rows = rows.join(merged.select(F.col("product_id").alias("final_candidate"), F.col("ancestor").alias("now"), F.lit(True).alias("_merged")), ["final_candidate", "now"], "left")
    rows = rows.withColumn("correct", F.coalesce((now == final) | F.col("_merged"), F.lit(False)))
    wrong = F.col("paired") & ~F.col("correct")
    return rows.withColumns({
        "in_candidates": F.col("paired") & (F.col("correct") | F.col("_there")),
        "n_problems": F.when(wrong, F.coalesce(F.size("looked_at"), F.lit(0))).otherwise(0),
    }).drop("_merged", "_there")


def evaluated_unknown(log: DataFrame, offers: DataFrame, products: DataFrame) -> DataFrame:
    """Log rows without a decision, with flags: paired, correct_category, several_yes, name_in_several and ean_in_several (one of
    several yes is by name, by EAN), unsupported, in_candidates, paired_decision (of the product that the offer is in, if the catalogue has
    it), and looked_at as in evaluated_matches."""
    yes = F.filter("comparisons", lambda c: c["decision"] == "yes")
    several = F.coalesce(F.size(yes) > 1, F.lit(False))
    begins = lambda what: F.coalesce(several & F.exists(yes, lambda c: F.startswith(c["details"], F.lit(what))), F.lit(False))
    compared = F.transform("comparisons", lambda c: F.struct(c["id"].alias("id"), c["decision"].alias("decision")))
    rows = beside_pairing(log, offers, products, several_yes=several, name_in_several=begins(BY_NAME), ean_in_several=begins(BY_EAN), comparisons=compared)
    return rows.withColumns({
        "unsupported": F.coalesce(F.col("final_decision") == "unsupported_category", F.lit(False)),
        "in_candidates": F.coalesce(F.col("known") & F.exists("comparisons", lambda c: c["id"] == F.col("now")), F.lit(False)),
        "paired_decision": F.when(F.col("known"), _of(F.col("comparisons"), F.col("now"), "decision")),
        "looked_at": _looked_at(),
    }).drop("comparisons", "candidates")


def problems(evaluated: DataFrame) -> DataFrame:
    """(offer_id, model, candidate, decision, is_current): the candidates to look at of wrong matches and of several yes."""
    rows = evaluated.filter("n_problems > 0" if "n_problems" in evaluated.columns else "several_yes")
    return rows.select("offer_id", "model", F.explode("looked_at").alias("c")).select("offer_id", "model", "c.*")


def _share(of: str, whole: str) -> Column:
    return F.when(F.col("enough_days") & (F.col(whole) > 0), F.col(of) / F.col(whole))


def _per_model(rows: DataFrame, counts: dict[str, Column], least_days: int) -> DataFrame:
    """Counts per model and in total, and whether a model's rows span enough days for shares to mean something."""
    days = F.floor((F.unix_micros(F.max(F.col("time").cast("timestamp"))) - F.unix_micros(F.min(F.col("time").cast("timestamp")))) / 86_400_000_000)
    out = rows.rollup("model").agg(F.grouping("model").alias("_all"), F.count("*").alias("n"), (days >= least_days).alias("enough_days"), *(c.alias(n) for n, c in counts.items()))
    return out.withColumn("model", F.when(F.col("_all") == 1, "total").otherwise(F.col("model"))).drop("_all")


def matched_metrics(evaluated: DataFrame, least_days: int = LEAST_DAYS) -> DataFrame:
    """Per model and in total. Counts are of paired offers but for n and n_unpaired; shares are null where there is nothing to
    divide by or the rows span too few days."""
    paired, wrong = F.col("paired"), F.col("n_problems") > 0
    counts = {
        "n_unpaired": F.count_if(~paired), "n_paired": F.count_if(paired), "n_correct": F.count_if(paired & F.col("correct")), "n_category": F.count_if(paired & F.col("correct_category")),
        "n_by_name": F.count_if(paired & F.col("by_name")), "n_by_name_correct": F.count_if(paired & F.col("by_name") & ~wrong),
        "n_by_ean": F.count_if(paired & F.col("by_ean")), "n_by_ean_correct": F.count_if(paired & F.col("by_ean") & ~wrong),
        "n_wrong": F.count_if(wrong), "n_wrong_in_candidates": F.count_if(wrong & F.col("in_candidates")),
    }
    shares = {
        "unpaired_share": ("n_unpaired", "n"), "correct_share": ("n_correct", "n_paired"), "category_share": ("n_category", "n_paired"), "by_name_correct_share": ("n_by_name_correct", "n_by_name"),
        "by_ean_correct_share": ("n_by_ean_correct", "n_by_ean"), "wrong_in_candidates_share": ("n_wrong_in_candidates", "n_wrong"), "correct_of_all": ("n_correct", "n"),
    }
    return _per_model(evaluated, counts, least_days).withColumns({name: _share(*x) for name, x in shares.items()})


def unknown_metrics(evaluated: DataFrame, least_days: int = LEAST_DAYS) -> DataFrame:
    """Per model and in total; shares as in matched_metrics."""
    paired, unsupported = F.col("paired"), F.col("unsupported")
    counts = {"n_several": F.count_if("several_yes"), "n_name": F.count_if("name_in_several"), "n_ean": F.count_if("ean_in_several"), "n_unsupported": F.count_if(unsupported), "n_paired": F.count_if(paired)}
    counts |= {f"n_{d}": F.count_if(paired & (F.col("paired_decision") == d)) for d in ("yes", "unknown", "no")}
    counts |= {"n_category": F.count_if(paired & F.col("correct_category")), "n_paired_unsupported": F.count_if(paired & unsupported), "n_unsupported_category": F.count_if(paired & unsupported & F.col("correct_category")), "n_in_candidates": F.count_if(paired & F.col("in_candidates"))}
    shares = {
        "several_share": ("n_several", "n"), "name_share": ("n_name", "n_several"), "ean_share": ("n_ean", "n_several"), "unsupported_share": ("n_unsupported", "n"), "paired_yes_share": ("n_yes", "n_paired"), "paired_unknown_share": ("n_unknown", "n_paired"),
        "paired_no_share": ("n_no", "n_paired"), "category_share": ("n_category", "n_paired"), "unsupported_category_share": ("n_unsupported_category", "n_paired_unsupported"), "in_candidates_share": ("n_in_candidates", "n"),
    }
    return _per_model(evaluated, counts, least_days).withColumns({name: _share(*x) for name, x in shares.items()})


def long_form(metrics: DataFrame, names: list[str]) -> DataFrame:
    """(model, metric, value), without nulls: what alert rules look at."""
    return metrics.select("model", F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names))).alias("x")).select("model", "x.*").filter("value is not null")


def switched_off(alerts: DataFrame, models: DataFrame, disabled: DataFrame, redeployed: DataFrame) -> DataFrame:
    """(category, model, retrain): categories that are off from now on. Off are those whose model has a critical alert and is in
    production, which are retrained, and those that were off before, but for the redeployed ones. models: (category, model,
    stage); disabled, redeployed: (category)."""
    critical = alerts.filter("level = 'critical'").select("model").distinct()
    new = models.filter("stage = 'Production'").join(critical, "model", "left_semi").select("category", "model", F.lit(True).alias("retrain"))
    old = disabled.select("category").distinct().join(redeployed.select("category"), "category", "left_anti").join(new, "category", "left_anti")
    old = old.join(models.filter("stage = 'Production'").select("category", "model"), "category", "left").select("category", "model", F.lit(False).alias("retrain"))
    return new.distinct().union(old)
