"""One surviving record per group of copies, field by field.

Latent two-sided quality model: a value of a field in a group is true or not; a claimant that has the group either
asserts the value or not. Each claimant has, per field, a sensitivity (chance to assert a true value) and a specificity
(chance to leave a false one). Expectation-maximisation over all groups infers them and the posterior of each value, starting from the
share of a group's claimants that assert it. More than one value may be true: all with a posterior of one half or more are
retained, the best is the survivor.

Who claims a field is a column of its own (collectors claim titles and publishers, publishers claim the source), so that no column vouches for itself.
A value's posterior depends on who asserts it and who has the group. Groups in which the same claimants assert in the same
way are one pattern and counted together before the iterations. An iteration is a few joins over the patterns' claims; its
work grows with the claims, never with the product of values and claimants, and the number of claimants is not limited.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.runtime import plain_unions, stage_table

ROUNDS = 8
#: Beta priors: sensitivity, specificity (as counts of hits and misses), share of true values.
PRIOR_SENSITIVITY, PRIOR_SPECIFICITY, PRIOR_TRUTH = (2.0, 1.0), (2.0, 1.0), (2.0, 2.0)


def _clean(name: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)[\s\p{P}]+", " ")))


def _blank(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)\s+", "") == ""


def claims(records: DataFrame, groups: DataFrame, claimants: dict[str, str], id_column: str = "id", recency: str = "created_at") -> DataFrame:
    """``first_id, field_name, value, s, n, best_id, last_at``: who asserts what, copies counted.

    ``claimants``: the column that claims each field. s: hash of the claimant's name (differences in case, space and punctuation ignored;
    blank names are one). A blank value is ''.
    """
    several = groups.groupBy("first_id").agg(F.count("*").alias("c")).where("c > 1").select("first_id")
    linked = groups.join(several, "first_id")
    values = F.array(*(F.struct(F.lit(f).alias("field_name"), F.when(_blank(F.col(f)), "").otherwise(F.col(f)).alias("value"), F.xxhash64(_clean(F.col(c))).alias("s")) for f, c in claimants.items()))
    rows = records.select(F.col(id_column).cast("bigint").alias("id"), F.unix_micros(F.col(recency)).alias("at"), values.alias("vs"))
    # ids are unique; fields are exploded after the join, so that the join moves each record once
    long = linked.join(rows, "id").select("first_id", "id", "at", F.explode("vs").alias("v")).select("first_id", "id", "at", "v.*")
    return long.groupBy("first_id", "field_name", "value", "s").agg(F.count("*").alias("n"), F.min("id").alias("best_id"), F.max("at").alias("last_at"))


def _sum_of_hashes(column: str) -> Column:
    """The same for equal bags of hashes, in whatever order."""
    return F.xxhash64(F.sum(F.col(column).cast("decimal(20,0)")).cast("string"), F.count("*"))


def _log_odds(sensitivity: Column, specificity: Column) -> tuple[Column, Column]:
    """What an assertion and a silence add to the log odds of a value."""
    return F.log(sensitivity / (1 - specificity)), F.log((1 - sensitivity) / specificity)


def fit_quality(asserted: DataFrame, having: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Expectation-maximisation over patterns; returns ``pid, aid, posterior`` and ``field_name, s, sensitivity, specificity``.

    asserted: ``pid, field_name, aid, w, s``, claimant s asserts the values aid of pattern pid, of which there are w. having: ``pid, field_name, s, k``,
    the claimants of a pattern, and how many. Both are staged tables.
    """
    values = stage_table(asserted.groupBy("pid", "field_name", "aid").agg(F.first("w").alias("w"), F.count("*").alias("a")), "values")
    size = having.groupBy("pid").agg(F.count("*").alias("k"))
    # first guess: the share of the claimants that assert the value
    posterior = values.join(size, "pid").select("pid", "field_name", "aid", "w", (F.col("a") / F.col("k")).alias("p"))
    for _ in range(rounds):
        posterior = stage_table(posterior, "posterior")
        per_pattern = posterior.groupBy("pid").agg(F.sum(F.col("w") * F.col("p")).alias("t"), F.sum(F.col("w") * (1 - F.col("p"))).alias("f"))
        said = asserted.join(posterior.select("pid", "aid", "p"), ["pid", "aid"]).groupBy("field_name", "s").agg(F.sum(F.col("w") * F.col("p")).alias("ta"), F.sum(F.col("w") * (1 - F.col("p"))).alias("fa"))
        held = having.join(per_pattern, "pid").groupBy("field_name", "s").agg(F.sum("t").alias("t"), F.sum("f").alias("f"))
        sen = (F.coalesce("ta", F.lit(0.0)) + PRIOR_SENSITIVITY[0]) / (F.col("t") + sum(PRIOR_SENSITIVITY))
        spe = (F.col("f") - F.coalesce("fa", F.lit(0.0)) + PRIOR_SPECIFICITY[0]) / (F.col("f") + sum(PRIOR_SPECIFICITY))
        quality = stage_table(held.join(said, ["field_name", "s"], "left").select("field_name", "s", sen.alias("sensitivity"), F.greatest(spe, F.lit(1e-6)).alias("specificity")), "quality")
        truth = posterior.groupBy("field_name").agg(((F.sum(F.col("w") * F.col("p")) + PRIOR_TRUTH[0]) / (F.sum("w") + sum(PRIOR_TRUTH))).alias("truth"))
        said_odds, silent_odds = _log_odds(F.col("sensitivity"), F.col("specificity"))
        odds = quality.select("field_name", "s", silent_odds.alias("ls"), (said_odds - silent_odds).alias("la"))
        base = having.join(odds.drop("la"), ["field_name", "s"]).groupBy("pid").agg(F.sum("ls").alias("base"))
        more = asserted.join(odds.drop("ls"), ["field_name", "s"]).groupBy("pid", "field_name", "aid").agg(F.first("w").alias("w"), F.sum("la").alias("more"))
        total = F.log(F.col("truth") / (1 - F.col("truth"))) + F.col("base") + F.col("more")
        posterior = more.join(base, "pid").join(F.broadcast(truth), "field_name").select("pid", "field_name", "aid", "w", (1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), total))))).alias("p"))  # one row per field
    return stage_table(posterior.select("pid", "aid", F.col("p").alias("posterior")), "posterior"), quality


def resolve(records: DataFrame, groups: DataFrame, claimants: dict[str, str]) -> DataFrame:
    """``first_id, field_name, value, posterior, support, best_id, last_at, n_values, best``: every value that a group of two or more holds.

    best marks the survivor: highest posterior, then most copies, most recent, longest, smallest id. A blank is the value '', is
    asserted by nobody (posterior 0) and survives only where nothing else is stored. n_values counts different stored values, all blanks as one.
    ``groups``: ``id, first_id``; ``claimants``: each field and the column that claims it. Groups of one record give no rows.
    """
    with plain_unions(records.sparkSession):
        return _resolve(records, groups, claimants)


def _resolve(records: DataFrame, groups: DataFrame, claimants: dict[str, str]) -> DataFrame:
    told = stage_table(claims(records, groups, claimants), "claims")
    # aid: one number for the set of those who assert a value; pid: one for the bag of these sets in a group
    values = told.groupBy("first_id", "field_name", "value").agg(_sum_of_hashes("s").alias("aid"), F.sum("n").alias("support"), F.min("best_id").alias("best_id"), F.max("last_at").alias("last_at"))
    some = values.where("value != ''")
    patterns = some.groupBy("first_id", "field_name").agg(_sum_of_hashes("aid").alias("bag")).select("first_id", "field_name", F.xxhash64("field_name", "bag").alias("pid"))
    facts = stage_table(values.join(patterns, ["first_id", "field_name"], "left"), "facts")
    # one group stands for each pattern
    counted = facts.where("value != ''").groupBy("pid", "field_name", "aid").agg(F.count("*").alias("w"), F.min("first_id").alias("at"))
    chosen = stage_table(counted, "patterns")
    example = chosen.groupBy("pid", "field_name").agg(F.min("at").alias("first_id"))
    shown = facts.where("value != ''").join(example, ["first_id", "field_name", "pid"], "left_semi").select("first_id", "field_name", "value", "pid", "aid")
    shown = shown.join(told.select("first_id", "field_name", "value", "s"), ["first_id", "field_name", "value"]).select("pid", "field_name", "aid", "s").distinct()
    asserted = stage_table(shown.join(chosen.select("pid", "aid", "w"), ["pid", "aid"]), "asserted")
    having = stage_table(asserted.select("pid", "field_name", "s").distinct(), "having")
    judged, _ = fit_quality(asserted, having)
    scored = facts.join(judged, ["pid", "aid"], "left").withColumn("posterior", F.when(F.col("value") == "", 0.0).otherwise(F.col("posterior")))
    order = F.struct("posterior", F.when(F.col("value") == "", 0).otherwise(1).alias("some"), "support", "last_at", F.length("value").alias("len"), (-F.col("best_id")).alias("low"), "value")
    best = scored.groupBy("first_id", "field_name").agg(F.count("*").alias("n_values"), F.max_by("value", order).alias("top"))
    return scored.join(best, ["first_id", "field_name"]).select("first_id", "field_name", "value", "posterior", "support", "best_id", "last_at", "n_values", (F.col("value") == F.col("top")).alias("best"))


def survivors(resolved: DataFrame, fields: list[str]) -> DataFrame:
    """``first_id`` and the surviving value of each field (NULL where every copy is blank): one row per group."""
    picked = resolved.where("best")
    return picked.groupBy("first_id").agg(*(F.nullif(F.max(F.when(F.col("field_name") == f, F.col("value"))), F.lit("")).alias(f) for f in fields))


def retained_values(resolved: DataFrame, at_least: float = 0.5) -> DataFrame:
    """``first_id, field_name, value, posterior, support``: every value judged true, and each field's survivor."""
    return resolved.where((F.col("value") != "") & ((F.col("posterior") >= at_least) | F.col("best"))).select("first_id", "field_name", "value", F.round("posterior", 6).alias("posterior"), "support")
