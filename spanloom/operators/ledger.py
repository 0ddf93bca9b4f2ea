"""A monthly count ledger: baseline and revisions, incident totals, review decisions and promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Violations(ValueError):
    """Rows that break a strict input's rules."""


def require_none(violations: DataFrame, what: str) -> None:
    rows = violations.limit(5).collect()
    if rows:
        raise Violations(f"{what}: {[r.asDict() for r in rows]}")


def baseline_violations(baseline: DataFrame) -> DataFrame:
    """(month, reason): bad months, negative or missing counts, months that occur twice."""
    rows = baseline.withColumn("twice", F.count("*").over(Window.partitionBy("month")) > 1)
    reasons = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("month").rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), F.lit(False)), "bad month"),
        F.when(F.coalesce(F.col("deaths") < 0, F.lit(True)), "bad count"), F.when(F.col("twice"), "month twice")))
    return rows.select("month", F.explode(reasons).alias("reason"))


#: States of a revision.
STATUSES = ("confirmed", "needs_review", "rejected")


def counted_violations(revisions: DataFrame, statuses: tuple[str, ...] = STATUSES) -> DataFrame:
    """(record_id, reason, n): how many revisions of each id break which rule. Rows without an id are not read; a blank count is 0.

    What a row breaks is known before ids meet, so only counts do, and no id's rows are held or sorted.
    """
    rows = revisions.withColumn("record_id", F.trim("record_id")).where("record_id <> ''")
    count = F.coalesce(F.nullif(F.trim(F.col("deaths_delta").cast("string")), F.lit("")), F.lit("0"))
    broken = {"bad status": ~F.coalesce(F.lower(F.trim("status")).isin(*statuses), F.lit(False)),
              "bad date": F.try_to_date(F.trim("attack_date"), "yyyy-MM-dd").isNull(), "bad count": count.try_cast("int").isNull()}
    told = rows.groupBy("record_id").agg(F.count("*").alias("rows"), *[F.count_if(c).alias(reason) for reason, c in broken.items()])
    each = F.filter(F.array(F.struct(F.lit("id twice").alias("reason"), F.when(F.col("rows") > 1, F.col("rows")).otherwise(0).alias("n")),
                            *[F.struct(F.lit(reason).alias("reason"), F.col(reason).alias("n")) for reason in broken]), lambda x: x["n"] > 0)
    return told.select("record_id", F.inline(each))


#: Rows that one step repeats at most, so that no list is as long as a key has rows.
_REPEATED = 4096


def revision_violations(revisions: DataFrame, statuses: tuple[str, ...] = STATUSES) -> DataFrame:
    """(record_id, reason) of revisions that break a rule, as ``counted_violations``, one row for each."""
    counted = counted_violations(revisions, statuses)
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _REPEATED))))
    return blocks.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(_REPEATED), F.col("n") - F.col("block") * _REPEATED)))).select("record_id", "reason")


def monthly_counts(baseline: DataFrame, revisions: DataFrame) -> DataFrame:
    """(month, deaths, delta, total): the baseline with confirmed revisions; months of either input."""
    delta = revisions.where("status = 'confirmed'").groupBy("month").agg(F.sum("deaths_delta").alias("delta"))
    both = baseline.select("month", "deaths").join(delta, "month", "full").na.fill(0, ["deaths", "delta"])
    return both.withColumn("total", F.col("deaths") + F.col("delta"))


def negative_totals(monthly: DataFrame) -> DataFrame:
    """Months that confirmed revisions make negative: violations."""
    return monthly.where("total < 0")


def published_monthly(baseline: DataFrame, revisions: DataFrame) -> DataFrame:
    """``monthly_counts``; raises where a total is negative."""
    monthly = monthly_counts(baseline, revisions)
    require_none(negative_totals(monthly), "negative monthly totals")
    return monthly


def control_totals(monthly: DataFrame, expected: DataFrame) -> DataFrame:
    """(year, deaths, expected) of years whose sums differ, also those that only one side has."""
    sums = monthly.groupBy(F.substring("month", 1, 4).alias("year")).agg(F.sum("deaths").alias("deaths"))
    return sums.join(expected, "year", "full").where("not (deaths <=> expected)")


def effective(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Effect of each incident: its latest cumulative total, plus its deltas, less what the baseline holds.

    ``rows`` have ``count_kind`` (cumulative or delta), ``n`` and ``credited``. A replayed total adds nothing.
    """
    latest = F.max_by(F.when(F.col("count_kind") == "cumulative", F.col("n")), F.when(F.col("count_kind") == "cumulative", F.struct(*order)))
    deltas = F.sum(F.when(F.col("count_kind") == "delta", F.col("n")).otherwise(0))
    return rows.groupBy(*keys).agg((F.coalesce(latest, F.lit(0)) + deltas - F.coalesce(F.max("credited"), F.lit(0))).alias("effect"))


def effect_of(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """What a change of the ledger does: after minus before, per key."""
    both = after.select(*keys, F.col("effect").alias("after")).join(before.select(*keys, F.col("effect").alias("before")), keys, "full")
    return both.na.fill(0, ["before", "after"]).withColumn("change", F.col("after") - F.col("before"))


def promoted(candidates: DataFrame, ledger: DataFrame, same: list[str]) -> DataFrame:
    """What promotion does with each candidate: insert, link (the ledger has an identical record) or conflict.

    ``ledger`` holds one row per record_id with the columns ``same`` and the linked ``candidate_ids``.
    """
    old = ledger.select(F.col("record_id").alias("r"), *[F.col(c).alias(f"old_{c}") for c in same], F.col("candidate_ids").alias("old_ids"))
    both = candidates.join(old, F.col("record_id") == F.col("r"), "left")
    equal = F.lit(True)
    for c in same:
        equal = equal & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    action = F.when(F.col("r").isNull(), "insert").when(~equal, "conflict").when(F.array_contains("old_ids", F.col("candidate_id")), "none").otherwise("link")
    ids = F.array_sort(F.array_union(F.coalesce("old_ids", F.array().cast("array<string>")), F.array("candidate_id")))
    return both.withColumn("action", action).select("candidate_id", "record_id", *same, "action", F.when(action != "conflict", ids).alias("candidate_ids"))


#: The transitions a review may make.
TRANSITIONS = [("needs_review", "confirmed"), ("needs_review", "rejected"), ("needs_review", "hold"), ("hold", "needs_review")]


def reviewed(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions (candidate_id, city_key, to_status, at) applied to candidates; ``accepted`` says which may be.

    The candidate must exist once, be of the same city, and its status must allow the transition.
    """
    allowed = candidates.sparkSession.createDataFrame(TRANSITIONS, "status string, to_status string").withColumn("allowed", F.lit(True))
    one = candidates.groupBy("candidate_id").agg(F.count("*").alias("found"), F.max("city_key").alias("own_city"), F.max("status").alias("status"))
    rows = decisions.join(one, "candidate_id", "left").join(F.broadcast(allowed), ["status", "to_status"], "left")
    reasons = F.array_compact(F.array(
        F.when(F.coalesce("found", F.lit(0)) != 1, "no single candidate"), F.when(~F.col("city_key").eqNullSafe(F.col("own_city")), "other city"),
        F.when(F.col("allowed").isNull(), "transition not allowed")))
    return rows.select("candidate_id", "city_key", "status", "to_status", "at", reasons.alias("reasons"), (F.size(reasons) == 0).alias("accepted"))


#: Formats of an incident's id and of a proof that cannot change.
INCIDENT = r"^incident:[a-z0-9][a-z0-9:_-]{7,119}$"
PROOF = r"^(?:sha256:[0-9a-f]{64}|git:[0-9a-f]{40}:[^\s]+)$"


def confirmation_reasons(rows: DataFrame) -> DataFrame:
    """Rows with ``reasons``: why a confirmation is not complete, in the order of the rules."""
    text = lambda c: F.trim(F.col(c).cast("string"))
    rules = {
        "no id": text("record_id") != "", "bad date": F.try_to_date(text("attack_date"), "yyyy-MM-dd").isNotNull(),
        "bad count": text("deaths_delta").try_cast("int") > 0, "no source": text("source_name") != "",
        "bad address": text("source_url").rlike(r"^(?i)https?://[^/\s]"), "bad incident": text("incident_id").rlike(INCIDENT),
        "bad kind": F.lower(text("count_kind")).isin("cumulative", "delta"), "bad credit": text("baseline_credited").rlike("^(?:0|[1-9][0-9]*)$"),
        "no identity": text("identity_proof").rlike(PROOF), "no credit proof": text("credited_proof").rlike(PROOF),
    }
    return rows.withColumn("reasons", F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()])))


def reviewed_history(candidates: DataFrame, accepted: DataFrame) -> DataFrame:
    """Candidates after accepted decisions: the new status, and ``review_history`` with the decision appended.

    ``candidates`` have ``review_history`` (an array of structs at, from, to); one decision a candidate at most.
    """
    made = accepted.where("accepted").select("candidate_id", "to_status", F.struct("at", F.col("status").alias("from"), F.col("to_status").alias("to")).alias("step"))
    rows = candidates.join(made, "candidate_id", "left")
    history = F.when(F.col("step").isNull(), F.col("review_history")).otherwise(F.array_append(F.coalesce("review_history", F.array().cast(candidates.schema["review_history"].dataType)), F.col("step")))
    return rows.withColumns({"status": F.coalesce("to_status", "status"), "review_history": history}).select(*candidates.columns)


def duplicate_warnings(rows: DataFrame, group: str, url: str, title: str, day: str) -> DataFrame:
    """Pairs (a, b, kind) of rows of one group: the same address or title, or the same day only.

    A row is tied to the first of its address, title or day, so a popular one gives links, not pairs.
    """
    def tied(column: str, kind: str) -> DataFrame:
        one = rows.where(F.col(column).isNotNull()).groupBy(group, column).agg(F.min("id").alias("a"))
        return rows.join(one, [group, column]).where("id <> a").select(group, "a", F.col("id").alias("b"), F.lit(kind).alias("kind"))

    media = tied(url, "media").unionByName(tied(title, "media")).distinct()
    return media.unionByName(tied(day, "day").join(media.select(group, "a", "b"), [group, "a", "b"], "left_anti"))


def by_status(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def outside_set(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the dimension."""
    return rows.join(dim.select(key).distinct(), key, "left_anti")


def inbox(queue: DataFrame, n: int = 30) -> DataFrame:
    """The first ``n`` open candidates, newest first."""
    return queue.where("status = 'needs_review'").orderBy(F.desc("updated_at"), "candidate_id").limit(n)
