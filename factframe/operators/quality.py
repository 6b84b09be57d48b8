"""Rule checks, their roll-up, and routing by the latest review."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where each decision leads: fixed values.
ROUTES = {"approved": "accepted", "edited": "accepted", "rejected": "excluded"}


def check(rows: DataFrame, key: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """(key, severity, issue_code) for each (severity, code, condition) that holds; all rules are read off a row at once."""
    hits = [F.when(broken, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("issue_code"))) for severity, code, broken in rules]
    found = F.filter(F.array(*hits), lambda h: h.isNotNull())
    return rows.select(key, F.explode(found).alias("i")).select(key, "i.*")


#: Files that a clip has to have: fixed values.
REQUIRED = ["clip.mp4", "keyframes/selected.png", "semantic.svg", "dynamic_data.json", "chart_data_validation.json", "animation_detection.json"]
ISSUE = ["severity", "issue_code", "artifact", "layer"]


def rule_issues(clips: DataFrame, key: str = "clip_id") -> DataFrame:
    """(key, severity, issue_code, artifact, layer) of what a clip's own files say.

    clips: files and bad_json (arrays of names), and, where dynamic_data.json
    reads: include, numeric_count, exclude_reason, n_states, n_state_ids,
    n_events, dynamic, extractable (null without a validation), n_csv,
    n_final, n_event_csv, planned, svgs (array of (success, svg), null without
    a manifest).
    """
    has = lambda name: F.array_contains(F.coalesce("files", F.array().cast("array<string>")), name)
    bad = lambda name: F.array_contains(F.coalesce("bad_json", F.array().cast("array<string>")), name)
    issue = lambda severity, code, artifact, broken: F.when(broken, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("issue_code"), (artifact if isinstance(artifact, Column) else F.lit(artifact)).alias("artifact")))
    hard, soft = "hard_fail", "needs_review"
    include, dyn = F.coalesce("include", F.lit(False)), "dynamic_data.json"
    reads = has(dyn) & ~bad(dyn)
    n = lambda c: F.coalesce(c, F.lit(0))
    own = [
        issue(hard, "included_without_numeric_facts", dyn, include & (n("numeric_count") <= 0)),
        issue(soft, "excluded_without_standard_reason", dyn, ~include & ~F.col("exclude_reason").eqNullSafe("no_recoverable_quantitative_data")),
        issue(hard, "included_without_states", dyn, include & (n("n_states") == 0)),
        issue(soft, "dynamic_flag_without_multiple_states_or_events", dyn, F.coalesce("dynamic", F.lit(False)) & (n("n_state_ids") < 2) & (n("n_events") == 0)),
        issue(soft, "validation_include_mismatch", "chart_data_validation.json", F.col("extractable").isNotNull() & (F.col("extractable") != include)),
        issue(hard, "missing_dynamic_data_csv", "dynamic_data.csv", include & (n("n_csv") == 0)),
        issue(hard, "missing_final_data_table", "final_data_table.csv", include & (n("n_final") == 0)),
        issue(soft, "event_csv_json_count_mismatch", "data_change_events.csv", (n("n_events") > 0) & (n("n_event_csv") != n("n_events"))),
        issue(soft, "missing_semantic_state_inputs", "semantic_state_input_manifest.json", F.coalesce("planned", F.lit(False)) & ~has("semantic_state_input_manifest.json")),
        issue(soft, "missing_semantic_state_svgs", "semantic_state_svg_manifest.json", F.coalesce("planned", F.lit(False)) & ~has("semantic_state_svg_manifest.json")),
        issue(hard, "invalid_json", "semantic_state_svg_manifest.json", bad("semantic_state_svg_manifest.json")),
    ]
    failed = F.transform(F.filter(F.coalesce("svgs", F.array().cast("array<struct<success: boolean, svg: string>>")), lambda s: ~F.coalesce(s["success"], F.lit(False))), lambda s: F.struct(F.lit(soft).alias("severity"), F.lit("semantic_state_svg_failed").alias("issue_code"), F.coalesce(s["svg"], F.lit("semantic_state_svg_manifest.json")).alias("artifact")))
    missing = [issue(hard, "missing_required_file", f, ~has(f)) for f in REQUIRED]
    # The two JSON files are opened once more, so a missing one is reported twice.
    opened = [x for f in (dyn, "chart_data_validation.json") for x in (issue(hard, "missing_required_file", f, ~has(f)), issue(hard, "invalid_json", f, bad(f)))]
    found = F.concat(F.array_compact(F.array(*missing, *opened)), F.when(reads, F.concat(F.array_compact(F.array(*own)), failed)).otherwise(F.slice(failed, 1, 0)))
    return clips.select(key, F.posexplode(found).alias("place", "i")).select(key, "place", "i.*", F.lit("rules").alias("layer"))


def cross_issues(states: DataFrame, svgs: DataFrame, key: str = "clip_id") -> DataFrame:
    """(key, severity, issue_code, artifact, layer) of a clip's data (key, state_id, entity_id, metric) against its drawings.

    svgs: (key, state_id, path, found, ids, entities, roles), state_id being
    null for the drawing of the whole clip; found without ids is a drawing
    that can't be read. An entity is drawn if it is among the entities or its
    id, `entity-` and its name, among the ids.
    """
    drawn = F.array_union(F.coalesce("entities", F.array().cast("array<string>")), F.transform(F.filter(F.coalesce("ids", F.array().cast("array<string>")), lambda i: F.startswith(i, F.lit("entity-"))), lambda i: F.substring(i, 8, 1 << 30)))
    of_clip = states.groupBy(key).agg(F.collect_set(F.nullif("entity_id", F.lit(""))).alias("held"), F.bool_or(~F.col("metric").eqNullSafe("value")).alias("measured"))
    of_state = states.where("state_id <> ''").groupBy(key, "state_id").agg(F.collect_set("entity_id").alias("held"))
    unread = F.col("ids").isNull()
    lacks = F.size(F.array_except("held", drawn)) > 0
    issue = lambda severity, code, broken: F.when(broken, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("issue_code"), F.col("path").alias("artifact")))
    top = svgs.where("state_id IS NULL AND found").join(of_clip, key)
    barless = F.col("measured") & ~F.array_contains(F.coalesce("roles", F.array().cast("array<string>")), "bar")
    first = top.select(key, F.lit(0).alias("part"), F.array(issue("hard_fail", "invalid_semantic_svg", unread), issue("needs_review", "semantic_missing_bar_role", ~unread & barless), issue("needs_review", "data_entity_missing_in_semantic", ~unread & lacks)).alias("found"))
    known = svgs.where("state_id IS NOT NULL").join(of_clip.select(key), key, "left_semi").join(of_state, [key, "state_id"], "left").withColumn("held", F.coalesce("held", F.array().cast("array<string>")))
    rest = known.select(key, F.lit(1).alias("part"), F.array(issue("needs_review", "missing_state_semantic_svg", ~F.col("found")), issue("hard_fail", "invalid_state_semantic_svg", F.col("found") & unread), issue("needs_review", "state_data_entity_missing_in_semantic", F.col("found") & ~unread & lacks)).alias("found"))
    rows = first.unionByName(rest).select(key, F.explode(F.array_compact("found")).alias("i")).select(key, "i.*", F.lit("cross_artifact").alias("layer"))
    return rows


def model_issues(answers: DataFrame, key: str = "clip_id") -> DataFrame:
    """(key, severity, issue_code, artifact, layer) of a model's review (key, model_status, result).

    model_status: ok, unavailable, interface_missing or failed; result: a
    struct (needs_review, severity, issue_codes), null where the model gave
    none.
    """
    codes = F.coalesce("result.issue_codes", F.array(F.lit("qc_vlm_flagged")))
    kinds = {"unavailable": "qc_vlm_unavailable", "interface_missing": "qc_vlm_interface_missing", "failed": "qc_vlm_failed"}
    table = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    flagged = F.when(F.coalesce("result.needs_review", F.lit(False)), codes).otherwise(F.slice(codes, 1, 0))
    found = F.when(F.col("model_status") != "ok", F.array(F.try_element_at(table, F.col("model_status")))).when(F.col("result").isNull(), F.array(F.lit("qc_vlm_bad_response"))).otherwise(flagged)
    severity = F.when(F.col("model_status") == "ok", F.coalesce(F.nullif("result.severity", F.lit("")), F.lit("needs_review"))).otherwise("needs_review")
    return answers.select(key, severity.alias("severity"), F.explode(found).alias("issue_code"), F.col(key).cast("string").alias("artifact"), F.lit("vlm").alias("layer"))


def all_issues(*layers: DataFrame, key: str = "clip_id") -> DataFrame:
    """The issues of several layers, in the order of layers."""
    rows = [layer.select(key, F.lit(n).alias("n_layer"), *ISSUE) for n, layer in enumerate(layers)]
    return reduce(DataFrame.unionByName, rows)


def status(keys: DataFrame, issues: DataFrame, key: str) -> DataFrame:
    """Every key's worst severity, number of issues, and its distinct codes joined by |."""
    codes = F.array_join(F.array_sort(F.collect_set("issue_code")), "|")
    rolled = issues.groupBy(key).agg(F.count("*").alias("n"), F.bool_or(F.col("severity") == "hard_fail").alias("hard"), codes.alias("codes"))
    out = keys.join(rolled, key, "left")
    kind = F.when(F.col("n").isNull(), "pass").when(F.col("hard"), "hard_fail").otherwise("needs_review")
    return out.select(key, kind.alias("status"), F.coalesce("n", F.lit(0).cast("long")).alias("n_issues"), F.coalesce("codes", F.lit("")).alias("issue_codes"))


def latest(reviews: DataFrame, key: str, at: list[str]) -> DataFrame:
    """The last review of each key by `at`, one partial row a key and task."""
    others = [c for c in reviews.columns if c != key]
    return reviews.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*at)).alias("r")).select(key, "r.*")


def route(keys: DataFrame, reviews: DataFrame, key: str, decision: str) -> DataFrame:
    """Each key with where its latest decision leads; without one, or with an unknown one, it stays unreviewed."""
    met = keys.join(reviews.select(key, decision), key, "left")
    table = F.create_map(*[F.lit(x) for pair in ROUTES.items() for x in pair])
    return met.withColumn("route", F.coalesce(F.try_element_at(table, F.col(decision)), F.lit("unreviewed")))
