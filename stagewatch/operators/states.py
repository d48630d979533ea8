"""Workflow states from ordered events, without a loop over rows.

An event either sets the state, clears it, or leaves it.  The state at a row is therefore decided by
the latest setting or clearing event, and by whether a disconnect came after it.  Both are running
"latest value" columns over strictly earlier rows, so they can also be carried across slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.ordered import group_values, next_value, row_position, running_before
from stagewatch.workflow import CRITICAL_TYPES, DEFAULT, KEYS, SCRIPT, Workflow, event_order

CLEARED = "<cleared>"
DUPLICATE_RULE = "clear_alignment_duplicate_coarse_same_timestamp"
DISCONNECT_RULE = "clear_post_treatment_disconnect_events"
DATE_RULE = "clear_segment_date_mismatch"


def segment_date_mismatch(workflow: Workflow = DEFAULT) -> Column:
    text = F.trim("segment_id")
    prefix = text.substr(1, 10)
    dated = (
        (F.length(text) >= 10) & text.contains("-") if workflow.loose_segment_date
        else prefix.rlike(r"^\d{4}-\d{2}-\d{2}$")
    )
    return F.coalesce(dated & (prefix != F.col("timestamp").cast("date").cast("string")), F.lit(False))


def is_disconnect() -> Column:
    kind = F.col("event_type")
    return F.coalesce(
        (kind == "MriConnectionRecord")
        | ((kind == "SessionEventRecord") & (F.col("event_kind") == 1))
        | ((kind == "SegmentEventRecord") & (F.col("event_kind") == 2)),
        F.lit(False),
    )


def _settled(last_op: Column, last_mark: Column, workflow: Workflow) -> Column:
    """State after the latest setting/clearing value and the latest mark ('set' or 'disconnect')."""
    gone = (last_op == CLEARED) | ((last_op == workflow.removal_state) & (last_mark == "disconnect"))
    return F.when(~F.coalesce(gone, F.lit(False)), last_op)


def mark_duplicate_alignment(events: DataFrame) -> DataFrame:
    """``is_duplicate``: an alignment directly after a coarse event of the same instant."""
    out = running_before(events, KEYS, event_order(), {
        "__prev": ("last", F.struct("event_type", "ts_us")),
    })
    return out.withColumn("is_duplicate", F.coalesce(
        (F.col("event_type") == "AlignmentWorkflowRecord")
        & (F.col("__prev.event_type") == "CoarseWorkflowRecord")
        & (F.col("__prev.ts_us") == F.col("ts_us")),
        F.lit(False),
    )).drop("__prev")


def _with_states(events: DataFrame, workflow: Workflow) -> DataFrame:
    mapped = workflow.state_of(F.col("event_type"))
    mismatch = segment_date_mismatch(workflow)
    positioned = mapped == workflow.positioning_state
    if not workflow.seen_before_clears:
        positioned = positioned & ~mismatch
    out = events.withColumn("mismatch", mismatch)
    out = running_before(out, KEYS, event_order(), {
        "seen": ("max", F.coalesce(positioned, F.lit(False)).cast("int")),
    })
    early_test = (F.col("event_type") == "UATestRecord") & (F.coalesce("seen", F.lit(0)) == 0)
    paused = F.col("event_type").contains("DeliveryPaused")
    out = out.withColumns({
        "set_state": F.when(early_test, workflow.ready_state).when(paused, workflow.paused_state).otherwise(mapped),
        "set_rule": F.when(early_test, "map_uatest_pre_positioning").when(paused, "map_delivery_paused")
        .otherwise(workflow.rule_of(F.col("event_type"))),
        "disconnect": is_disconnect(),
    })
    out = out.withColumn("op", F.when(F.col("is_duplicate") | F.col("mismatch"), CLEARED).otherwise(F.col("set_state")))
    out = out.withColumn("mark", F.when(F.col("disconnect"), "disconnect").when(F.col("op").isNotNull(), "set"))
    out = running_before(out, KEYS, event_order(), {"op_in": ("last", F.col("op")), "mark_in": ("last", F.col("mark"))})
    return out.withColumns({
        "prior_state": _settled(F.col("op_in"), F.col("mark_in"), workflow),
        "state": _settled(F.coalesce("op", "op_in"), F.coalesce("mark", "mark_in"), workflow),
    })


_SCRATCH = ["mismatch", "seen", "set_state", "set_rule", "disconnect", "op", "mark", "op_in", "mark_in"]


def label_states(events: DataFrame, workflow: Workflow = DEFAULT) -> DataFrame:
    """Add ``state``, ``state_assignment_rule``, ``cleanup_rule_applied`` and ``prior_state``."""
    out = _with_states(mark_duplicate_alignment(events), workflow)
    before = F.when(~F.col("is_duplicate"), F.coalesce("set_state", "prior_state"))
    out = out.withColumn("__disc", F.coalesce((before == workflow.removal_state) & F.col("disconnect"), F.lit(False)))
    cleanup = F.concat_ws(
        ";",
        F.when(F.col("is_duplicate"), DUPLICATE_RULE),
        F.when(F.col("__disc"), DISCONNECT_RULE),
        F.when(before.isNotNull() & ~F.col("__disc") & F.col("mismatch"), DATE_RULE),
    )
    return out.withColumns({
        "state_assignment_rule": F.coalesce(
            "set_rule", F.when(F.col("prior_state").isNotNull(), "carry_forward_previous_state")
        ),
        "cleanup_rule_applied": cleanup,
    }).drop(*_SCRATCH, "is_duplicate", "__disc")


def is_critical_type(kind: Column) -> Column:
    return kind.contains("WorkflowRecord") | kind.contains("Delivery") | kind.isin(*CRITICAL_TYPES)


def unmapped_critical(labelled: DataFrame) -> DataFrame:
    """Critical event types met while no state was set and none resulted: once per case and type."""
    idle = F.col("state_assignment_rule").isNull()
    return labelled.filter(idle & is_critical_type(F.col("event_type"))).groupBy(*KEYS, "event_type").agg(
        F.count(F.lit(1)).alias("n_events")
    )


# ---- script profile -----------------------------------------------------------------------------

def label_states_script(events: DataFrame, workflow: Workflow = SCRIPT) -> DataFrame:
    """Script profile: duplicate alignments are removed; every remaining row is kept, stateless ones too."""
    unique = mark_duplicate_alignment(events).filter(~F.col("is_duplicate"))
    return _with_states(unique, workflow).drop(*_SCRATCH, "prior_state", "is_duplicate")


def setup_positions(events: DataFrame) -> DataFrame:
    """Add ``pos`` (0-based) and the case's landmark positions used to choose the anchor.

    ``al``/``ii``/``di``/``su`` first alignment, initial imaging, insertion end, setup; ``uh_*`` homings;
    ``ready_at`` the last test before alignment (with its fallbacks).  Landmarks are (pos, ts_us) pairs.
    """
    at = F.struct("pos", "ts_us")

    def pick(kind: str) -> Column:
        return F.when(F.col("event_type") == kind, at)

    out = row_position(events, KEYS, event_order(), "pos", first=0)
    out = group_values(out, KEYS, {
        "al": F.min(pick("AlignmentWorkflowRecord")),
        "ii": F.min(pick("InitialImaging")),
        "di": F.min(pick("DeviceInsertionEnds")),
        "su": F.min(pick("SetupWorkflowRecord")),
        "uh_first": F.min(pick("PSHomingRecord")),
        "uh_last": F.max(pick("PSHomingRecord")),
        "uh_count": F.count(pick("PSHomingRecord")),
        "first_us": F.min("ts_us"),
    })
    early = F.col("pos") < F.col("al.pos")
    out = group_values(out, KEYS, {
        "last_test": F.max(F.when(F.col("event_type").isin("PSTestRecord", "UATestRecord") & early, F.col("pos"))),
        "uh_before_al": F.max(F.when(early, pick("PSHomingRecord"))),
    })
    tested = F.coalesce("last_test", F.lit(0).cast("bigint"))
    return out.withColumn("ready_at", F.when(tested > 1, tested).when(F.col("uh_count") > 1, F.col("uh_first.pos"))
                          .otherwise(F.coalesce("su.pos", tested)))


LANDMARKS = ["al", "ii", "di", "su", "uh_first", "uh_last", "uh_count", "last_test", "uh_before_al", "ready_at"]


def adjust_setup(labelled: DataFrame) -> DataFrame:
    """Script profile: overwrite the set-up states of a case and name its rebase anchor."""
    out = setup_positions(labelled)
    homed = F.col("uh_last.pos") > F.col("ready_at")
    imaged_early = F.col("ii.pos") < F.col("al.pos")
    anchor = (
        F.when(F.col("al").isNull(), F.lit(None))
        .when(~F.coalesce(homed, F.lit(False)), "Alignment")
        .when(F.col("ii").isNull() & F.col("uh_before_al").isNotNull(), "LastUAHoming")
        .when(imaged_early, "InitialImaging")
    )
    out = out.withColumn("rebase_anchor", anchor)
    pos = F.col("pos")
    start = F.when(F.col("rebase_anchor") == "LastUAHoming", F.col("uh_before_al.pos")).when(
        F.col("rebase_anchor") == "InitialImaging", F.col("ii.pos"))
    inserting = F.col("al").isNotNull() & (F.col("di.pos") <= F.col("ii.pos")) & pos.between(
        F.col("di.pos"), F.col("ii.pos"))
    state = (
        F.when((pos >= start) & (pos < F.col("al.pos")), "Device repositioning")
        .when(inserting, "Device insertion")
        .otherwise(F.col("state"))
    )
    return out.withColumn("state", state).drop(*LANDMARKS, "first_us")


def script_times(adjusted: DataFrame) -> DataFrame:
    """Script profile: drop stateless rows, then times relative to the anchor of the case."""
    present = adjusted.filter(F.coalesce("state", F.lit("")) != "")
    out = next_value(present, KEYS, event_order(), "next_us", F.col("ts_us"))
    at = F.struct("pos", "ts_us")

    def pick(kind: str) -> Column:
        return F.when(F.col("event_type") == kind, at)

    out = group_values(out, KEYS, {
        "first_us": F.min("ts_us"), "last_us": F.max("ts_us"),
        "__ii": F.min(pick("InitialImaging")), "__uh": F.max(pick("PSHomingRecord")),
        "__al": F.min(pick("AlignmentWorkflowRecord")),
    })
    origin = (
        F.when(F.col("rebase_anchor") == "InitialImaging", F.col("__ii.ts_us"))
        .when(F.col("rebase_anchor") == "LastUAHoming", F.col("__uh.ts_us"))
        .when(F.col("rebase_anchor") == "Alignment", F.col("__al.ts_us"))
    )
    return out.withColumns({
        "start_us": F.col("ts_us") - F.coalesce(origin, F.col("first_us")),
        "duration_us": F.greatest(F.coalesce(F.col("next_us") - F.col("ts_us"), F.lit(0)), F.lit(0)).cast("bigint"),
    }).withColumns({
        "start_sec": F.col("start_us") / 1e6, "duration_sec": F.col("duration_us") / 1e6,
    }).drop("__ii", "__uh", "__al", "next_us")


def relabel_review_tail(labelled: DataFrame, gap_min: int = 30) -> DataFrame:
    """Optional legacy rule: rows of the review and transfer tail become 'NA'.

    With a transfer end, everything from the first one on; without one, everything from the first
    review on (or from the last but one row, if that is earlier).  A review more than ``gap_min``
    minutes after the first is 'NA' in either case.
    """
    out = row_position(labelled, KEYS, event_order(), "pos", first=0)
    at = F.struct("pos", "ts_us")
    review = F.col("event_type") == "ReviewWorkflowRecord"
    out = group_values(out, KEYS, {
        "__pt": F.min(F.when(F.col("event_type") == "PatientTransferEnds", F.col("pos"))),
        "__rv": F.min(F.when(review, at)),
        "__n": F.count(F.lit(1)),
    })
    tail = F.coalesce("__pt", F.when(F.col("__rv").isNotNull(), F.least(F.col("__rv.pos"), F.greatest(F.col("__n") - 2, F.lit(0)))))
    late = review & (F.col("ts_us") - F.col("__rv.ts_us") > gap_min * 60_000_000)
    is_tail = F.coalesce(F.col("pos") >= tail, F.lit(False)) | F.coalesce(late, F.lit(False))
    return out.withColumn("state", F.when(is_tail, "NA").otherwise(F.col("state"))).drop("__pt", "__rv", "__n", "pos")
