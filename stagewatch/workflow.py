"""The clinical workflow as data: states, transitions, labels and phase groups.

Every operator takes a :class:`Workflow`; ``DEFAULT`` is the one shipped here.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["site_code", "case_id"]

# ---- fixed values -------------------------------------------------------------------------------
STATES = (
    ("TULSA QA", "#D9D9D9"),
    ("Room ready", "#B3B3B3"),
    ("Patient positioning & induction", "#8C8C8C"),
    ("Device insertion", "#9BCD9B"),
    ("Device repositioning", "#698B69"),
    ("Alignment", "#ADD8E6"),
    ("Coarse", "#4169E1"),
    ("Detailed", "#27408B"),
    ("Planning start angle", "#000080"),
    ("Initialization", "#EEDD82"),
    ("Treating", "#DAA520"),
    ("Paused", "#B8860B"),
    ("Review", "#8B6508"),
    ("Post-treatment scans & Device removal", "#C1FFC1"),
    ("Patient recovery & transfer", "#8B7B8B"),
    ("NA", "#FFFFFF"),
)
UNKNOWN_STATE_COLOR = "slategray"

TRANSITIONS = (
    ("SetupWorkflowRecord", "TULSA QA", "map_setup_workflow"),
    ("SetupUnlockWorkflowRecord", "Room ready", "map_setup_unlock_workflow"),
    ("AnesthesiaStart", "Patient positioning & induction", "map_anesthesia_or_urology_ready"),
    ("Ready4Urology", "Patient positioning & induction", "map_anesthesia_or_urology_ready"),
    ("DeviceInsertionBegins", "Device insertion", "map_device_insertion"),
    ("DeviceInsertionEnds", "Device insertion", "map_device_insertion"),
    ("InitialImaging", "Device repositioning", "map_initial_imaging"),
    ("AlignmentWorkflowRecord", "Alignment", "map_alignment"),
    ("CoarseWorkflowRecord", "Coarse", "map_coarse"),
    ("CoarseUnlockWorkflowRecord", "Coarse", "map_coarse"),
    ("DetailedWorkflowRecord", "Detailed", "map_detailed"),
    ("PlanReadyWorkflowRecord", "Planning start angle", "map_plan_ready"),
    ("PlanReadyCompleteWorkflowRecord", "Planning start angle", "map_plan_ready"),
    ("PlanReadyUserStoppedInitializationWorkflowRecord", "Planning start angle", "map_plan_ready_stop_init"),
    ("DeliveryInitializingWorkflowRecord", "Initialization", "map_initialization"),
    ("DeliveryInterruptedWorkflowRecord", "Review", "map_delivery_interrupted_review"),
    ("DeliveryWorkflowRecord", "Treating", "map_delivery_treating"),
    ("DeliveryResumedWorkflowRecord", "Treating", "map_delivery_treating"),
    ("ReviewWorkflowRecord", "Post-treatment scans & Device removal", "map_review_post_treatment"),
    ("DevicesRemovalStarts", "Post-treatment scans & Device removal", "map_devices_removal"),
    ("DevicesRemovalEnds", "Post-treatment scans & Device removal", "map_devices_removal"),
    ("PatientTransferBegins", "Patient recovery & transfer", "map_patient_transfer"),
    ("PatientTransferEnds", "Patient recovery & transfer", "map_patient_transfer"),
)
SCRIPT_ONLY_TRANSITIONS = (("TreatmentRecord", "Treating", "map_delivery_treating"),)

CRITICAL_TYPES = (
    "AnesthesiaStart", "Ready4Urology", "DeviceInsertionBegins", "DeviceInsertionEnds",
    "InitialImaging", "PatientTransferBegins", "PatientTransferEnds",
)
SPARSE_TYPES = ("FPumpRecord", "PSConnectionRecord", "UATestRecord", "Ready4Urology")
SPARSE_RULES = ("carry_forward_previous_state", "map_uatest_pre_positioning", "map_anesthesia_or_urology_ready")

SESSION_FIELDS = (
    ("TimePatientSedatedAt", "Ready4Urology"),
    ("TimeUaInsertedAt", "DeviceInsertionEnds"),
    ("TimePatientTransferredAt", "PatientTransferEnds"),
    ("TimeUaRemovedAt", None),
)
TIMING_LABELS = (
    ("Anesthesia Team starts to prepapre the patient ", "AnesthesiaStart", "start"),
    ("Anesthesia Team starts to prepare the patient ", "AnesthesiaStart", "start"),
    ("Patient is ready for Urology team", "Ready4Urology", "end"),
    ("Devices Insertion", "DeviceInsertionBegins", "start"),
    ("Devices Insertion", "DeviceInsertionEnds", "end"),
    ("Patient Transfer from MRI Bed to Recovery room", "PatientTransferBegins", "start"),
    ("Patient Transfer from MRI Bed to Recovery room", "PatientTransferEnds", "end"),
    ("Initial Device Imaging (From first until last survey)", "InitialImaging", "start"),
)
DIAGNOSTIC_FLAGS = (
    "interval_truncated_large_gap",
    "interval_terminal_state_clamped",
    "interval_early_state_truncated",
    "interval_unassigned_state_truncated",
    "negative_rebased_start",
)
INSERTION_STATES = ("Device insertion", "Device repositioning")
REMOVAL_STATE = "Post-treatment scans & Device removal"
MRI_STATES = (
    "Patient positioning & induction", "Device insertion", "Device repositioning", "Alignment", "Coarse", "Detailed",
    "Planning start angle", "Initialization", "Treating", "Paused", "Review", "Post-treatment scans & Device removal",
    "Patient recovery & transfer",
)
IN_ROOM_STATES = (
    "Patient positioning & induction", "Device insertion", "Device repositioning", "Alignment", "Coarse", "Detailed",
    "Planning start angle", "Initialization", "Treating", "Paused", "Review", "Post-treatment scans & Device removal",
)
PHASE_GROUPS = {
    "code5X008_intra": (
        "Device insertion", "Device repositioning", "Alignment", "Coarse", "Detailed", "Planning start angle",
        "Initialization", "Treating", "Paused", "Review", "Post-treatment scans & Device removal",
    ),
    "code5X006_intra": ("Device insertion", "Device repositioning", "Post-treatment scans & Device removal"),
    "code5X007_intra": (
        "Device repositioning", "Alignment", "Coarse", "Detailed", "Planning start angle", "Initialization", "Treating",
        "Paused", "Review", "Post-treatment scans & Device removal",
    ),
}
# ---- end of fixed values ------------------------------------------------------------------------

STATE_NAMES = tuple(name for name, _ in STATES)
PLOT_STATES = tuple(s for s in STATE_NAMES if s != "NA")


def quoted(text: str | None) -> str:
    """SQL string literal."""
    return "NULL" if text is None else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(items) -> Column:
    """Constant array of strings as one expression."""
    return F.expr("array(" + ", ".join(quoted(i) for i in items) + ")")


@dataclass(frozen=True)
class Workflow:
    """Parameters of the state machine and of the interval rules."""

    transitions: tuple = TRANSITIONS
    noise_type: str = "SignalRecord"
    positioning_state: str = "Patient positioning & induction"
    ready_state: str = "Room ready"
    paused_state: str = "Paused"
    removal_state: str = REMOVAL_STATE
    unassigned: tuple = ("", "NA", "<NA>")
    terminal_states: tuple = ("Patient recovery & transfer", REMOVAL_STATE)
    early_states: tuple = ("Room ready", "TULSA QA", "Patient positioning & induction")
    sparse_types: tuple = SPARSE_TYPES
    sparse_rules: tuple = SPARSE_RULES
    large_gap_sec: int = 7200
    negative_start_warn_sec: int = 21600
    # Script profile: transition seen before clears count as positioning; duplicates are removed
    # instead of cleared; any 10-character prefix with a dash somewhere counts as a segment date.
    seen_before_clears: bool = False
    drop_duplicate_alignment: bool = False
    loose_segment_date: bool = False
    phase_groups: dict = field(default_factory=lambda: dict(PHASE_GROUPS), hash=False)

    def state_of(self, event_type: Column) -> Column:
        return self._lookup(event_type, 1)

    def rule_of(self, event_type: Column) -> Column:
        return self._lookup(event_type, 2)

    def _lookup(self, event_type: Column, at: int) -> Column:
        pairs = ", ".join(f"{quoted(row[0])}, {quoted(row[at])}" for row in self.transitions)
        return F.try_element_at(F.expr(f"map({pairs})"), event_type)


DEFAULT = Workflow()
SCRIPT = replace(
    DEFAULT,
    transitions=TRANSITIONS + SCRIPT_ONLY_TRANSITIONS,
    seen_before_clears=True,
    drop_duplicate_alignment=True,
    loose_segment_date=True,
)


def state_dimension(spark: SparkSession) -> DataFrame:
    """state, ordinal (1-based), color — 16 rows, always safe to broadcast."""
    rows = ", ".join(f"({quoted(s)}, {i}, {quoted(c)})" for i, (s, c) in enumerate(STATES, start=1))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(state, ordinal, color)")


def timing_label_dimension(spark: SparkSession) -> DataFrame:
    rows = ", ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in TIMING_LABELS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(label, event_type, selector)")


def tie_rank() -> Column:
    """Order of events of one instant as a single number: log rows by number, then sessions, then timing sheets."""
    return F.expr(
        "(IF(is_synthetic, 4000000000000, 0) + coalesce(row_number, 1000000000000)) * 100"
        " + CASE source WHEN 'auditlog' THEN 0 WHEN 'sessions' THEN 1 WHEN 'timing_log' THEN 2 ELSE 99 END"
    )


def event_order() -> list[Column]:
    """Total order of the events of a case, over plain columns only.

    Ordering by expressions would give every window operator its own copy of them, and with it a
    sort of its own; plain columns let all ordered steps share one sort.
    """
    return [F.col("ts_us"), F.col("tie_rank"), F.col("event_type"), F.col("source_detail"), F.col("source_row")]


def as_warnings(df: DataFrame, category: str | Column, row_number: Column, detail: Column) -> DataFrame:
    """Long warning rows: keys, category, row_number, detail."""
    return df.select(
        *KEYS, (F.lit(category) if isinstance(category, str) else category).alias("category"),
        row_number.cast("bigint").alias("row_number"), detail.cast("string").alias("detail"),
    )
