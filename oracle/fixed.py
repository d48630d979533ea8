"""The SQL's own copy of the fixed values: nothing here comes from the package that the SQL checks."""

# Fixed values.
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
SCRIPT_ONLY_TRANSITIONS = (
    ("TreatmentRecord", "Treating", "map_delivery_treating"),
)
CRITICAL_TYPES = (
    "AnesthesiaStart", "Ready4Urology", "DeviceInsertionBegins", "DeviceInsertionEnds", "InitialImaging",
    "PatientTransferBegins", "PatientTransferEnds",
)
SPARSE_TYPES = (
    "FPumpRecord", "PSConnectionRecord", "UATestRecord", "Ready4Urology",
)
SPARSE_RULES = (
    "carry_forward_previous_state", "map_uatest_pre_positioning", "map_anesthesia_or_urology_ready",
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
MRI_STATES = (
    "Patient positioning & induction", "Device insertion", "Device repositioning", "Alignment", "Coarse", "Detailed",
    "Planning start angle", "Initialization", "Treating", "Paused", "Review", "Post-treatment scans & Device removal",
    "Patient recovery & transfer",
)
PHASE_GROUPS = {
    "code5X008_intra": (
        "Device insertion", "Device repositioning", "Alignment", "Coarse", "Detailed", "Planning start angle",
        "Initialization", "Treating", "Paused", "Review", "Post-treatment scans & Device removal",
    ),
    "code5X006_intra": (
        "Device insertion", "Device repositioning", "Post-treatment scans & Device removal",
    ),
    "code5X007_intra": (
        "Device repositioning", "Alignment", "Coarse", "Detailed", "Planning start angle", "Initialization", "Treating",
        "Paused", "Review", "Post-treatment scans & Device removal",
    ),
}
# Event types, sheet labels and files of the binding.
TYPES = (
    "SetupWorkflowRecord", "SetupUnlockWorkflowRecord", "AnesthesiaStart", "Ready4Urology", "DeviceInsertionBegins",
    "DeviceInsertionEnds", "InitialImaging", "AlignmentWorkflowRecord", "CoarseWorkflowRecord", "CoarseUnlockWorkflowRecord",
    "DetailedWorkflowRecord", "PlanReadyWorkflowRecord", "PlanReadyCompleteWorkflowRecord",
    "PlanReadyUserStoppedInitializationWorkflowRecord", "DeliveryInitializingWorkflowRecord", "DeliveryWorkflowRecord",
    "DeliveryResumedWorkflowRecord", "DeliveryPausedWorkflowRecord", "DeliveryInterruptedWorkflowRecord",
    "ReviewWorkflowRecord", "DevicesRemovalStarts", "DevicesRemovalEnds", "PatientTransferBegins", "PatientTransferEnds",
    "TreatmentRecord", "UATestRecord", "PSTestRecord", "PSHomingRecord", "MriConnectionRecord", "SessionEventRecord",
    "SegmentEventRecord", "SignalRecord", "SignalRecord", "FPumpRecord", "PSConnectionRecord", "UnknownWorkflowRecord",
    "CoarseWorkflowRecord", "PSHomingRecord", "UATestRecord", "AlignmentWorkflowRecord",
)
LABELS = (
    "Anesthesia Team starts to prepare the patient ", "Patient is ready for Urology team", "Devices Insertion",
    "Patient Transfer from MRI Bed to Recovery room", "Initial Device Imaging (From first until last survey)",
    "Device Removal",
)
FILES = (
    ("local.db",),
    ("_s1/local.db",),
    ("a/_x/local.db", "b/_x/local.db"),
    ("Session1.zip",),
    ("TDC Sessions/_s.zip", "local.db"),
    ("notes.txt",),
)
STATE_NAMES = tuple(name for name, _ in STATES)
PLOT_STATES = STATE_NAMES[:-1]
