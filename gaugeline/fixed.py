"""Names, lists, patterns and defaults that results depend on."""

# Node ids of the monitored device.
DEVICE_PATH = "PLC_S7_200_SMART.Compressor"
NODE_ID_PREFIX = "ns=2;s=PLC_S7_200_SMART.Compressor."

# The tags the device exposes, as the server spells them (three hold a space).
DEVICE_TAGS = (
    "Comp_Air_run_time",
    "Comp_Fan_Current_A",
    "Comp_Fan_Current_B",
    "Comp_Fan_Current_C",
    "Comp_Freq",
    "Comp_Grease_run_time",
    "Comp_Lube_run_time",
    "Comp_Motor_Current",
    "Comp_Motor_Current_ A",
    "Comp_Motor_Current_ B",
    "Comp_Motor_Current_ C",
    "Comp_Motor_Power",
    "Comp_Motor_Speed",
    "Comp_Motor_this_elec",
    "Comp_Motor_total_elec",
    "Comp_Motor_Voltage",
    "Comp_OA_run_time",
    "Comp_Oil_run_time",
    "Comp_Pf_fan_phase_UI",
    "Comp_Pf_fan_this_elec",
    "Comp_Pf_total_elec",
    "Comp_Pressure",
    "Comp_Supply_Voltage",
)

# The shorter default list of clean tags.
DEFAULT_CLEAN_TAGS = (
    "Comp_Pressure",
    "Comp_Motor_Power",
    "Comp_Motor_Speed",
    "Comp_Motor_Current_A",
    "Comp_Motor_Current_B",
    "Comp_Motor_Current_C",
    "Comp_Motor_Voltage",
    "Comp_Supply_Voltage",
    "Comp_Air_run_time",
    "Comp_Oil_run_time",
    "Comp_Grease_run_time",
)

# Browse names that mark server infrastructure.
INFRASTRUCTURE_KEYWORDS = (
    "Server",
    "Diagnostics",
    "Security",
    "AggregateFunctions",
    "Namespaces",
    "BacNet",
    "DNP3",
    "Redundancy",
)

# Browse names that mark method arguments and change counters.
METHOD_KEYWORDS = (
    "InputArguments",
    "OutputArguments",
    "LastChange",
)

# Message types on the wire.
TYPE_BAD_VALUE = "opcua_bad_value"
TYPE_SUBSCRIPTION_STATUS = "opcua_subscription_status"
TYPE_EVENT = "opcua_event"
TYPE_EVENT_SUBSCRIPTION_STATUS = "opcua_event_subscription_status"

# Topics.
TOPIC_VALUES = "OPCUA"
TOPIC_EVENTS = "OPCUA_EVENTS"

# Hierarchy defaults and partition order.
DEFAULT_SITE = "Site_name"
DEFAULT_LINE = "Line-1"
DEFAULT_EQUIPMENT = "Compressor"
HIERARCHY = ("Enterprise", "Site", "ProductionLine", "Equipment", "Tag")

# Time columns in order of preference, compared without case.
TIME_COLUMNS = ("eventtime", "timestamp", "time", "ts")

# Limits, delays and triggers.
MAX_FUTURE_SECONDS = 600
WATERMARK_DELAY = "10 minutes"
TRIGGER_INTERVAL = "20 seconds"
TRIGGER_INTERVAL_SHORT = "10 seconds"
MAX_OFFSETS_PER_TRIGGER = 100_000
MAX_OFFSETS_PER_TRIGGER_LARGE = 200_000
LATEST_LIMIT = 10
RANGE_LIMIT = 5000
FILTER_LIMIT = 100
PATH_LIMIT = 100
PATH_LIMIT_MAX = 1000
DUMP_LIMIT = 10_000
PROBE_LIMIT = 25
SAMPLES_PER_TAG = 5
MAX_BROWSE_DEPTH = 10
