"""Dataset profiles: which columns a table must have and what its label means."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from oddrow.errors import ConfigurationError


@dataclass(frozen=True)
class Profile:
    """Names, types and label rules of one kind of table.

    ``key`` names identifying columns outside the required ones; it may be empty.
    ``sources`` maps a column to the SQL expression that yields it, for tables
    whose features are not plain columns.
    """

    name: str
    label: str
    normal: str | int
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    label_map: Mapping[str | int, int]
    key: tuple[str, ...] = ()
    sources: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        columns = self.required
        repeated = sorted({c for c in columns if columns.count(c) > 1})
        if repeated:
            raise ConfigurationError(f"profile '{self.name}' repeats columns: {repeated}")
        if not self.features:
            raise ConfigurationError(f"profile '{self.name}' has no feature columns")
        if self.label_map.get(self.normal) != 0:
            raise ConfigurationError(f"profile '{self.name}' must map its normal label to 0")
        if not set(self.label_map.values()) <= {0, 1}:
            raise ConfigurationError(f"profile '{self.name}' has a label map beyond 0 and 1")

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.numeric

    @property
    def feature_count(self) -> int:
        return len(self.features)

    @property
    def required(self) -> tuple[str, ...]:
        return self.categorical + self.numeric + (self.label,)

    @property
    def label_type(self) -> T.DataType:
        return T.IntegerType() if isinstance(self.normal, int) else T.StringType()

    def column_type(self, column: str) -> T.DataType:
        if column == self.label:
            return self.label_type
        return T.DoubleType() if column in self.numeric else T.StringType()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, self.column_type(c)) for c in self.required])


# The column and label names that tables of these profiles must have. They follow
# the public intrusion-detection datasets, but for the last three numeric names of CICIDS2017 and
# the last four of UNSW_NB15, which are part of the contract only.
NSL_KDD_CATEGORICAL = ("protocol_type", "service", "flag")
NSL_KDD_NUMERIC = (
    "duration", "src_bytes", "dst_bytes", "land", "wrong_fragment", "urgent", "hot",
    "num_failed_logins", "logged_in", "num_compromised", "root_shell", "su_attempted",
    "num_root", "num_file_creations", "num_shells", "num_access_files", "num_outbound_cmds",
    "is_host_login", "is_guest_login", "count", "srv_count", "serror_rate", "srv_serror_rate",
    "rerror_rate", "srv_rerror_rate", "same_srv_rate", "diff_srv_rate", "srv_diff_host_rate",
    "dst_host_count", "dst_host_srv_count", "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate", "dst_host_serror_rate",
    "dst_host_srv_serror_rate", "dst_host_rerror_rate", "dst_host_srv_rerror_rate",
)
NSL_KDD_ATTACKS = (
    "neptune", "smurf", "back", "teardrop", "pod", "land",
    "ipsweep", "portsweep", "satan", "mscan", "saint",
    "warezclient", "guess_passwd", "warezmaster", "imap", "ftp_write", "multihop", "phf", "spy",
    "sendmail", "named", "snmpgetattack", "snmpguess", "xlock", "xsnoop", "worm",
    "rootkit", "buffer_overflow", "loadmodule", "perl", "xterm", "ps", "sqlattack",
    "httptunnel", "processtable", "udpstorm", "apache2",
    "dos", "probe", "r2l", "u2r",
)
CICIDS2017_NUMERIC = (
    "Flow Duration", "Total Fwd Packets", "Total Backward Packets",
    "Total Length of Fwd Packets", "Total Length of Bwd Packets",
    "Fwd Packet Length Max", "Fwd Packet Length Min", "Fwd Packet Length Mean",
    "Fwd Packet Length Std", "Bwd Packet Length Max", "Bwd Packet Length Min",
    "Bwd Packet Length Mean", "Bwd Packet Length Std", "Flow Bytes/s", "Flow Packets/s",
    "Flow IAT Mean", "Flow IAT Std", "Flow IAT Max", "Flow IAT Min",
    "Fwd IAT Total", "Fwd IAT Mean", "Fwd IAT Std", "Fwd IAT Max", "Fwd IAT Min",
    "Bwd IAT Total", "Bwd IAT Mean", "Bwd IAT Std", "Bwd IAT Max", "Bwd IAT Min",
    "Fwd PSH Flags", "Bwd PSH Flags", "Fwd URG Flags", "Bwd URG Flags",
    "Fwd Header Length", "Bwd Header Length", "Fwd Packets/s", "Bwd Packets/s",
    "Min Packet Length", "Max Packet Length", "Packet Length Mean", "Packet Length Std",
    "Packet Length Variance", "FIN Flag Count", "SYN Flag Count", "RST Flag Count",
    "PSH Flag Count", "ACK Flag Count", "URG Flag Count", "CWE Flag Count", "ECE Flag Count",
    "Down/Up Ratio", "Average Packet Size", "Avg Fwd Segment Size", "Avg Bwd Segment Size",
    "Fwd Header Length.1", "Fwd Avg Bytes/Bulk", "Fwd Avg Packets/Bulk", "Fwd Avg Bulk Rate",
    "Bwd Avg Bytes/Bulk", "Bwd Avg Packets/Bulk", "Bwd Avg Bulk Rate",
    "Subflow Fwd Packets", "Subflow Fwd Bytes", "Subflow Bwd Packets", "Subflow Bwd Bytes",
    "Init_Win_bytes_forward", "Init_Win_bytes_backward", "act_data_pkt_fwd",
    "min_seg_size_forward", "Active Mean", "Active Std", "Active Max", "Active Min",
    "Idle Mean", "Idle Std", "Idle Max", "Idle Min",
    "Fwd Bytes/Bulk Avg", "Fwd Packet/Bulk Avg", "Fwd Bulk Rate Avg",
)
UNSW_NB15_CATEGORICAL = ("proto", "service", "state")
UNSW_NB15_NUMERIC = (
    "sport", "dport", "dur", "Stime", "Ltime", "spkts", "dpkts", "sbytes", "dbytes",
    "sttl", "dttl", "sloss", "dloss", "Sload", "Dload", "swin", "dwin", "stcpb", "dtcpb",
    "smeansz", "dmeansz", "trans_depth", "res_bdy_len", "Sjit", "Djit", "Sintpkt", "Dintpkt",
    "tcprtt", "synack", "ackdat", "is_sm_ips_ports", "ct_state_ttl", "ct_flw_http_mthd",
    "is_ftp_login", "ct_ftp_cmd", "ct_srv_src", "ct_srv_dst", "ct_dst_ltm", "ct_src_ltm",
    "ct_src_dport_ltm", "ct_dst_sport_ltm", "ct_dst_src_ltm", "ct_src_ltm2",
    "ct_dst_src_ltm2", "ct_srv_dst2", "ct_dst_ltm2",
)

NSL_KDD = Profile(
    name="nsl_kdd",
    label="label",
    normal="normal",
    categorical=NSL_KDD_CATEGORICAL,
    numeric=NSL_KDD_NUMERIC,
    label_map={"normal": 0, **dict.fromkeys(NSL_KDD_ATTACKS, 1)},
)
CICIDS2017 = Profile(
    name="cicids2017",
    label="Label",
    normal="BENIGN",
    categorical=(),
    numeric=CICIDS2017_NUMERIC,
    label_map={"BENIGN": 0},
)
UNSW_NB15 = Profile(
    name="unsw_nb15",
    label="label",
    normal=0,
    categorical=UNSW_NB15_CATEGORICAL,
    numeric=UNSW_NB15_NUMERIC,
    label_map={0: 0, 1: 1},
)

# The raw distribution file has no header: features in this order, label, difficulty.
NSL_KDD_RAW_HEADER = (
    NSL_KDD_NUMERIC[:1] + NSL_KDD_CATEGORICAL + NSL_KDD_NUMERIC[1:] + ("label", "difficulty")
)

# Profiles over the TPC-H-like tables, one for each shape above.
LINEITEM = Profile(
    name="lineitem",
    label="l_returnflag",
    normal="N",
    categorical=("l_linestatus",),
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    label_map={"N": 0},
    key=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
)
EVENTS = Profile(
    name="events",
    label="event_type",
    normal="view",
    categorical=(),
    numeric=("value", "props_k", "hour"),
    label_map={"view": 0},
    key=("event_id",),
    sources={"props_k": "get_json_object(props, '$.k')", "hour": "hour(ts)"},
)
EMBEDDINGS = Profile(
    name="embeddings",
    label="label",
    normal=0,
    categorical=(),
    numeric=tuple(f"e{i}" for i in range(64)),
    label_map={0: 0},
    key=("vec_id",),
    sources={f"e{i}": f"embedding[{i}]" for i in range(64)},
)

_REGISTRY: dict[str, Profile] = {
    p.name: p for p in (NSL_KDD, CICIDS2017, UNSW_NB15, LINEITEM, EVENTS, EMBEDDINGS)
}


def get_profile(name: str) -> Profile:
    """Look a profile up by name."""
    if name not in _REGISTRY:
        raise ConfigurationError(
            f"dataset.schema has invalid value '{name}'; known profiles: {sorted(_REGISTRY)}"
        )
    return _REGISTRY[name]


def register_profile(profile: Profile) -> Profile:
    """Make a profile available to :func:`get_profile` and to job parameters."""
    if _REGISTRY.get(profile.name, profile) != profile:
        raise ConfigurationError(f"another profile is already named '{profile.name}'")
    _REGISTRY[profile.name] = profile
    return profile


def profile_names() -> list[str]:
    return sorted(_REGISTRY)
