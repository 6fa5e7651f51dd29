"""

    from signals import api
    logs = api.read_logs(spark, "/landing/app/")
    parsed = api.normalize(api.parse_header(logs), {"type": "kv"}, input_col="body")
"""

from signals.functions.text import (  # noqa: F401  S1-S17
    base_name,
    decode_replace,
    iso_local,
    json_or_error,
    literal_split,
    preview_json,
    py_strip,
    safe_module_name,
    split_first,
    thousands,
)
from signals.operators.anomaly import explain, feature_stats, isolation_forest_fit, isolation_forest_score, reconstruction_score  # noqa: F401  F5-F7
from signals.operators.detect import Rule, brute_force_login, detect_rules, detect_syn_flood, detect_threshold, entity_features  # noqa: F401  F1-F4
from signals.operators.envelope import combine_envelopes, stamp  # noqa: F401  B1
from signals.operators.grep import grep, route, stream_routes, write_routes  # noqa: F401  F11-F12
from signals.operators.parse import (  # noqa: F401  C1-C6
    ParseRule,
    apply_schema,
    extract,
    kv_parse,
    kv_preview_json,
    normalize,
    parse_header,
    regex_parse,
    split_quarantine,
)
from signals.operators.response import assign_responses, first_responses, policy_table  # noqa: F401  F10
from signals.operators.risk import risk_scores, top_risks, weights_table  # noqa: F401  F8-F9
from signals.operators.schema import (  # noqa: F401  D1-D7
    train_schemas,
    append_history,
    catalog_from_inference,
    current_schema,
    history_rows,
    infer_schema,
    list_artifacts,
    revise_schema,
    schema_diff,
    schema_fit,
    schema_quality,
    training_history,
)
from signals.operators.sequence import arrival_sequence  # noqa: F401
from signals.operators.tail import latest_global, latest_per_source, latest_view, retain_latest  # noqa: F401  B2-B5
from signals.operators.tenancy import (  # noqa: F401  E1-E5
    all_healthy,
    entitled,
    eps_violations,
    grants_table,
    limits_table,
    source_status,
    tenants_table,
    valid_tenant,
)
from signals.sources.artifacts import read_schema_artifacts, schema_fields, write_schema_artifacts  # noqa: F401  A7-A8
from signals.sources.datagram import datagram_envelope  # noqa: F401  A4
from signals.sources.files import read_logs, stream_logs, with_byte_offset, write_lines  # noqa: F401  A1, A3
from signals.sources.jdbc import CollectorTarget, read_jdbc_target  # noqa: F401  A5
from signals.sources.ledger import get_offset, offset_ledger  # noqa: F401  A10
from signals.sources.metrics import read_training_metrics, write_training_metrics  # noqa: F401  A9
from signals.sources.tail_source import read_log_tail, register_tail_source, stream_log_tail  # noqa: F401  A2
from signals.sources.zones import read_zone, write_zone, zone_path  # noqa: F401  A6
from signals.streaming.listener import SourceStatusListener, late_rows  # noqa: F401  E1 feed
from signals.streaming.ring import stream_ring, stream_rings, stream_tail  # noqa: F401  B4 stream
from signals.streaming.ingest import ingest_stream, parsed_stream  # noqa: F401  main path on a stream

SURVEY_MAP = {
    "A1": ["read_logs", "stream_logs"],
    "A2": ["stream_log_tail", "read_log_tail"],
    "A3": ["with_byte_offset"],
    "A4": ["datagram_envelope"],
    "A5": ["read_jdbc_target"],
    "A6": ["write_zone", "read_zone", "zone_path"],
    "A7": ["read_schema_artifacts", "schema_fields"],
    "A8": ["write_schema_artifacts"],
    "A9": ["read_training_metrics", "write_training_metrics"],
    "A10": ["offset_ledger", "get_offset"],
    "B1": ["stamp"],
    "B2": ["latest_global"],
    "B3": ["latest_per_source"],
    "B4": ["retain_latest", "stream_rings", "stream_tail"],
    "B5": ["latest_view"],
    "C1": ["kv_parse", "extract"],
    "C2": ["kv_parse", "kv_preview_json"],
    "C3": ["regex_parse"],
    "C4": ["normalize", "split_quarantine"],
    "C5": ["parse_header"],
    "C6": ["apply_schema"],
    "D1": ["infer_schema"],
    "D2": ["schema_quality", "schema_fit"],
    "D3": ["history_rows", "append_history", "train_schemas"],
    "D4": ["training_history"],
    "D5": ["list_artifacts"],
    "D6": ["revise_schema", "current_schema"],
    "D7": ["schema_diff"],
    "E1": ["source_status", "SourceStatusListener"],
    "E2": ["all_healthy"],
    "E3": ["entitled"],
    "E4": ["valid_tenant"],
    "E5": ["eps_violations"],
    "F1": ["detect_rules"],
    "F2": ["detect_threshold", "brute_force_login"],
    "F3": ["detect_syn_flood"],
    "F4": ["entity_features"],
    "F5": ["isolation_forest_fit", "isolation_forest_score"],
    "F6": ["reconstruction_score"],
    "F7": ["explain", "feature_stats"],
    "F8": ["risk_scores"],
    "F9": ["top_risks"],
    "F10": ["assign_responses", "first_responses"],
    "F11": ["grep"],
    "F12": ["route", "write_routes", "stream_routes"],
    "S1": ["literal_split"], "S2": ["kv_parse"], "S3": ["split_first"], "S4": ["py_strip"], "S5": ["read_logs"],
    "S6": ["decode_replace"], "S7": ["regex_parse"], "S8": ["entitled"], "S9": ["safe_module_name"],
    "S10": ["base_name"], "S11": ["write_schema_artifacts"], "S12": ["iso_local"], "S13": ["schema_quality"],
    "S14": ["read_schema_artifacts"], "S15": ["json_or_error"], "S16": ["preview_json"], "S17": ["thousands"],
}
