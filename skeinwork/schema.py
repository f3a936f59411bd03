"""Schemas of trajectory records, environment configs and checkpoints, and the column sets that rules refer to."""

from __future__ import annotations

from pyspark.sql import types as T

BUCKETS = 128


def _struct(text: str) -> T.StructType:
    out = T.StructType()
    for part in (x.strip() for x in text.split(",")):
        name, kind = part.split()
        out.add(name, T._parse_datatype_string(kind.rstrip("!")) if "<" in kind else _KINDS[kind.rstrip("!")], not kind.endswith("!"))
    return out


_KINDS = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "float": T.FloatType(), "boolean": T.BooleanType(), "strings": T.ArrayType(T.StringType(), True)}

#: Landing (raw) and serving (published) records share one schema of 28 columns.
RECORD = _struct(
    "dataset_type string!, dt string!, id string!, session_id string, created_at long!, source_updated_at long!, serving_updated_at long, "
    "step_id int, is_terminal boolean, env_id string, job_id string, is_truncated boolean, step_reward float, reward float, "
    "messages string, response string, chosen_trace string, rejected_trace string, ground_truth_answer string, reference_answer string, "
    "search_text string, agent_model string, env_name string, is_session_completed boolean, is_trainable boolean, meta_json string, "
    "tags strings, blob_manifest strings"
)
ENV_CONFIG = _struct("id long!, env_id string!, job_id string!, group_id string, finished boolean!, env_name string!, env_params string, image string, created_at long!")
CHECKPOINT = _struct(
    "id string!, pipeline_name string!, pipeline_version string!, source_table string!, target_table string!, bucket int!, committed_until_ms long!, "
    "last_run_id string, active_window_start_ms long, active_window_end_ms long, last_processed_id string, status string!, updated_at_ms long!"
)

#: Columns that hold JSON text; a malformed value stays what it is.
JSON_COLUMNS = ("messages", "response", "chosen_trace", "rejected_trace", "meta_json")
#: Columns that no patch or update may set.
PROTECTED = ("id", "created_at", "job_id", "source_updated_at", "serving_updated_at")
#: Columns of an identity that a pipeline stage may not own.
IMMUTABLE = (*PROTECTED, "session_id", "step_id", "dataset_type", "dt")
REQUIRED = tuple(f.name for f in RECORD if not f.nullable)

#: Indexed columns and their kinds, kept as layout hints: sort and bloom filters for the first, statistics for the rest.
LANDING_INDEXES = {"id": "BTREE", "session_id": "BTREE", "created_at": "BTREE", "source_updated_at": "BTREE", "job_id": "BTREE", "dataset_type": "BITMAP", "dt": "BITMAP", "is_session_completed": "BITMAP"}
