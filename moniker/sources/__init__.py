"""Reading recognised mentions and dictionaries, and publishing dictionaries."""

from moniker.sources.dictionaries import (
    build_dictionary,
    load_order,
    merge_union,
    union_dictionary,
    publish_dictionary,
    read_entity_json,
)
from moniker.sources.manifest import assign_batches, file_manifest, misnamed_files, part_id, pending_files
from moniker.sources.ner import (
    MENTION_SCHEMA,
    NER_SCHEMA,
    cem_mentions,
    count_ingest,
    quarantined,
    read_mentions,
    read_ner,
    write_mentions,
)
from moniker.sources.drift import schema_drift, seen_fields
from moniker.sources.scratch import materialise, packed, scratch_job, scratch_path, settle, store
from moniker.sources.upkeep import start_dictionary, update_dictionary

__all__ = [
    "MENTION_SCHEMA",
    "NER_SCHEMA",
    "assign_batches",
    "build_dictionary",
    "cem_mentions",
    "count_ingest",
    "file_manifest",
    "load_order",
    "materialise",
    "misnamed_files",
    "packed",
    "merge_union",
    "union_dictionary",
    "part_id",
    "pending_files",
    "publish_dictionary",
    "quarantined",
    "read_entity_json",
    "read_mentions",
    "read_ner",
    "schema_drift",
    "scratch_job",
    "scratch_path",
    "seen_fields",
    "settle",
    "start_dictionary",
    "store",
    "update_dictionary",
    "write_mentions",
]
