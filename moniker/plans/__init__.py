"""The linking job: chain of lookups, routing and publication."""

from moniker.plans.batches import batch_documents, link_batches, write_batches
from moniker.plans.cascade import (
    Discard,
    Lookup,
    answered_words,
    distinct_words,
    extend_resolution,
    resolve_words,
    standard_chain,
    tag_mentions,
)
from moniker.plans.job import Output, link_documents
from moniker.plans.publish import compact, publish_documents, write_bucketed
from moniker.plans.routing import keep_resolved, resolved_only, route_entity, route_substance
from moniker.plans.versions import compact_table, current_version, drop_versions, publish_version

__all__ = [
    "Discard",
    "Lookup",
    "Output",
    "answered_words",
    "batch_documents",
    "compact",
    "compact_table",
    "current_version",
    "distinct_words",
    "drop_versions",
    "extend_resolution",
    "keep_resolved",
    "link_batches",
    "link_documents",
    "publish_documents",
    "publish_version",
    "resolve_words",
    "resolved_only",
    "route_entity",
    "route_substance",
    "standard_chain",
    "tag_mentions",
    "write_batches",
    "write_bucketed",
]
