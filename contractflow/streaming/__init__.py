"""Structured Streaming runs of the contract path and the nine event streams."""

from contractflow.streaming.contract_stream import batch_writer, provision_stats, start_contract_stream, tag_messages
from contractflow.streaming.domain_streams import domain_stream, run_on_kafka, start_domain_streams
from contractflow.streaming.duplicates import flag_duplicates, with_duplicate_rule

__all__ = [
    "batch_writer",
    "domain_stream",
    "flag_duplicates",
    "provision_stats",
    "run_on_kafka",
    "start_contract_stream",
    "start_domain_streams",
    "tag_messages",
    "with_duplicate_rule",
]
