"""Sinks (K1-K5): topics, bulk document upsert, raw archive, ranked batches."""

from clickflow.sinks.store import Store
from clickflow.sinks.writers import (
    archive_logs, compact, docs_store, init_user_state, latest_ranks, path_exists, ranked_batches,
    read_user_state, replay_file_to_topic, rerank_windows, stored_before, touched_buckets,
    update_user_state, upsert_docs, user_state_store, write_batch, write_topic,
)

__all__ = ["Store", "archive_logs", "compact", "docs_store", "init_user_state", "latest_ranks", "path_exists",
           "ranked_batches", "read_user_state", "replay_file_to_topic", "rerank_windows",
           "stored_before", "touched_buckets", "update_user_state", "upsert_docs", "user_state_store",
           "write_batch",
           "write_topic"]
