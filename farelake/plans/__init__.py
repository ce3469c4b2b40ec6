"""Jobs that read, transform and write, and chains of them."""

from farelake.plans.chains import (
    finish_batch,
    follow_topic,
    run_batch,
    run_batch_all,
    run_evaluation,
    run_topic_batch,
    start_batch,
)
from farelake.plans.compact import compact_silver, small_months
from farelake.plans.jobs import (
    GoldStatus,
    SilverBuild,
    build_gold,
    build_silver,
    evaluate_gold,
    ingest_bronze,
    ingest_bronze_counted,
    ingest_bronze_months,
    ingest_messages,
    ingest_topic,
    load_zone_lookup,
    merge_messages,
    new_run,
    pickup_months,
    publish_gold,
    publish_topic,
    record_counts,
    score_bronze,
    score_silver,
)
from farelake.plans.ledger import Ledger
from farelake.plans.states import build_states, merge_states, run_states, write_state

__all__ = [
    "GoldStatus",
    "Ledger",
    "SilverBuild",
    "build_gold",
    "build_silver",
    "build_states",
    "compact_silver",
    "evaluate_gold",
    "finish_batch",
    "follow_topic",
    "ingest_bronze",
    "ingest_bronze_counted",
    "ingest_bronze_months",
    "ingest_messages",
    "ingest_topic",
    "load_zone_lookup",
    "merge_messages",
    "merge_states",
    "new_run",
    "pickup_months",
    "publish_gold",
    "publish_topic",
    "record_counts",
    "run_batch",
    "run_batch_all",
    "run_evaluation",
    "run_states",
    "run_topic_batch",
    "score_bronze",
    "score_silver",
    "small_months",
    "start_batch",
    "write_state",
]
