"""recoflow: news-recommendation data jobs on Spark.

Main entry points (all take and return DataFrames; ``as_of`` is explicit):

* ETL: ``build_interactions``, ``build_items``, ``promote_attributes``
* serving: ``recommend_batch``, ``reply_assembly``, ``coverage_metrics``
* scoring: ``similar_items``, ``user_personalization``, ``personalized_ranking``
* streams: ``event_batch_writer``, ``content_batch_writer``, ``run_stream``
* monitoring: ``metric_rollup``, ``alarm_rule``, ``stream_lag``

Command-line runners live in ``recoflow.jobs``; the per-operator registry
used by the correctness check lives in ``recoflow.registry``.
"""

from recoflow.operators.scoring import personalized_ranking, similar_items, user_personalization
from recoflow.plans.etl import build_interactions, build_items, promote_attributes
from recoflow.plans.monitoring import alarm_rule, metric_rollup, stream_lag
from recoflow.plans.recommend import coverage_metrics, recommend_batch, reply_assembly
from recoflow.streaming.ingest import content_batch_writer, event_batch_writer, run_stream

__all__ = [
    "alarm_rule", "build_interactions", "build_items", "content_batch_writer", "coverage_metrics",
    "event_batch_writer", "metric_rollup", "personalized_ranking", "promote_attributes",
    "recommend_batch", "reply_assembly", "run_stream", "similar_items", "stream_lag",
    "user_personalization",
]
