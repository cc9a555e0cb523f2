"""DataFrame -> DataFrame operators (usable with ``DataFrame.transform``)."""

from verdant.operators.bandjoin import band_join, band_join_naive
from verdant.operators.climate import (build_gold, climate_by_window, climate_score, crop_score,
                                       overall_anomaly_rate, pivot_climate, vpd_by_window, vpd_pairs,
                                       zone_spread)
from verdant.operators.decode import decode_messages, flatten_payload, route_topics, type_readings
from verdant.operators.joins import join_small
from verdant.operators.quality import (classify_anomalies, facility_aggregate, peer_outliers,
                                       sensor_stats, with_sensor_stats)
from verdant.operators.serving import (climate_trends, current_anomalies, latest_by_key, live_gauges,
                                       live_latest, merge_upsert, threshold_band)

__all__ = [
    "band_join", "band_join_naive", "build_gold", "climate_by_window", "climate_score", "crop_score",
    "overall_anomaly_rate", "pivot_climate", "vpd_by_window", "vpd_pairs", "zone_spread", "decode_messages",
    "flatten_payload", "route_topics", "type_readings", "join_small", "classify_anomalies",
    "facility_aggregate", "peer_outliers", "sensor_stats", "with_sensor_stats", "climate_trends",
    "current_anomalies", "latest_by_key", "live_gauges", "live_latest", "merge_upsert",
    "threshold_band",
]
