"""Design measurements at one scale: band join naive vs binned, sensor
statistics by window vs by aggregate + broadcast join, end-to-end Gold.

Usage: python tools/measure.py [sf_dir] [cpus]  -> one JSON line
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from verdant.operators.bandjoin import band_join, band_join_naive  # noqa: E402
from verdant.operators.climate import build_gold  # noqa: E402
from verdant.operators.quality import classify_anomalies, with_sensor_stats  # noqa: E402
from verdant.session import build_session  # noqa: E402
from verdant.sources.fixture import load_readings  # noqa: E402


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return round(time.perf_counter() - t0, 3), out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = sys.argv[2] if len(sys.argv) > 2 else "8"
    spark = build_session(f"local[{cpus}]", app="verdant-measure")
    r = load_readings(spark, sf_dir)
    c = classify_anomalies(r).where(~F.col("is_anomaly")).checkpoint(eager=True)
    t = c.where("sensor_type = 'temperature'").select("facility_id", F.col("event_id").alias("tid"),
                                                      F.col("event_ts").alias("tts"))
    h = c.where("sensor_type = 'humidity'").select("facility_id", F.col("event_id").alias("hid"),
                                                   F.col("event_ts").alias("hts"))
    res = {"sf_dir": sf_dir, "cpus": int(cpus)}
    band_join(t, h, ["facility_id"], "tts", "hts", 60).count()        # warm-up
    res["band_join_binned_s"], n1 = timed(lambda: band_join(t, h, ["facility_id"], "tts", "hts", 60).count())
    res["band_join_naive_s"], n2 = timed(lambda: band_join_naive(t, h, ["facility_id"], "tts", "hts", 60).count())
    res["band_join_pairs"] = [n1, n2]
    w = Window.partitionBy("facility_id", "sensor_id")
    by_window = r.select("event_id", F.avg("value").over(w).alias("m"), F.stddev_samp("value").over(w).alias("s"))
    res["sensor_stats_window_s"], _ = timed(lambda: by_window.write.format("noop").mode("overwrite").save())
    res["sensor_stats_join_s"], _ = timed(
        lambda: with_sensor_stats(r).select("event_id", "sensor_mean", "sensor_stddev")
        .write.format("noop").mode("overwrite").save())
    res["gold_end_to_end_s"], _ = timed(
        lambda: build_gold(classify_anomalies(load_readings(spark, sf_dir))).write.format("noop")
        .mode("overwrite").save())
    print(json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main()
