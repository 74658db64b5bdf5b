"""Incidents load (G3) on a Parquet source: filter, stamp, replace, reconcile."""

import os

from snapflow.plans import incidents

from conftest import SF


def test_incidents_run(spark, tmp):
    events = spark.read.parquet(f"{SF}/events.parquet")
    out = os.path.join(tmp, "stage")
    m = incidents.run(spark, events, out, "error", [8, 9], "2024-06-26 04:00:00",
                      assignment_col="event_type", reference_col="user_id")
    exp = events.where("event_type = 'error' and user_id in (8, 9)").count()
    assert m == {"expected": exp, "loaded": exp}
    staged = spark.read.parquet(out)
    assert staged.select("Date_Ingested").distinct().count() <= 1
    # rerun replaces, never appends (K3)
    incidents.run(spark, events, out, "error", [8, 9], "2024-07-26 04:00:00",
                  assignment_col="event_type", reference_col="user_id")
    assert spark.read.parquet(out).count() == exp


def test_target_layout_is_enforced(spark, tmp):
    """K4: the stage has the target's 144 columns and types; a missing key or one too wide stops the load."""
    import pytest
    from pyspark.sql import functions as F
    from snapflow.plans import incidents
    assert len(incidents.TARGET.fields) == 144
    cols = [f.name for f in incidents.TARGET.fields if f.name != "Date_Ingested"]
    base = spark.range(3).select(*[F.lit(None).cast("string").alias(c) for c in cols if c not in ("IN_ID", "ASSIGNMENT", "OPEN_TIME")],
                                 F.concat(F.lit("IN"), F.col("id").cast("string")).alias("IN_ID"), F.lit("team").alias("ASSIGNMENT"),
                                 F.lit("2024-01-02 03:04:05").alias("OPEN_TIME"), F.lit("r").alias("ref"))
    kept = dict(assignment_col="ASSIGNMENT", reference_col="STATUS")
    rows = base.drop("ref").withColumn("STATUS", F.lit("open"))
    out = incidents.run(spark, rows, f"{tmp}/s", "team", ["open"], "2024-06-26 04:00:00", target=incidents.TARGET, **kept)
    stage = spark.read.parquet(f"{tmp}/s")
    assert out["loaded"] == 3 and [(f.name, f.dataType) for f in stage.schema.fields] == [(f.name, f.dataType) for f in incidents.TARGET.fields]
    for key in (F.lit(None).cast("string"), F.lit("longer than twelve")):
        with pytest.raises(Exception, match="NOT NULL|wider"):
            incidents.run(spark, rows.withColumn("IN_ID", key), f"{tmp}/s", "team", ["open"], "2024-06-26 04:00:00", target=incidents.TARGET, **kept)
