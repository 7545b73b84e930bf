"""Match analytics on Spark: DataFrame functions over match, ranking, veto and telemetry tables."""
