"""End-to-end plans (train/predict, tuning, run analysis) and the registry of
checkable queries used by ``__spark_entry__``."""
