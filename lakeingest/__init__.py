"""Configuration-driven landing -> bronze ingestion on Spark Structured Streaming,
plus silver/gold operators over bronze tables.

    from lakeingest import EngineSpec, load_dataset_specs, run_ingestion

    engine = EngineSpec.load("configs/engine.json")
    datasets = load_dataset_specs("configs/datasets")
    run_ingestion(spark, engine, datasets)

The spec layer needs no PySpark; the engine is imported on first use.
"""

from .spec import DatasetSpec, EngineSpec, KafkaSpec, SpecError, load_dataset_specs

__all__ = ["DatasetSpec", "EngineSpec", "KafkaSpec", "SpecError", "load_dataset_specs",
           "IngestResult", "run_ingestion"]

__version__ = "0.1.0"


def __getattr__(name):
    if name == "run_ingestion":
        from .streaming.runner import run_ingestion
        return run_ingestion
    if name == "IngestResult":
        from .streaming.audit import IngestResult
        return IngestResult
    raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
