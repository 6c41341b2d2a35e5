"""Persisted runs and streaming chains."""

from tidemark.streaming.change_capture import ChangeStore, SweepSpec, run_once, sweep_from_config
from tidemark.streaming.medallion import SilverSink, SilverSpec, ingest_bronze, ingest_staging, run_silver
from tidemark.streaming.scd_stream import ScdSink, scd2_stream

__all__ = ["ChangeStore", "SweepSpec", "run_once", "sweep_from_config", "SilverSink", "SilverSpec",
           "ingest_bronze", "ingest_staging", "run_silver", "ScdSink", "scd2_stream"]
