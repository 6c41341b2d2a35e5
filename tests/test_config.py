import pytest

from tidemark.operators.rolling import RollingSpec
from tidemark.sources.files import FileSource
from tidemark.streaming.change_capture import sweep_from_config
from tidemark.streaming.medallion import SilverSpec

ROLLING = {
    "source_table": "loan_details",
    "federated_source": {"foreign_fqn": "cat.sch.loans", "window_column": "updated_at",
                         "rolling_window_days": 3, "select_columns": ["a", "b"]},
    "row_identity": {"mode": "key_columns", "key_columns": ["a"]},
    "reconciliation": {"enabled": True, "run_on_weekday": "sunday", "max_age_days": 30, "max_delete_pct": 2.5},
}


def test_rolling_and_sweep_from_config():
    spec = RollingSpec.from_config(ROLLING)
    assert (spec.window_column, spec.days, spec.mode, spec.key_columns) == ("updated_at", 3, "key_columns", ("a",))
    sweep = sweep_from_config(ROLLING)
    assert sweep.enabled and sweep.weekday == "sunday" and sweep.max_age_days == 30
    bad = {**ROLLING, "reconciliation": {"enabled": True, "max_age_days": 2}}
    with pytest.raises(ValueError):
        sweep_from_config(bad)                    # scope shorter than the window
    with pytest.raises(ValueError):
        RollingSpec.from_config({**ROLLING, "federated_source": {"foreign_fqn": "x", "window_column": "w",
                                                                 "window_start_anchor": "noon"}})


def test_file_source_from_config():
    src = FileSource.from_config({"source_table": "t", "source_path": "/x", "file_format": "CSV",
                                  "bronze_options": {"csv_options": {"delimiter": "|"}, "file_name_pattern": "*.csv"}})
    assert src.file_format == "csv" and src.reader_options()["sep"] == "|"
    with pytest.raises(ValueError):
        FileSource.from_config({"source_table": "t", "source_path": "/x", "file_format": "csv"})
    with pytest.raises(ValueError):
        FileSource.from_config({"source_table": "t", "source_path": "/x", "file_format": "json",
                                "bronze_options": {"schema_evolution_mode": "sometimes"}})


def test_silver_from_config():
    spec = SilverSpec.from_config({"source_table": "loan_details", "scd_2_key_list": ["id"],
                                   "silver_columns": [{"name": "id"}, {"name": "amt", "rename": "amount"}],
                                   "history_timestamp_source": "amt",
                                   "data_quality_rules": [{"description": "pos", "expr": "amount > 0"}]})
    assert spec.silver_table == "loandetails" and spec.data_quality_rules == (("pos", "amount > 0"),)
    with pytest.raises(ValueError):
        SilverSpec.from_config({"source_table": "t", "scd_2_key_list": ["id"], "scd_type": 3})
    with pytest.raises(ValueError):
        SilverSpec.from_config({"source_table": "t", "scd_2_key_list": ["id"],
                                "silver_columns": [{"name": "id"}], "history_timestamp_source": "nope"})
