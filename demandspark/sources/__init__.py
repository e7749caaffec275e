"""Sources and sinks: declared-schema readers, the events → panel binding, the validated prediction sink."""

from demandspark.sources.panel import PanelBinding, binding_of, load_binding, load_frames, load_panel, panel_from_events, split_panel
from demandspark.sources.readers import read_csv, read_table, read_test_csv, read_train_csv
from demandspark.sources.schemas import ROW_KEY, TARGET, TEST_SCHEMA, TRAIN_SCHEMA

__all__ = ["PanelBinding", "binding_of", "load_binding", "load_frames", "load_panel", "panel_from_events", "split_panel",
           "read_csv", "read_table", "read_test_csv", "read_train_csv", "ROW_KEY", "TARGET", "TEST_SCHEMA",
           "TRAIN_SCHEMA"]
