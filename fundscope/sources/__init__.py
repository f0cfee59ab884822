"""Sources and sinks."""

from .goals import GOALS_SCHEMA, rejected_cells, typed_import
from .sinks import checkpoint_dir, publish_view
from .tables import checked_text_csv, literal_rows, read_table, read_text_csv
from .versions import Versions, materialise, register

__all__ = ["GOALS_SCHEMA", "typed_import", "rejected_cells", "read_table", "read_text_csv",
           "checked_text_csv", "literal_rows", "publish_view", "materialise", "checkpoint_dir", "Versions", "register"]
