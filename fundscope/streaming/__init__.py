"""The activity rules on a stream of activities."""

from .visits import append_visits, read_visit_counts, start_visit_counts, visit_counts, visit_rows

__all__ = ["append_visits", "read_visit_counts", "start_visit_counts", "visit_counts", "visit_rows"]
