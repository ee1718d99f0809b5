"""Sources (delimited/line readers) and sinks (report writers)."""

from rankfold.sources.checked import (Checked, check_adjacency, check_items, check_node_names, check_people,
                                      check_ratings, check_readings, check_spend)
from rankfold.sources.readers import (adjacency_entries, read_adjacency, read_items, read_lines,
                                      read_node_names, read_people, read_ratings, read_readings,
                                      read_spend)
from rankfold.sources.sinks import (format_lines, read_tag_report, write_lines, write_similarities,
                                    write_tag_report, write_tag_report_file)

__all__ = ["Checked", "check_adjacency", "check_items", "check_node_names", "check_people",
           "check_ratings", "check_readings", "check_spend", "adjacency_entries", "read_adjacency", "read_items", "read_lines", "read_node_names",
           "read_people", "read_ratings", "read_readings", "read_spend", "format_lines",
           "read_tag_report", "write_lines", "write_similarities", "write_tag_report", "write_tag_report_file"]
