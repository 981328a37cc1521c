from autostrata.sources.files import (
    consolidate,
    file_headers,
    read_fleet,
    read_municipalities,
    read_yearly,
    rejected_lines,
    select_years,
    write_yearly,
    yearly_layouts,
)
from autostrata.sources.pages import container_links, linked_files
from autostrata.sources.tables import full_load, save_table, use_layer

__all__ = [
    "consolidate",
    "container_links",
    "file_headers",
    "full_load",
    "linked_files",
    "read_fleet",
    "read_municipalities",
    "read_yearly",
    "rejected_lines",
    "save_table",
    "select_years",
    "use_layer",
    "write_yearly",
    "yearly_layouts",
]
