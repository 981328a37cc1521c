from autostrata.functions.filenames import file_date_parts, link_file_name
from autostrata.functions.text import normalize_name, strip_accents

__all__ = ["file_date_parts", "link_file_name", "normalize_name", "strip_accents"]
