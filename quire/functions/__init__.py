"""Column -> Column helpers; all native Catalyst expressions, no Python UDFs."""

from quire.functions.naming import (  # noqa: F401
    flat_name,
    git_dir_name,
    in_build_dir,
    logical_name,
    page_hierarchy,
    page_stem,
    processor_kind,
    source_dir,
    trim_trailing_slashes,
    wiki_dir_name,
)
from quire.functions.text import html_to_markdown, lossy_utf8  # noqa: F401
from quire.functions.pdf import README_PDF_NAME, readme_pdf_stub  # noqa: F401
