"""README item of the ReadmeToPDF processor.

The processor's payload is a fixed placeholder document: the README text is
not rendered.  We keep the README text next to it in ``source_text``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Item name, and a 120-byte placeholder starting with the PDF magic.
README_SOURCE_NAME = "README.md"
README_PDF_NAME = "README.pdf"
PDF_STUB_BYTES = 120
PDF_HEAD = b"%PDF-1.4\n%placeholder document, not rendered from text\n"
PDF_TAIL = b"\n%%EOF\n"
PDF_STUB = PDF_HEAD + b"." * (PDF_STUB_BYTES - len(PDF_HEAD) - len(PDF_TAIL)) + PDF_TAIL


def readme_pdf_stub() -> Column:
    return F.lit(bytearray(PDF_STUB)).cast("binary")
