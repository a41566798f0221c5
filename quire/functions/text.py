"""Text transforms: HTML to light markdown, lossy UTF-8 decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results:
# exact, case-sensitive tag replacements, then every remaining tag is deleted.
MARKDOWN_REPLACEMENTS = (
    ("<h1>", "\n# "),
    ("</h1>", "\n"),
    ("<h2>", "\n## "),
    ("</h2>", "\n"),
    ("<h3>", "\n### "),
    ("</h3>", "\n"),
    ("<h4>", "\n#### "),
    ("</h4>", "\n"),
    ("<h5>", "\n##### "),
    ("</h5>", "\n"),
    ("<h6>", "\n###### "),
    ("</h6>", "\n"),
    ("<p>", "\n\n"),
    ("</p>", "\n"),
    ("<br>", "\n"),
    ("<br/>", "\n"),
    ("<ul>", "\n"),
    ("</ul>", "\n"),
    ("<ol>", "\n"),
    ("</ol>", "\n"),
    ("<li>", "- "),
    ("</li>", "\n"),
)
ANY_TAG = "<[^>]+>"


def html_to_markdown(html) -> Column:
    """Light markdown.

    No replacement introduces '<' or '>', so the literal replacements commute
    and only the final tag deletion has to come last.
    """
    out = F.col(html) if isinstance(html, str) else html
    for tag, repl in MARKDOWN_REPLACEMENTS:
        out = F.replace(out, F.lit(tag), F.lit(repl))
    return F.regexp_replace(out, ANY_TAG, "")


def lossy_utf8(content) -> Column:
    """Bytes to text, each invalid UTF-8 sequence replaced by U+FFFD."""
    c = F.col(content) if isinstance(content, str) else content
    return F.make_valid_utf8(c.cast("string"))
